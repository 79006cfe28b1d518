"""Elastic-net logistic regression along a penalty path (glmnet's problem).

``path`` minimises, for each penalty from the largest down, mean log-loss +
penalty * (alpha * |b|_1 + (1 - alpha) / 2 * |b|_2^2) over standardised
features and a free intercept, the objective of Spark ML's
``LogisticRegression(standardization=True)``.  Each Newton step asks ``stats``
for loss, gradient and Hessian at a point, solves the penalised quadratic by
coordinate sweeps and feature-sign search and starts from the neighbouring penalty's solution; steps
are halved until the objective does not rise.  ``stats`` may work on arrays
or be a Spark aggregate.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np

TOL = 1e-8        # of the mean log-loss
MAX_NEWTON = 50
MAX_SWEEPS = 10_000


def descend(hess: np.ndarray, grad: np.ndarray, start: np.ndarray, l1: float, l2: float, tol: float) -> np.ndarray:
    """Minimiser of grad.(b - start) + (b - start).hess.(b - start)/2 + l1 |b|_1 + l2 |b|_2^2 / 2.

    A few sweeps over the coordinates find most signs; feature-sign search
    (a linear solve per set of signs) ends exactly where sweeps converge slowly.
    """
    b, diag, r = start.tolist(), np.diag(hess).tolist(), grad.copy()
    every = [j for j, h in enumerate(diag) if h > 1e-12]

    def sweep(todo) -> float:
        moved = 0.0
        for j in todo:
            h, old = diag[j], b[j]
            z = h * old - r.item(j)
            new = (z - l1 if z > l1 else z + l1 if z < -l1 else 0.0) / (h + l2)
            if new != old:
                r[:] += (new - old) * hess[j]
                b[j] = new
                moved = max(moved, h * (new - old) ** 2)
        return moved

    for _ in range(4):
        if sweep(every) < tol:
            return np.array(b)
    found = feature_sign(hess, grad - hess @ start, np.array(b), l1, l2, np.array(every))
    if found is not None:
        return found
    for _ in range(MAX_SWEEPS):
        if sweep(every) < tol:
            break
    return np.array(b)


def feature_sign(hess: np.ndarray, lin: np.ndarray, b: np.ndarray, l1: float, l2: float,
                 free: np.ndarray) -> np.ndarray | None:
    """Minimiser of b.hess.b/2 + lin.b + l1 |b|_1 + l2 |b|_2^2 / 2; None if it does not end."""
    full = hess + (l2 + 1e-10) * np.eye(len(b))
    sign = np.sign(b)
    slack = 1e-9 + 1e-6 * l1

    def cost(v):
        return 0.5 * v @ full @ v + lin @ v + l1 * np.abs(v).sum()

    for _ in range(20 * len(b) + 100):
        g = full @ b + lin
        act = np.flatnonzero(sign)
        if not len(act) or np.max(np.abs(g[act] + l1 * sign[act])) <= slack:
            out = free[sign[free] == 0]
            over = np.abs(g[out]) - l1
            if not len(out) or over.max() <= slack:
                return b
            j = out[int(np.argmax(over))]
            sign[j] = -np.sign(g[j])
            act = np.flatnonzero(sign)
        try:
            goal = np.linalg.solve(full[np.ix_(act, act)], -(lin[act] + l1 * sign[act]))
        except np.linalg.LinAlgError:
            return None
        here = b[act]
        cross = (here != 0) & (np.sign(goal) != np.sign(here))
        best, least = None, np.inf
        for t in [1.0, *np.unique(here[cross] / (here[cross] - goal[cross])).tolist()]:
            v = b.copy()
            v[act] = here + t * (goal - here)
            v[act[cross]] = np.where(np.isclose(here[cross] / (here[cross] - goal[cross]), t, rtol=0, atol=1e-15),
                                     0.0, v[act[cross]])
            c = cost(v)
            if c < least:
                best, least = v, c
        if least >= cost(b):
            return None
        b, sign = best, np.sign(best)
    return None


def array_stats(x: np.ndarray, y: np.ndarray) -> Callable:
    """``stats`` over arrays: (mean log-loss, gradient, Hessian) with the intercept last."""
    x1 = np.column_stack([x, np.ones(len(x))])

    def at(b: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        return tuple(v / len(y) for v in sums(x1, y, b))

    return at


def sums(x1: np.ndarray, y: np.ndarray, b: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Log-loss, gradient and Hessian summed over rows (``x1`` has a last column of ones)."""
    eta = x1 @ b
    p = 1.0 / (1.0 + np.exp(-np.clip(eta, -500, 500)))
    w = np.maximum(p * (1.0 - p), 1e-6)
    return float(np.sum(np.logaddexp(0.0, eta) - y * eta)), x1.T @ (p - y), (x1 * w[:, None]).T @ x1


def path(stats: Callable, width: int, share: float, penalties: Sequence[float], alpha: float) -> Iterator[np.ndarray]:
    """Coefficients (standardised features, intercept last) per penalty, in the order given (largest first)."""
    b = np.zeros(width + 1)
    b[-1] = np.log(share / (1.0 - share))
    loss, grad, hess = stats(b)
    for penalty in penalties:
        l1, l2 = penalty * alpha, penalty * (1.0 - alpha)

        def cost(loss, b):
            return loss + l1 * np.abs(b[:-1]).sum() + l2 / 2 * float(b[:-1] @ b[:-1])

        for _ in range(MAX_NEWTON):
            h0, h00 = hess[:-1, -1], hess[-1, -1]  # the intercept is solved for, not penalised
            new = descend(hess[:-1, :-1] - np.outer(h0, h0) / h00, grad[:-1] - h0 * grad[-1] / h00,
                          b[:-1], l1, l2, TOL / 100)
            step = np.append(new - b[:-1], -(grad[-1] + h0 @ (new - b[:-1])) / h00)
            now, size = cost(loss, b), 1.0
            while True:
                there = b + size * step
                got = stats(there)
                gain = now - cost(got[0], there)
                if gain >= 0 or size < 1e-4:
                    break
                size /= 2
            if gain >= 0:
                b, (loss, grad, hess) = there, got
            if gain < TOL:
                break
        yield b.copy()


def standardised(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(centred and scaled features, means, scales); a constant column becomes 0 (scale 1)."""
    mean, scale = x.mean(axis=0), x.std(axis=0, ddof=1)
    flat = ~(scale > 1e-12)
    scale = np.where(flat, 1.0, scale)
    return np.where(flat, 0.0, (x - mean) / scale), mean, scale
