"""Many elastic-net logistic regressions in lockstep.

A *group* is a set of penalised fits over the same training rows (a fold's
whole penalty path, a tuning grid of one fold).  All fits of all groups move
together, one Spark job per step: tasks compute every fit's loss and gradient
as two matrix products per block of rows, and the curvature at a few of each
group's fits (*knots*); one task per group merges its sums and takes a
proximal Newton step for each fit with the curvature of its nearest knot.  A
fit whose objective rose goes half the way back.  Settled fits leave the job;
the last few have a knot each.  Ten folds of 100 penalties settle in a few
dozen jobs, whatever the number of rows.

Rows are packed once into blocks (numpy arrays as binary columns) of one
*tag*; a group trains on some tags and is scored on others.  The driver
holds coefficients only: its size depends on columns and fits, not on rows.

The problem is Spark ML's with ``standardization=True``: mean log-loss +
penalty * (alpha * |b|_1 + (1 - alpha) / 2 * |b|_2^2) over features divided by
their standard deviation in the group's training rows; the intercept is free.
A column constant in those rows gets coefficient 0.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditlens.operators import penalty_path
from creditlens.session import checkpoint_dir, ship

BLOCK_ROWS = 2_048
KNOTS = 8
MAX_STEPS = 60
TOL = 1e-7        # gain of a step that still counts, in units of the loss without features
MAX_INNER = 30    # alternating steps of one quadratic problem
RHO = 0.3         # weight of the split, in units of the curvature's diagonal
EXPLAINED = 1e-3  # a path's solver ends where this share of the loss is left
BINS = 4_096      # score histogram: bins of the log-odds in [-REACH, REACH]
REACH = 16.0


@dataclass
class Group:
    """Fits ``(penalty, alpha)`` trained on rows of ``train`` tags and scored on rows of ``test`` tags."""
    train: set
    test: set
    points: list[tuple[float, float]]
    mean: np.ndarray = field(default=None, repr=False)
    scale: np.ndarray = field(default=None, repr=False)
    rows: int = 0
    positives: float = 0.0
    null_gradient: np.ndarray = field(default=None, repr=False)
    coef: np.ndarray = field(default=None, repr=False)  # (columns + 1) x fits, standardised, intercept last


def pack(x: DataFrame, label: str, tag: str, features: str = "features") -> DataFrame:
    """Checkpointed blocks (tag, rows, x, y) of a design frame; each holds rows of one tag."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict = {}

        def block(t):
            xs, ys = zip(*held.pop(t))
            m = np.concatenate(xs)
            return t, len(m), np.ascontiguousarray(m).tobytes(), np.concatenate(ys).tobytes()

        for b in batches:
            out = []
            if not len(b):
                continue
            m = np.stack(b["x"].to_numpy())
            y = b["y"].to_numpy(np.float64)
            tags = b["tag"].to_numpy()
            for t in np.unique(tags).tolist():
                at = np.flatnonzero(tags == t)
                for lo in range(0, len(at), BLOCK_ROWS):
                    part = at[lo:lo + BLOCK_ROWS]
                    held.setdefault(t, []).append((m[part], y[part]))
                    if sum(len(v) for _, v in held[t]) >= BLOCK_ROWS:
                        out.append(block(t))
            if out:
                yield pd.DataFrame(out, columns=["tag", "rows", "x", "y"])
        if held:
            yield pd.DataFrame([block(t) for t in list(held)], columns=["tag", "rows", "x", "y"])

    spark = x.sparkSession
    ship(spark)
    checkpoint_dir(spark)
    return x.select(F.col(tag).cast("int").alias("tag"), vector_to_array(features).alias("x"),
                    F.col(label).cast("double").alias("y")) \
        .mapInPandas(run, "tag int, rows int, x binary, y binary").checkpoint()


def _arrays(b: pd.DataFrame) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    for tag, rows, x, y in zip(b["tag"], b["rows"], b["x"], b["y"]):
        yield int(tag), np.frombuffer(x, np.float64).reshape(rows, -1), np.frombuffer(y, np.float64)


def _merged(blocks: DataFrame, partial, add, finish=None) -> dict:
    """{part: merged value}: ``partial`` yields (part, value) over a task's blocks, ``add`` merges two values,
    ``finish`` maps a part's merged value in the task that merged it."""
    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict = {}
        for b in batches:
            for tag, x, y in _arrays(b):
                for part, value in partial(tag, x, y):
                    held[part] = add(held[part], value) if part in held else value
        for part, value in held.items():
            yield pd.DataFrame({"part": [part], "value": [pickle.dumps(value, 5)]})

    def merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict = {}
        for b in batches:
            for part, value in zip(b["part"], b["value"]):
                got = pickle.loads(value)
                held[part] = add(held[part], got) if part in held else got
        for part, value in held.items():
            if finish is not None:
                value = finish(part, value)
            yield pd.DataFrame({"part": [part], "value": [pickle.dumps(value, 5)]})

    kind = "part string, value binary"
    sums = blocks.mapInPandas(emit, kind).repartition("part").mapInPandas(merge, kind)
    return {r["part"]: pickle.loads(r["value"]) for r in sums.collect()}


def _moments(tag, x, y):
    mean = x.mean(axis=0)
    yield str(tag), (len(x), mean, ((x - mean) ** 2).sum(axis=0), y.sum(), y @ x)


def _join_moments(a, b):
    n = a[0] + b[0]
    gap = b[1] - a[1]
    return n, a[1] + gap * (b[0] / n), a[2] + b[2] + gap * gap * (a[0] * b[0] / n), a[3] + b[3], a[4] + b[4]


class Lockstep:
    def __init__(self, blocks: DataFrame, groups: Sequence[Group]):
        self.blocks, self.groups = blocks, list(groups)
        self.jobs = 0
        by_tag = _merged(blocks, _moments, _join_moments)
        self.jobs += 1
        for g in self.groups:
            tags = [by_tag[str(t)] for t in sorted(g.train) if str(t) in by_tag]
            if not tags:
                raise ValueError("a group has no training rows")
            total = tags[0]
            for t in tags[1:]:
                total = _join_moments(total, t)
            g.rows, g.mean, square, g.positives, with_pos = total
            sd = np.sqrt(square / max(g.rows - 1, 1))
            # a column constant in these rows is left out by an infinite scale
            g.scale = np.where(sd > 1e-12 * np.maximum(1.0, np.abs(g.mean)), sd, np.inf)
            share = g.positives / g.rows
            if not 0.0 < share < 1.0:
                raise ValueError("a group's training rows hold one class only")
            # the standardised gradient of the mean loss at the model without features
            g.null_gradient = (g.positives * g.mean - with_pos) / g.scale / g.rows

    def path(self, g: int, n: int, alpha: float = 1.0) -> list[float]:
        """glmnet's penalties: from the least that zeroes every coefficient down to 0.0001 of it (0.01 if rows are few)."""
        group = self.groups[g]
        hi = float(np.max(np.abs(group.null_gradient), initial=0.0)) / max(alpha, 1e-3)
        ratio = 1e-4 if group.rows >= len(group.scale) else 1e-2
        return [hi * ratio ** (i / max(n - 1, 1)) for i in range(n)]

    def fit(self) -> None:
        """Sets every group's ``coef``."""
        states = {}
        for i, g in enumerate(self.groups):
            b = np.zeros((len(g.mean) + 1, len(g.points)))
            b[-1] = np.log(g.positives / (g.rows - g.positives))
            g.coef = b.copy()
            states[i] = State(np.arange(len(g.points)), b, b.copy(), np.full(len(g.points), np.inf))
        spark = self.blocks.sparkSession
        for _ in range(MAX_STEPS):
            if not states:
                return
            sent = spark.sparkContext.broadcast([(i, self.groups[i], s, s.knots()) for i, s in states.items()])
            got = _merged(self.blocks, lambda tag, x, y: _curved(tag, x, y, sent.value), _add,
                          lambda part, sums: _advanced(part, sums, sent.value))
            self.jobs += 1
            sent.destroy()
            states = {}
            for part, (state, done, coef) in got.items():
                g = self.groups[int(part)]
                g.coef[:, done] = coef
                if len(state.live):
                    g.coef[:, state.live] = state.at  # where the search ends if steps run out
                    states[int(part)] = state

    def held_out_loss(self) -> np.ndarray:
        """Log-loss summed over all groups' test rows, per fit (groups of equal points)."""
        sent = self.blocks.sparkSession.sparkContext.broadcast(
            [(frozenset(g.test), g.mean, g.scale, g.coef) for g in self.groups])

        def partial(tag, x, y):
            for test, mean, scale, coef in sent.value:
                if tag in test:
                    eta = ((x - mean) / scale) @ coef[:-1] + coef[-1]
                    yield "all", (np.logaddexp(0.0, eta).sum(axis=0) - y @ eta,)

        got = _merged(self.blocks, partial, _add)["all"][0]
        self.jobs += 1
        sent.destroy()
        return got

    def score_histograms(self) -> list[np.ndarray]:
        """Per group: (fits, classes, BINS) counts of its test rows by log-odds, merged over tasks."""
        sent = self.blocks.sparkSession.sparkContext.broadcast(
            [(frozenset(g.test), g.mean, g.scale, g.coef) for g in self.groups])

        def partial(tag, x, y):
            for i, (test, mean, scale, coef) in enumerate(sent.value):
                if tag not in test:
                    continue
                eta = ((x - mean) / scale) @ coef[:-1] + coef[-1]
                bin_of = np.clip((eta + REACH) * (BINS / (2 * REACH)), 0, BINS - 1).astype(np.int64)
                fits = coef.shape[1]
                cell = (np.arange(fits)[None, :] * 2 + y[:, None].astype(np.int64)) * BINS + bin_of
                yield f"{i}", np.bincount(cell.ravel(), minlength=fits * 2 * BINS).astype(np.int32)

        got = _merged(self.blocks, partial, np.add)
        self.jobs += 1
        sent.destroy()
        return [got[str(i)].reshape(-1, 2, BINS) for i in range(len(self.groups))]


@dataclass
class State:
    """Unsettled fits of a group: their numbers, accepted and proposed coefficients, objective where accepted."""
    live: np.ndarray
    at: np.ndarray
    there: np.ndarray
    value: np.ndarray

    def knots(self) -> np.ndarray:
        """Columns whose curvature is computed; before the first step all fits are one point."""
        n = 1 if np.isinf(self.value).all() else min(KNOTS, len(self.live))
        return np.unique(np.linspace(0, len(self.live) - 1, n).round().astype(int))


def _add(a: tuple, b: tuple) -> tuple:
    return tuple(u + v for u, v in zip(a, b))


def _curved(tag: int, x: np.ndarray, y: np.ndarray, sent: list) -> Iterator[tuple[str, tuple]]:
    """(group, (losses, gradients, curvature per knot)) of one block at the proposed coefficients."""
    for i, g, state, knots in sent:
        if tag not in g.train:
            continue
        z = np.empty((len(x), x.shape[1] + 1))
        np.divide(x - g.mean, g.scale, out=z[:, :-1])
        z[:, -1] = 1.0
        eta = z @ state.there
        p = 1.0 / (1.0 + np.exp(-np.clip(eta, -500, 500)))
        curve = np.empty((len(knots), z.shape[1], z.shape[1]))
        for j, k in enumerate(knots.tolist()):
            weighted = z * np.sqrt(np.maximum(p[:, k] * (1.0 - p[:, k]), 1e-9))[:, None]
            curve[j] = weighted.T @ weighted  # of one array with itself: half the products
        yield str(i), (np.logaddexp(0.0, eta).sum(axis=0) - y @ eta, z.T @ (p - y[:, None]), curve)


def _advanced(part: str, sums: tuple, sent: list) -> tuple[State, np.ndarray, np.ndarray]:
    """(state after one step, numbers of the fits that settled, their coefficients) of a group."""
    _, g, s, knots = next(t for t in sent if str(t[0]) == part)
    loss, grad, curve = (v / g.rows for v in sums)
    l1 = np.array([g.points[k][0] * g.points[k][1] for k in s.live])
    l2 = np.array([g.points[k][0] * (1.0 - g.points[k][1]) for k in s.live])
    now = loss + l1 * np.abs(s.there[:-1]).sum(axis=0) + l2 / 2 * (s.there[:-1] ** 2).sum(axis=0)
    good = now <= s.value + 1e-12
    at, value = np.where(good, s.there, s.at), np.where(good, now, s.value)
    there = (s.at + s.there) / 2  # of fits that rose
    settled = np.zeros(len(s.live), bool)
    share = g.positives / g.rows
    null = -(share * np.log(share) + (1.0 - share) * np.log(1.0 - share))
    nearest = np.abs(np.arange(len(s.live))[:, None] - knots[None, :]).argmin(axis=1)
    for j in range(len(knots)):
        c = np.flatnonzero(good & (nearest == j))
        if len(c):
            there[:, c] = proximal(curve[j], grad[:, c], at[:, c], l1[c], l2[c])
            move = there[:, c] - at[:, c]
            # the next step's gain (at most half of this), or the last one's, is nothing; or all is explained
            settled[c] = (np.einsum("ij,ij->j", move, curve[j] @ move) < TOL * null) \
                | (s.value[c] - now[c] < TOL * null) | (loss[c] < EXPLAINED * null)
    left = ~settled
    return (State(s.live[left], at[:, left], there[:, left], value[left]), s.live[settled], there[:, settled])


def proximal(hess: np.ndarray, grad: np.ndarray, start: np.ndarray, l1: np.ndarray, l2: np.ndarray) -> np.ndarray:
    """Per column: minimiser of grad.d + d.hess.d / 2 + penalties of ``start + d`` (last row free).

    The free row is eliminated.  Alternating directions (one inverse for all
    columns, then a soft threshold) find most signs; feature-sign search ends
    exactly, also where columns are nearly dependent.
    """
    h0, h00 = hess[:-1, -1], hess[-1, -1]
    h = hess[:-1, :-1] - np.outer(h0, h0) / h00
    whole = grad - hess @ start
    lin = whole[:-1] - np.outer(h0, whole[-1]) / h00
    d = np.diag(h).copy()
    free = np.flatnonzero(d > 1e-10)
    d[d <= 1e-10] = 1.0  # a column without spread: its coefficient stays 0
    weight = (RHO * d)[:, None]
    inverse = np.linalg.inv(h + np.diag(weight[:, 0]))
    cut, shrink = l1 / weight, 1.0 / (1.0 + l2 / weight)
    z, u = start[:-1].copy(), np.zeros_like(lin)
    for _ in range(MAX_INNER):
        x = 1.6 * (inverse @ (weight * (z - u) - lin)) - 0.6 * z
        v = x + u
        z = np.sign(v) * np.maximum(np.abs(v) - cut, 0.0) * shrink
        u = v - z
    for c in range(z.shape[1]):
        exact = penalty_path.feature_sign(h, lin[:, c], z[:, c], float(l1[c]), float(l2[c]), free)
        if exact is not None:
            z[:, c] = exact
    return np.vstack([z, -(whole[-1] + h0 @ z)[None, :] / h00])


def resampled(hist: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ROC, Sens, Spec) per fit of a (fits, classes, BINS) histogram.

    ``Sens`` is the share of class 0 kept and ``Spec`` of class 1 caught at
    probability 0.5 (the first class is the event, as in ``twoClassSummary``).
    """
    neg, pos = hist[:, 0].astype(float), hist[:, 1].astype(float)
    below = np.cumsum(neg, axis=1) - neg
    n0, n1 = neg.sum(axis=1), pos.sum(axis=1)
    with np.errstate(invalid="ignore", divide="ignore"):
        roc = (pos * (below + neg / 2)).sum(axis=1) / (n0 * n1)
        return roc, neg[:, :BINS // 2].sum(axis=1) / n0, pos[:, BINS // 2:].sum(axis=1) / n1
