"""Unpenalised logistic regression with aliased columns and standard errors.

``glm`` leaves out a design column that depends linearly on earlier ones and
reports it as NA.  The triangular factor of the whole design is a tree of
tall-skinny QR factors: every task factors its blocks, factors are stacked and
factored again in pairs, and the driver gets one square matrix (columns +
intercept).  Its columns, taken in order, show which ones depend on the kept
ones before them, exactly as those of the design would.

The fit takes Newton steps (iteratively reweighted least squares) on the kept
columns: one Spark aggregate of loss, gradient and curvature per step, ended
as ``glm`` does by the relative change of the deviance.  Standard errors come
from the last curvature.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from creditlens.operators.lockstep import _add, _merged

TOL = 1e-9       # part of a column's length that earlier columns must leave over
EPSILON = 1e-8   # fixed value: glm's relative change of the deviance
MAX_STEPS = 25   # fixed value: glm's limit


@dataclass
class GlmFit:
    names: list[str]               # intercept first
    coefficient: list[float | None]
    std_error: list[float | None]  # None where aliased
    rank: int
    deviance: float
    converged: bool
    steps: int


def triangle(blocks: DataFrame) -> np.ndarray:
    """R of the QR factors of (1, x) over all rows, by stacked factors."""
    def partial(tag, x, y):
        yield "r", np.linalg.qr(np.column_stack([np.ones(len(x)), x]), mode="r")

    return _merged(blocks, partial, lambda a, b: np.linalg.qr(np.vstack([a, b]), mode="r"))["r"]


def independent(r: np.ndarray, tol: float = TOL) -> list[int]:
    """Columns that do not depend on kept earlier ones."""
    kept: list[int] = []
    basis = np.zeros((r.shape[0], 0))
    for j in range(r.shape[1]):
        c = r[:, j]
        length = float(np.linalg.norm(c))
        rest = c - basis @ (basis.T @ c)
        rest = rest - basis @ (basis.T @ rest)  # once more: rounding of the first pass
        left = float(np.linalg.norm(rest))
        if length > 0 and left > tol * length:
            kept.append(j)
            basis = np.column_stack([basis, rest / left])
    return kept


def fit_glm(blocks: DataFrame, names: list[str]) -> GlmFit:
    """``blocks`` of ``lockstep.pack`` (all rows train) and the names of their columns."""
    spark = blocks.sparkSession
    r = triangle(blocks)
    kept = independent(r)
    scale = np.array([float(np.linalg.norm(r[:, j])) for j in kept])

    def sums(b: np.ndarray) -> tuple:
        sent = spark.sparkContext.broadcast(b)

        def partial(tag, x, y):
            z = np.column_stack([np.ones(len(x)), x])[:, kept] / scale
            eta = z @ sent.value
            p = 1.0 / (1.0 + np.exp(-np.clip(eta, -500, 500)))
            w = np.maximum(p * (1.0 - p), 1e-12)
            yield "s", (float(np.sum(np.logaddexp(0.0, eta) - y * eta)), z.T @ (p - y), (z * w[:, None]).T @ z)

        got = _merged(blocks, partial, _add)["s"]
        sent.destroy()
        return got

    b = np.zeros(len(kept))
    loss, grad, curve = sums(b)
    converged, steps = False, 0
    while steps < MAX_STEPS and not converged:
        steps += 1
        move = np.linalg.solve(curve, -grad)
        size = 1.0
        while True:
            there = sums(b + size * move)
            if there[0] <= loss + 1e-9 * (abs(loss) + 0.1) or size < 1e-6:
                break
            size /= 2
        converged = abs(2 * there[0] - 2 * loss) / (abs(2 * there[0]) + 0.1) < EPSILON
        b, (loss, grad, curve) = b + size * move, there
    error = np.sqrt(np.diag(np.linalg.inv(curve))) / scale
    at = {j: i for i, j in enumerate(kept)}
    every = range(len(names) + 1)
    return GlmFit(["(Intercept)", *names], [float(b[at[j]] / scale[at[j]]) if j in at else None for j in every],
                  [float(error[at[j]]) if j in at else None for j in every], len(kept), 2 * loss, converged, steps)


def coefficient_table(spark: SparkSession, fit: GlmFit) -> DataFrame:
    """(Feature, Coefficient, Std_Error, z_value, aliased), one row per design column and the intercept."""
    rows = [(n, c, e, None if c is None else c / e, c is None)
            for n, c, e in zip(fit.names, fit.coefficient, fit.std_error)]
    return spark.createDataFrame(rows, "Feature string, Coefficient double, Std_Error double, z_value double, "
                                       "aliased boolean")
