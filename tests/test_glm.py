"""Unpenalised logistic regression: aliased columns, rank and standard errors against numpy."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from creditlens.operators import glm, lockstep


def _blocks(spark, x, y, parts):
    df = spark.createDataFrame([(int(t), Vectors.dense(r.tolist())) for r, t in zip(x, y)], ["y", "features"])
    return lockstep.pack(df.repartition(parts).withColumn("tag", F.lit(0)), "y", "tag")


def _irls(z, y):
    b = np.zeros(z.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-z @ b))
        h = (z * (p * (1 - p))[:, None]).T @ z
        b = b + np.linalg.solve(h, z.T @ (y - p))
    return b, np.sqrt(np.diag(np.linalg.inv(h)))


@pytest.mark.parametrize("parts", [1, 6])
def test_dependent_columns_are_left_out(spark, parts):
    rng = np.random.default_rng(2)
    n = 900
    a = rng.normal(size=(n, 3)) * [1, 1e5, 1e-3]
    dummies = np.eye(4)[rng.integers(0, 4, n)]                # all four: the last depends on the intercept
    x = np.column_stack([a, a[:, 0] + 2 * a[:, 2], dummies, np.full(n, 3.0), np.zeros(n)])
    y = (rng.random(n) < 1 / (1 + np.exp(1 - a[:, 0] - dummies[:, 1]))).astype(float)
    names = [f"c{i}" for i in range(x.shape[1])]
    fit = glm.fit_glm(_blocks(spark, x, y, parts), names)
    z = np.column_stack([np.ones(n), x])
    assert fit.rank == np.linalg.matrix_rank(z / np.maximum(np.linalg.norm(z, axis=0), 1e-300)) == 7
    gone = {nm for nm, c in zip(fit.names, fit.coefficient) if c is None}
    assert gone == {"c3", "c7", "c8", "c9"} and fit.converged
    keep = [i for i, c in enumerate(fit.coefficient) if c is not None]
    scale = np.linalg.norm(z[:, keep], axis=0)
    b, se = _irls(z[:, keep] / scale, y)
    assert np.allclose([fit.coefficient[i] for i in keep], b / scale, rtol=1e-6)
    assert np.allclose([fit.std_error[i] for i in keep], se / scale, rtol=1e-4)
    p = 1 / (1 + np.exp(-(z[:, keep] / scale) @ b))
    assert abs(fit.deviance + 2 * np.sum(y * np.log(p) + (1 - y) * np.log(1 - p))) < 1e-6
    table = {r.Feature: r for r in glm.coefficient_table(spark, fit).collect()}
    assert table["c3"].aliased and table["c3"].Std_Error is None and abs(table["c0"].z_value) > 2


def test_triangle_of_any_split(spark):
    x = np.random.default_rng(5).normal(size=(5_000, 6))
    r = glm.triangle(_blocks(spark, x, np.zeros(5_000), 4))
    z = np.column_stack([np.ones(5_000), x])
    assert np.allclose(r.T @ r, z.T @ z, rtol=1e-9)
    assert glm.independent(r) == list(range(7))
