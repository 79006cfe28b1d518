"""Penalty paths against Spark ML's solver, and the registered grid's size."""

import inspect
import random

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from creditlens.operators import lockstep, modeling, penalty_path, sampling
from creditlens.plans import training


def _design(spark, n=400, d=6, seed=5):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        x = [rng.gauss(0, 1 + j) for j in range(d)]
        x[1] += 0.8 * x[0]
        rows.append((i, int(rng.random() < 1 / (1 + np.exp(2 - x[0] + 0.3 * x[2]))), Vectors.dense(x)))
    return spark.createDataFrame(rows, ["SK_ID_CURR", "TARGET", "features"])


def test_default_grid_is_twenty_by_twenty():
    for f in (training.tune_grid, training.tuned_grid, training.final_fit):
        n = inspect.signature(f).parameters["tune_length"].default
        assert n == 20 and len(set(training.grid_points([0.5 ** i for i in range(n)]))) == 400


@pytest.mark.parametrize("alpha", [0.1, 1.0])
def test_path_agrees_with_spark_ml(spark, alpha):
    df = _design(spark).persist()
    got = df.select(vector_to_array("features").alias("x"), "TARGET").collect()
    x, y = np.array([r.x for r in got]), np.array([float(r.TARGET) for r in got])
    z, mean, scale = penalty_path.standardised(x)
    regs = [0.1, 0.02, 0.001]
    for reg, b in zip(regs, penalty_path.path(penalty_path.array_stats(z, y), 6, y.mean(), regs, alpha)):
        m = modeling.logistic(reg, alpha, 1000).setTol(1e-12).fit(df)
        coef = b[:-1] / scale
        assert np.allclose(coef, m.coefficients.toArray(), atol=1e-4)
        assert abs(b[-1] - coef @ mean - m.intercept) < 1e-4


def _tagged(df, tags=3):
    return df.withColumn("tag", F.pmod("SK_ID_CURR", F.lit(tags)))


@pytest.mark.parametrize("alpha", [0.1, 1.0])
def test_lockstep_agrees_with_spark_ml(spark, alpha):
    """Every group's every fit equals Spark ML's fit on the same rows, for blocks of any size."""
    df = _tagged(_design(spark)).persist()
    regs = [0.2, 0.1, 0.05, 0.02, 0.01, 0.005, 0.001, 0.0001]
    groups = [lockstep.Group({0, 1, 2}, set(), [(r, alpha) for r in regs]),
              lockstep.Group({0, 1}, {2}, [(r, alpha) for r in regs])]
    fit = lockstep.Lockstep(lockstep.pack(df.repartition(5), "TARGET", "tag"), groups)
    fit.fit()
    assert fit.jobs < 30
    for g, rows in zip(groups, (df, df.where("tag < 2"))):
        for i in (1, 3, 6):
            m = modeling.logistic(regs[i], alpha, 1000).setTol(1e-12).fit(rows)
            coef = g.coef[:-1, i] / g.scale
            assert np.allclose(coef, m.coefficients.toArray(), atol=1e-4)
            assert abs(g.coef[-1, i] - coef @ g.mean - m.intercept) < 1e-4


def test_lockstep_agrees_with_single_paths(spark):
    df = _tagged(_design(spark, n=700, d=12)).persist()
    got = df.select(vector_to_array("features").alias("x"), "TARGET", "tag").collect()
    x, y, tag = (np.array([r[c] for r in got], float) for c in ("x", "TARGET", "tag"))
    fit = lockstep.Lockstep(lockstep.pack(df, "TARGET", "tag"),
                            [lockstep.Group({0, 1, 2} - {t}, {t}, []) for t in range(3)])
    regs = fit.path(0, 40)
    for g in fit.groups:
        g.points = [(r, 1.0) for r in regs]
    fit.fit()
    want = np.zeros(40)
    for t in range(3):
        z, mean, scale = penalty_path.standardised(x[tag != t])
        train = y[tag != t]
        for i, b in enumerate(penalty_path.path(penalty_path.array_stats(z, train), 12, train.mean(), regs, 1.0)):
            assert np.allclose(fit.groups[t].coef[:, i], b, atol=2e-3)
            eta = (x[tag == t] - mean) / scale @ b[:-1] + b[-1]
            want[i] += np.sum(np.logaddexp(0, eta) - y[tag == t] * eta)
    assert np.allclose(fit.held_out_loss(), want, rtol=1e-5)


def test_nearly_dependent_and_constant_columns_settle(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(300, 4))
    x = np.column_stack([base, base[:, 0] + 1e-6 * rng.normal(size=300), np.ones(300), np.eye(300)[:, 0]])
    y = (rng.random(300) < 1 / (1 + np.exp(-base[:, 0]))).astype(int)
    df = spark.createDataFrame([(i, int(t), Vectors.dense(r.tolist())) for i, (r, t) in enumerate(zip(x, y))],
                               ["SK_ID_CURR", "TARGET", "features"])
    fit = lockstep.Lockstep(lockstep.pack(_tagged(df, 1), "TARGET", "tag"), [lockstep.Group({0}, set(), [])])
    fit.groups[0].points = [(r, 1.0) for r in fit.path(0, 100)]
    fit.fit()
    coef = fit.groups[0].coef
    assert fit.jobs < lockstep.MAX_STEPS and np.isfinite(coef).all()
    assert not coef[5].any() and not coef[:-1, 0].any()


def test_histograms_give_roc_sens_and_spec(spark):
    df = _tagged(_design(spark, n=500), 2).persist()
    points = [(0.05, 0.5), (0.001, 1.0)]
    fit = lockstep.Lockstep(lockstep.pack(df, "TARGET", "tag"), [lockstep.Group({0}, {1}, points)])
    fit.fit()
    roc, sens, spec = lockstep.resampled(fit.score_histograms()[0])
    got = df.where("tag = 1").select(vector_to_array("features").alias("x"), "TARGET").collect()
    x, y = np.array([r.x for r in got]), np.array([r.TARGET for r in got])
    g = fit.groups[0]
    for i in range(2):
        eta = (x - g.mean) / g.scale @ g.coef[:-1, i] + g.coef[-1, i]
        pos, neg = eta[y == 1], eta[y == 0]
        auc = np.mean((pos[:, None] > neg) + 0.5 * (pos[:, None] == neg))
        assert abs(roc[i] - auc) < 2e-3
        assert sens[i] == np.mean(neg < 0) and spec[i] == np.mean(pos >= 0)


def test_tuning_rows_and_columns(spark):
    df = _design(spark, n=300).select("SK_ID_CURR", "TARGET", *[vector_to_array("features")[j].alias(f"x{j}")
                                                                 for j in range(6)])
    grid = training.tune_grid(spark, df, [f"x{j}" for j in range(6)], [], tune_length=4)
    rows = grid.collect()
    assert len(rows) == 32 and {r.sampling for r in rows} == {"none", "smote"}
    regs = sorted({r.regParam for r in rows})
    assert len(regs) == 4 and np.allclose(np.diff(np.log(regs)), np.log(regs[1] / regs[0]))
    assert all(0 <= v <= 1 for r in rows for v in (r.cv_auc, r.Sens, r.Spec, r.ROCSD, r.SensSD, r.SpecSD))
    best = {r.Model: r for r in training.tune_comparison(grid).collect()}
    for arm, name in (("none", "LASSO (No Sampling)"), ("smote", "LASSO (SMOTE)")):
        assert best[name].CV_AUC == max(r.cv_auc for r in rows if r.sampling == arm)
    assert any(r.best for r in best.values())


def test_lasso_with_defaults_takes_few_jobs(spark):
    """100 penalties and 10 folds, as registered."""
    rng = np.random.default_rng(1)
    x = rng.normal(size=(600, 20))
    y = (rng.random(600) < 1 / (1 + np.exp(2 - x[:, 0] - x[:, 1]))).astype(int)
    names = [f"x{j}" for j in range(20)]
    df = spark.createDataFrame([(i, int(t), *map(float, r)) for i, (r, t) in enumerate(zip(x, y))],
                               ["SK_ID_CURR", "TARGET", *names])
    folded = sampling.kfold_assign(df.select("SK_ID_CURR", "TARGET", array_to_vector(F.array(*names))
                                             .alias("features")), "SK_ID_CURR", 10, 42)
    jobs = []
    held_out = lockstep.Lockstep.held_out_loss

    def counted(self):
        out = held_out(self)
        jobs.append(self.jobs)
        return out

    lockstep.Lockstep.held_out_loss = counted
    try:
        modeling.best_penalty(folded, 10)
    finally:
        lockstep.Lockstep.held_out_loss = held_out
    assert jobs[0] < 40
    m = modeling.cv_lasso(df, names, [])
    coef = dict(zip(m.attribute_names(), m.model.stages[-1].coefficients.toArray()))
    assert coef["x0"] > 0.3 and coef["x1"] > 0.3


def test_workers_get_the_package_from_any_folder(tmp_path):
    """A session started elsewhere runs the learned queries' Python stages without another query before."""
    import os
    import subprocess
    import sys

    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = f"""
import sys
sys.path.insert(0, {top!r})
from creditlens.session import get_spark
spark = get_spark("local[2]", 2)
import __spark_entry__ as e
q = e.queries()
print("rows", q["fit_lasso_cv"](spark, "/root/testdata/sf0.001").count())
print("rows", q["smote"](spark, "/root/testdata/sf0.001").count())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert out.stdout.count("rows") == 2, out.stderr[-2000:]


def test_lasso_path_comes_from_the_data(spark):
    defaults = inspect.signature(modeling.cv_lasso).parameters
    assert (defaults["n_lambda"].default, defaults["inner_folds"].default) == (100, 10)
    df = _design(spark).select("SK_ID_CURR", "TARGET", *[vector_to_array("features")[j].alias(f"x{j}") for j in range(6)])
    names = [f"x{j}" for j in range(6)]
    got = df.collect()
    x, y = np.array([[r[c] for c in names] for r in got]), np.array([float(r.TARGET) for r in got])
    z, _, _ = penalty_path.standardised(x)
    m = modeling.cv_lasso(df, names, [], n_lambda=8, inner_folds=3)
    hi = np.max(np.abs(z.T @ (y - y.mean()))) / len(y)
    assert min(abs(m.model.stages[-1].getRegParam() / r - 1) for r in modeling.lambda_grid(8, hi, 1e-4)) < 1e-9
    assert m.nonzero() > 0


def test_curvature_is_a_product_of_one_array_with_itself():
    """Half the products: exactly symmetric, and right."""
    rng = np.random.default_rng(6)
    x, y = rng.normal(size=(500, 30)), (rng.random(500) < 0.3).astype(float)
    g = lockstep.Group({0}, set(), [(0.1, 1.0)], x.mean(axis=0), x.std(axis=0, ddof=1), 500, y.sum())
    state = lockstep.State(np.arange(1), rng.normal(size=(31, 1)), rng.normal(size=(31, 1)), np.full(1, np.inf))
    (_, (_, _, curve)), = lockstep._curved(0, x, y, [(0, g, state, np.array([0]))])
    z = np.column_stack([(x - g.mean) / g.scale, np.ones(500)])
    p = 1 / (1 + np.exp(-(z @ state.there[:, 0])))
    assert np.allclose(curve[0], (z * (p * (1 - p))[:, None]).T @ z)
    assert np.array_equal(curve[0], curve[0].T)
