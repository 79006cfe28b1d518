"""SMOTE's neighbours against exact ones, at two sizes and beside far-away rows."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from creditlens.operators import modeling
from creditlens.operators.smote import _Asking, _nearest, _neighbours, copies_per_vector, smote


def _exact(x, k):
    d = ((x[:, None, :] - x[None, :, :]) ** 2).sum(axis=2)
    np.fill_diagonal(d, np.inf)
    return {i: set(np.argsort(d[i])[:k].tolist()) for i in range(len(x))}


def _sets(rows):
    out = {}
    for r in rows:
        out.setdefault(r["_nrep"], set()).add(r["_b"])
    return out


@pytest.mark.parametrize("n", [300, 1500])
def test_neighbours_are_exact(spark, n):
    x = np.random.default_rng(n).normal(size=(n, 20))
    x[: n // 2] *= 0.01  # half the rows in one dense spot
    mino = spark.createDataFrame([(i, Vectors.dense(v)) for i, v in enumerate(x)], ["id", "features"])
    _, nn, _ = _neighbours(mino, "id", "features", 5, 200)
    z = (x - x.mean(axis=0)) / x.std(axis=0, ddof=1)
    assert _sets(nn.collect()) == _exact(z, 5)


@pytest.mark.parametrize("n", [400, 2500])
@pytest.mark.parametrize("pivot_rows,block_rows", [(16, 50), (64, 2_000)])
def test_pruned_join_equals_brute_force(spark, n, pivot_rows, block_rows):
    """Whole neighbour lists, ties by id, on clustered data with equal distances; few copies."""
    rng = np.random.default_rng(n)
    x = np.round(8 * rng.normal(size=(n, 4)) + 320 * rng.integers(0, 12, size=(n, 1))) / 8  # exact in binary
    _, first = np.unique(x, axis=0, return_index=True)
    x = x[np.sort(first)]
    uniq = spark.createDataFrame([(i, 1, v.tolist()) for i, v in enumerate(x)],
                                 "_rep long, _dup long, _key array<double>")
    best = {}
    for r in _nearest(uniq, 5, block_rows, pivot_rows).collect():
        best.setdefault(r["_nrep"], []).append((r["_d"], r["_b"]))
    assert len(best) == len(x)
    for i in range(len(x)):
        d = np.sqrt(((x - x[i]) ** 2).sum(axis=1))
        want = sorted((round(float(d[j]), 9), j) for j in range(len(x)) if j != i)[:5]
        assert [(round(a, 9), b) for a, b in sorted(best[i])[:5]] == want
    cost = copies_per_vector(uniq, 5, block_rows, pivot_rows).first()
    assert cost["vectors"] == len(x) and cost["asking"] < cost["blocks"] * len(x) / 2


def test_far_rows_change_nothing(spark):
    x = np.random.default_rng(1).normal(size=(100, 8))
    far = np.random.default_rng(2).normal(size=(150, 8)) + 1000
    made = [[(i, 1, v.tolist()) for i, v in enumerate(y)] for y in (x, np.vstack([x, far]))]
    alone, beside = (spark.createDataFrame(m, "_rep long, _dup long, _key array<double>") for m in made)
    few = _sets(_nearest(alone, 5).collect())
    k = 5
    near = sorted(_nearest(beside, k, 40).where(F.col("_nrep") < 100).collect(), key=lambda r: (r["_nrep"], r["_d"]))
    kept = {}
    for r in near:
        kept.setdefault(r["_nrep"], []).append(r["_b"])
    assert {i: set(b[:k]) for i, b in kept.items()} == few


def test_single_minority_row_raises(spark):
    df = spark.createDataFrame([(1, 1, Vectors.dense([0.0])), (2, 0, Vectors.dense([1.0]))], ["id", "y", "f"])
    with pytest.raises(ValueError):
        smote(df, "id", "f", "y")


def test_vectors_meet_without_a_shuffle_per_pair(spark):
    """Vectors that no bound separates are not copied to every block: stored chunks meet in a Cartesian product."""
    x = np.random.default_rng(4).normal(size=(900, 20))
    uniq = spark.createDataFrame([(i, 1, v.tolist()) for i, v in enumerate(x)], "_rep long, _dup long, _key array<double>")
    near = _nearest(uniq, 5, 60, 16)
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" in plan and "Exchange" not in plan
    best = {}
    for r in sorted(near.collect(), key=lambda r: (r["_nrep"], r["_d"], r["_b"])):
        best.setdefault(r["_nrep"], []).append(r["_b"])
    assert {i: set(b[:5]) for i, b in best.items()} == _exact(x, 5)


def test_design_rows_run_their_input_once(spark):
    runs = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            runs.add(len(b))
            yield b

    df = spark.range(100).selectExpr("id as SK_ID_CURR", "cast(id % 2 as int) as TARGET") \
        .mapInPandas(counted, "SK_ID_CURR long, TARGET int")
    assert modeling.design_rows(df, ("SK_ID_CURR", "TARGET")).count() == 100
    assert runs.value == 100


def test_a_forests_rows_keep_as_many_partitions_as_slots(spark):
    df = spark.range(0, 40_000, 1, 16)
    slots = spark.sparkContext.defaultParallelism
    assert modeling.right_size(df, spread=True).rdd.getNumPartitions() == min(slots, 8)
    assert modeling.right_size(spark.range(0, 900, 1, 16), spread=True).rdd.getNumPartitions() == 1


@pytest.mark.parametrize("kind, kinds", [("spread", {np.float32}), ("clusters", {np.float32, np.float64}),
                                         ("huge", {np.float64})])
def test_products_of_single_precision_lose_no_neighbour(monkeypatch, kind, kinds):
    """Also where single precision cannot tell vectors apart, or cannot hold their squares."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(240, 12))
    if kind == "clusters":
        x = np.repeat(rng.normal(size=(4, 12)) * 1e4, 60, axis=0) + x * 1e-3
    elif kind == "huge":
        x *= 1e16
    seen, opened = [], _Asking._open
    monkeypatch.setattr(_Asking, "_open", lambda self, *a: seen.append(a[-1]) or opened(self, *a))
    ids = rng.permutation(240)
    asking = _Asking(0, 5, ids[:80], x[:80])
    for lo in range(0, 240, 60):
        asking.meet(ids[lo:lo + 60], np.ones(60, np.int64), x[lo:lo + 60])
    assert set(seen) == kinds
    got = asking.nearest().groupby("_nrep")["_b"].apply(list).to_dict()
    for i in range(80):
        far = np.sqrt(((x - x[i]) ** 2).sum(axis=1))
        far[i] = np.inf
        assert got[ids[i]] == ids[np.lexsort((ids, far))[:5]].tolist()
