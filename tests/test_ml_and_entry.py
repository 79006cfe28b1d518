"""Learned operators on synthetic data, and the driver contract."""

import random

import duckdb
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from conftest import SF001
from creditlens.operators import modeling
from creditlens.operators.smote import smote
from creditlens.plans import training


def _separable(spark, n=600, seed=3):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        y = 1 if i % 5 == 0 else 0
        x1 = rng.gauss(2.0 if y else -2.0, 0.7)
        rows.append((i, y, x1, rng.gauss(0, 1), "a" if rng.random() < 0.5 else "b"))
    return spark.createDataFrame(rows, "SK_ID_CURR long, TARGET int, x1 double, noise double, g string")


def test_logistic_separates(spark):
    df = _separable(spark)
    m = modeling.fit(df, modeling.logistic(), ["x1", "noise"], ["g"])
    assert training.auc_of(m.score(df)) > 0.95
    assert m.attribute_names() == ["x1", "noise", "g_b"]


def test_l1_zeroes_noise(spark):
    df = _separable(spark)
    m = modeling.fit(df, modeling.logistic(reg=0.05, alpha=1.0), ["x1", "noise"], [])
    coef = dict(zip(m.attribute_names(), m.model.stages[-1].coefficients.toArray()))
    assert coef["noise"] == 0.0 and coef["x1"] != 0.0


def test_unseen_level_is_mapped(spark):
    df = _separable(spark)
    m = modeling.fit(df, modeling.logistic(), ["x1", "noise"], ["g"])
    new = df.limit(3).withColumn("g", F.lit("zzz"))
    assert m.score(new).count() == 3


def test_smote_points_on_segments(spark):
    rows = [(i, 1, Vectors.dense([float(i), float(2 * i)])) for i in range(1, 21)] + \
           [(100 + i, 0, Vectors.dense([50.0 + i, 0.0])) for i in range(200)]
    from pyspark.ml.linalg import VectorUDT
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("SK_ID_CURR", T.LongType()), T.StructField("TARGET", T.IntegerType()),
                           T.StructField("features", VectorUDT())])
    df = spark.createDataFrame(rows, schema)
    out = smote(df, "SK_ID_CURR", "features", "TARGET", k=3, seed=1)
    syn = out.where("synthetic").select(vector_to_array("features").alias("x")).collect()
    assert len(syn) == 40
    for r in syn:  # minority rows lie on the line y = 2x between 1 and 20
        x, y = r.x
        assert 1 - 1e-9 <= x <= 20 + 1e-9 and abs(y - 2 * x) < 1e-6
    kept = out.where(~F.col("synthetic") & (F.col("TARGET") == 0)).count()
    assert kept == 80  # perc_under 200 % of the 40 synthetic rows
    assert out.where(F.col("SK_ID_CURR") < 0).count() == 40


def test_smote_with_heavy_duplicates(spark):
    from pyspark.ml.linalg import VectorUDT
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("SK_ID_CURR", T.LongType()), T.StructField("TARGET", T.IntegerType()),
                           T.StructField("features", VectorUDT())])
    rows = [(i, 1, Vectors.dense([5.0, 10.0])) for i in range(1, 31)] + \
           [(100 + i, 1, Vectors.dense([float(i), 2.0 * i])) for i in range(1, 11)] + \
           [(1000 + i, 0, Vectors.dense([0.0, 0.0])) for i in range(300)]
    out = smote(spark.createDataFrame(rows, schema), "SK_ID_CURR", "features", "TARGET", k=5, seed=7,
                target_bucket=4)
    syn = [r.x for r in out.where("synthetic").select(vector_to_array("features").alias("x")).collect()]
    assert len(syn) == 80
    for x, y in syn:  # every minority point lies on y = 2x, so every synthetic point does too
        assert abs(y - 2 * x) < 1e-6 and 1 - 1e-9 <= x <= 10 + 1e-9
    # a duplicated vector's nearest neighbours are its copies: its synthetic rows are copies
    dup_syn = out.where("synthetic AND SK_ID_CURR >= -62 AND SK_ID_CURR <= -3") \
        .select(vector_to_array("features").alias("x")).collect()
    assert all(tuple(r.x) == (5.0, 10.0) for r in dup_syn)


def test_smote_never_reaches_evaluation_folds(spark):
    df = _separable(spark, n=300)
    designs = training.fold_designs(df, ["x1", "noise"], ["g"], 3, 42, True)
    ids_seen = set()
    for x_tr, x_te in designs:
        assert x_te.where(F.col("SK_ID_CURR") < 0).count() == 0
        assert x_tr.where(F.col("SK_ID_CURR") < 0).count() > 0
        te_ids = {r[0] for r in x_te.select("SK_ID_CURR").collect()}
        assert not te_ids & {r[0] for r in x_tr.select("SK_ID_CURR").collect()}
        ids_seen |= te_ids
    assert len(ids_seen) == 300  # every row is evaluated exactly once


def test_entry_contract(spark):
    import __spark_entry__ as entry
    df = entry.entry(spark)
    assert df.count() > 0
    qs, oracle = entry.queries(), entry.oracle_sql()
    assert set(oracle) <= set(qs)
    assert len(qs) >= 80


@pytest.mark.parametrize("name", ["pos_client", "bureau_client", "feature_matrix_test", "threshold_sweep",
                                  "roc_auc", "stratified_split", "rate_spread"])
def test_oracle_agrees_at_smoke_scale(spark, name):
    import __spark_entry__ as entry
    con = duckdb.connect()
    for t in ["customer", "orders", "lineitem", "events", "nation", "region"]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF001}/{t}.parquet'")
    sdf = entry.queries()[name](spark, SF001)
    cur = con.execute(entry.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    assert sorted(sdf.columns) == sorted(ocols)
    order = sorted(range(len(ocols)), key=lambda i: ocols[i])
    sorder = sorted(range(len(sdf.columns)), key=lambda i: sdf.columns[i])
    a = sorted((tuple(r[i] for i in sorder) for r in sdf.collect()), key=repr)
    b = sorted((tuple(r[i] for i in order) for r in cur.fetchall()), key=repr)
    assert a == b


def test_reports_on_validation_scores(spark):
    """Each decision report equals the one recomputed by hand from the saved validation scores."""
    import __spark_entry__ as entry
    qs = entry.queries()
    rows = training.final_fit(spark, SF001).validation.collect()
    n = len(rows)
    assert n > 0
    c = qs["validation_confusion"](spark, SF001).first()
    low = [r for r in rows if r.p_default < 0.65]
    assert (c.tn, c.fn) == (sum(r.TARGET == 0 for r in low), sum(r.TARGET == 1 for r in low))
    sweep = {round(r.threshold * 100): r for r in qs["validation_sweep"](spark, SF001).collect()}
    assert len(sweep) == 99
    best = None
    for k in range(1, 100):
        good = sum(r.p_default < k / 100 and r.TARGET == 0 for r in rows)
        bad = sum(r.p_default < k / 100 and r.TARGET == 1 for r in rows)
        profit = 0.12 * good - 0.6 * bad
        assert (sweep[k].good_approved, sweep[k].bad_approved) == (good, bad)
        assert abs(sweep[k].profit_per_applicant - profit / n) < 1e-6
        if best is None or profit > best[1] + 1e-9:
            best = (k, profit)
    sensitivity = {r.offset_steps: r for r in qs["validation_sensitivity"](spark, SF001).collect()}
    assert round(sensitivity[0].threshold * 100) == best[0]
    top = qs["validation_top_thresholds"](spark, SF001).collect()
    assert len(top) == 10 and any(r.is_max_profit for r in top)
    for r in qs["validation_approval"](spark, SF001).collect():
        mine = [x for x in rows if x[r.group] == r.level]
        assert r.n == len(mine)
        assert abs(r.Approval_Rate - 100 * sum(x.p_default < 0.65 for x in mine) / r.n) < 1e-6


def test_client_aggregates_are_stored_one_by_one(spark, monkeypatch):
    """No task of the materialised build holds more than one aggregate's tables; the frame is the same."""
    from pyspark.sql.classic.dataframe import DataFrame

    from creditlens.plans import feature_matrix

    stored = []
    kept = DataFrame.checkpoint
    monkeypatch.setattr(DataFrame, "checkpoint", lambda self, *a: stored.append(self.columns) or kept(self, *a))
    sf = "/root/testdata/sf0.001"
    built = feature_matrix.build(spark, sf, materialize=True)
    assert len(stored) == 6
    monkeypatch.undo()
    plain = feature_matrix.build(spark, sf)
    assert built.train.exceptAll(plain.train).count() == 0 == plain.train.exceptAll(built.train).count()


def test_a_forest_takes_few_passes():
    from creditlens.operators import modeling

    f = modeling.forest()
    assert (f.getMaxMemoryInMB(), f.getNumTrees(), f.getMaxDepth()) == (512, 200, 12) and f.getCacheNodeIds()
