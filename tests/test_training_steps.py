"""The steps of the final fit: stored folds, steps side by side, raw rows from the stored aggregates."""

import threading
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from creditlens.operators import history, modeling
from creditlens.plans import feature_matrix as fm
from creditlens.plans import training
from creditlens.sources.tables import Tables


def test_folds_have_as_many_partitions_as_their_size_calls_for(spark, monkeypatch):
    """Not ``spark.sql.shuffle.partitions`` of them in every pass of every fold."""
    rows = [(i, int(i % 4 == 0), float(i % 17), "ab"[i % 2]) for i in range(600)]
    df = spark.createDataFrame(rows, "SK_ID_CURR long, TARGET int, x double, g string")
    seen, levels = [], modeling.training_levels
    monkeypatch.setattr(modeling, "training_levels",
                        lambda part, cat: seen.append(part.rdd.getNumPartitions()) or levels(part, cat))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "150")
    try:
        designs = training.plain_fold_designs(df, ["x"], ["g"], 3, 42)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(seen) == 3 and max(seen) < 100
    held_out = [r.SK_ID_CURR for _, x_te in designs for r in x_te.collect()]
    assert sorted(held_out) == list(range(600))


def test_rows_of_the_final_fit_do_not_wait_for_tuning(spark, monkeypatch):
    begun, folds = threading.Event(), training.fold_designs

    def grid(spark, *a):
        assert begun.wait(120)
        return spark.createDataFrame([("smote", 0.01, 1.0, 0.5)],
                                     "sampling string, regParam double, elasticNetParam double, cv_auc double")

    monkeypatch.setattr(training, "fold_designs", lambda *a: begun.set() or folds(*a))
    monkeypatch.setattr(training, "tuned_grid", grid)
    ff = training.final_fit(spark, SF001, seed=7)
    train = training.feature_build(spark, SF001).train
    assert (ff.reg, ff.alpha) == (0.01, 1.0)
    assert ff.cv_auc == pytest.approx(training.cv_auc(train, *modeling.feature_columns(train), 0.01, 1.0, 5, 7, True))
    part = {r.split: r["count"] for r in ff.split.groupBy("split").count().collect()}
    assert part["validation"] == ff.validation.count() and sum(part.values()) == train.count()


def test_raw_rows_come_from_the_stored_aggregates(spark, monkeypatch):
    """Scoring raw rows does not aggregate the histories again; the rows are the same."""
    import __spark_entry__ as entry

    training.final_fit(spark, SF001)
    again, real = [], history.pos_client
    monkeypatch.setattr(history, "pos_client", lambda *a: again.append(1) or real(*a))
    scored = entry.queries()["score_raw"](spark, SF001)
    assert not again
    monkeypatch.undo()
    b = training.feature_build(spark, SF001)
    raw = fm.raw_applications(Tables(spark, SF001))
    assert b.raw.columns == raw.columns
    assert sorted(map(repr, b.raw.collect())) == sorted(map(repr, raw.collect()))
    assert scored.count() == b.test.count()


def test_forests_follow_one_another_and_scores_hold_no_model(spark, monkeypatch):
    """A forest fills memory alone; stored scores do not keep it in the driver."""
    rows = [(i, int(i % 4 == 0), float(i * 7 % 17), "ab"[i % 2]) for i in range(300)]
    df = spark.createDataFrame(rows, "SK_ID_CURR long, TARGET int, x double, g string")
    forest, fit, running, most = modeling.forest, modeling.fit, [], []
    monkeypatch.setattr(modeling, "forest", lambda n, seed: forest(4, seed, 3))

    def watched(*a):
        running.append(1)
        most.append(len(running))
        try:
            return fit(*a)
        finally:
            running.pop()

    monkeypatch.setattr(modeling, "fit", watched)
    scores, n_pred = training.oof_predictions(df, ["x"], ["g"], ("Random Forest",))
    assert max(most) == 1 and n_pred == {"Random Forest": 2}
    assert sorted(r.SK_ID_CURR for r in scores.collect()) == list(range(300))
    plan = scores._jdf.queryExecution().optimizedPlan().toString()
    assert "InMemoryRelation" not in plan and "UDF" not in plan


def test_votes_of_parts_of_a_forest_are_the_forests(spark, monkeypatch):
    """Rows that come twice and rows with levels unseen in training included."""
    rows = [(i, int(i % 4 == 0), float(i * 7 % 17), "ab"[i % 2]) for i in range(200)]
    df = spark.createDataFrame(rows, "SK_ID_CURR long, TARGET int, x double, g string")
    m = modeling.fit(df, modeling.forest(7, 1, 4), ["x"], ["g"])
    monkeypatch.setattr(modeling, "TREES_SENT", 3)
    odd = df.unionByName(df.where("SK_ID_CURR < 20")).unionByName(df.limit(5).withColumn("g", F.lit("new")))
    got = modeling.forest_scores(m, odd, ("SK_ID_CURR", "TARGET")).collect()
    want = m.score(odd).select("SK_ID_CURR", "TARGET", "p_default").collect()
    assert len(got) == 225 and len(set(r.p_default for r in got)) > 3
    for a, b in zip(sorted(got), sorted(want)):
        assert a[:2] == b[:2] and a.p_default == pytest.approx(b.p_default, abs=1e-12)


def test_tuning_reads_every_training_row(spark, monkeypatch):
    """Not a sample of 5,000."""
    rows = [(i, int(i % 9 == 0), float(i * 7 % 17)) for i in range(6_000)]
    train = spark.createDataFrame(rows, "SK_ID_CURR long, TARGET int, x double")
    seen = []
    monkeypatch.setattr(training, "feature_build", lambda spark, sf: SimpleNamespace(train=train))
    monkeypatch.setattr(training, "tune_grid", lambda spark, df, *a: seen.append(df.count()) or df)
    training.tuned_grid(spark, "/nowhere/6000-rows")
    assert seen == [6_000]
