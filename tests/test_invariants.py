"""Invariants on the driver tables."""

import pytest
from pyspark.sql import functions as F

from conftest import SF001, SF01
from creditlens.operators import evaluate, impute, sampling
from creditlens.plans import feature_matrix as fm
from creditlens.sources import fixtures
from creditlens.sources.tables import Tables


@pytest.fixture(scope="module")
def build(spark):
    return fm.build(spark, SF01)


def test_left_joins_keep_row_count(spark, build):
    t = Tables(spark, SF01)
    assert build.train.count() == fixtures.application_train(t).count()
    assert build.test.count() == fixtures.application_test(t).count()
    for agg in fm.client_aggregates(t):
        assert agg.count() == agg.select("SK_ID_CURR").distinct().count()


def test_no_null_after_fill_and_has_flags(spark, build):
    cols = impute.zero_fill_columns(build.train.columns)
    nulls = build.train.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols]).first()
    assert all(v == 0 for v in nulls)
    for flag, src in impute.HAS_FLAGS:
        bad = build.train.where(F.col(flag) != (F.col(src) > 0).cast("int")).count()
        assert bad == 0


def test_feature_matrix_has_no_nulls(spark, build):
    row = build.train.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in build.train.columns]).first()
    assert {k: v for k, v in row.asDict().items() if v} == {}


def test_fold_sizes_and_split_share(spark):
    train = fixtures.application_train(Tables(spark, SF01))
    sizes = [r["count"] for r in sampling.kfold_assign(train, "SK_ID_CURR", 3).groupBy("fold").count().collect()]
    assert len(sizes) == 3 and max(sizes) - min(sizes) <= 1
    split = sampling.stratified_split(train, "SK_ID_CURR", "TARGET", 0.8)
    per = {(r.TARGET, r.split): r["count"] for r in split.groupBy("TARGET", "split").count().collect()}
    for y in (0, 1):
        n = per.get((y, "train"), 0) + per.get((y, "validation"), 0)
        assert per[(y, "train")] == -(-n * 8 // 10)


def test_sweep_monotone_and_auc_symmetry(spark):
    scored = fixtures.scored_rows(Tables(spark, SF01))
    rates = [r.approval_rate for r in evaluate.threshold_sweep(scored, "p_default", "TARGET")
             .orderBy("threshold").collect()]
    assert all(a <= b for a, b in zip(rates, rates[1:]))
    auc = evaluate.roc_auc(scored, "p_default", "TARGET").first().auc
    flipped = evaluate.roc_auc(scored.withColumn("q", 1 - F.col("p_default")), "q", "TARGET").first().auc
    assert auc + flipped == pytest.approx(1.0)


def test_fit_depends_on_train_only(spark):
    t = Tables(spark, SF001)
    app = fixtures.application(t)
    s1 = impute.fit_train_stats(app.where(~fixtures.is_test()))
    # edit every test row: the fitted numbers must not move
    edited = app.withColumn("DAYS_LAST_PHONE_CHANGE",
                            F.when(fixtures.is_test(), F.lit(-99999.0)).otherwise(F.col("DAYS_LAST_PHONE_CHANGE")))
    s2 = impute.fit_train_stats(edited.where(~fixtures.is_test()))
    assert s1 == s2
    # the test rows are filled with the training median, not their own
    test = edited.where(fixtures.is_test()).withColumn(
        "DAYS_LAST_PHONE_CHANGE", F.when(F.col("SK_ID_CURR") % 2 == 0, F.lit(None).cast("double"))
        .otherwise(F.col("DAYS_LAST_PHONE_CHANGE")))
    filled = impute.clean_application(test, s1).where(F.col("SK_ID_CURR") % 2 == 0) \
        .select("DAYS_LAST_PHONE_CHANGE").distinct().collect()
    assert [r[0] for r in filled] == [s1.medians["DAYS_LAST_PHONE_CHANGE"]]


def test_transform_is_deterministic(spark):
    b = fm.build(spark, SF001)
    a = sorted(map(tuple, b.train.collect()))
    c = sorted(map(tuple, b.train.collect()))
    assert a == c


@pytest.mark.parametrize("parts", [1, 4, 17])
def test_partition_independence(spark, parts):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        train = fixtures.application_train(Tables(spark, SF001)).repartition(parts)
        folds = sorted((r.SK_ID_CURR, r.fold) for r in
                       sampling.kfold_assign(train, "SK_ID_CURR", 3).select("SK_ID_CURR", "fold").collect())
        split = sorted((r.SK_ID_CURR, r.split) for r in
                       sampling.stratified_split(train, "SK_ID_CURR", "TARGET").select("SK_ID_CURR", "split")
                       .collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        scored = fixtures.scored_rows(Tables(spark, SF001)).repartition(parts)
        auc = round(evaluate.roc_auc(scored, "p_default", "TARGET").first().auc, 12)
        sweep = tuple(tuple(r) for r in evaluate.threshold_sweep(scored, "p_default", "TARGET")
                      .orderBy("threshold").collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    key = (hash(tuple(folds)), hash(tuple(split)), auc, hash(sweep))
    test_partition_independence.seen = getattr(test_partition_independence, "seen", set()) | {key}
    assert len(test_partition_independence.seen) == 1
