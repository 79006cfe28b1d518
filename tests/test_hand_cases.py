"""Hand-sized cases with expected values worked out by hand (FIXTURES.md)."""

import math

import pytest
from pyspark.sql import functions as F

from creditlens.functions import aggs, scalar
from creditlens.operators import evaluate, history, impute, joins, recode, sampling
from creditlens.operators.quantiles import exact_quantiles, group_mode


def test_all_null_group(spark):
    df = spark.createDataFrame([(1, None), (1, None)], "k int, x double")
    r = df.groupBy("k").agg(aggs.safe_mean("x").alias("m"), aggs.safe_sum("x").alias("s"),
                            aggs.safe_min("x").alias("lo"), aggs.safe_max("x").alias("hi"),
                            aggs.sum0("x").alias("s0")).first()
    assert (r.m, r.s, r.lo, r.hi, r.s0) == (None, None, None, None, 0.0)
    flag = spark.createDataFrame([(None,)], "mx double").select(aggs.ever_flag("mx").alias("e")).first()
    assert flag.e is None


def test_mixed_nulls(spark):
    df = spark.createDataFrame([(1, 0.0), (1, None), (1, 6.0)], "k int, x double")
    r = df.groupBy("k").agg(aggs.safe_mean("x").alias("m"), aggs.safe_sum("x").alias("s"),
                            aggs.safe_max("x").alias("mx")).withColumn("e", aggs.ever_flag("mx")).first()
    assert (r.m, r.s, r.mx, r.e) == (3.0, 6.0, 6.0, 1)


def test_mean_of_means_vs_row_weighted(spark):
    pos = spark.createDataFrame(
        [(1, 10, -1.0, 1.0, 1.0, 1.0, 1.0), (1, 10, -2.0, 1.0, 1.0, 1.0, 1.0),
         (1, 10, -3.0, 1.0, 1.0, 1.0, 1.0), (1, 20, -1.0, 5.0, 5.0, 5.0, 5.0)],
        "SK_ID_CURR int, SK_ID_PREV int, MONTHS_BALANCE double, CNT_INSTALMENT double, "
        "CNT_INSTALMENT_FUTURE double, SK_DPD double, SK_DPD_DEF double")
    c = history.pos_client(pos).first()
    assert c.pos_SK_DPD_mean == 3.0  # mean of loan means
    assert pos.agg(F.avg("SK_DPD")).first()[0] == 2.0  # row-weighted


def test_status_counts_and_overdue(spark):
    bb = spark.createDataFrame([(1, -1.0, "C"), (1, -2.0, "X"), (1, -3.0, "0"), (1, -4.0, "1"),
                                (1, -5.0, None)], "SK_ID_BUREAU int, MONTHS_BALANCE double, STATUS string")
    r = history.bureau_balance_credit(bb).first()
    assert (r.bb_status_C_count, r.bb_status_X_count, r.bb_status_0_count, r.bb_status_1_count) == (1, 1, 1, 1)
    assert r.bb_ever_overdue == 1 and r.bb_MONTHS_BALANCE_count == 5


def test_overdue_rate_and_debt_ratio(spark):
    bureau = spark.createDataFrame(
        [(1, 10, 99.0, 100.0, -1.0, None), (1, 11, 99.0, None, -1.0, None), (1, 12, 99.0, None, -1.0, None)],
        "SK_ID_CURR int, SK_ID_BUREAU int, AMT_CREDIT_SUM double, AMT_CREDIT_SUM_DEBT double, "
        "DAYS_CREDIT double, DAYS_CREDIT_ENDDATE double")
    bb = spark.createDataFrame([(10, -1.0, "1"), (11, -1.0, "0")],
                               "SK_ID_BUREAU int, MONTHS_BALANCE double, STATUS string")
    r = history.bureau_client(bureau, bb).first()
    assert r.bureau_ever_overdue_rate == 0.5
    assert r.bureau_DEBT_RATIO == pytest.approx(1.0)
    neg = spark.createDataFrame([(1, 10, -1.0, 5.0, -1.0, None)], bureau.schema)
    assert history.bureau_client(neg, bb).first().bureau_DEBT_RATIO is None


def test_delay(spark):
    inst = spark.createDataFrame([(1, 1, -15.0, -10.0, 1.0, 1.0), (1, 1, -15.0, None, 1.0, None)],
                                 "SK_ID_CURR int, SK_ID_PREV int, DAYS_INSTALMENT double, "
                                 "DAYS_ENTRY_PAYMENT double, AMT_INSTALMENT double, AMT_PAYMENT double")
    r = history.install_loan(inst).first()
    assert (r.inst_delay_mean, r.inst_delay_max, r.inst_ever_late) == (5.0, 5.0, 1)


def test_no_history_zero_fill(spark):
    app = spark.createDataFrame([(1,), (2,)], "SK_ID_CURR int")
    agg = spark.createDataFrame([(2, 3, 1.5)], "SK_ID_CURR int, COUNT_POS_LOANS long, pos_x double")
    out = impute.zero_fill_flags(joins.left_enrich(app, agg)).orderBy("SK_ID_CURR").collect()
    assert (out[0].COUNT_POS_LOANS, out[0].pos_x, out[0].HAS_POS_LOAN) == (0, 0.0, 0)
    assert out[1].HAS_POS_LOAN == 1


def _stats(medians=None, edges=(20.0, 30.0, 40.0, 50.0, 60.0)):
    labels = scalar.cut_labels(list(edges))
    return impute.TrainStats(medians or {}, {}, list(edges), labels, 1)


def test_flag_before_fill_and_ratio_after_fill(spark):
    df = spark.createDataFrame([(None, None, 9.0, 10.0, -7300.0, -100.0, None)],
                               "EXT_SOURCE_1 double, AMT_ANNUITY double, AMT_INCOME_TOTAL double, "
                               "AMT_CREDIT double, DAYS_BIRTH double, DAYS_EMPLOYED double, "
                               "EMERGENCYSTATE_MODE string")
    for c in ["EXT_SOURCE_2", "EXT_SOURCE_3"]:
        df = df.withColumn(c, F.lit(0.1))
    df = df.withColumn("AMT_GOODS_PRICE", F.lit(1.0)).withColumn("CNT_FAM_MEMBERS", F.lit(1.0))
    st = _stats({"EXT_SOURCE_1": 0.5, "AMT_ANNUITY": 20.0})
    r = impute.clean_application(df, st).first()
    assert r.EXT_SOURCE_1_missing == 1 and r.EXT_SOURCE_1 == 0.5
    assert r.ANNUITY_TO_INCOME == 2.0


def test_sentinel(spark):
    df = spark.createDataFrame([(365243.0,), (-730.0,), (None,)], "d double")
    got = [r[0] for r in df.select(scalar.sentinel_repair("d")).collect()]
    assert got == [0.0, 730.0, None]


def test_right_closed_bins(spark):
    edges = [20.0, 30.0, 40.0, 50.0, 60.0]
    df = spark.createDataFrame([(20.0,), (30.0,), (30.01,), (60.0,), (61.0,)], "a double")
    got = [r[0] for r in df.select(scalar.right_closed_bin_index("a", edges)).collect()]
    assert got == [1, 1, 2, 4, None]
    assert scalar.cut_labels([20.5, 34.0, 45.23, 53.9, 69.1]) == \
        ["[20.5,34]", "(34,45.2]", "(45.2,53.9]", "(53.9,69.1]"]
    with pytest.raises(ValueError):
        scalar.cut_labels([1.0, 1.0, 2.0])


def test_mode_tie_and_distinct_with_null(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (1, "b"), (1, "a"), (1, None)], "k int, s string")
    assert group_mode(df, ["k"], "s").first()["mode"] == "a"
    d = spark.createDataFrame([(1,), (2,), (None,)], "x int").agg(aggs.n_distinct_na("x")).first()[0]
    assert d == 3


def test_recode(spark):
    df = spark.createDataFrame([("XNA", "Unknown", "Trade: type 2"), ("M", "Married", None)],
                               "CODE_GENDER string, NAME_FAMILY_STATUS string, ORGANIZATION_TYPE string")
    r = recode.recode_levels(df).collect()
    assert (r[0].CODE_GENDER, r[0].NAME_FAMILY_STATUS, r[0].ORGANIZATION_TYPE) == ("F", "Married", "Trade")
    assert r[1].ORGANIZATION_TYPE == "Other"


def test_recode_null_semantics_per_column(spark):
    """NULL stays NULL where R uses ifelse / case_when(TRUE ~ x); becomes Other where the default is Other."""
    cols = list(recode.RECODE_RULES)
    df = spark.createDataFrame([tuple([None] * len(cols))], ", ".join(f"{c} string" for c in cols))
    got = recode.recode_levels(df).first().asDict()
    assert got == {"CODE_GENDER": None, "NAME_TYPE_SUITE": None, "NAME_INCOME_TYPE": None,
                   "NAME_EDUCATION_TYPE": "Other", "NAME_FAMILY_STATUS": None, "NAME_HOUSING_TYPE": None,
                   "OCCUPATION_TYPE": "Other", "ORGANIZATION_TYPE": "Other", "WALLSMATERIAL_MODE": None}
    rows = [("Higher education", "Rented apartment", "Industry: type 1", "Drivers", "Monolithic", "Student")]
    df2 = spark.createDataFrame(rows, "NAME_EDUCATION_TYPE string, NAME_HOUSING_TYPE string, "
                                      "ORGANIZATION_TYPE string, OCCUPATION_TYPE string, "
                                      "WALLSMATERIAL_MODE string, NAME_INCOME_TYPE string")
    r = recode.recode_levels(df2).first()
    assert (r.NAME_EDUCATION_TYPE, r.NAME_HOUSING_TYPE, r.ORGANIZATION_TYPE, r.OCCUPATION_TYPE,
            r.WALLSMATERIAL_MODE, r.NAME_INCOME_TYPE) == (
        "Academic / Bachelors or higher", "Rented / Municipal", "Industry", "Drivers", "Other", "Other")


def test_smoothed_ratio_null_at_minus_one(spark):
    df = spark.createDataFrame([(10.0, -1.0), (10.0, 4.0), (None, 4.0)], "a double, b double")
    got = [r[0] for r in df.select(scalar.smoothed_ratio("a", "b")).collect()]
    assert got == [None, 2.0, None]


def test_suffix_join(spark):
    a = spark.createDataFrame([(1, 1.0)], "SK_ID_CURR int, SK_DPD_MEAN double")
    b = spark.createDataFrame([(1, 2.0)], "SK_ID_CURR int, SK_DPD_MEAN double")
    cols = joins.suffix_join(a, b, "SK_ID_CURR").columns
    assert set(cols) == {"SK_ID_CURR", "SK_DPD_MEAN_x", "SK_DPD_MEAN_y"}


def test_tied_auc(spark):
    df = spark.createDataFrame(list(zip([.1, .4, .4, .35, .8, .4], [0, 1, 0, 1, 1, 0])), "p double, y int")
    assert evaluate.roc_auc(df, "p", "y").first().auc == pytest.approx(2 / 3)


def test_sweep_example(spark):
    df = spark.createDataFrame([(.2, 0), (.2, 1), (.9, 0)], "p double, y int")
    r = evaluate.threshold_sweep(df, "p", "y").where(F.col("threshold") == 0.5).first()
    assert (r.good_approved, r.bad_approved) == (1, 1)
    assert r.profit == pytest.approx(-0.48)
    assert r.approval_rate == pytest.approx(200 / 3)


def test_optimal_threshold_first_on_ties_and_sensitivity(spark):
    sweep = spark.createDataFrame(
        [(k / 100, float(v)) for k, v in zip(range(1, 100), [0] * 9 + [5] * 5 + [3] * 85)],
        "threshold double, profit_per_applicant double")
    r = evaluate.optimal_threshold(sweep).first()
    assert (r.optimal_threshold, r.profit_per_applicant) == (0.10, 5.0)  # 0.10..0.14 tie: lowest wins
    sens = {x.offset_steps: x.threshold for x in evaluate.threshold_sensitivity(sweep).collect()}
    assert sens == {-5: 0.05, 0: 0.10, 5: 0.15}


def test_top_thresholds_order_and_max_flag(spark):
    profits = [float(k % 7) for k in range(1, 100)]
    sweep = spark.createDataFrame(
        [(k / 100, 50.0, 1, 1, p) for k, p in zip(range(1, 100), profits)],
        "threshold double, approval_rate double, good_approved long, bad_approved long, profit double")
    top = evaluate.top_thresholds(sweep).collect()
    assert len(top) == 10 and [r.threshold for r in top] == sorted((r.threshold for r in top), reverse=True)
    assert all(r.profit == 6.0 and r.is_max_profit for r in top)  # 14 rows tie at 6: the ten lowest kept
    assert max(r.threshold for r in top) == 0.69 and top[0].approval_rate == "50.00%"


def test_threshold_grid_floor_correction(spark):
    df = spark.createDataFrame([(0.29, 0), (0.57, 1), (0.0, 0), (0.99, 1)], "p double, y int")
    got = {r.p: r.k for r in df.select("p", evaluate.first_approving_step(F.col("p")).alias("k")).collect()}
    for p, k in got.items():
        assert p < k / 100 and (k == 1 or p >= (k - 1) / 100)


def test_grouped_quantiles_refinement_with_hot_value(spark):
    import numpy as np
    from creditlens.operators.quantiles import long_quantiles
    rng = np.random.default_rng(5)
    rows = []
    for g in ("a", "b", None):
        vals = list(rng.exponential(3.0, size=300)) + [7.25] * 150  # one value holds a third
        rows += [(g, float(v)) for v in vals]
    df = spark.createDataFrame(rows, "grp string, value double")
    probs = [0.1, 0.5, 0.9, 1.0]
    got = long_quantiles(df, ["grp"], probs)
    for g in ("a", "b", None):
        want = np.quantile([v for k, v in rows if k == g], probs)
        assert np.allclose(got[(g,)], want)


def test_exact_quantiles_type7(spark):
    import numpy as np
    vals = [float(v) for v in np.random.default_rng(1).normal(size=501)] + [None]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    probs = [0, 0.25, 0.5, 0.75, 1]
    want = np.quantile([v for v in vals if v is not None], probs)  # numpy linear == R type 7
    got = exact_quantiles(df, ["x"], probs)["x"]
    assert np.allclose(got, want)


def test_quantiles_odd_values(spark):
    """NaN counts as NULL; infinities, one outlier, ties and an all-NULL column end in the same few jobs."""
    import numpy as np
    inf, nan = float("inf"), float("nan")
    cols = {"nan": [1.0, 2.0, 3.0, 4.0, 5.0, nan], "inf": [-inf, 0.0, 1.0, 2.0, inf, inf],
            "far": [1.0, 2.0, 3.0, 4.0, 5.0, 1e300], "tie": [2.0] * 5 + [None], "none": [None] * 6}
    df = spark.createDataFrame(list(zip(*cols.values())), ", ".join(f"`{c}` double" for c in cols))
    got = exact_quantiles(df, list(cols), [0, 0.25, 0.5, 0.75, 1])
    assert got["none"] == [None] * 5 and got["tie"] == [2.0] * 5
    assert got["nan"] == [1.0, 2.0, 3.0, 4.0, 5.0]
    assert np.allclose(got["far"], np.quantile(cols["far"], [0, 0.25, 0.5, 0.75, 1]))
    assert got["inf"][0] == -inf and got["inf"][2] == 1.5 and got["inf"][3:] == [inf, inf]


def test_sweep_and_split_keep_null_rows(spark):
    df = spark.createDataFrame([(0.2, 0), (None, 0), (None, 1), (0.995, 1)], "p double, y int")
    rows = {round(r.threshold, 2): r for r in evaluate.threshold_sweep(df, "p", "y").collect()}
    assert rows[0.01].approval_rate == 0 and rows[0.99].approval_rate == 25 and rows[0.99].profit == 0.12
    labels = spark.createDataFrame([(i, None if i % 4 == 0 else i % 2) for i in range(40)], "id long, y int")
    split = sampling.stratified_split(labels, "id", "y").collect()
    assert len(split) == 40 and sum(r.split == "train" for r in split if r.y is None) == 8


def test_sample_n_is_the_first_n_of_the_draw(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    from creditlens.functions.scalar import md5_uniform
    order = [r.k for r in df.withColumn("u", md5_uniform("k", 42)).orderBy("u", "k").collect()]
    for n in (0, 1, 37, 999, 1000, 2000):
        assert {r.k for r in sampling.sample_n(df, "k", n).collect()} == set(order[:n])
