"""Profiling operators on hand-sized frames."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from creditlens.operators import columns, fairness, profile


@pytest.fixture()
def small(spark):
    rows = [(1, 0, "a", 1.0), (2, 1, "a", 2.0), (3, 0, "b", None), (4, 1, None, 4.0),
            (5, 0, None, 5.0), (6, 0, "b", 100.0)]
    return spark.createDataFrame(rows, "SK_ID_CURR long, TARGET int, g string, x double")


def test_class_balance(small):
    got = {r.Default: (r.Count, r.Proportion) for r in profile.class_balance(small).collect()}
    assert got == {0: (4, round(4 / 6, 4)), 1: (2, round(2 / 6, 4))}


def test_rate_spread_keeps_null_level(small):
    r = profile.rate_spread(small, ["g"]).first()
    # levels: a -> 0.5, b -> 0.0, NULL -> 0.5
    assert r.Predictor == "g" and r.Max_Proportion_Diff == pytest.approx(0.5)
    lv = {r.level: r.n for r in profile.level_freq(small, ["g"]).collect()}
    assert lv == {"a": 2, "b": 2, None: 2}


def test_missing_summary(small):
    got = {r.Variable: (r.Count, r.Proportion) for r in profile.missing_summary(
        small, exclude=["TARGET", "SK_ID_CURR"]).collect()}
    assert got == {"g": (2, round(2 / 6, 4)), "x": (1, round(1 / 6, 4))}


def test_numeric_summary_matches_numpy(small):
    r = profile.numeric_summary(small, ["x"]).first()
    vals = np.array([1.0, 2.0, 4.0, 5.0, 100.0])
    assert (r.Min, r.Max, r.NAs) == (1.0, 100.0, 1)
    assert r.Q1 == pytest.approx(np.quantile(vals, 0.25)) and r.Median == pytest.approx(4.0)
    assert r.Mean == pytest.approx(vals.mean())


def test_box_stats_whiskers_and_outliers(small):
    rows = {r.TARGET: r for r in profile.box_stats(small, ["x"], "TARGET").collect()}
    r0 = rows[0]  # values 1, 5, 100
    q1, q3 = np.quantile([1.0, 5.0, 100.0], [0.25, 0.75])
    assert (r0.q1, r0.q3) == (pytest.approx(q1), pytest.approx(q3))
    hi = q3 + 1.5 * (q3 - q1)
    assert r0.upper_whisker == max(v for v in [1.0, 5.0, 100.0] if v <= hi)
    assert r0.n == 3


def test_histogram_puts_max_in_last_bin(small):
    h = profile.histogram(small, "x", bins=10).orderBy("bin").collect()
    assert sum(r["count"] for r in h) == 5
    assert h[-1].bin == 10 and h[-1]["count"] == 1 and h[-1].upper == pytest.approx(100.0)


def test_target_corr_constant_column_is_null(spark):
    df = spark.createDataFrame([(0, 1.0, 3.0), (1, 1.0, 5.0), (0, 1.0, None), (1, None, 9.0)],
                               "TARGET int, c double, v double")
    got = {r.Predictor: r.Correlation_with_Target for r in profile.target_corr(df, "TARGET", ["c", "v"]).collect()}
    assert got["c"] is None
    assert got["v"] == pytest.approx(round(np.corrcoef([0, 1, 1], [3, 5, 9])[0, 1], 4))


def test_union_and_type_profile(spark, small):
    test = small.drop("TARGET")
    u = profile.union_train_test(small, test)
    assert u.count() == 12 and u.where(F.col("dataset") == "test").where(F.col("TARGET").isNull()).count() == 6
    tp = {r.Data_Type: r.Count for r in columns.type_profile(small, exclude=["SK_ID_CURR"]).collect()}
    assert tp == {"integer": 1, "character": 1, "numeric": 1}


def test_adverse_action_withholds_protected(spark):
    imp = spark.createDataFrame([("CODE_GENDER_M", 0.4), ("EXT_SOURCE_3", -0.5), ("OTHER", 0.1)],
                                "Feature string, Coefficient double")
    got = {r.Feature: (r.Reason, r.allowed) for r in fairness.adverse_action_map(imp, spark).collect()}
    assert got["CODE_GENDER_M"] == (None, False)
    assert got["EXT_SOURCE_3"] == ("Low external credit score", True)
    assert got["OTHER"] == (None, True)
    coded = spark.createDataFrame([("NAME_EDUCATION_TYPE_Lower", 0.2), ("EXT_SOURCE_1_missing", 0.3)],
                                  "Feature string, Coefficient double")
    got = {r.Feature: r.Reason for r in fairness.adverse_action_map(
        coded, spark, sources={"NAME_EDUCATION_TYPE_Lower": "NAME_EDUCATION_TYPE"}).collect()}
    assert got == {"NAME_EDUCATION_TYPE_Lower": "Education level associated with higher risk",
                   "EXT_SOURCE_1_missing": None}


def test_approval_by_group_directions(spark):
    df = spark.createDataFrame([(0.1, "F"), (0.7, "F"), (0.9, "M")], "p double, g string")
    lt = {r.level: r.Approval_Rate for r in fairness.approval_by_group(df, "p", ["g"], 0.65).collect()}
    ge = {r.level: r.Approval_Rate for r in fairness.approval_by_group(df, "p", ["g"], 0.65, "ge").collect()}
    assert lt == {"F": 50.0, "M": 0.0} and ge == {"F": 50.0, "M": 100.0}
