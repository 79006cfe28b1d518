"""Queries for aggregate functions (A1-A26), column operators (P, F, X),
reshaping (U) and the dictionary (S2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from creditlens.functions import aggs, scalar
from creditlens.operators import columns, history, impute, joins, profile, recode
from creditlens.operators.aggregate import aggregate, with_ever_flags
from creditlens.operators.quantiles import exact_quantiles, group_mode
from creditlens.plans import feature_matrix as fm
from creditlens.plans.oracle_sql import APP_DOUBLES, rounded, with_fixtures
from creditlens.plans.q_features import (HIST_CTES, HISTORY, MEDIANS, MODES, STATS_CTE, _aug,
                                         _clean, _filled, _recode)
from creditlens.plans.q_history import POS_CLIENT_DOUBLES, POS_CLIENT_SQL
from creditlens.plans.registry import query
from creditlens.sources import fixtures
from creditlens.sources.tables import Tables

CATS = ["NAME_TYPE_SUITE", "OCCUPATION_TYPE", "FONDKAPREMONT_MODE", "HOUSETYPE_MODE",
        "WALLSMATERIAL_MODE", "EMERGENCYSTATE_MODE", "CODE_GENDER", "NAME_INCOME_TYPE",
        "NAME_EDUCATION_TYPE", "NAME_FAMILY_STATUS", "NAME_HOUSING_TYPE", "ORGANIZATION_TYPE"]


def _t(spark, sf):
    return Tables(spark, sf)


def _r4(e: str) -> str:
    from creditlens.plans.oracle_sql import rnd
    return rnd(rnd(e, 9), 4)


# --- A1-A13: reducers -------------------------------------------------------

@query("safe_aggs", with_fixtures(["pos"], rounded(
    "SELECT SK_ID_CURR, count(*) AS n, avg(SK_DPD) AS dpd_mean, sum(SK_DPD) AS dpd_sum, "
    "min(SK_DPD) AS dpd_min, max(SK_DPD) AS dpd_max FROM pos GROUP BY SK_ID_CURR",
    ["dpd_mean", "dpd_sum", "dpd_min", "dpd_max"])))
def q_safe_aggs(spark, sf):
    """A1-A5: NULL-safe mean / sum / min / max (NULL on an all-NULL group) and n()."""
    pos = fixtures.pos_cash(_t(spark, sf))
    return pos.groupBy("SK_ID_CURR").agg(
        aggs.count_rows().alias("n"), aggs.safe_mean("SK_DPD").alias("dpd_mean"),
        aggs.safe_sum("SK_DPD").alias("dpd_sum"), aggs.safe_min("SK_DPD").alias("dpd_min"),
        aggs.safe_max("SK_DPD").alias("dpd_max"))


@query("raw_aggs", with_fixtures(["bureau"], rounded(
    "SELECT SK_ID_CURR, COALESCE(sum(AMT_CREDIT_SUM_OVERDUE), 0) AS overdue_sum, "
    "COALESCE(sum(AMT_CREDIT_MAX_OVERDUE), 0) AS max_overdue_sum, "
    "avg(AMT_CREDIT_MAX_OVERDUE) AS max_overdue_mean, max(AMT_CREDIT_MAX_OVERDUE) AS max_overdue_max "
    "FROM bureau GROUP BY SK_ID_CURR",
    ["overdue_sum", "max_overdue_sum", "max_overdue_mean", "max_overdue_max"])))
def q_raw_aggs(spark, sf):
    """R reducers with na.rm: sum 0 on all-NULL; mean NaN and max -Inf become NULL."""
    b = fixtures.bureau(_t(spark, sf))
    return b.groupBy("SK_ID_CURR").agg(
        aggs.sum0("AMT_CREDIT_SUM_OVERDUE").alias("overdue_sum"),
        aggs.sum0("AMT_CREDIT_MAX_OVERDUE").alias("max_overdue_sum"),
        aggs.safe_mean("AMT_CREDIT_MAX_OVERDUE").alias("max_overdue_mean"),
        aggs.safe_max("AMT_CREDIT_MAX_OVERDUE").alias("max_overdue_max"))


@query("n_distinct_na", with_fixtures(["bureau"],
    "SELECT SK_ID_CURR, count(DISTINCT DAYS_CREDIT_ENDDATE) + "
    "CAST(bool_or(DAYS_CREDIT_ENDDATE IS NULL) AS BIGINT) AS n_end_dates, "
    "count(DISTINCT SK_ID_BUREAU) AS n_credits FROM bureau GROUP BY SK_ID_CURR"))
def q_n_distinct_na(spark, sf):
    """``n_distinct`` counts NULL as one value (Spark's count_distinct does not)."""
    b = fixtures.bureau(_t(spark, sf))
    return b.groupBy("SK_ID_CURR").agg(
        aggs.n_distinct_na("DAYS_CREDIT_ENDDATE").cast("long").alias("n_end_dates"),
        aggs.n_distinct_na("SK_ID_BUREAU").cast("long").alias("n_credits"))


@query("status_counts", with_fixtures(["bb"],
    "SELECT MONTHS_BALANCE, count(*) FILTER (WHERE STATUS = 'C') AS n_C, "
    "count(*) FILTER (WHERE STATUS = 'X') AS n_X, "
    "count(*) FILTER (WHERE STATUS IN ('1','2','3','4','5')) AS n_overdue, "
    "count(*) FILTER (WHERE STATUS IS NULL) AS n_missing FROM bb GROUP BY MONTHS_BALANCE"))
def q_status_counts(spark, sf):
    """A10: conditional counts; a NULL status counts in no bucket."""
    bb = fixtures.bureau_balance(_t(spark, sf))
    s = F.col("STATUS")
    return bb.groupBy("MONTHS_BALANCE").agg(
        aggs.count_where(s == "C").alias("n_C"), aggs.count_where(s == "X").alias("n_X"),
        aggs.count_where(s.isin("1", "2", "3", "4", "5")).alias("n_overdue"),
        aggs.count_where(s.isNull()).alias("n_missing"))


@query("flag_rates", with_fixtures(["prev"], rounded(
    "SELECT SK_ID_CURR, avg(CAST(FLAG_LAST_APPL_PER_CONTRACT = 'Y' AS DOUBLE)) AS last_appl_rate, "
    "avg(CAST(NAME_CONTRACT_STATUS = 'Approved' AS DOUBLE)) AS approved_rate, "
    "avg(CAST(AMT_ANNUITY > 20000 AS DOUBLE)) AS high_annuity_rate FROM prev GROUP BY SK_ID_CURR",
    ["last_appl_rate", "approved_rate", "high_annuity_rate"])))
def q_flag_rates(spark, sf):
    """Rate of a condition over the rows where it is not NULL."""
    p = fixtures.previous_application(_t(spark, sf))
    return p.groupBy("SK_ID_CURR").agg(
        aggs.rate_where(F.col("FLAG_LAST_APPL_PER_CONTRACT") == "Y").alias("last_appl_rate"),
        aggs.rate_where(F.col("NAME_CONTRACT_STATUS") == "Approved").alias("approved_rate"),
        aggs.rate_where(F.col("AMT_ANNUITY") > 20000).alias("high_annuity_rate"))


@query("ever_flags", with_fixtures(["pos"], rounded(
    "SELECT SK_ID_CURR, SK_ID_PREV, max(SK_DPD) AS dpd_max, CAST(max(SK_DPD) > 0 AS INTEGER) AS dpd_ever "
    "FROM pos GROUP BY SK_ID_CURR, SK_ID_PREV", ["dpd_max"])))
def q_ever_flags(spark, sf):
    """``as.integer(max > 0)``; a loan whose values are all NULL keeps NULL."""
    pos = fixtures.pos_cash(_t(spark, sf))
    loans = aggregate(pos, ["SK_ID_CURR", "SK_ID_PREV"], [("dpd_max", "max", "SK_DPD")])
    return with_ever_flags(loans, [("dpd_ever", "dpd_max")])


@query("group_mode", with_fixtures(["prev"],
    "SELECT SK_ID_CURR, NAME_CONTRACT_STATUS AS status_mode FROM prev "
    "GROUP BY SK_ID_CURR, NAME_CONTRACT_STATUS "
    "QUALIFY row_number() OVER (PARTITION BY SK_ID_CURR ORDER BY count(*) DESC, NAME_CONTRACT_STATUS) = 1"))
def q_group_mode(spark, sf):
    """Most common level per group, alphabetical on ties."""
    p = fixtures.previous_application(_t(spark, sf))
    return group_mode(p, ["SK_ID_CURR"], "NAME_CONTRACT_STATUS", "status_mode")


# --- A18-A26: profiles -----------------------------------------------------

CORR_COLS = APP_DOUBLES


@query("target_corr", with_fixtures(["train"], " UNION ALL ".join(
    f"SELECT '{c}' AS Predictor, {_r4(f'corr({c}, CAST(TARGET AS DOUBLE))')} AS Correlation_with_Target "
    f"FROM train" for c in CORR_COLS)))
def q_target_corr(spark, sf):
    """A18 + U2 + L1 + X12: correlation with the label, one pass, sorted by |r|."""
    train = fixtures.application_train(_t(spark, sf))
    return profile.target_corr(train, "TARGET", columns.numeric_columns(
        train, exclude=["TARGET", "SK_ID_CURR"]))


@query("class_balance", with_fixtures(["train"],
    f"SELECT TARGET AS \"Default\", count(*) AS Count, "
    f"{_r4('count(*) / sum(count(*)) OVER ()')} AS Proportion FROM train GROUP BY TARGET"))
def q_class_balance(spark, sf):
    """A23 + P7 + W1: class counts and shares."""
    return profile.class_balance(fixtures.application_train(_t(spark, sf)))


@query("group_rate", with_fixtures(["train"], rounded(
    "SELECT NAME_INCOME_TYPE, avg(CAST(TARGET AS DOUBLE)) AS Default_Rate, count(*) AS Count "
    "FROM train GROUP BY NAME_INCOME_TYPE", ["Default_Rate"])))
def q_group_rate(spark, sf):
    """A24 + L6: default rate by income type, ordered by rate."""
    return profile.group_rate(fixtures.application_train(_t(spark, sf)), "NAME_INCOME_TYPE")


@query("rate_spread", with_fixtures(["train"], rounded(" UNION ALL ".join(
    f"SELECT '{c}' AS Predictor, max(r) - min(r) AS Max_Proportion_Diff FROM "
    f"(SELECT avg(CAST(TARGET AS DOUBLE)) AS r FROM train GROUP BY {c})" for c in CATS),
    ["Max_Proportion_Diff"])))
def q_rate_spread(spark, sf):
    """Spread of the default rate across the levels of each categorical column."""
    train = fixtures.application_train(_t(spark, sf))
    return profile.rate_spread(train, columns.string_columns(train))


@query("level_freq", with_fixtures(["train"], " UNION ALL ".join(
    f"SELECT '{c}' AS variable, {c} AS level, count(*) AS n FROM train GROUP BY {c}" for c in CATS)))
def q_level_freq(spark, sf):
    """A26 + L2: level frequencies of every categorical column (NULL level kept)."""
    train = fixtures.application_train(_t(spark, sf))
    return profile.level_freq(train, columns.string_columns(train))


_COMBINED = ("combined AS (SELECT *, 'train' AS dataset FROM train UNION ALL BY NAME "
             "SELECT *, CAST(NULL AS INTEGER) AS TARGET, 'test' AS dataset FROM test)")
_NON_ID = [c for c in APP_DOUBLES + CATS]


@query("missing_summary", with_fixtures(["train", "test"], "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS Variable, count(*) FILTER (WHERE {c} IS NULL) AS Count, "
    f"{_r4(f'count(*) FILTER (WHERE {c} IS NULL) / count(*)')} AS Proportion FROM combined"
    for c in _NON_ID + ["dataset"]) + ") WHERE Count > 0", [_COMBINED]))
def q_missing_summary(spark, sf):
    """A19 + F2 + U1: NULL counts over train and test stacked (label and id excluded)."""
    t = _t(spark, sf)
    combined = profile.union_train_test(fixtures.application_train(t), fixtures.application_test(t))
    return profile.missing_summary(combined, exclude=["TARGET", "SK_ID_CURR"])


_NO_BUILDING = [c for c in _NON_ID if c not in ("APARTMENTS_AVG", "BASEMENTAREA_AVG", "LIVINGAREA_MEDI")]


@query("missing_summary_no_building", with_fixtures(["train", "test"], "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS Variable, count(*) FILTER (WHERE {c} IS NULL) AS Count, "
    f"{_r4(f'count(*) FILTER (WHERE {c} IS NULL) / count(*)')} AS Proportion FROM combined"
    for c in _NO_BUILDING + ["dataset"]) + ") WHERE Count > 0", [_COMBINED]))
def q_missing_summary_no_building(spark, sf):
    """The second missing table, without the building columns."""
    t = _t(spark, sf)
    combined = profile.union_train_test(fixtures.application_train(t), fixtures.application_test(t))
    return profile.missing_summary(combined, exclude=["TARGET", "SK_ID_CURR", *fm.building_vars(combined)])


@query("numeric_summary", with_fixtures(["train"], rounded(" UNION ALL ".join(
    f"SELECT '{c}' AS variable, min({c}) AS Min, quantile_cont({c}, 0.25) AS Q1, "
    f"quantile_cont({c}, 0.5) AS Median, avg({c}) AS Mean, quantile_cont({c}, 0.75) AS Q3, "
    f"max({c}) AS Max, count(*) FILTER (WHERE {c} IS NULL) AS NAs FROM train" for c in APP_DOUBLES),
    ["Min", "Q1", "Median", "Mean", "Q3", "Max"])))
def q_numeric_summary(spark, sf):
    """R ``summary`` of every numeric column, exact quartiles."""
    return profile.numeric_summary(fixtures.application_train(_t(spark, sf)), APP_DOUBLES)


_BOX = ["EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3"]


@query("box_stats", with_fixtures(["train"], rounded(
    "WITH long AS (" + " UNION ALL ".join(
        f"SELECT '{c}' AS variable, TARGET, {c} AS value FROM train WHERE {c} IS NOT NULL" for c in _BOX)
    + "), q AS (SELECT variable, TARGET, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median, "
    "quantile_cont(value, 0.75) AS q3 FROM long GROUP BY variable, TARGET) "
    "SELECT variable, TARGET, q1, median, q3, "
    "min(value) FILTER (WHERE value >= q1 - 1.5 * (q3 - q1)) AS lower_whisker, "
    "max(value) FILTER (WHERE value <= q3 + 1.5 * (q3 - q1)) AS upper_whisker, "
    "count(*) FILTER (WHERE value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)) AS n_outliers, "
    "count(*) AS n FROM long JOIN q USING (variable, TARGET) GROUP BY variable, TARGET, q1, median, q3",
    ["q1", "median", "q3", "lower_whisker", "upper_whisker"])))
def q_box_stats(spark, sf):
    """Box-plot statistics of the external scores by class."""
    return profile.box_stats(fixtures.application_train(_t(spark, sf)), _BOX, "TARGET")


@query("histogram", with_fixtures(["train"], rounded(
    "WITH r AS (SELECT min(DAYS_EMPLOYED) AS lo, max(DAYS_EMPLOYED) AS hi FROM train), "
    "c AS (SELECT CAST(least(floor((DAYS_EMPLOYED - lo) * 150 / (hi - lo)) + 1, 150) AS INTEGER) AS bin, "
    "count(*) AS count FROM train, r WHERE DAYS_EMPLOYED IS NOT NULL GROUP BY 1) "
    "SELECT CAST(g.range AS INTEGER) AS bin, lo + (g.range - 1) * ((hi - lo) / 150) AS lower, "
    "lo + g.range * ((hi - lo) / 150) AS upper, COALESCE(c.count, 0) AS count "
    "FROM range(1, 151) AS g, r LEFT JOIN c ON c.bin = g.range", ["lower", "upper"])))
def q_histogram(spark, sf):
    """150 equal-width bins of DAYS_EMPLOYED (the sentinel spike shows up)."""
    return profile.histogram(fixtures.application_train(_t(spark, sf)), "DAYS_EMPLOYED", 150)


# --- U: reshaping ------------------------------------------------------------

@query("union_train_test", with_fixtures(["train", "test"], rounded(
    "SELECT * FROM combined", APP_DOUBLES), [_COMBINED]))
def q_union_train_test(spark, sf):
    """U1 + P8: train and test stacked by name with a provenance column."""
    t = _t(spark, sf)
    return profile.union_train_test(fixtures.application_train(t), fixtures.application_test(t))


@query("unpivot_scores", with_fixtures(["train"], rounded(" UNION ALL ".join(
    f"SELECT SK_ID_CURR, TARGET, '{c}' AS Source, {c} AS Value FROM train" for c in _BOX), ["Value"])))
def q_unpivot_scores(spark, sf):
    """The three external scores in long form."""
    train = fixtures.application_train(_t(spark, sf))
    return profile.unpivot_long(train, ["SK_ID_CURR", "TARGET"], _BOX)


# --- P / S2: columns ----------------------------------------------------------

@query("select_drop", with_fixtures(["train"], rounded(
    "SELECT * EXCLUDE (TARGET, SK_ID_CURR) FROM train", APP_DOUBLES)))
def q_select_drop(spark, sf):
    """Drop the label and the id."""
    return columns.select_drop(fixtures.application_train(_t(spark, sf)), drop=["TARGET", "SK_ID_CURR"])


@query("select_by_type", with_fixtures(["train"], rounded(
    f"SELECT {', '.join(APP_DOUBLES)} FROM train", APP_DOUBLES)))
def q_select_by_type(spark, sf):
    """Numeric columns except the label and the id."""
    train = fixtures.application_train(_t(spark, sf))
    return train.select(*columns.numeric_columns(train, exclude=["TARGET", "SK_ID_CURR"]))


@query("type_profile", with_fixtures(["train"],
    "SELECT CASE WHEN column_type IN ('INTEGER', 'SMALLINT', 'TINYINT') THEN 'integer' "
    "WHEN column_type IN ('DOUBLE', 'BIGINT', 'FLOAT') THEN 'numeric' ELSE 'character' END AS Data_Type, "
    "count(*) AS Count, sum(present)::BIGINT AS Present "
    "FROM (DESCRIBE SELECT * EXCLUDE (TARGET, SK_ID_CURR) FROM train) AS d "
    "JOIN (UNPIVOT (SELECT count(COLUMNS(* EXCLUDE (TARGET, SK_ID_CURR))) FROM train) ON COLUMNS(*) "
    "INTO NAME column_name VALUE present) AS p USING (column_name) GROUP BY 1"))
def q_type_profile(spark, sf):
    """Columns per R class (label and id excluded) and their values present."""
    return columns.type_profile(fixtures.application_train(_t(spark, sf)), exclude=["TARGET", "SK_ID_CURR"])


@query("select_by_prefix", with_fixtures(["app"] + HISTORY, rounded(
    "SELECT SK_ID_CURR, COLUMNS('^pos_') FROM augq", POS_CLIENT_DOUBLES),
    HIST_CTES + [f"augq AS ({_aug('app')})"]))
def q_select_by_prefix(spark, sf):
    """Case-sensitive ``^pos_`` columns of the augmented frame."""
    t = _t(spark, sf)
    aug = joins.augment_star(fixtures.application(t), fm.client_aggregates(t))
    return aug.select("SK_ID_CURR", *columns.columns_by_prefix(aug, "pos_"))


_APP_COLS = ["TARGET"] + APP_DOUBLES + CATS


@query("shared_columns", with_fixtures(["train", "test"] + HISTORY, rounded(
    f"SELECT {', '.join(_APP_COLS)} FROM ({_recode(_clean(_filled('train')))}) AS f", APP_DOUBLES),
    HIST_CTES + [STATS_CTE]))
def q_shared_columns(spark, sf):
    """Application columns present in the feature matrix (id dropped)."""
    t = _t(spark, sf)
    raw_cols = fixtures.application(t).columns
    train = fm.build(spark, sf).train
    keep = columns.setdiff(columns.intersect(raw_cols, train.columns), ["SK_ID_CURR"])
    return train.select(*keep)


@query("ordered_derive", with_fixtures(["train", "test"], rounded(
    "SELECT SK_ID_CURR, CAST(AMT_ANNUITY IS NULL AS INTEGER) AS AMT_ANNUITY_missing, "
    "COALESCE(AMT_ANNUITY, m) AS AMT_ANNUITY, COALESCE(AMT_ANNUITY, m) / (AMT_INCOME_TOTAL + 1) "
    "AS ANNUITY_TO_INCOME FROM test, (SELECT quantile_cont(AMT_ANNUITY, 0.5) AS m FROM train)",
    ["AMT_ANNUITY", "ANNUITY_TO_INCOME"])))
def q_ordered_derive(spark, sf):
    """P5: flag from the raw value, then impute, then a ratio of the imputed value.

    Three dependency levels, three ``withColumns`` calls.
    """
    t = _t(spark, sf)
    med = exact_quantiles(fixtures.application_train(t), ["AMT_ANNUITY"], [0.5])["AMT_ANNUITY"][0]
    test = fixtures.application_test(t)
    test = test.withColumns({"AMT_ANNUITY_missing": scalar.missing_flag("AMT_ANNUITY")})
    test = test.withColumns({"AMT_ANNUITY": F.coalesce("AMT_ANNUITY", F.lit(med))})
    test = test.withColumns({"ANNUITY_TO_INCOME": scalar.smoothed_ratio("AMT_ANNUITY", "AMT_INCOME_TOTAL")})
    return test.select("SK_ID_CURR", "AMT_ANNUITY_missing", "AMT_ANNUITY", "ANNUITY_TO_INCOME")


_REQ = ["AMT_REQ_CREDIT_BUREAU_MON", "AMT_REQ_CREDIT_BUREAU_YEAR"]


@query("zero_fill_group", with_fixtures(["app"], rounded(
    "SELECT SK_ID_CURR, COALESCE(COLUMNS('^AMT_REQ_CREDIT_BUREAU_'), 0) FROM app", _REQ)))
def q_zero_fill_group(spark, sf):
    """One expression (replace NULL by 0) over a prefix-selected group."""
    app = fixtures.application(_t(spark, sf))
    grp = columns.columns_by_prefix(app, "AMT_REQ_CREDIT_BUREAU_")
    return app.fillna(0, subset=grp).select("SK_ID_CURR", *grp)


@query("dict_select", with_fixtures(["app"], rounded(
    "SELECT SK_ID_CURR, APARTMENTS_AVG, BASEMENTAREA_AVG, LIVINGAREA_MEDI FROM app",
    ["APARTMENTS_AVG", "BASEMENTAREA_AVG", "LIVINGAREA_MEDI"])))
def q_dict_select(spark, sf):
    """S2 + F1 + P4: building columns named by the dictionary, minus the categorical ones."""
    app = fixtures.application(_t(spark, sf))
    return app.select("SK_ID_CURR", *fm.building_vars(app))


@query("filter_eq", with_fixtures(["app"], rounded(
    "SELECT SK_ID_CURR, AMT_CREDIT FROM app WHERE CODE_GENDER = 'F' AND NAME_FAMILY_STATUS = 'Married'",
    ["AMT_CREDIT"])))
def q_filter_eq(spark, sf):
    """conjunctive equality filter (pushed to the scan where the column is stored)."""
    app = fixtures.application(_t(spark, sf))
    return app.where((F.col("CODE_GENDER") == "F") & (F.col("NAME_FAMILY_STATUS") == "Married")) \
        .select("SK_ID_CURR", "AMT_CREDIT")


@query("left_enrich", with_fixtures(["app", "pos"], rounded(
    f"SELECT * FROM app LEFT JOIN pos_client USING (SK_ID_CURR)", APP_DOUBLES + POS_CLIENT_DOUBLES),
    [POS_CLIENT_SQL]))
def q_left_enrich(spark, sf):
    """Left join of a one-row-per-client aggregate (row count unchanged)."""
    t = _t(spark, sf)
    return joins.left_enrich(fixtures.application(t), history.pos_client(fixtures.pos_cash(t)))


# --- X: scalar functions --------------------------------------------------------

@query("missing_flags", with_fixtures(["app"],
    "SELECT SK_ID_CURR, " + ", ".join(f"CAST({c} IS NULL AS INTEGER) AS {c}_missing" for c in
                                      ["EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3", "EMERGENCYSTATE_MODE"])
    + " FROM app"))
def q_missing_flags(spark, sf):
    """``as.integer(is.na(x))``."""
    app = fixtures.application(_t(spark, sf))
    return impute.missing_flags(app, ["EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3",
                                      "EMERGENCYSTATE_MODE"]).select(
        "SK_ID_CURR", *[f"{c}_missing" for c in ["EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3",
                                                  "EMERGENCYSTATE_MODE"]])


_ZERO = ["OWN_CAR_AGE", "OBS_30_CNT_SOCIAL_CIRCLE", "DEF_30_CNT_SOCIAL_CIRCLE",
         "OBS_60_CNT_SOCIAL_CIRCLE", "DEF_60_CNT_SOCIAL_CIRCLE"]


@query("impute_constants", with_fixtures(["app"], rounded(
    "SELECT SK_ID_CURR, " + ", ".join(f"COALESCE({c}, 0) AS {c}" for c in _ZERO) + " FROM app", _ZERO)))
def q_impute_constants(spark, sf):
    """``replace_na(x, 0)``."""
    app = fixtures.application(_t(spark, sf))
    return app.select("SK_ID_CURR", *[F.coalesce(F.col(c), F.lit(0.0)).alias(c) for c in _ZERO])


@query("impute_fitted", with_fixtures(["train", "test"], rounded(
    "SELECT SK_ID_CURR, " + ", ".join(f"COALESCE({c}, m_{c}) AS {c}" for c in MEDIANS) + ", "
    + ", ".join(f"COALESCE({c}, mode_{c}) AS {c}" for c in MODES) + " FROM test CROSS JOIN stats",
    MEDIANS), [STATS_CTE]))
def q_impute_fitted(spark, sf):
    """Test NULLs replaced by medians / modes fitted on the training rows."""
    t = _t(spark, sf)
    stats = impute.fit_train_stats(fixtures.application_train(t))
    test = fixtures.application_test(t)
    return test.select("SK_ID_CURR", *[F.coalesce(F.col(c), F.lit(stats.medians[c])).alias(c) for c in MEDIANS],
                       *[F.coalesce(F.col(c), F.lit(stats.modes[c])).alias(c) for c in MODES])


@query("sentinel_repair", with_fixtures(["app"], rounded(
    "SELECT SK_ID_CURR, CASE WHEN DAYS_EMPLOYED = 365243 THEN CAST(0 AS DOUBLE) "
    "WHEN DAYS_EMPLOYED <> 365243 THEN abs(DAYS_EMPLOYED) END AS DAYS_EMPLOYED FROM app",
    ["DAYS_EMPLOYED"])))
def q_sentinel_repair(spark, sf):
    """F4 + X4: ``ifelse(x == 365243, 0, abs(x))`` (NULL condition stays NULL)."""
    app = fixtures.application(_t(spark, sf))
    return app.select("SK_ID_CURR", scalar.sentinel_repair("DAYS_EMPLOYED").alias("DAYS_EMPLOYED"))


@query("recode_prefix", with_fixtures(["app"],
    "SELECT SK_ID_CURR, " + "CASE WHEN regexp_matches(ORGANIZATION_TYPE, '^Industry') THEN 'Industry' "
    "WHEN regexp_matches(ORGANIZATION_TYPE, '^Trade') THEN 'Trade' "
    "WHEN regexp_matches(ORGANIZATION_TYPE, '^Transport') THEN 'Transport' "
    "WHEN ORGANIZATION_TYPE IN ('Business Entity Type 3', 'Government', 'Construction', 'Housing', "
    "'Medicine', 'Self-employed', 'School', 'XNA') THEN ORGANIZATION_TYPE ELSE 'Other' END "
    "AS ORGANIZATION_TYPE FROM app"))
def q_recode_prefix(spark, sf):
    """X7 + X5 + X6: prefix rules, a kept list, everything else (NULL too) to Other."""
    app = fixtures.application(_t(spark, sf))
    rules, default = recode.RECODE_RULES["ORGANIZATION_TYPE"]
    return app.select("SK_ID_CURR", recode.recode_expr("ORGANIZATION_TYPE", rules, default)
                      .alias("ORGANIZATION_TYPE"))


@query("day_conversions", with_fixtures(["app"], rounded(
    "SELECT SK_ID_CURR, abs(DAYS_BIRTH) / 365 AS AGE_YEARS, abs(DAYS_EMPLOYED) AS DAYS_EMPLOYED_ABS, "
    "DAYS_EMPLOYED - DAYS_BIRTH AS DAYS_EMPLOYED_MINUS_BIRTH FROM app",
    ["AGE_YEARS", "DAYS_EMPLOYED_ABS", "DAYS_EMPLOYED_MINUS_BIRTH"])))
def q_day_conversions(spark, sf):
    """X8 + X16: abs, subtraction and days -> years."""
    app = fixtures.application(_t(spark, sf))
    return app.select("SK_ID_CURR", scalar.days_to_years("DAYS_BIRTH").alias("AGE_YEARS"),
                      F.abs("DAYS_EMPLOYED").alias("DAYS_EMPLOYED_ABS"),
                      (F.col("DAYS_EMPLOYED") - F.col("DAYS_BIRTH")).alias("DAYS_EMPLOYED_MINUS_BIRTH"))


_RATIOS = ["CREDIT_TO_INCOME", "ANNUITY_TO_INCOME", "LOAN_TO_GOODS", "CREDIT_PER_PERSON"]


@query("smoothed_ratios", with_fixtures(["app"], rounded(
    "SELECT SK_ID_CURR, AMT_CREDIT / NULLIF(AMT_INCOME_TOTAL + 1, 0) AS CREDIT_TO_INCOME, "
    "AMT_ANNUITY / NULLIF(AMT_INCOME_TOTAL + 1, 0) AS ANNUITY_TO_INCOME, "
    "AMT_CREDIT / NULLIF(AMT_GOODS_PRICE + 1, 0) AS LOAN_TO_GOODS, "
    "AMT_CREDIT / NULLIF(CNT_FAM_MEMBERS + 1, 0) AS CREDIT_PER_PERSON, "
    "DEF_60_CNT_SOCIAL_CIRCLE / NULLIF(DEF_60_CNT_SOCIAL_CIRCLE + 1, 0) AS DEF60_RATIO FROM app",
    _RATIOS + ["DEF60_RATIO"])))
def q_smoothed_ratios(spark, sf):
    """``a / (b + 1)`` on raw values; NULL where b = -1 (DEF60_RATIO hits it)."""
    app = fixtures.application(_t(spark, sf))
    r = scalar.smoothed_ratio
    return app.select("SK_ID_CURR", r("AMT_CREDIT", "AMT_INCOME_TOTAL").alias("CREDIT_TO_INCOME"),
                      r("AMT_ANNUITY", "AMT_INCOME_TOTAL").alias("ANNUITY_TO_INCOME"),
                      r("AMT_CREDIT", "AMT_GOODS_PRICE").alias("LOAN_TO_GOODS"),
                      r("AMT_CREDIT", "CNT_FAM_MEMBERS").alias("CREDIT_PER_PERSON"),
                      r("DEF_60_CNT_SOCIAL_CIRCLE", "DEF_60_CNT_SOCIAL_CIRCLE").alias("DEF60_RATIO"))


@query("age_bin", with_fixtures(["train", "test"], rounded(
    "SELECT SK_ID_CURR, abs(DAYS_BIRTH) / 365 AS AGE_YEARS, "
    "COALESCE(labels[CASE WHEN abs(DAYS_BIRTH) / 365 >= e[1] AND abs(DAYS_BIRTH) / 365 <= e[2] THEN 1 "
    "WHEN abs(DAYS_BIRTH) / 365 > e[2] AND abs(DAYS_BIRTH) / 365 <= e[3] THEN 2 "
    "WHEN abs(DAYS_BIRTH) / 365 > e[3] AND abs(DAYS_BIRTH) / 365 <= e[4] THEN 3 "
    "WHEN abs(DAYS_BIRTH) / 365 > e[4] AND abs(DAYS_BIRTH) / 365 <= e[5] THEN 4 END], labels[mode_bin]) "
    "AS AGE_BIN FROM test CROSS JOIN stats", ["AGE_YEARS"]), [STATS_CTE]))
def q_age_bin(spark, sf):
    """X10 + X11: right-closed bins on training quartiles; unbinned test rows get the modal bin."""
    t = _t(spark, sf)
    stats = impute.fit_age_bins(fixtures.application_train(t))
    age = scalar.days_to_years("DAYS_BIRTH")
    label = scalar.right_closed_bin_label(age, stats.age_edges, stats.age_labels)
    return fixtures.application_test(t).select(
        "SK_ID_CURR", age.alias("AGE_YEARS"),
        F.coalesce(label, F.lit(stats.age_mode_label)).alias("AGE_BIN"))


@query("label_levels", with_fixtures(["train"],
    "SELECT SK_ID_CURR, CASE TARGET WHEN 0 THEN 'No' WHEN 1 THEN 'Yes' END AS TARGET_label, "
    "CAST(TARGET AS VARCHAR) AS TARGET_str FROM train"))
def q_label_levels(spark, sf):
    """Casts, including a factor with labels (0 -> No, 1 -> Yes)."""
    train = fixtures.application_train(_t(spark, sf))
    return train.select("SK_ID_CURR", F.when(F.col("TARGET") == 0, "No").when(F.col("TARGET") == 1, "Yes")
                        .alias("TARGET_label"), F.col("TARGET").cast("string").alias("TARGET_str"))

