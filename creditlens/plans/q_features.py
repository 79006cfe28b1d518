"""Queries D10-D15: fitted statistics, zero-fill, cleaning, recoding and the
end-to-end feature matrices."""

from __future__ import annotations

from pyspark.sql import functions as F

from creditlens.operators import impute, joins, recode
from creditlens.operators.quantiles import exact_quantiles, mode_frame
from creditlens.plans import feature_matrix as fm
from creditlens.plans.oracle_sql import APP_DOUBLES, rounded, with_fixtures
from creditlens.plans.q_history import (BUREAU_CLIENT_DOUBLES, BUREAU_CLIENT_SQL,
                                        CC_CLIENT_DOUBLES, CC_CLIENT_SQL, INST_CLIENT_DOUBLES,
                                        INST_CLIENT_SQL, POS_CLIENT_DOUBLES, POS_CLIENT_SQL,
                                        PREV_CLIENT_DOUBLES, PREV_CLIENT_SQL)
from creditlens.plans.registry import query
from creditlens.sources import fixtures
from creditlens.sources.tables import Tables

HISTORY = ["pos", "bureau", "bb", "cc", "prev", "install"]
HIST_CTES = [POS_CLIENT_SQL, BUREAU_CLIENT_SQL, CC_CLIENT_SQL, PREV_CLIENT_SQL, INST_CLIENT_SQL]
FILL_RE = "^(COUNT_|pos_|bureau_|cc_|prev_|inst_|AMT_REQ_CREDIT_BUREAU_)"
MEDIANS = ["EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3", "CNT_FAM_MEMBERS", "AMT_ANNUITY",
           "AMT_GOODS_PRICE", "DAYS_LAST_PHONE_CHANGE"]
MODES = ["NAME_TYPE_SUITE", "OCCUPATION_TYPE", "FONDKAPREMONT_MODE", "HOUSETYPE_MODE",
         "WALLSMATERIAL_MODE", "EMERGENCYSTATE_MODE"]


def _aug(app: str) -> str:
    return (f"SELECT * FROM {app} LEFT JOIN pos_client USING (SK_ID_CURR) "
            "LEFT JOIN bureau_client USING (SK_ID_CURR) LEFT JOIN cc_client USING (SK_ID_CURR) "
            "LEFT JOIN prev_client USING (SK_ID_CURR) LEFT JOIN inst_client USING (SK_ID_CURR)")


def _filled(app: str) -> str:
    return f"""SELECT COLUMNS(lambda c: NOT regexp_matches(c, '{FILL_RE}')),
      COALESCE(COLUMNS('{FILL_RE}'), 0),
      CAST(COALESCE(COUNT_POS_LOANS, 0) > 0 AS INTEGER) AS HAS_POS_LOAN,
      CAST(COALESCE(COUNT_BUREAU_RECORDS, 0) > 0 AS INTEGER) AS HAS_BUREAU_RECORD,
      CAST(COALESCE(COUNT_CREDIT_CARDS, 0) > 0 AS INTEGER) AS HAS_CREDIT_CARD,
      CAST(COALESCE(COUNT_PREV_APPLICATIONS, 0) > 0 AS INTEGER) AS HAS_PREV_APP,
      CAST(COALESCE(COUNT_INSTALLMENT_LOANS, 0) > 0 AS INTEGER) AS HAS_INSTALLMENT_LOAN
    FROM ({_aug(app)}) AS a"""


def _mode_sql(c: str) -> str:
    return (f"(SELECT {c} FROM train WHERE {c} IS NOT NULL GROUP BY {c} "
            f"ORDER BY count(*) DESC, {c} LIMIT 1)")


def _bin_sql(x: str) -> str:
    return (f"CASE WHEN {x} >= e[1] AND {x} <= e[2] THEN 1 WHEN {x} > e[2] AND {x} <= e[3] THEN 2 "
            f"WHEN {x} > e[3] AND {x} <= e[4] THEN 3 WHEN {x} > e[4] AND {x} <= e[5] THEN 4 END")


_LABELS = ("['[' || printf('%.3g', e[1]) || ',' || printf('%.3g', e[2]) || ']', "
           "'(' || printf('%.3g', e[2]) || ',' || printf('%.3g', e[3]) || ']', "
           "'(' || printf('%.3g', e[3]) || ',' || printf('%.3g', e[4]) || ']', "
           "'(' || printf('%.3g', e[4]) || ',' || printf('%.3g', e[5]) || ']']")

STATS_CTE = ("stats0 AS (SELECT " + ", ".join(f"quantile_cont({c}, 0.5) AS m_{c}" for c in MEDIANS)
             + ", " + ", ".join(f"{_mode_sql(c)} AS mode_{c}" for c in MODES)
             + ", quantile_cont(abs(DAYS_BIRTH) / 365, [0.0, 0.25, 0.5, 0.75, 1.0]) AS e FROM train),\n"
             + f"stats AS (SELECT *, {_LABELS} AS labels, (SELECT b FROM (SELECT {_bin_sql('abs(DAYS_BIRTH) / 365')} AS b"
             " FROM train) WHERE b IS NOT NULL GROUP BY b ORDER BY count(*) DESC, b LIMIT 1) AS mode_bin"
             " FROM stats0)")

_ZERO_IMPUTE = ["bureau_DEBT_RATIO", "OWN_CAR_AGE", "OBS_30_CNT_SOCIAL_CIRCLE",
                "DEF_30_CNT_SOCIAL_CIRCLE", "OBS_60_CNT_SOCIAL_CIRCLE", "DEF_60_CNT_SOCIAL_CIRCLE",
                "APARTMENTS_AVG", "BASEMENTAREA_AVG", "LIVINGAREA_MEDI"]


def _clean(src: str) -> str:
    rep = [f"COALESCE({c}, m_{c}) AS {c}" for c in MEDIANS]
    rep += [f"COALESCE({c}, CAST(0 AS DOUBLE)) AS {c}" for c in _ZERO_IMPUTE]
    rep += [f"COALESCE({c}, mode_{c}) AS {c}" for c in MODES]
    rep.append("CASE WHEN DAYS_EMPLOYED = 365243 THEN CAST(0 AS DOUBLE) "
               "WHEN DAYS_EMPLOYED <> 365243 THEN abs(DAYS_EMPLOYED) END AS DAYS_EMPLOYED")
    new = [f"CAST({c} IS NULL AS INTEGER) AS {c}_missing"
           for c in ["EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3", "EMERGENCYSTATE_MODE"]]
    new += [
        "abs(DAYS_BIRTH) / 365 AS AGE_YEARS",
        "AMT_CREDIT / NULLIF(AMT_INCOME_TOTAL + 1, 0) AS CREDIT_TO_INCOME",
        "COALESCE(AMT_ANNUITY, m_AMT_ANNUITY) / NULLIF(AMT_INCOME_TOTAL + 1, 0) AS ANNUITY_TO_INCOME",
        "AMT_CREDIT / NULLIF(COALESCE(AMT_GOODS_PRICE, m_AMT_GOODS_PRICE) + 1, 0) AS LOAN_TO_GOODS",
        "AMT_CREDIT / NULLIF(COALESCE(CNT_FAM_MEMBERS, m_CNT_FAM_MEMBERS) + 1, 0) AS CREDIT_PER_PERSON",
        f"COALESCE(labels[{_bin_sql('abs(DAYS_BIRTH) / 365')}], labels[mode_bin]) AS AGE_BIN",
    ]
    stats_cols = ", ".join([f"m_{c}" for c in MEDIANS] + [f"mode_{c}" for c in MODES]
                           + ["e", "labels", "mode_bin"])
    return (f"SELECT * EXCLUDE ({stats_cols}) REPLACE ({', '.join(rep)}), {', '.join(new)} "
            f"FROM ({src}) AS s CROSS JOIN stats")


_RECODE = {
    "CODE_GENDER": "CASE WHEN CODE_GENDER IN ('XNA') THEN 'F' ELSE CODE_GENDER END",
    "NAME_TYPE_SUITE": "CASE WHEN NAME_TYPE_SUITE IN ('Other_A', 'Other_B', 'Group of people') "
                       "THEN 'Other' ELSE NAME_TYPE_SUITE END",
    "NAME_INCOME_TYPE": "CASE WHEN NAME_INCOME_TYPE IN ('Businessman', 'Maternity leave', 'Student', "
                        "'Unemployed') THEN 'Other' ELSE NAME_INCOME_TYPE END",
    "NAME_EDUCATION_TYPE": "CASE WHEN NAME_EDUCATION_TYPE IN ('Lower secondary', "
                           "'Secondary / secondary special', 'Incomplete higher') THEN NAME_EDUCATION_TYPE "
                           "WHEN NAME_EDUCATION_TYPE IN ('Higher education', 'Academic degree') "
                           "THEN 'Academic / Bachelors or higher' ELSE 'Other' END",
    "NAME_FAMILY_STATUS": "CASE WHEN NAME_FAMILY_STATUS = 'Unknown' THEN 'Married' ELSE NAME_FAMILY_STATUS END",
    "NAME_HOUSING_TYPE": "CASE WHEN NAME_HOUSING_TYPE IN ('Co-op apartment', 'Office apartment') THEN 'Other' "
                         "WHEN NAME_HOUSING_TYPE IN ('Municipal apartment', 'Rented apartment') "
                         "THEN 'Rented / Municipal' ELSE NAME_HOUSING_TYPE END",
    "OCCUPATION_TYPE": "CASE WHEN OCCUPATION_TYPE IN ('Laborers', 'Core staff', 'Sales staff', 'Managers', "
                       "'Drivers') THEN OCCUPATION_TYPE ELSE 'Other' END",
    "ORGANIZATION_TYPE": "CASE WHEN regexp_matches(ORGANIZATION_TYPE, '^Industry') THEN 'Industry' "
                         "WHEN regexp_matches(ORGANIZATION_TYPE, '^Trade') THEN 'Trade' "
                         "WHEN regexp_matches(ORGANIZATION_TYPE, '^Transport') THEN 'Transport' "
                         "WHEN ORGANIZATION_TYPE IN ('Business Entity Type 3', 'Government', 'Construction', "
                         "'Housing', 'Medicine', 'Self-employed', 'School', 'XNA') THEN ORGANIZATION_TYPE "
                         "ELSE 'Other' END",
    "WALLSMATERIAL_MODE": "CASE WHEN WALLSMATERIAL_MODE IN ('Monolithic', 'Mixed', 'Others') THEN 'Other' "
                          "ELSE WALLSMATERIAL_MODE END",
}


def _recode(src: str) -> str:
    rep = ", ".join(f"{e} AS {c}" for c, e in _RECODE.items())
    return f"SELECT * REPLACE ({rep}) FROM ({src}) AS r"


HIST_DOUBLES = (POS_CLIENT_DOUBLES + BUREAU_CLIENT_DOUBLES + CC_CLIENT_DOUBLES
                + PREV_CLIENT_DOUBLES + INST_CLIENT_DOUBLES)
FM_DOUBLES = APP_DOUBLES + HIST_DOUBLES + ["AGE_YEARS", "CREDIT_TO_INCOME", "ANNUITY_TO_INCOME",
                                           "LOAN_TO_GOODS", "CREDIT_PER_PERSON"]


def _feature_matrix_sql(app: str) -> str:
    body = _recode(_clean(_filled(app)))
    return with_fixtures(["train", "test"] + HISTORY, rounded("SELECT * FROM fmx", FM_DOUBLES),
                         HIST_CTES + [STATS_CTE, f"fmx AS ({body})"])


# ---------------------------------------------------------------------------


def _train_stats(spark, sf):
    t = Tables(spark, sf)
    return impute.fit_train_stats(fixtures.application_train(t))


@query("fit_train_stats", with_fixtures(["train"], rounded(
    "SELECT " + ", ".join(f"m_{c} AS {c}_median" for c in MEDIANS) + ", "
    + ", ".join(f"mode_{c} AS {c}_mode" for c in MODES) + ", "
    + ", ".join(f"e[{i + 1}] AS AGE_edge_{i}" for i in range(5))
    + ", labels[mode_bin] AS AGE_BIN_mode FROM stats",
    [f"{c}_median" for c in MEDIANS] + [f"AGE_edge_{i}" for i in range(5)]), [STATS_CTE]))
def q_fit_train_stats(spark, sf):
    """The fitted bundle (medians, modes, age edges, modal bin) as one row."""
    return impute.stats_frame(spark, _train_stats(spark, sf))


@query("train_medians", with_fixtures(["train"], rounded(
    "SELECT " + ", ".join(f"quantile_cont({c}, 0.5) AS {c}" for c in MEDIANS) + " FROM train", MEDIANS)))
def q_train_medians(spark, sf):
    """Exact interpolated medians of the training rows."""
    train = fixtures.application_train(Tables(spark, sf))
    q = exact_quantiles(train, MEDIANS, [0.5])
    return spark.createDataFrame([tuple(q[c][0] for c in MEDIANS)],
                                 ", ".join(f"{c} double" for c in MEDIANS))


@query("quantile_edges", with_fixtures(["train"], rounded(
    "SELECT unnest([0.0, 0.25, 0.5, 0.75, 1.0]) AS prob, "
    "unnest(quantile_cont(abs(DAYS_BIRTH) / 365, [0.0, 0.25, 0.5, 0.75, 1.0])) AS AGE_YEARS "
    "FROM train", ["prob", "AGE_YEARS"])))
def q_quantile_edges(spark, sf):
    """Type-7 quantiles of age in years."""
    train = fixtures.application_train(Tables(spark, sf))
    ages = train.select((F.abs("DAYS_BIRTH") / 365).alias("AGE_YEARS"))
    probs = impute.AGE_PROBS
    q = exact_quantiles(ages, ["AGE_YEARS"], probs)["AGE_YEARS"]
    return spark.createDataFrame(list(zip(probs, q)), "prob double, AGE_YEARS double")


@query("col_modes", with_fixtures(["train"], " UNION ALL ".join(
    f"SELECT '{c}' AS variable, {c} AS mode, count(*) AS n FROM train WHERE {c} IS NOT NULL "
    f"GROUP BY {c} QUALIFY row_number() OVER (ORDER BY count(*) DESC, {c}) = 1" for c in MODES)))
def q_col_modes(spark, sf):
    """Modal level per categorical column (smallest level on ties)."""
    return mode_frame(fixtures.application_train(Tables(spark, sf)), MODES)


@query("augment_star", with_fixtures(["app"] + HISTORY, rounded(
    "SELECT * FROM augq", APP_DOUBLES + HIST_DOUBLES), HIST_CTES + [
    f"augq AS ({_aug('app')})"]))
def q_augment_star(spark, sf):
    """Five left joins; the application row count is unchanged."""
    t = Tables(spark, sf)
    return joins.augment_star(fixtures.application(t), fm.client_aggregates(t))


@query("zero_fill_flags", with_fixtures(["app"] + HISTORY, rounded(
    "SELECT * FROM zf", APP_DOUBLES + HIST_DOUBLES), HIST_CTES + [
    f"zf AS ({_filled('app')})"]))
def q_zero_fill_flags(spark, sf):
    """Zero-filled history groups and HAS_* flags for every client."""
    t = Tables(spark, sf)
    return fm.augment(fixtures.application(t), fm.client_aggregates(t))


_CLEAN_COLS = (["SK_ID_CURR"] + MEDIANS + _ZERO_IMPUTE + MODES
               + ["DAYS_EMPLOYED", "EXT_SOURCE_1_missing", "EXT_SOURCE_2_missing",
                  "EXT_SOURCE_3_missing", "EMERGENCYSTATE_MODE_missing", "AGE_YEARS",
                  "CREDIT_TO_INCOME", "ANNUITY_TO_INCOME", "LOAN_TO_GOODS", "CREDIT_PER_PERSON",
                  "AGE_BIN"])
_CLEAN_DOUBLES = [c for c in _CLEAN_COLS if c not in MODES and not c.endswith("_missing")
                  and c not in ("SK_ID_CURR", "AGE_BIN")]


@query("clean_application", with_fixtures(["train", "test"] + HISTORY, rounded(
    f"SELECT {', '.join(_CLEAN_COLS)} FROM ({_clean(_filled('test'))}) AS c", _CLEAN_DOUBLES),
    HIST_CTES + [STATS_CTE]))
def q_clean_application(spark, sf):
    """The test rows cleaned with statistics fitted on the training rows."""
    return _clean_only(spark, sf)


def _clean_only(spark, sf):
    t = Tables(spark, sf)
    stats = impute.fit_train_stats(fixtures.application_train(t))
    test = fm.augment(fixtures.application_test(t), fm.client_aggregates(t))
    bvars = fm.building_vars(fixtures.application_train(t))
    return impute.clean_application(test, stats, bvars).select(*_CLEAN_COLS)


@query("recode_levels", with_fixtures(["app"], f"SELECT SK_ID_CURR, {', '.join(_RECODE)} FROM ("
       + _recode("SELECT * FROM app") + ") AS x"))
def q_recode_levels(spark, sf):
    """The nine recode rules on every application row."""
    app = fixtures.application(Tables(spark, sf))
    return recode.recode_levels(app).select("SK_ID_CURR", *recode.RECODE_RULES)


@query("feature_matrix_train", _feature_matrix_sql("train"))
def q_feature_matrix_train(spark, sf):
    """The training feature matrix (flagship)."""
    return fm.build(spark, sf).train


@query("feature_matrix_test", _feature_matrix_sql("test"))
def q_feature_matrix_test(spark, sf):
    """The test feature matrix, cleaned with training statistics."""
    return fm.build(spark, sf).test
