"""Credit-risk tables derived from the driver's TPC-H-like tables.

The reference reads an application table and six history tables.  The
driver ships none of them, so each one is a projection of the given tables
(FIXTURES.md, SURVEY 5.3).  NULLs are injected by fixed ``CASE`` rules on
keys so the same rows exist in Spark and in the DuckDB oracle.  Nothing is
filtered by id: every customer, order and line item takes part.

application      customer        one row per client; TARGET = c_acctbal < 0
POS_CASH         lineitem+orders  loans of priority 1-URGENT / 2-HIGH
installments     lineitem+orders  every line of every order
previous_app     orders           every order
bureau           orders           every order as an external credit
bureau_balance   lineitem         every line as a monthly status
credit_card      events           one account per (user, event type)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditlens.sources.tables import Tables

# ---------------------------------------------------------------------------
# Category levels of the public application table (the levels
# the recode rules name must be present so that the rules are exercised).
# ---------------------------------------------------------------------------
NAME_TYPE_SUITE_LEVELS = ["Unaccompanied", "Family", "Spouse, partner", "Children",
                          "Other_A", "Other_B", "Group of people"]
NAME_INCOME_TYPE_LEVELS = ["Working", "Commercial associate", "Pensioner", "State servant",
                           "Unemployed", "Student", "Businessman", "Maternity leave"]
NAME_EDUCATION_TYPE_LEVELS = ["Secondary / secondary special", "Higher education",
                              "Incomplete higher", "Lower secondary", "Academic degree"]
NAME_FAMILY_STATUS_LEVELS = ["Married", "Single / not married", "Civil marriage", "Separated",
                             "Widow", "Unknown"]
NAME_HOUSING_TYPE_LEVELS = ["House / apartment", "With parents", "Municipal apartment",
                            "Rented apartment", "Office apartment", "Co-op apartment"]
OCCUPATION_TYPE_LEVELS = ["Laborers", "Core staff", "Sales staff", "Managers", "Drivers",
                          "High skill tech staff", "Accountants", "Medicine staff",
                          "Security staff", "Cooking staff"]
ORGANIZATION_TYPE_LEVELS = ["Business Entity Type 3", "XNA", "Self-employed", "Other", "Medicine",
                            "Government", "School", "Trade: type 7", "Kindergarten",
                            "Construction", "Transport: type 4", "Industry: type 9", "Housing",
                            "Bank", "Trade: type 2", "Military"]
FONDKAPREMONT_MODE_LEVELS = ["reg oper account", "org spec account", "reg oper spec account",
                             "not specified"]
HOUSETYPE_MODE_LEVELS = ["block of flats", "specific housing", "terraced house"]
WALLSMATERIAL_MODE_LEVELS = ["Panel", "Stone, brick", "Block", "Wooden", "Mixed", "Monolithic",
                             "Others"]
EMERGENCYSTATE_MODE_LEVELS = ["No", "Yes"]

BUILDING_NUMERIC = ["APARTMENTS_AVG", "BASEMENTAREA_AVG", "LIVINGAREA_MEDI"]
BUILDING_CATEGORICAL = ["FONDKAPREMONT_MODE", "HOUSETYPE_MODE", "WALLSMATERIAL_MODE",
                        "EMERGENCYSTATE_MODE"]
BUILDING_DESCRIPTION = (
    "Normalized information about building where the client lives, What is average "
    "(_AVG suffix), modus (_MODE suffix), median (_MEDI suffix) apartment size, common area, "
    "living area, age of building, number of elevators, number of entrances, state of the "
    "building, number of floor")
APPLICATION_TABLE_NAME = "application_{train|test}.csv"

# Train / test membership of a client: both halves are used.
TEST_MODULUS = 5


def _nul(cond: str, expr: str) -> str:
    return f"CASE WHEN {cond} THEN NULL ELSE {expr} END"


def _pick_sql(levels: list[str], index: str) -> str:
    arr = ", ".join("'" + v.replace("'", "\\'") + "'" for v in levels)
    return f"element_at(array({arr}), CAST(({index}) % {len(levels)} AS INT) + 1)"


# (column, Spark SQL expression over customer); k = c_custkey, nk = c_nationkey
_APPLICATION_COLUMNS = [
    ("SK_ID_CURR", "k"),
    ("TARGET", "CAST(CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END AS INT)"),
    ("EXT_SOURCE_1", _nul("k % 7 = 0", "(k * 37 % 1000) / 1000")),
    ("EXT_SOURCE_2", _nul("k % 11 = 0", "(k * 91 % 1000) / 1000")),
    ("EXT_SOURCE_3", _nul("k % 9 = 4", "round(nk / 50 + (k * 73 % 1000) / 2000, 4)")),
    ("CNT_FAM_MEMBERS", _nul("k % 13 = 0", "CAST(k % 5 + 1 AS DOUBLE)")),
    ("AMT_ANNUITY", _nul("k % 17 = 0", "CAST(k * 53 % 9000 + 500 AS DOUBLE)")),
    ("AMT_GOODS_PRICE", _nul("k % 19 = 0", "CAST(k * 101 % 90000 + 9000 AS DOUBLE)")),
    ("AMT_CREDIT", "CAST(k * 101 % 90000 + 10000 AS DOUBLE)"),
    ("AMT_INCOME_TOTAL", "CAST(k * 211 % 50000 + 5000 AS DOUBLE)"),
    ("OWN_CAR_AGE", _nul("k % 3 = 0", "CAST(k % 20 AS DOUBLE)")),
    ("OBS_30_CNT_SOCIAL_CIRCLE", _nul("k % 23 = 0", "CAST(k % 4 AS DOUBLE)")),
    ("DEF_30_CNT_SOCIAL_CIRCLE", _nul("k % 23 = 0", "CAST(k % 2 AS DOUBLE)")),
    ("OBS_60_CNT_SOCIAL_CIRCLE", _nul("k % 23 = 1", "CAST(k % 5 AS DOUBLE)")),
    ("DEF_60_CNT_SOCIAL_CIRCLE", _nul("k % 23 = 1", "CAST(k % 3 - 1 AS DOUBLE)")),
    ("DAYS_LAST_PHONE_CHANGE", _nul("k % 29 = 0", "CAST(-(k * 17 % 3000) AS DOUBLE)")),
    ("DAYS_EMPLOYED", "CASE WHEN k % 6 = 0 THEN 365243D ELSE CAST(-(k * 7 % 8000) AS DOUBLE) END"),
    ("DAYS_BIRTH", "CAST(-(k * 13 % 17500 + 7500) AS DOUBLE)"),
    ("AMT_REQ_CREDIT_BUREAU_MON", _nul("k % 8 = 0", "CAST(k % 3 AS DOUBLE)")),
    ("AMT_REQ_CREDIT_BUREAU_YEAR", _nul("k % 8 = 0", "CAST(k % 4 AS DOUBLE)")),
    ("APARTMENTS_AVG", _nul("k % 4 = 0", "(k * 7 % 100) / 100")),
    ("BASEMENTAREA_AVG", _nul("k % 5 = 0", "(k * 11 % 100) / 100")),
    ("LIVINGAREA_MEDI", _nul("k % 3 = 2", "(k * 13 % 100) / 100")),
    ("NAME_TYPE_SUITE", _nul("k % 10 = 0", _pick_sql(NAME_TYPE_SUITE_LEVELS, "k * 3 + nk"))),
    ("OCCUPATION_TYPE", _nul("k % 7 = 3", _pick_sql(OCCUPATION_TYPE_LEVELS, "k + nk"))),
    ("FONDKAPREMONT_MODE", _nul("k % 3 = 1", _pick_sql(FONDKAPREMONT_MODE_LEVELS, "k"))),
    ("HOUSETYPE_MODE", _nul("k % 4 = 1", _pick_sql(HOUSETYPE_MODE_LEVELS, "k * 7"))),
    ("WALLSMATERIAL_MODE", _nul("k % 5 = 2", _pick_sql(WALLSMATERIAL_MODE_LEVELS, "k * 3"))),
    ("EMERGENCYSTATE_MODE", _nul("k % 6 = 1", _pick_sql(EMERGENCYSTATE_MODE_LEVELS, "k * 3 + nk"))),
    ("CODE_GENDER", "CASE WHEN k % 50 = 1 THEN 'XNA' WHEN k % 2 = 0 THEN 'F' ELSE 'M' END"),
    ("NAME_INCOME_TYPE", _pick_sql(NAME_INCOME_TYPE_LEVELS, "k * 5 + nk")),
    ("NAME_EDUCATION_TYPE", _pick_sql(NAME_EDUCATION_TYPE_LEVELS, "k * 11 + nk")),
    ("NAME_FAMILY_STATUS", _pick_sql(NAME_FAMILY_STATUS_LEVELS, "k * 13")),
    ("NAME_HOUSING_TYPE", _pick_sql(NAME_HOUSING_TYPE_LEVELS, "k * 17 + nk")),
    ("ORGANIZATION_TYPE", _pick_sql(ORGANIZATION_TYPE_LEVELS, "k * 19 + nk")),
]


def application(t: Tables) -> DataFrame:
    """Application rows for every client (train and test together), one projection."""
    c = t.customer.selectExpr("c_custkey AS k", "CAST(c_nationkey AS BIGINT) AS nk", "c_acctbal")
    return c.selectExpr(*[f"{e} AS {name}" for name, e in _APPLICATION_COLUMNS])


def is_test(id_col: str = "SK_ID_CURR") -> Column:
    return F.col(id_col) % TEST_MODULUS == 0


def application_train(t: Tables) -> DataFrame:
    return application(t).filter(~is_test())


def application_test(t: Tables) -> DataFrame:
    """Test rows carry no label, as in the reference."""
    return application(t).filter(is_test()).drop("TARGET")


def _line_orders(t: Tables) -> DataFrame:
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderdate")
    return t.lineitem.join(o, F.col("l_orderkey") == F.col("o_orderkey"), "inner")


def pos_cash(t: Tables) -> DataFrame:
    """POS_CASH_balance: (client, loan, month) rows, one per line of every order."""
    return _line_orders(t).selectExpr(
        "o_custkey AS SK_ID_CURR", "l_orderkey AS SK_ID_PREV",
        "CAST(-l_linenumber AS DOUBLE) AS MONTHS_BALANCE",
        _nul("l_linenumber = 3", "l_quantity") + " AS CNT_INSTALMENT",
        _nul("l_linenumber = 4", "l_quantity - l_linenumber") + " AS CNT_INSTALMENT_FUTURE",
        "CASE WHEN l_orderkey % 7 = 0 THEN NULL WHEN l_returnflag = 'R' THEN l_quantity - 40 "
        "ELSE 0D END AS SK_DPD",
        "CASE WHEN l_orderkey % 7 = 0 THEN NULL WHEN l_returnflag = 'R' AND l_linestatus = 'F' "
        "THEN l_quantity - 45 ELSE 0D END AS SK_DPD_DEF")


def installments(t: Tables) -> DataFrame:
    """installments_payments: one row per line of every order."""
    return _line_orders(t).selectExpr(
        "o_custkey AS SK_ID_CURR", "l_orderkey AS SK_ID_PREV",
        "CAST(l_linenumber * 30 AS DOUBLE) AS DAYS_INSTALMENT",
        _nul("l_linenumber = 5", "CAST(datediff(to_date(l_shipdate), to_date(o_orderdate)) AS DOUBLE)")
        + " AS DAYS_ENTRY_PAYMENT",
        "l_extendedprice AS AMT_INSTALMENT",
        _nul("l_linenumber = 5", "l_extendedprice * (1 - l_discount)") + " AS AMT_PAYMENT")


def previous_application(t: Tables) -> DataFrame:
    d = "CAST(-datediff(DATE'2002-01-01', to_date(o_orderdate)) AS DOUBLE)"
    return t.orders.selectExpr(
        "o_custkey AS SK_ID_CURR", "o_orderkey AS SK_ID_PREV", "o_totalprice AS AMT_APPLICATION",
        _nul("o_orderstatus = 'P'", "o_totalprice * 0.9D") + " AS AMT_CREDIT",
        _nul("o_orderkey % 7 = 0", "o_totalprice / 12") + " AS AMT_ANNUITY",
        f"{d} AS DAYS_DECISION",
        f"CASE WHEN o_orderstatus = 'F' THEN {d} + 10 END AS DAYS_FIRST_DRAWING",
        f"CASE WHEN o_orderstatus <> 'O' THEN {d} + 365 END AS DAYS_LAST_DUE",
        f"CASE WHEN o_orderstatus = 'F' THEN {d} + 400 END AS DAYS_TERMINATION",
        "CASE WHEN o_orderpriority = '5-LOW' THEN 0D ELSE 1D END AS NFLAG_LAST_APPL_IN_DAY",
        "CASE WHEN o_orderpriority = '1-URGENT' THEN 'N' ELSE 'Y' END AS FLAG_LAST_APPL_PER_CONTRACT",
        "CASE o_orderstatus WHEN 'F' THEN 'Approved' WHEN 'O' THEN 'Refused' ELSE 'Canceled' END "
        "AS NAME_CONTRACT_STATUS")


def bureau(t: Tables) -> DataFrame:
    return t.orders.selectExpr(
        "o_custkey AS SK_ID_CURR", "o_orderkey AS SK_ID_BUREAU", "o_totalprice AS AMT_CREDIT_SUM",
        _nul("o_orderkey % 7 = 1", "o_totalprice / 3") + " AS AMT_CREDIT_SUM_DEBT",
        "CASE WHEN o_orderstatus = 'P' THEN o_totalprice / 10 ELSE 0D END AS AMT_CREDIT_SUM_OVERDUE",
        "CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice / 5 END AS AMT_CREDIT_MAX_OVERDUE",
        "CAST(-(o_orderkey % 3000) AS DOUBLE) AS DAYS_CREDIT",
        "CASE WHEN o_orderstatus <> 'O' THEN CAST(o_orderkey % 2000 - 1000 AS DOUBLE) END "
        "AS DAYS_CREDIT_ENDDATE",
        "CASE WHEN o_orderstatus = 'O' THEN 'Active' ELSE 'Closed' END AS CREDIT_ACTIVE")


def bureau_balance(t: Tables) -> DataFrame:
    return t.lineitem.selectExpr(
        "l_orderkey AS SK_ID_BUREAU", "CAST(-l_linenumber AS DOUBLE) AS MONTHS_BALANCE",
        "CASE WHEN l_linenumber = 7 THEN NULL WHEN l_linestatus = 'F' THEN 'C' "
        "WHEN l_returnflag = 'N' THEN 'X' ELSE CAST(floor(l_quantity) % 6 AS STRING) END AS STATUS")


def credit_card_balance(t: Tables) -> DataFrame:
    type_ix = ("CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'purchase' THEN 3 "
               "WHEN 'signup' THEN 4 ELSE 5 END")
    return t.events.selectExpr(
        "user_id AS SK_ID_CURR", f"user_id * 10 + {type_ix} AS SK_ID_PREV",
        "CAST(-dayofmonth(ts) AS DOUBLE) AS MONTHS_BALANCE", "value AS AMT_BALANCE",
        "CAST(user_id * 1000 + 5000 AS DOUBLE) AS AMT_CREDIT_LIMIT_ACTUAL",
        _nul("event_id % 9 = 0", "value / 2") + " AS AMT_PAYMENT_CURRENT",
        "value / 2 AS AMT_PAYMENT_TOTAL_CURRENT",
        "CAST(event_id % 4 AS DOUBLE) AS CNT_DRAWINGS_CURRENT",
        _nul("event_id % 5 = 0", "CAST(event_id % 30 AS DOUBLE)") + " AS CNT_INSTALMENT_MATURE_CUM",
        "CASE WHEN user_id % 10 = 3 THEN NULL WHEN event_type = 'error' THEN CAST(event_id % 40 AS DOUBLE) "
        "ELSE 0D END AS SK_DPD",
        "CASE WHEN user_id % 10 = 3 THEN NULL WHEN event_type = 'error' AND value > 50 THEN 1D "
        "ELSE 0D END AS SK_DPD_DEF")


def data_dictionary(app: DataFrame) -> DataFrame:
    """Column dictionary (Table, Row, Description, Special) for the application frame.

    The rows are derived from the application frame's own schema: building
    columns are the ones with an _AVG / _MODE / _MEDI suffix, as in the
    public dictionary.
    """
    return app.sparkSession.createDataFrame(
        dictionary_rows(app), "Table string, Row string, Description string, Special string")


def dictionary_rows(app: DataFrame) -> list[tuple]:
    """The dictionary as plain rows (one per column of the application schema)."""
    rows = []
    for name in app.columns:
        building = name.endswith(("_AVG", "_MODE", "_MEDI"))
        rows.append((APPLICATION_TABLE_NAME, name,
                     BUILDING_DESCRIPTION if building else f"Application column {name}",
                     "normalized" if building else None))
    return rows


def scored_rows(t: Tables) -> DataFrame:
    """Labelled clients with a deterministic default probability.

    p_default mixes an md5-derived uniform number with the label and is
    rounded to two decimals, so ties occur (exercises the mid-rank AUC).
    """
    app = application_train(t)
    u = F.conv(F.substring(F.md5(F.concat(F.col("SK_ID_CURR").cast("string"), F.lit(":42"))), 1, 8),
               16, 10).cast("bigint") / 4294967296.0
    return app.select(
        "SK_ID_CURR", "TARGET", "CODE_GENDER", "NAME_EDUCATION_TYPE", "DAYS_BIRTH",
        F.round(u * 0.7 + F.col("TARGET") * 0.3, 2).alias("p_default"))
