"""DuckDB oracle SQL for the registered queries.

Written from the operator definitions in SURVEY 2 (not from the Spark
plans).  The driver registers the raw tables as views; each query here
starts with the fixture views it needs as CTEs, then computes the
operator's result.  Every double output is rounded (2 decimals for money,
6 otherwise) exactly like the Spark side's report projection.
"""

from __future__ import annotations

# --------------------------------------------------------------------------
# fixture views (mirror creditlens.sources.fixtures)
# --------------------------------------------------------------------------
_LEVELS = {
    "NAME_TYPE_SUITE": ["Unaccompanied", "Family", "Spouse, partner", "Children", "Other_A",
                        "Other_B", "Group of people"],
    "NAME_INCOME_TYPE": ["Working", "Commercial associate", "Pensioner", "State servant",
                         "Unemployed", "Student", "Businessman", "Maternity leave"],
    "NAME_EDUCATION_TYPE": ["Secondary / secondary special", "Higher education",
                            "Incomplete higher", "Lower secondary", "Academic degree"],
    "NAME_FAMILY_STATUS": ["Married", "Single / not married", "Civil marriage", "Separated",
                           "Widow", "Unknown"],
    "NAME_HOUSING_TYPE": ["House / apartment", "With parents", "Municipal apartment",
                          "Rented apartment", "Office apartment", "Co-op apartment"],
    "OCCUPATION_TYPE": ["Laborers", "Core staff", "Sales staff", "Managers", "Drivers",
                        "High skill tech staff", "Accountants", "Medicine staff", "Security staff",
                        "Cooking staff"],
    "ORGANIZATION_TYPE": ["Business Entity Type 3", "XNA", "Self-employed", "Other", "Medicine",
                          "Government", "School", "Trade: type 7", "Kindergarten", "Construction",
                          "Transport: type 4", "Industry: type 9", "Housing", "Bank",
                          "Trade: type 2", "Military"],
    "FONDKAPREMONT_MODE": ["reg oper account", "org spec account", "reg oper spec account",
                           "not specified"],
    "HOUSETYPE_MODE": ["block of flats", "specific housing", "terraced house"],
    "WALLSMATERIAL_MODE": ["Panel", "Stone, brick", "Block", "Wooden", "Mixed", "Monolithic",
                           "Others"],
    "EMERGENCYSTATE_MODE": ["No", "Yes"],
}


def _pick(name: str, index_sql: str) -> str:
    levels = _LEVELS[name]
    arr = "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in levels) + "]"
    return f"({arr})[CAST(({index_sql}) % {len(levels)} AS INTEGER) + 1]"


APP = f"""app AS (
  SELECT c_custkey AS SK_ID_CURR,
    CAST(CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END AS INTEGER) AS TARGET,
    CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE (c_custkey * 37 % 1000) / 1000 END AS EXT_SOURCE_1,
    CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE (c_custkey * 91 % 1000) / 1000 END AS EXT_SOURCE_2,
    CASE WHEN c_custkey % 9 = 4 THEN NULL
         ELSE round(c_nationkey / 50 + (c_custkey * 73 % 1000) / 2000, 4) END AS EXT_SOURCE_3,
    CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE CAST(c_custkey % 5 + 1 AS DOUBLE) END AS CNT_FAM_MEMBERS,
    CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE CAST(c_custkey * 53 % 9000 + 500 AS DOUBLE) END AS AMT_ANNUITY,
    CASE WHEN c_custkey % 19 = 0 THEN NULL ELSE CAST(c_custkey * 101 % 90000 + 9000 AS DOUBLE) END AS AMT_GOODS_PRICE,
    CAST(c_custkey * 101 % 90000 + 10000 AS DOUBLE) AS AMT_CREDIT,
    CAST(c_custkey * 211 % 50000 + 5000 AS DOUBLE) AS AMT_INCOME_TOTAL,
    CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE CAST(c_custkey % 20 AS DOUBLE) END AS OWN_CAR_AGE,
    CASE WHEN c_custkey % 23 = 0 THEN NULL ELSE CAST(c_custkey % 4 AS DOUBLE) END AS OBS_30_CNT_SOCIAL_CIRCLE,
    CASE WHEN c_custkey % 23 = 0 THEN NULL ELSE CAST(c_custkey % 2 AS DOUBLE) END AS DEF_30_CNT_SOCIAL_CIRCLE,
    CASE WHEN c_custkey % 23 = 1 THEN NULL ELSE CAST(c_custkey % 5 AS DOUBLE) END AS OBS_60_CNT_SOCIAL_CIRCLE,
    CASE WHEN c_custkey % 23 = 1 THEN NULL ELSE CAST(c_custkey % 3 - 1 AS DOUBLE) END AS DEF_60_CNT_SOCIAL_CIRCLE,
    CASE WHEN c_custkey % 29 = 0 THEN NULL ELSE CAST(-(c_custkey * 17 % 3000) AS DOUBLE) END AS DAYS_LAST_PHONE_CHANGE,
    CASE WHEN c_custkey % 6 = 0 THEN CAST(365243 AS DOUBLE) ELSE CAST(-(c_custkey * 7 % 8000) AS DOUBLE) END AS DAYS_EMPLOYED,
    CAST(-(c_custkey * 13 % 17500 + 7500) AS DOUBLE) AS DAYS_BIRTH,
    CASE WHEN c_custkey % 8 = 0 THEN NULL ELSE CAST(c_custkey % 3 AS DOUBLE) END AS AMT_REQ_CREDIT_BUREAU_MON,
    CASE WHEN c_custkey % 8 = 0 THEN NULL ELSE CAST(c_custkey % 4 AS DOUBLE) END AS AMT_REQ_CREDIT_BUREAU_YEAR,
    CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE (c_custkey * 7 % 100) / 100 END AS APARTMENTS_AVG,
    CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE (c_custkey * 11 % 100) / 100 END AS BASEMENTAREA_AVG,
    CASE WHEN c_custkey % 3 = 2 THEN NULL ELSE (c_custkey * 13 % 100) / 100 END AS LIVINGAREA_MEDI,
    CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE {_pick("NAME_TYPE_SUITE", "c_custkey * 3 + c_nationkey")} END AS NAME_TYPE_SUITE,
    CASE WHEN c_custkey % 7 = 3 THEN NULL ELSE {_pick("OCCUPATION_TYPE", "c_custkey + c_nationkey")} END AS OCCUPATION_TYPE,
    CASE WHEN c_custkey % 3 = 1 THEN NULL ELSE {_pick("FONDKAPREMONT_MODE", "c_custkey")} END AS FONDKAPREMONT_MODE,
    CASE WHEN c_custkey % 4 = 1 THEN NULL ELSE {_pick("HOUSETYPE_MODE", "c_custkey * 7")} END AS HOUSETYPE_MODE,
    CASE WHEN c_custkey % 5 = 2 THEN NULL ELSE {_pick("WALLSMATERIAL_MODE", "c_custkey * 3")} END AS WALLSMATERIAL_MODE,
    CASE WHEN c_custkey % 6 = 1 THEN NULL ELSE {_pick("EMERGENCYSTATE_MODE", "c_custkey * 3 + c_nationkey")} END AS EMERGENCYSTATE_MODE,
    CASE WHEN c_custkey % 50 = 1 THEN 'XNA' WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS CODE_GENDER,
    {_pick("NAME_INCOME_TYPE", "c_custkey * 5 + c_nationkey")} AS NAME_INCOME_TYPE,
    {_pick("NAME_EDUCATION_TYPE", "c_custkey * 11 + c_nationkey")} AS NAME_EDUCATION_TYPE,
    {_pick("NAME_FAMILY_STATUS", "c_custkey * 13")} AS NAME_FAMILY_STATUS,
    {_pick("NAME_HOUSING_TYPE", "c_custkey * 17 + c_nationkey")} AS NAME_HOUSING_TYPE,
    {_pick("ORGANIZATION_TYPE", "c_custkey * 19 + c_nationkey")} AS ORGANIZATION_TYPE
  FROM customer)"""

APP_DOUBLES = ["EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3", "CNT_FAM_MEMBERS", "AMT_ANNUITY",
               "AMT_GOODS_PRICE", "AMT_CREDIT", "AMT_INCOME_TOTAL", "OWN_CAR_AGE",
               "OBS_30_CNT_SOCIAL_CIRCLE", "DEF_30_CNT_SOCIAL_CIRCLE", "OBS_60_CNT_SOCIAL_CIRCLE",
               "DEF_60_CNT_SOCIAL_CIRCLE", "DAYS_LAST_PHONE_CHANGE", "DAYS_EMPLOYED", "DAYS_BIRTH",
               "AMT_REQ_CREDIT_BUREAU_MON", "AMT_REQ_CREDIT_BUREAU_YEAR", "APARTMENTS_AVG",
               "BASEMENTAREA_AVG", "LIVINGAREA_MEDI"]

TRAIN = "train AS (SELECT * FROM app WHERE SK_ID_CURR % 5 <> 0)"
TEST = "test AS (SELECT * EXCLUDE (TARGET) FROM app WHERE SK_ID_CURR % 5 = 0)"

POS = """pos AS (
  SELECT o_custkey AS SK_ID_CURR, l_orderkey AS SK_ID_PREV,
    CAST(-l_linenumber AS DOUBLE) AS MONTHS_BALANCE,
    CASE WHEN l_linenumber = 3 THEN NULL ELSE l_quantity END AS CNT_INSTALMENT,
    CASE WHEN l_linenumber = 4 THEN NULL ELSE l_quantity - l_linenumber END AS CNT_INSTALMENT_FUTURE,
    CASE WHEN l_orderkey % 7 = 0 THEN NULL WHEN l_returnflag = 'R' THEN l_quantity - 40
         ELSE CAST(0 AS DOUBLE) END AS SK_DPD,
    CASE WHEN l_orderkey % 7 = 0 THEN NULL
         WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN l_quantity - 45
         ELSE CAST(0 AS DOUBLE) END AS SK_DPD_DEF
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

INSTALL = """install AS (
  SELECT o_custkey AS SK_ID_CURR, l_orderkey AS SK_ID_PREV,
    CAST(l_linenumber * 30 AS DOUBLE) AS DAYS_INSTALMENT,
    CASE WHEN l_linenumber = 5 THEN NULL
         ELSE CAST(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS DOUBLE) END
      AS DAYS_ENTRY_PAYMENT,
    l_extendedprice AS AMT_INSTALMENT,
    CASE WHEN l_linenumber = 5 THEN NULL ELSE l_extendedprice * (1 - l_discount) END AS AMT_PAYMENT
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

PREV = """prev AS (
  SELECT o_custkey AS SK_ID_CURR, o_orderkey AS SK_ID_PREV, o_totalprice AS AMT_APPLICATION,
    CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice * 0.9 END AS AMT_CREDIT,
    CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_totalprice / 12 END AS AMT_ANNUITY,
    d AS DAYS_DECISION,
    CASE WHEN o_orderstatus = 'F' THEN d + 10 END AS DAYS_FIRST_DRAWING,
    CASE WHEN o_orderstatus <> 'O' THEN d + 365 END AS DAYS_LAST_DUE,
    CASE WHEN o_orderstatus = 'F' THEN d + 400 END AS DAYS_TERMINATION,
    CASE WHEN o_orderpriority = '5-LOW' THEN CAST(0 AS DOUBLE) ELSE CAST(1 AS DOUBLE) END AS NFLAG_LAST_APPL_IN_DAY,
    CASE WHEN o_orderpriority = '1-URGENT' THEN 'N' ELSE 'Y' END AS FLAG_LAST_APPL_PER_CONTRACT,
    CASE o_orderstatus WHEN 'F' THEN 'Approved' WHEN 'O' THEN 'Refused' ELSE 'Canceled' END AS NAME_CONTRACT_STATUS
  FROM (SELECT *, CAST(-date_diff('day', CAST(o_orderdate AS DATE), DATE '2002-01-01') AS DOUBLE) AS d
        FROM orders))"""

BUREAU = """bureau AS (
  SELECT o_custkey AS SK_ID_CURR, o_orderkey AS SK_ID_BUREAU, o_totalprice AS AMT_CREDIT_SUM,
    CASE WHEN o_orderkey % 7 = 1 THEN NULL ELSE o_totalprice / 3 END AS AMT_CREDIT_SUM_DEBT,
    CASE WHEN o_orderstatus = 'P' THEN o_totalprice / 10 ELSE CAST(0 AS DOUBLE) END AS AMT_CREDIT_SUM_OVERDUE,
    CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice / 5 END AS AMT_CREDIT_MAX_OVERDUE,
    CAST(-(o_orderkey % 3000) AS DOUBLE) AS DAYS_CREDIT,
    CASE WHEN o_orderstatus <> 'O' THEN CAST(o_orderkey % 2000 - 1000 AS DOUBLE) END AS DAYS_CREDIT_ENDDATE,
    CASE WHEN o_orderstatus = 'O' THEN 'Active' ELSE 'Closed' END AS CREDIT_ACTIVE
  FROM orders)"""

BB = """bb AS (
  SELECT l_orderkey AS SK_ID_BUREAU, CAST(-l_linenumber AS DOUBLE) AS MONTHS_BALANCE,
    CASE WHEN l_linenumber = 7 THEN NULL WHEN l_linestatus = 'F' THEN 'C'
         WHEN l_returnflag = 'N' THEN 'X'
         ELSE CAST(CAST(floor(l_quantity) AS BIGINT) % 6 AS VARCHAR) END AS STATUS
  FROM lineitem)"""

CC = """cc AS (
  SELECT user_id AS SK_ID_CURR,
    user_id * 10 + CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'purchase' THEN 3
                                   WHEN 'signup' THEN 4 ELSE 5 END AS SK_ID_PREV,
    CAST(-dayofmonth(ts) AS DOUBLE) AS MONTHS_BALANCE,
    value AS AMT_BALANCE,
    CAST(user_id * 1000 + 5000 AS DOUBLE) AS AMT_CREDIT_LIMIT_ACTUAL,
    CASE WHEN event_id % 9 = 0 THEN NULL ELSE value / 2 END AS AMT_PAYMENT_CURRENT,
    value / 2 AS AMT_PAYMENT_TOTAL_CURRENT,
    CAST(event_id % 4 AS DOUBLE) AS CNT_DRAWINGS_CURRENT,
    CASE WHEN event_id % 5 = 0 THEN NULL ELSE CAST(event_id % 30 AS DOUBLE) END AS CNT_INSTALMENT_MATURE_CUM,
    CASE WHEN user_id % 10 = 3 THEN NULL WHEN event_type = 'error' THEN CAST(event_id % 40 AS DOUBLE)
         ELSE CAST(0 AS DOUBLE) END AS SK_DPD,
    CASE WHEN user_id % 10 = 3 THEN NULL WHEN event_type = 'error' AND value > 50 THEN CAST(1 AS DOUBLE)
         ELSE CAST(0 AS DOUBLE) END AS SK_DPD_DEF
  FROM events)"""

SCORED = """scored AS (
  SELECT SK_ID_CURR, TARGET, CODE_GENDER, NAME_EDUCATION_TYPE, DAYS_BIRTH,
    round((('0x' || substr(md5(CAST(SK_ID_CURR AS VARCHAR) || ':42'), 1, 8))::BIGINT / 4294967296.0::DOUBLE) * 0.7
          + TARGET * 0.3, 2) AS p_default
  FROM train)"""

FIXTURES = {"app": APP, "train": TRAIN, "test": TEST, "pos": POS, "install": INSTALL,
            "prev": PREV, "bureau": BUREAU, "bb": BB, "cc": CC, "scored": SCORED}
_DEPENDS = {"train": ["app"], "test": ["app"], "scored": ["app", "train"]}


def with_fixtures(names: list[str], body: str, extra_ctes: list[str] = ()) -> str:
    """``WITH <fixtures>, <extra> <body>`` including dependencies in order."""
    order: list[str] = []

    def add(n):
        for d in _DEPENDS.get(n, []):
            add(d)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    ctes = [FIXTURES[n] for n in order] + list(extra_ctes)
    return "WITH " + ",\n".join(ctes) + "\n" + body


def rnd(expr: str, d: int) -> str:
    """Round half-up on the shortest decimal form of a double (Spark's ``round``)."""
    return f"CAST(round(CAST(CAST({expr} AS VARCHAR) AS DECIMAL(38,12)), {d}) AS DOUBLE)"


def report(expr: str) -> str:
    """Snap to 9 decimals, then round to 6 (the report rounding on both sides)."""
    return rnd(rnd(expr, 9), 6)


def rounded(select_sql: str, double_cols: list[str]) -> str:
    """Wrap a query and round the given double columns."""
    if not double_cols:
        return select_sql
    rep = ", ".join(f"{report(c)} AS {c}" for c in double_cols)
    return f"SELECT * REPLACE ({rep}) FROM ({select_sql}) AS q"
