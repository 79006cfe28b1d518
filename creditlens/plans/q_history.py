"""Queries D1-D9: history tables reduced to loan and client level."""

from __future__ import annotations

from creditlens.operators import history
from creditlens.plans.oracle_sql import rounded, with_fixtures
from creditlens.plans.registry import query
from creditlens.sources import fixtures
from creditlens.sources.tables import Tables

_POS_LOAN_SQL = """
  SELECT SK_ID_CURR, SK_ID_PREV,
    count(*) AS pos_MONTHS_BALANCE_count,
    min(MONTHS_BALANCE) AS pos_MONTHS_BALANCE_min,
    avg(CNT_INSTALMENT) AS pos_CNT_INSTALMENT_mean,
    max(CNT_INSTALMENT) AS pos_CNT_INSTALMENT_max,
    avg(CNT_INSTALMENT_FUTURE) AS pos_CNT_INSTALMENT_FUTURE_mean,
    min(CNT_INSTALMENT_FUTURE) AS pos_CNT_INSTALMENT_FUTURE_min,
    avg(SK_DPD) AS pos_SK_DPD_mean, max(SK_DPD) AS pos_SK_DPD_max, sum(SK_DPD) AS pos_SK_DPD_sum,
    avg(SK_DPD_DEF) AS pos_SK_DPD_DEF_mean, max(SK_DPD_DEF) AS pos_SK_DPD_DEF_max,
    sum(SK_DPD_DEF) AS pos_SK_DPD_DEF_sum,
    CAST(max(SK_DPD) > 0 AS INTEGER) AS pos_SK_DPD_ever,
    CAST(max(SK_DPD_DEF) > 0 AS INTEGER) AS pos_SK_DPD_DEF_ever
  FROM pos GROUP BY SK_ID_CURR, SK_ID_PREV"""
_POS_LOAN_DOUBLES = ["pos_MONTHS_BALANCE_min", "pos_CNT_INSTALMENT_mean", "pos_CNT_INSTALMENT_max",
                     "pos_CNT_INSTALMENT_FUTURE_mean", "pos_CNT_INSTALMENT_FUTURE_min",
                     "pos_SK_DPD_mean", "pos_SK_DPD_max", "pos_SK_DPD_sum", "pos_SK_DPD_DEF_mean",
                     "pos_SK_DPD_DEF_max", "pos_SK_DPD_DEF_sum"]

POS_CLIENT_SQL = f"""pos_loan AS ({_POS_LOAN_SQL}),
pos_client AS (
  SELECT SK_ID_CURR, count(*) AS COUNT_POS_LOANS,
    avg(pos_CNT_INSTALMENT_mean) AS pos_CNT_INSTALMENT_mean,
    max(pos_CNT_INSTALMENT_max) AS pos_CNT_INSTALMENT_max,
    avg(pos_CNT_INSTALMENT_FUTURE_mean) AS pos_CNT_INSTALMENT_FUTURE_mean,
    min(pos_CNT_INSTALMENT_FUTURE_min) AS pos_CNT_INSTALMENT_FUTURE_min,
    avg(pos_SK_DPD_mean) AS pos_SK_DPD_mean, max(pos_SK_DPD_max) AS pos_SK_DPD_max,
    sum(pos_SK_DPD_sum) AS pos_SK_DPD_sum,
    avg(pos_SK_DPD_DEF_mean) AS pos_SK_DPD_DEF_mean, max(pos_SK_DPD_DEF_max) AS pos_SK_DPD_DEF_max,
    sum(pos_SK_DPD_DEF_sum) AS pos_SK_DPD_DEF_sum,
    avg(pos_SK_DPD_ever) AS pos_SK_DPD_ever_rate,
    avg(pos_SK_DPD_DEF_ever) AS pos_SK_DPD_DEF_ever_rate
  FROM pos_loan GROUP BY SK_ID_CURR)"""
POS_CLIENT_DOUBLES = ["pos_CNT_INSTALMENT_mean", "pos_CNT_INSTALMENT_max",
                      "pos_CNT_INSTALMENT_FUTURE_mean", "pos_CNT_INSTALMENT_FUTURE_min",
                      "pos_SK_DPD_mean", "pos_SK_DPD_max", "pos_SK_DPD_sum", "pos_SK_DPD_DEF_mean",
                      "pos_SK_DPD_DEF_max", "pos_SK_DPD_DEF_sum", "pos_SK_DPD_ever_rate",
                      "pos_SK_DPD_DEF_ever_rate"]

_BB_STATUS = ["C", "X", "0", "1", "2", "3", "4", "5"]
BB_CREDIT_SQL = """bb_credit AS (
  SELECT SK_ID_BUREAU, count(*) AS bb_MONTHS_BALANCE_count, min(MONTHS_BALANCE) AS bb_MONTHS_BALANCE_min,
    """ + ",\n    ".join(f"count(*) FILTER (WHERE STATUS = '{s}') AS bb_status_{s}_count" for s in _BB_STATUS) + """,
    CAST(count(*) FILTER (WHERE STATUS IN ('1','2','3','4','5')) > 0 AS INTEGER) AS bb_ever_overdue
  FROM bb GROUP BY SK_ID_BUREAU)"""

BUREAU_CLIENT_SQL = BB_CREDIT_SQL + """,
bureau_client AS (
  SELECT SK_ID_CURR, count(*) AS COUNT_BUREAU_RECORDS,
    avg(AMT_CREDIT_SUM) AS bureau_AMT_CREDIT_SUM_mean, max(AMT_CREDIT_SUM) AS bureau_AMT_CREDIT_SUM_max,
    sum(AMT_CREDIT_SUM_DEBT) AS bureau_AMT_CREDIT_SUM_debt,
    avg(DAYS_CREDIT) AS bureau_days_credit_mean, max(DAYS_CREDIT_ENDDATE) AS bureau_days_credit_end_max,
    avg(bb_ever_overdue) AS bureau_ever_overdue_rate,
    sum(AMT_CREDIT_SUM_DEBT) / NULLIF(avg(AMT_CREDIT_SUM) + 1, 0) AS bureau_DEBT_RATIO
  FROM bureau LEFT JOIN bb_credit USING (SK_ID_BUREAU) GROUP BY SK_ID_CURR)"""
BUREAU_CLIENT_DOUBLES = ["bureau_AMT_CREDIT_SUM_mean", "bureau_AMT_CREDIT_SUM_max",
                         "bureau_AMT_CREDIT_SUM_debt", "bureau_days_credit_mean",
                         "bureau_days_credit_end_max", "bureau_ever_overdue_rate",
                         "bureau_DEBT_RATIO"]

_CC_MEASURES = [  # (output, agg, source)
    ("cc_AMT_BALANCE_mean", "avg", "AMT_BALANCE"), ("cc_AMT_BALANCE_max", "max", "AMT_BALANCE"),
    ("cc_AMT_BALANCE_sum", "sum", "AMT_BALANCE"),
    ("cc_AMT_CREDIT_LIMIT_ACTUAL_mean", "avg", "AMT_CREDIT_LIMIT_ACTUAL"),
    ("cc_AMT_CREDIT_LIMIT_ACTUAL_max", "max", "AMT_CREDIT_LIMIT_ACTUAL"),
    ("cc_AMT_PAYMENT_CURRENT_sum", "sum", "AMT_PAYMENT_CURRENT"),
    ("cc_AMT_PAYMENT_TOTAL_CURRENT_sum", "sum", "AMT_PAYMENT_TOTAL_CURRENT"),
    ("cc_CNT_DRAWINGS_CURRENT_sum", "sum", "CNT_DRAWINGS_CURRENT"),
    ("cc_CNT_INSTALMENT_MATURE_CUM", "max", "CNT_INSTALMENT_MATURE_CUM"),
    ("cc_SK_DPD_mean", "avg", "SK_DPD"), ("cc_SK_DPD_max", "max", "SK_DPD"),
    ("cc_SK_DPD_sum", "sum", "SK_DPD"), ("cc_SK_DPD_DEF_mean", "avg", "SK_DPD_DEF"),
    ("cc_SK_DPD_DEF_max", "max", "SK_DPD_DEF"), ("cc_SK_DPD_DEF_sum", "sum", "SK_DPD_DEF"),
]
CC_ACCOUNT_SQL = """cc_account AS (
  SELECT SK_ID_CURR, SK_ID_PREV, count(*) AS cc_MONTHS_BALANCE_count,
    min(MONTHS_BALANCE) AS cc_MONTHS_BALANCE_min,
    """ + ",\n    ".join(f"{a}({s}) AS {o}" for o, a, s in _CC_MEASURES) + """,
    CAST(max(SK_DPD) > 0 AS INTEGER) AS cc_SK_DPD_ever,
    CAST(max(SK_DPD_DEF) > 0 AS INTEGER) AS cc_SK_DPD_DEF_ever
  FROM cc GROUP BY SK_ID_CURR, SK_ID_PREV)"""
CC_CLIENT_SQL = CC_ACCOUNT_SQL + """,
cc_client AS (
  SELECT SK_ID_CURR, count(*) AS COUNT_CREDIT_CARDS,
    """ + ",\n    ".join(f"{a}({o}) AS {o}" for o, a, _ in _CC_MEASURES) + """,
    avg(cc_SK_DPD_ever) AS cc_SK_DPD_ever_rate, avg(cc_SK_DPD_DEF_ever) AS cc_SK_DPD_DEF_ever_rate
  FROM cc_account GROUP BY SK_ID_CURR)"""
CC_CLIENT_DOUBLES = [o for o, _, _ in _CC_MEASURES] + ["cc_SK_DPD_ever_rate", "cc_SK_DPD_DEF_ever_rate"]

PREV_CLIENT_SQL = """prev_client AS (
  SELECT SK_ID_CURR, count(*) AS COUNT_PREV_APPLICATIONS,
    avg(AMT_APPLICATION) AS prev_AMT_APPLICATION_mean, max(AMT_APPLICATION) AS prev_AMT_APPLICATION_max,
    avg(AMT_CREDIT) AS prev_AMT_CREDIT_mean, max(AMT_CREDIT) AS prev_AMT_CREDIT_max,
    avg(AMT_ANNUITY) AS prev_AMT_ANNUITY_mean, max(AMT_ANNUITY) AS prev_AMT_ANNUITY_max,
    avg(DAYS_DECISION) AS prev_DAYS_DECISION_mean, min(DAYS_FIRST_DRAWING) AS prev_DAYS_FIRST_DRAWING_min,
    max(DAYS_LAST_DUE) AS prev_DAYS_LAST_DUE_max, max(DAYS_TERMINATION) AS prev_DAYS_TERMINATION_max,
    avg(CAST(FLAG_LAST_APPL_PER_CONTRACT = 'Y' AS DOUBLE)) AS prev_FLAG_LAST_APPL_PER_CONTRACT_rate,
    avg(NFLAG_LAST_APPL_IN_DAY) AS prev_NFLAG_LAST_APPL_IN_DAY_rate,
    avg(CAST(NAME_CONTRACT_STATUS = 'Approved' AS DOUBLE)) AS prev_APPROVED_rate,
    avg(CAST(NAME_CONTRACT_STATUS = 'Refused' AS DOUBLE)) AS prev_REFUSED_rate
  FROM prev GROUP BY SK_ID_CURR)"""
PREV_CLIENT_DOUBLES = ["prev_AMT_APPLICATION_mean", "prev_AMT_APPLICATION_max",
                       "prev_AMT_CREDIT_mean", "prev_AMT_CREDIT_max", "prev_AMT_ANNUITY_mean",
                       "prev_AMT_ANNUITY_max", "prev_DAYS_DECISION_mean",
                       "prev_DAYS_FIRST_DRAWING_min", "prev_DAYS_LAST_DUE_max",
                       "prev_DAYS_TERMINATION_max", "prev_FLAG_LAST_APPL_PER_CONTRACT_rate",
                       "prev_NFLAG_LAST_APPL_IN_DAY_rate", "prev_APPROVED_rate", "prev_REFUSED_rate"]

_INST_LOAN_SQL = """
  SELECT SK_ID_CURR, SK_ID_PREV, count(*) AS inst_NUM_INSTALMENTS,
    avg(AMT_INSTALMENT) AS inst_AMT_INSTALMENT_mean, sum(AMT_INSTALMENT) AS inst_AMT_INSTALMENT_sum,
    avg(AMT_PAYMENT) AS inst_AMT_PAYMENT_mean, sum(AMT_PAYMENT) AS inst_AMT_PAYMENT_sum,
    avg(DAYS_ENTRY_PAYMENT - DAYS_INSTALMENT) AS inst_delay_mean,
    max(DAYS_ENTRY_PAYMENT - DAYS_INSTALMENT) AS inst_delay_max,
    CAST(max(DAYS_ENTRY_PAYMENT - DAYS_INSTALMENT) > 0 AS INTEGER) AS inst_ever_late
  FROM install GROUP BY SK_ID_CURR, SK_ID_PREV"""
_INST_LOAN_DOUBLES = ["inst_AMT_INSTALMENT_mean", "inst_AMT_INSTALMENT_sum", "inst_AMT_PAYMENT_mean",
                      "inst_AMT_PAYMENT_sum", "inst_delay_mean", "inst_delay_max"]
INST_CLIENT_SQL = f"""inst_loan AS ({_INST_LOAN_SQL}),
inst_client AS (
  SELECT SK_ID_CURR, count(*) AS COUNT_INSTALLMENT_LOANS,
    avg(inst_AMT_INSTALMENT_mean) AS inst_AMT_INSTALMENT_mean,
    sum(inst_AMT_INSTALMENT_sum) AS inst_AMT_INSTALMENT_sum,
    avg(inst_AMT_PAYMENT_mean) AS inst_AMT_PAYMENT_mean,
    sum(inst_AMT_PAYMENT_sum) AS inst_AMT_PAYMENT_sum,
    avg(inst_delay_mean) AS inst_delay_mean, max(inst_delay_max) AS inst_delay_max,
    avg(inst_ever_late) AS inst_ever_late_rate
  FROM inst_loan GROUP BY SK_ID_CURR)"""
INST_CLIENT_DOUBLES = _INST_LOAN_DOUBLES + ["inst_ever_late_rate"]


def _q(fixture_names, ctes, final_table, doubles):
    return with_fixtures(fixture_names, rounded(f"SELECT * FROM {final_table}", doubles), ctes)


@query("pos_loan", with_fixtures(["pos"], rounded(_POS_LOAN_SQL, _POS_LOAN_DOUBLES)))
def q_pos_loan(spark, sf):
    """POS loan level."""
    return history.pos_loan(fixtures.pos_cash(Tables(spark, sf)))


@query("pos_client", _q(["pos"], [POS_CLIENT_SQL], "pos_client", POS_CLIENT_DOUBLES))
def q_pos_client(spark, sf):
    """POS client level (mean of loan means)."""
    return history.pos_client(fixtures.pos_cash(Tables(spark, sf)))


@query("bureau_balance_credit",
       _q(["bb"], [BB_CREDIT_SQL], "bb_credit", ["bb_MONTHS_BALANCE_min"]))
def q_bb_credit(spark, sf):
    """D3: bureau balance per credit."""
    return history.bureau_balance_credit(fixtures.bureau_balance(Tables(spark, sf)))


@query("bureau_client", _q(["bureau", "bb"], [BUREAU_CLIENT_SQL], "bureau_client",
                           BUREAU_CLIENT_DOUBLES))
def q_bureau_client(spark, sf):
    """Bureau client level over a left join to the credit summary."""
    t = Tables(spark, sf)
    return history.bureau_client(fixtures.bureau(t), fixtures.bureau_balance(t))


@query("card_account", _q(["cc"], [CC_ACCOUNT_SQL], "cc_account",
                          ["cc_MONTHS_BALANCE_min"] + [o for o, _, _ in _CC_MEASURES]))
def q_card_account(spark, sf):
    """Card account level."""
    return history.card_account(fixtures.credit_card_balance(Tables(spark, sf)))


@query("card_client", _q(["cc"], [CC_CLIENT_SQL], "cc_client", CC_CLIENT_DOUBLES))
def q_card_client(spark, sf):
    """Card client level."""
    return history.card_client(fixtures.credit_card_balance(Tables(spark, sf)))


@query("prev_app_client", _q(["prev"], [PREV_CLIENT_SQL], "prev_client", PREV_CLIENT_DOUBLES))
def q_prev_app_client(spark, sf):
    """Previous applications per client."""
    return history.prev_app_client(fixtures.previous_application(Tables(spark, sf)))


@query("install_loan", with_fixtures(["install"], rounded(_INST_LOAN_SQL, _INST_LOAN_DOUBLES)))
def q_install_loan(spark, sf):
    """Instalment loan level."""
    return history.install_loan(fixtures.installments(Tables(spark, sf)))


@query("install_client", _q(["install"], [INST_CLIENT_SQL], "inst_client", INST_CLIENT_DOUBLES))
def q_install_client(spark, sf):
    """Instalment client level."""
    return history.install_client(fixtures.installments(Tables(spark, sf)))
