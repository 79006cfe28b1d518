"""Client-level aggregates of the history tables.

Each table is a spec (data) plus the shared two-level aggregator.  Output
column names are those of the reference's feature matrix.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditlens.operators.aggregate import aggregate, two_level, with_ever_flags

CLIENT = "SK_ID_CURR"

# --- POS_CASH_balance ------------------------------------------------------
POS_LOAN_SPEC = [
    ("pos_MONTHS_BALANCE_count", "count", None),
    ("pos_MONTHS_BALANCE_min", "min", "MONTHS_BALANCE"),
    ("pos_CNT_INSTALMENT_mean", "mean", "CNT_INSTALMENT"),
    ("pos_CNT_INSTALMENT_max", "max", "CNT_INSTALMENT"),
    ("pos_CNT_INSTALMENT_FUTURE_mean", "mean", "CNT_INSTALMENT_FUTURE"),
    ("pos_CNT_INSTALMENT_FUTURE_min", "min", "CNT_INSTALMENT_FUTURE"),
    ("pos_SK_DPD_mean", "mean", "SK_DPD"),
    ("pos_SK_DPD_max", "max", "SK_DPD"),
    ("pos_SK_DPD_sum", "sum", "SK_DPD"),
    ("pos_SK_DPD_DEF_mean", "mean", "SK_DPD_DEF"),
    ("pos_SK_DPD_DEF_max", "max", "SK_DPD_DEF"),
    ("pos_SK_DPD_DEF_sum", "sum", "SK_DPD_DEF"),
]
POS_LOAN_FLAGS = [("pos_SK_DPD_ever", "pos_SK_DPD_max"),
                  ("pos_SK_DPD_DEF_ever", "pos_SK_DPD_DEF_max")]
POS_CLIENT_SPEC = [
    ("COUNT_POS_LOANS", "count", None),
    ("pos_CNT_INSTALMENT_mean", "mean", "pos_CNT_INSTALMENT_mean"),
    ("pos_CNT_INSTALMENT_max", "max", "pos_CNT_INSTALMENT_max"),
    ("pos_CNT_INSTALMENT_FUTURE_mean", "mean", "pos_CNT_INSTALMENT_FUTURE_mean"),
    ("pos_CNT_INSTALMENT_FUTURE_min", "min", "pos_CNT_INSTALMENT_FUTURE_min"),
    ("pos_SK_DPD_mean", "mean", "pos_SK_DPD_mean"),
    ("pos_SK_DPD_max", "max", "pos_SK_DPD_max"),
    ("pos_SK_DPD_sum", "sum", "pos_SK_DPD_sum"),
    ("pos_SK_DPD_DEF_mean", "mean", "pos_SK_DPD_DEF_mean"),
    ("pos_SK_DPD_DEF_max", "max", "pos_SK_DPD_DEF_max"),
    ("pos_SK_DPD_DEF_sum", "sum", "pos_SK_DPD_DEF_sum"),
    ("pos_SK_DPD_ever_rate", "mean", "pos_SK_DPD_ever"),
    ("pos_SK_DPD_DEF_ever_rate", "mean", "pos_SK_DPD_DEF_ever"),
]

# --- bureau_balance / bureau ----------------------------------------------
BB_STATUSES = ["C", "X", "0", "1", "2", "3", "4", "5"]
BB_CREDIT_SPEC = [
    ("bb_MONTHS_BALANCE_count", "count", None),
    ("bb_MONTHS_BALANCE_min", "min", "MONTHS_BALANCE"),
] + [(f"bb_status_{s}_count", "count_where", f"STATUS = '{s}'") for s in BB_STATUSES]
BUREAU_CLIENT_SPEC = [
    ("COUNT_BUREAU_RECORDS", "count", None),
    ("bureau_AMT_CREDIT_SUM_mean", "mean", "AMT_CREDIT_SUM"),
    ("bureau_AMT_CREDIT_SUM_max", "max", "AMT_CREDIT_SUM"),
    ("bureau_AMT_CREDIT_SUM_debt", "sum", "AMT_CREDIT_SUM_DEBT"),
    ("bureau_days_credit_mean", "mean", "DAYS_CREDIT"),
    ("bureau_days_credit_end_max", "max", "DAYS_CREDIT_ENDDATE"),
    ("bureau_ever_overdue_rate", "mean", "bb_ever_overdue"),
]

# --- credit_card_balance ---------------------------------------------------
CC_ACCOUNT_SPEC = [
    ("cc_MONTHS_BALANCE_count", "count", None),
    ("cc_MONTHS_BALANCE_min", "min", "MONTHS_BALANCE"),
    ("cc_AMT_BALANCE_mean", "mean", "AMT_BALANCE"),
    ("cc_AMT_BALANCE_max", "max", "AMT_BALANCE"),
    ("cc_AMT_BALANCE_sum", "sum", "AMT_BALANCE"),
    ("cc_AMT_CREDIT_LIMIT_ACTUAL_mean", "mean", "AMT_CREDIT_LIMIT_ACTUAL"),
    ("cc_AMT_CREDIT_LIMIT_ACTUAL_max", "max", "AMT_CREDIT_LIMIT_ACTUAL"),
    ("cc_AMT_PAYMENT_CURRENT_sum", "sum", "AMT_PAYMENT_CURRENT"),
    ("cc_AMT_PAYMENT_TOTAL_CURRENT_sum", "sum", "AMT_PAYMENT_TOTAL_CURRENT"),
    ("cc_CNT_DRAWINGS_CURRENT_sum", "sum", "CNT_DRAWINGS_CURRENT"),
    ("cc_CNT_INSTALMENT_MATURE_CUM", "max", "CNT_INSTALMENT_MATURE_CUM"),
    ("cc_SK_DPD_mean", "mean", "SK_DPD"),
    ("cc_SK_DPD_max", "max", "SK_DPD"),
    ("cc_SK_DPD_sum", "sum", "SK_DPD"),
    ("cc_SK_DPD_DEF_mean", "mean", "SK_DPD_DEF"),
    ("cc_SK_DPD_DEF_max", "max", "SK_DPD_DEF"),
    ("cc_SK_DPD_DEF_sum", "sum", "SK_DPD_DEF"),
]
CC_ACCOUNT_FLAGS = [("cc_SK_DPD_ever", "cc_SK_DPD_max"), ("cc_SK_DPD_DEF_ever", "cc_SK_DPD_DEF_max")]
CC_CLIENT_SPEC = [("COUNT_CREDIT_CARDS", "count", None)] + [
    (name, kind, name) for name, kind in [
        ("cc_AMT_BALANCE_mean", "mean"), ("cc_AMT_BALANCE_max", "max"),
        ("cc_AMT_BALANCE_sum", "sum"), ("cc_AMT_CREDIT_LIMIT_ACTUAL_mean", "mean"),
        ("cc_AMT_CREDIT_LIMIT_ACTUAL_max", "max"), ("cc_AMT_PAYMENT_CURRENT_sum", "sum"),
        ("cc_AMT_PAYMENT_TOTAL_CURRENT_sum", "sum"), ("cc_CNT_DRAWINGS_CURRENT_sum", "sum"),
        ("cc_CNT_INSTALMENT_MATURE_CUM", "max"), ("cc_SK_DPD_mean", "mean"),
        ("cc_SK_DPD_max", "max"), ("cc_SK_DPD_sum", "sum"), ("cc_SK_DPD_DEF_mean", "mean"),
        ("cc_SK_DPD_DEF_max", "max"), ("cc_SK_DPD_DEF_sum", "sum")]
] + [("cc_SK_DPD_ever_rate", "mean", "cc_SK_DPD_ever"),
     ("cc_SK_DPD_DEF_ever_rate", "mean", "cc_SK_DPD_DEF_ever")]

# --- previous_application --------------------------------------------------
PREV_CLIENT_SPEC = [
    ("COUNT_PREV_APPLICATIONS", "count", None),
    ("prev_AMT_APPLICATION_mean", "mean", "AMT_APPLICATION"),
    ("prev_AMT_APPLICATION_max", "max", "AMT_APPLICATION"),
    ("prev_AMT_CREDIT_mean", "mean", "AMT_CREDIT"),
    ("prev_AMT_CREDIT_max", "max", "AMT_CREDIT"),
    ("prev_AMT_ANNUITY_mean", "mean", "AMT_ANNUITY"),
    ("prev_AMT_ANNUITY_max", "max", "AMT_ANNUITY"),
    ("prev_DAYS_DECISION_mean", "mean", "DAYS_DECISION"),
    ("prev_DAYS_FIRST_DRAWING_min", "min", "DAYS_FIRST_DRAWING"),
    ("prev_DAYS_LAST_DUE_max", "max", "DAYS_LAST_DUE"),
    ("prev_DAYS_TERMINATION_max", "max", "DAYS_TERMINATION"),
    ("prev_FLAG_LAST_APPL_PER_CONTRACT_rate", "rate_where", "FLAG_LAST_APPL_PER_CONTRACT = 'Y'"),
    ("prev_NFLAG_LAST_APPL_IN_DAY_rate", "mean", "NFLAG_LAST_APPL_IN_DAY"),
    ("prev_APPROVED_rate", "rate_where", "NAME_CONTRACT_STATUS = 'Approved'"),
    ("prev_REFUSED_rate", "rate_where", "NAME_CONTRACT_STATUS = 'Refused'"),
]

# --- installments_payments -------------------------------------------------
INST_LOAN_SPEC = [
    ("inst_NUM_INSTALMENTS", "count", None),
    ("inst_AMT_INSTALMENT_mean", "mean", "AMT_INSTALMENT"),
    ("inst_AMT_INSTALMENT_sum", "sum", "AMT_INSTALMENT"),
    ("inst_AMT_PAYMENT_mean", "mean", "AMT_PAYMENT"),
    ("inst_AMT_PAYMENT_sum", "sum", "AMT_PAYMENT"),
    ("inst_delay_mean", "mean", "inst_delay"),
    ("inst_delay_max", "max", "inst_delay"),
]
INST_LOAN_FLAGS = [("inst_ever_late", "inst_delay_max")]
INST_CLIENT_SPEC = [
    ("COUNT_INSTALLMENT_LOANS", "count", None),
    ("inst_AMT_INSTALMENT_mean", "mean", "inst_AMT_INSTALMENT_mean"),
    ("inst_AMT_INSTALMENT_sum", "sum", "inst_AMT_INSTALMENT_sum"),
    ("inst_AMT_PAYMENT_mean", "mean", "inst_AMT_PAYMENT_mean"),
    ("inst_AMT_PAYMENT_sum", "sum", "inst_AMT_PAYMENT_sum"),
    ("inst_delay_mean", "mean", "inst_delay_mean"),
    ("inst_delay_max", "max", "inst_delay_max"),
    ("inst_ever_late_rate", "mean", "inst_ever_late"),
]


def pos_loan(pos: DataFrame) -> DataFrame:
    """One row per (client, POS loan)."""
    return with_ever_flags(aggregate(pos, [CLIENT, "SK_ID_PREV"], POS_LOAN_SPEC), POS_LOAN_FLAGS)


def pos_client(pos: DataFrame, **kw) -> DataFrame:
    """Mean of loan means (unweighted), roll-ups and ever rates."""
    return two_level(pos, CLIENT, "SK_ID_PREV", POS_LOAN_SPEC, POS_CLIENT_SPEC, POS_LOAN_FLAGS, **kw)


def bureau_balance_credit(bb: DataFrame) -> DataFrame:
    """D3: months, status counts and an ever-overdue flag per bureau credit."""
    out = aggregate(bb, ["SK_ID_BUREAU"], BB_CREDIT_SPEC)
    overdue = " + ".join(f"bb_status_{s}_count" for s in ["1", "2", "3", "4", "5"])
    return out.withColumn("bb_ever_overdue", F.expr(f"CAST({overdue} > 0 AS INT)"))


def bureau_client(bureau: DataFrame, bb: DataFrame) -> DataFrame:
    """Bureau credits left-joined to their monthly summary, per client.

    The overdue rate is over credits that have monthly rows (NULL flag
    otherwise); the debt ratio is NULL where the mean credit is -1.
    """
    credit = bureau_balance_credit(bb).select("SK_ID_BUREAU", "bb_ever_overdue")
    joined = bureau.join(credit, "SK_ID_BUREAU", "left")
    out = aggregate(joined, [CLIENT], BUREAU_CLIENT_SPEC)
    return out.withColumn(
        "bureau_DEBT_RATIO", F.expr("try_divide(bureau_AMT_CREDIT_SUM_debt, bureau_AMT_CREDIT_SUM_mean + 1)"))


def card_account(cc: DataFrame) -> DataFrame:
    """One row per (client, card account)."""
    return with_ever_flags(aggregate(cc, [CLIENT, "SK_ID_PREV"], CC_ACCOUNT_SPEC), CC_ACCOUNT_FLAGS)


def card_client(cc: DataFrame, **kw) -> DataFrame:
    """Roll-up of D5 per client."""
    return two_level(cc, CLIENT, "SK_ID_PREV", CC_ACCOUNT_SPEC, CC_CLIENT_SPEC, CC_ACCOUNT_FLAGS, **kw)


def prev_app_client(prev: DataFrame) -> DataFrame:
    """Previous applications, single level."""
    return aggregate(prev, [CLIENT], PREV_CLIENT_SPEC)


def _with_delay(inst: DataFrame) -> DataFrame:
    return inst.withColumn("inst_delay", F.expr("DAYS_ENTRY_PAYMENT - DAYS_INSTALMENT"))


def install_loan(inst: DataFrame) -> DataFrame:
    """delay = paid day - due day, per (client, loan)."""
    return with_ever_flags(aggregate(_with_delay(inst), [CLIENT, "SK_ID_PREV"], INST_LOAN_SPEC),
                           INST_LOAN_FLAGS)


def install_client(inst: DataFrame, **kw) -> DataFrame:
    """Roll-up of D8 per client."""
    return two_level(_with_delay(inst), CLIENT, "SK_ID_PREV", INST_LOAN_SPEC, INST_CLIENT_SPEC,
                     INST_LOAN_FLAGS, **kw)
