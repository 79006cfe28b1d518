"""Single-level client aggregates of the profiling notebook.

These differ from the feature tables on purpose: means are row-weighted
(not means of loan means), ``sum`` is 0 on an all-NULL group, ``n_distinct``
counts NULL as a value, and the bureau status summary is a mode.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditlens.functions import aggs
from creditlens.operators.joins import suffix_join

CLIENT = "SK_ID_CURR"


def eda_pos_client(pos: DataFrame) -> DataFrame:
    """Distinct loans, rows and four row-weighted means per client."""
    return pos.groupBy(CLIENT).agg(
        aggs.n_distinct_na("SK_ID_PREV").cast("long").alias("POS_CASH_LOANS"),
        aggs.count_rows().alias("MONTHS_HISTORY"),
        aggs.safe_mean("CNT_INSTALMENT").alias("CNT_INSTALMENT_MEAN"),
        aggs.safe_mean("CNT_INSTALMENT_FUTURE").alias("CNT_INSTALMENT_FUTURE_MEAN"),
        aggs.safe_mean("SK_DPD").alias("SK_DPD_MEAN"),
        aggs.safe_mean("SK_DPD_DEF").alias("SK_DPD_DEF_MEAN"))


def eda_bb_credit(bb: DataFrame) -> DataFrame:
    """Months per credit and the most common status (alphabetical on ties)."""
    levels = bb.groupBy("SK_ID_BUREAU", "STATUS").agg(aggs.count_rows().alias("_n"))
    return levels.groupBy("SK_ID_BUREAU").agg(
        F.sum("_n").alias("MONTHS_BUREAU"),
        # NULL ordering keys are skipped, so rows without a status do not compete
        F.min_by("STATUS", F.when(F.col("STATUS").isNotNull(), F.struct(-F.col("_n"), F.col("STATUS"))))
        .alias("STATUS_MOST_COMMON"))


def eda_bureau_client(bureau: DataFrame, bb: DataFrame) -> DataFrame:
    """Credits, active count, sums (0 when all NULL), max overdue, mean months."""
    credit = eda_bb_credit(bb).select("SK_ID_BUREAU", "MONTHS_BUREAU")
    j = bureau.join(credit, "SK_ID_BUREAU", "left")
    return j.groupBy(CLIENT).agg(
        aggs.n_distinct_na("SK_ID_BUREAU").cast("long").alias("BUREAU_CREDITS"),
        aggs.count_where(F.col("CREDIT_ACTIVE") == "Active").alias("CREDIT_ACTIVE_COUNT"),
        aggs.sum0("AMT_CREDIT_SUM").alias("AMT_CREDIT_SUM"),
        aggs.sum0("AMT_CREDIT_SUM_OVERDUE").alias("AMT_CREDIT_SUM_OVERDUE"),
        aggs.safe_max("AMT_CREDIT_MAX_OVERDUE").alias("AMT_CREDIT_MAX_OVERDUE"),
        aggs.safe_mean("MONTHS_BUREAU").alias("MONTHS_BUREAU_MEAN"))


def eda_card_client(cc: DataFrame) -> DataFrame:
    """Accounts, rows and five row-weighted means per client."""
    return cc.groupBy(CLIENT).agg(
        aggs.n_distinct_na("SK_ID_PREV").cast("long").alias("CC_LOANS"),
        aggs.count_rows().alias("MONTHS_CC"),
        aggs.safe_mean("AMT_BALANCE").alias("AMT_BALANCE_MEAN"),
        aggs.safe_mean("AMT_CREDIT_LIMIT_ACTUAL").alias("AMT_CREDIT_LIMIT_MEAN"),
        aggs.safe_mean("AMT_PAYMENT_CURRENT").alias("AMT_PAYMENT_MEAN"),
        aggs.safe_mean("SK_DPD").alias("SK_DPD_MEAN"),
        aggs.safe_mean("SK_DPD_DEF").alias("SK_DPD_DEF_MEAN"))


def eda_prev_client(prev: DataFrame) -> DataFrame:
    """Applications, two means, approved and refused counts."""
    s = F.col("NAME_CONTRACT_STATUS")
    return prev.groupBy(CLIENT).agg(
        aggs.count_rows().alias("NUM_PREV_APPS"),
        aggs.safe_mean("AMT_APPLICATION").alias("AMT_APPLICATION_MEAN"),
        aggs.safe_mean("AMT_CREDIT").alias("AMT_CREDIT_MEAN"),
        aggs.count_where(s == "Approved").alias("NUM_APPROVED"),
        aggs.count_where(s == "Refused").alias("NUM_REFUSED"))


def eda_install_client(inst: DataFrame) -> DataFrame:
    """Instalments, two totals (0 when all NULL) and the mean lateness."""
    return inst.groupBy(CLIENT).agg(
        aggs.count_rows().alias("NUM_INSTALLMENTS"),
        aggs.sum0("AMT_INSTALMENT").alias("AMT_INSTALMENT_TOTAL"),
        aggs.sum0("AMT_PAYMENT").alias("AMT_PAYMENT_TOTAL"),
        aggs.safe_mean(F.col("DAYS_ENTRY_PAYMENT") - F.col("DAYS_INSTALMENT")).alias("DAYS_LATE_MEAN"))


def eda_augment(app: DataFrame, pos_c: DataFrame, bureau_c: DataFrame, card_c: DataFrame,
                prev_c: DataFrame, inst_c: DataFrame) -> DataFrame:
    """D22 + J4: five left joins; columns present on both sides get ``_x`` / ``_y``."""
    out = app
    for right in (pos_c, bureau_c, card_c, prev_c, inst_c):
        out = suffix_join(out, right, CLIENT, "left")
    return out
