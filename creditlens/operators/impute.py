"""Zero-fill, train-fitted imputation and cleaning.

``fit_train_stats`` is the fit half of a fit/transform pair: it runs a few
small aggregate jobs on the *training* rows only and returns a tiny
``TrainStats`` value.  ``clean_application`` is the transform half: pure
Column expressions with the fitted values as literals, so train and test
are cleaned by the same plan and nothing about the test rows can change a
fitted number (SURVEY Q6).
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditlens.functions import scalar
from creditlens.operators.quantiles import column_modes, long_quantiles

COUNT_VARS = ["COUNT_POS_LOANS", "COUNT_BUREAU_RECORDS", "COUNT_CREDIT_CARDS",
              "COUNT_PREV_APPLICATIONS", "COUNT_INSTALLMENT_LOANS"]
ZERO_FILL_PREFIXES = ["pos_", "bureau_", "cc_", "prev_", "inst_", "AMT_REQ_CREDIT_BUREAU_"]
HAS_FLAGS = [("HAS_POS_LOAN", "COUNT_POS_LOANS"), ("HAS_BUREAU_RECORD", "COUNT_BUREAU_RECORDS"),
             ("HAS_CREDIT_CARD", "COUNT_CREDIT_CARDS"), ("HAS_PREV_APP", "COUNT_PREV_APPLICATIONS"),
             ("HAS_INSTALLMENT_LOAN", "COUNT_INSTALLMENT_LOANS")]

MEDIAN_VARS = ["EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3", "CNT_FAM_MEMBERS", "AMT_ANNUITY",
               "AMT_GOODS_PRICE"]
# Fitted on train as well (the reference takes it from the frame being cleaned).
EXTRA_MEDIAN_VARS = ["DAYS_LAST_PHONE_CHANGE"]
MODE_VARS = ["NAME_TYPE_SUITE", "OCCUPATION_TYPE", "FONDKAPREMONT_MODE", "HOUSETYPE_MODE",
             "WALLSMATERIAL_MODE", "EMERGENCYSTATE_MODE"]
ZERO_IMPUTE_VARS = ["bureau_DEBT_RATIO", "OWN_CAR_AGE", "OBS_30_CNT_SOCIAL_CIRCLE",
                    "DEF_30_CNT_SOCIAL_CIRCLE", "OBS_60_CNT_SOCIAL_CIRCLE",
                    "DEF_60_CNT_SOCIAL_CIRCLE"]
MISSING_FLAG_VARS = ["EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3"]
AGE_PROBS = [0.0, 0.25, 0.5, 0.75, 1.0]


def select_by_prefix(columns: Sequence[str], prefix: str) -> list[str]:
    """``grep("^prefix", names)``, case-sensitive, order kept."""
    pat = re.compile("^" + re.escape(prefix))
    return [c for c in columns if pat.match(c)]


def zero_fill_columns(columns: Sequence[str]) -> list[str]:
    out = [c for c in COUNT_VARS if c in columns]
    for p in ZERO_FILL_PREFIXES:
        out += [c for c in select_by_prefix(columns, p) if c not in out]
    return out


def zero_fill_flags(df: DataFrame) -> DataFrame:
    """Zero-fill count and history columns, then add ``HAS_*`` flags."""
    cols = zero_fill_columns(df.columns)
    df = df.fillna(0, subset=cols)  # 0 of each column's own type
    return df.withColumns({flag: F.expr(f"CAST(`{src}` > 0 AS INT)")
                           for flag, src in HAS_FLAGS if src in df.columns})


@dataclass
class TrainStats:
    medians: dict[str, float | None]
    modes: dict[str, str | None]
    age_edges: list[float]
    age_labels: list[str] = field(default_factory=list)
    age_mode_bin: int | None = None

    @property
    def age_mode_label(self) -> str | None:
        return None if self.age_mode_bin is None else self.age_labels[self.age_mode_bin - 1]

    def as_row(self) -> dict:
        row = {f"{k}_median": v for k, v in self.medians.items()}
        row.update({f"{k}_mode": v for k, v in self.modes.items()})
        row.update({f"AGE_edge_{i}": e for i, e in enumerate(self.age_edges)})
        row["AGE_BIN_mode"] = self.age_mode_label
        return row


def fit_train_stats(train: DataFrame) -> TrainStats:
    """Medians, modes and age-bin edges from the training rows only."""
    med_cols = [c for c in MEDIAN_VARS + EXTRA_MEDIAN_VARS if c in train.columns]
    mode_cols = [c for c in MODE_VARS if c in train.columns]
    # medians and age quartiles share one long frame (two small jobs); the
    # categorical modes are an independent job and run concurrently
    num = train.select(*[F.col(c).cast("double").alias(c) for c in med_cols],
                       scalar.days_to_years("DAYS_BIRTH").alias("AGE_YEARS"))
    long = num.unpivot([], med_cols + ["AGE_YEARS"], "variable", "value")
    with ThreadPoolExecutor(max_workers=2) as pool:
        modes_job = pool.submit(column_modes, train, mode_cols)
        q = long_quantiles(long, ["variable"], [0.5] + AGE_PROBS)
        modes = modes_job.result()
    medians = {c: q.get((c,), [None])[0] for c in med_cols}
    edges = q[("AGE_YEARS",)][1:]
    labels = scalar.cut_labels(edges)
    return TrainStats(medians, modes, edges, labels, _modal_bin(train, edges))


def fit_age_bins(train: DataFrame) -> TrainStats:
    """Only the age part of D10 (edges, labels, modal bin): one quantile pass.

    For reports that bin ages (approval by age group) without the imputation
    statistics; the values equal those of ``fit_train_stats``.
    """
    ages = train.select(scalar.days_to_years("DAYS_BIRTH").alias("value")).withColumn("variable", F.lit("AGE"))
    edges = long_quantiles(ages, ["variable"], AGE_PROBS)[("AGE",)]
    return TrainStats({}, {}, edges, scalar.cut_labels(edges), _modal_bin(train, edges))


def _modal_bin(train: DataFrame, edges: list[float]) -> int | None:
    """Most frequent right-closed age bin of the training rows, lowest bin on ties (one aggregate job)."""
    bins = (train.select(scalar.right_closed_bin_index(scalar.days_to_years("DAYS_BIRTH"), edges).alias("b"))
            .where(F.col("b").isNotNull()).groupBy("b").count()
            .orderBy(F.col("count").desc(), F.col("b")).first())
    return None if bins is None else bins["b"]


def stats_frame(spark, stats: TrainStats) -> DataFrame:
    """The fitted bundle as a one-row DataFrame (persistable next to a model)."""
    row = stats.as_row()
    schema = ", ".join(f"`{k}` {'string' if k.endswith('_mode') else 'double'}" for k in row)
    return spark.createDataFrame([tuple(row.values())], schema)


def missing_flags(df: DataFrame, cols: Sequence[str] = MISSING_FLAG_VARS) -> DataFrame:
    return df.withColumns({f"{c}_missing": scalar.missing_flag(c) for c in cols})


def clean_application(df: DataFrame, stats: TrainStats,
                      building_vars: Sequence[str] = ()) -> DataFrame:
    """Flags -> imputation and sentinel -> ratios and age bin -> modal bin.

    R's ``mutate`` evaluates left to right, so later expressions see earlier
    results.  One ``withColumns`` call would read the old values, hence one
    call per dependency level.
    """
    # level 1: flags from raw values
    df = df.withColumns({f"{c}_missing": F.expr(f"CAST(`{c}` IS NULL AS INT)")
                         for c in MISSING_FLAG_VARS + ["EMERGENCYSTATE_MODE"]})
    # level 2: imputation (fitted constants in one fillna), sentinel repair, age in years
    fills: dict = {c: float(stats.medians[c]) for c in MEDIAN_VARS + EXTRA_MEDIAN_VARS
                   if stats.medians.get(c) is not None and c in df.columns}
    fills.update({c: 0.0 for c in list(ZERO_IMPUTE_VARS) + list(building_vars) if c in df.columns})
    fills.update({c: stats.modes[c] for c in MODE_VARS if stats.modes.get(c) is not None and c in df.columns})
    df = df.fillna(fills) if fills else df
    df = df.withColumns({
        "DAYS_EMPLOYED": F.expr(f"CASE WHEN DAYS_EMPLOYED = {scalar.DAYS_EMPLOYED_SENTINEL} THEN 0D "
                                f"WHEN DAYS_EMPLOYED <> {scalar.DAYS_EMPLOYED_SENTINEL} "
                                "THEN CAST(abs(DAYS_EMPLOYED) AS DOUBLE) END"),
        "AGE_YEARS": F.expr("CAST(abs(DAYS_BIRTH) AS DOUBLE) / 365"),
    })
    # level 3: ratios on imputed values, right-closed age bin
    ratio = "try_divide(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE) + 1)"
    df = df.withColumns({
        "CREDIT_TO_INCOME": F.expr(ratio.format(a="AMT_CREDIT", b="AMT_INCOME_TOTAL")),
        "ANNUITY_TO_INCOME": F.expr(ratio.format(a="AMT_ANNUITY", b="AMT_INCOME_TOTAL")),
        "LOAN_TO_GOODS": F.expr(ratio.format(a="AMT_CREDIT", b="AMT_GOODS_PRICE")),
        "CREDIT_PER_PERSON": F.expr(ratio.format(a="AMT_CREDIT", b="CNT_FAM_MEMBERS")),
        "AGE_BIN": F.expr(scalar.right_closed_bin_sql("AGE_YEARS", stats.age_edges, stats.age_labels)),
    })
    # level 4: rows outside the training age range take the training modal bin
    if stats.age_mode_label is None:
        return df
    return df.fillna({"AGE_BIN": stats.age_mode_label})
