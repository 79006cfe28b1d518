"""Evaluation and decision reports.

Scores, labels and groups live in one DataFrame keyed by id; there is no
positional alignment.  Approval rule everywhere: approve iff
p(default) < threshold (SURVEY Q1); ``direction="ge"`` reproduces the
reference's fairness figures, which approve at p >= threshold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditlens.operators.ranking import prefix_sums, quantile_buckets

# Business assumptions per $1 of principal (model card).
PROFIT_REPAID = 0.12
LOSS_DEFAULT = -0.60
GRID_STEPS = 100  # thresholds 0.01 .. 0.99


def roc_auc(df: DataFrame, score: str, label: str) -> DataFrame:
    """Exact ROC AUC with mid-ranks for ties (one row, column ``auc``).

    Rows are collapsed to one row per distinct score (positives and
    negatives counted), the negatives below each score come from bucketed
    prefix sums, and AUC = sum(pos * (neg_below + neg_tied / 2)) / (P * N).
    Higher score = default (fixed direction, SURVEY Q17).
    """
    return _grouped_scores(df, score, label).agg(_AUC().alias("auc"))


def _grouped_scores(df: DataFrame, score: str, label: str) -> DataFrame:
    """One row per distinct score with positives, negatives and negatives below it."""
    y = F.col(label).cast("long")
    g = df.where(F.col(score).isNotNull() & y.isNotNull()).groupBy(score).agg(
        F.sum(y).alias("pos"), F.sum(1 - y).alias("neg"))
    g = quantile_buckets(g, score, "_bkt", buckets=1024)
    return prefix_sums(g, "_bkt", [score], ["neg"])


def _AUC() -> Column:  # noqa: N802 - reads like the quantity
    return F.try_divide(F.sum(F.col("pos") * (F.col("neg_before") + F.col("neg") / 2.0)),
                        F.sum("pos").cast("double") * F.sum("neg"))


def _approve(score: Column, threshold: float, direction: str) -> Column:
    return score >= threshold if direction == "ge" else score < threshold


def confusion_metrics(df: DataFrame, score: str, label: str, threshold: float = 0.65) -> DataFrame:
    """M15 + Q14: confusion counts at ``p >= t`` (predicted default), accuracy,
    precision, recall and the approval rate (computed, not typed in)."""
    p, y = F.col(score), F.col(label)
    pred = p >= threshold
    tp, fp = F.count_if(pred & (y == 1)), F.count_if(pred & (y == 0))
    fn, tn = F.count_if(~pred & (y == 1)), F.count_if(~pred & (y == 0))
    return df.agg(tn.alias("tn"), fp.alias("fp"), fn.alias("fn"), tp.alias("tp")).select(
        "tn", "fp", "fn", "tp",
        F.try_divide(F.col("tp") + F.col("tn"), (F.col("tp") + F.col("tn") + F.col("fp") + F.col("fn"))
                     .cast("double")).alias("accuracy"),
        F.try_divide(F.col("tp"), (F.col("tp") + F.col("fp")).cast("double")).alias("precision"),
        F.try_divide(F.col("tp"), (F.col("tp") + F.col("fn")).cast("double")).alias("recall"),
        F.try_divide(F.col("tn") + F.col("fn"), (F.col("tp") + F.col("tn") + F.col("fp") + F.col("fn"))
                     .cast("double")).alias("approval_rate"))


def sens_spec(df: DataFrame, score: str, label: str, threshold: float = 0.5) -> DataFrame:
    """``twoClassSummary``: ROC AUC, sensitivity (defaults caught at
    p >= t) and specificity, from one pass over the per-score counts."""
    at = F.col(score) >= threshold
    return _grouped_scores(df, score, label).agg(
        _AUC().alias("ROC"),
        F.try_divide(F.sum(F.when(at, F.col("pos")).otherwise(0)), F.sum("pos").cast("double")).alias("Sens"),
        F.try_divide(F.sum(F.when(~at, F.col("neg")).otherwise(0)), F.sum("neg").cast("double")).alias("Spec"))


def first_approving_step(score: Column, steps: int = GRID_STEPS) -> Column:
    """Smallest k with ``score < k / steps`` (k = steps means never on the grid).

    ``floor(p * steps) + 1`` is corrected against the exact thresholds
    because ``p * steps`` can round across an integer (0.29 * 100 = 28.999...).
    A missing score is approved by no threshold (a step beyond the grid).
    """
    k = F.floor(score * steps).cast("int") + 1
    k = F.when(score >= k / F.lit(float(steps)), k + 1).otherwise(k)
    k = F.when(score < (k - 1) / F.lit(float(steps)), k - 1).otherwise(k)
    return F.when(score.isNull(), steps + 1).otherwise(F.greatest(k, F.lit(1)))


def threshold_sweep(df: DataFrame, score: str, label: str, steps: int = GRID_STEPS) -> DataFrame:
    """M17 + J6 + X15: approval rate (%), good / bad approved and profit at 99 thresholds.

    Each score is bucketed once by the first threshold that approves it;
    the bucket totals (at most ``steps`` + 2 rows; a client without a score
    counts in the denominators and is never approved) are joined to the grid and
    cumulated, which equals comparing every score with every threshold.
    """
    spark = df.sparkSession
    y = F.col(label)
    counts = df.groupBy(first_approving_step(F.col(score), steps).alias("k")).agg(
        F.count_if(y == 0).alias("good"), F.count_if(y == 1).alias("bad"))
    grid = spark.range(1, steps).select(F.col("id").cast("int").alias("k"))
    j = grid.join(counts, "k", "full_outer").fillna(0, ["good", "bad"])
    w_all = Window.partitionBy()  # at most steps + 1 rows
    w_cum = Window.orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    cum = j.select("k", F.sum(F.col("good") + F.col("bad")).over(w_all).alias("n"),
                   F.sum("good").over(w_cum).alias("good_approved"),
                   F.sum("bad").over(w_cum).alias("bad_approved"))
    return cum.where(F.col("k") < steps).select(
        (F.col("k") / F.lit(float(steps))).alias("threshold"),
        (F.lit(100.0) * (F.col("good_approved") + F.col("bad_approved")) / F.col("n")).alias("approval_rate"),
        "good_approved", "bad_approved",
        (F.col("good_approved") * PROFIT_REPAID + F.col("bad_approved") * LOSS_DEFAULT).alias("profit"),
        (F.col("good_approved") * PROFIT_REPAID + F.col("bad_approved") * LOSS_DEFAULT)
        .alias("_p"), "n").withColumn("profit_per_applicant", F.col("_p") / F.col("n")).drop("_p", "n")


def top_thresholds(sweep: DataFrame, k: int = 10) -> DataFrame:
    """M18 + L3 + L4 + X13: top k by profit (lower threshold first on ties),
    re-sorted by threshold descending, with the approval rate as text."""
    # Flag the rows equal to the global maximum (window over <= 99 sweep rows)
    flagged = sweep.withColumn("is_max_profit", F.col("profit") == F.max("profit").over(Window.partitionBy()))
    top = flagged.orderBy(F.col("profit").desc(), F.col("threshold")).limit(k)
    return top.select("threshold", F.format_string("%.2f%%", F.col("approval_rate")).alias("approval_rate"),
                      "good_approved", "bad_approved", "profit", "is_max_profit").orderBy(F.col("threshold").desc())


def optimal_threshold(sweep: DataFrame) -> DataFrame:
    """M19 + L5: argmax of profit per applicant, first (lowest threshold) on ties."""
    return sweep.agg(
        F.max_by("threshold", F.struct(F.col("profit_per_applicant"), -F.col("threshold")))
        .alias("optimal_threshold"),
        F.max("profit_per_applicant").alias("profit_per_applicant"))


def threshold_sensitivity(sweep: DataFrame, delta_steps: int = 5, steps: int = GRID_STEPS) -> DataFrame:
    """Profit per applicant at the optimum and at +/- 0.05 (same approval rule)."""
    opt = optimal_threshold(sweep).select(
        F.round(F.col("optimal_threshold") * steps).cast("int").alias("k_opt"))
    s = sweep.withColumn("k", F.round(F.col("threshold") * steps).cast("int"))
    j = s.join(F.broadcast(opt), (s["k"] - opt["k_opt"]).isin(-delta_steps, 0, delta_steps))
    return j.select((F.col("k") - F.col("k_opt")).alias("offset_steps"), "threshold", "profit_per_applicant")


def majority_baseline(df: DataFrame, label: str) -> DataFrame:
    """M1 + A27: accuracy of always predicting 0, and the AUC of a constant score (0.5)."""
    acc = df.agg(F.avg((F.col(label) == 0).cast("double")).alias("Value")) \
        .select(F.lit("Baseline Accuracy").alias("Metric"), "Value")
    const = df.select(label, F.lit(1.0).alias("_p"))
    auc = roc_auc(const, "_p", label).select(F.lit("Baseline AUC").alias("Metric"), F.col("auc").alias("Value"))
    return acc.unionByName(auc)
