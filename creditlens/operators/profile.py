"""Profiling operators.

Per-column statistics are computed in one aggregate pass over many
expressions and then ``unpivot``-ed to one row per column, instead of one
job per column (the reference loops over columns).  A very wide pass that
outgrows the JVM method-size limit falls back from whole-stage codegen to
interpreted evaluation; it still reads the data once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditlens.operators.quantiles import clean_value, quantile_frame, same_keys


def round4(c) -> Column:
    """``round(x, 4)``; snapped to 9 decimals first so both engines agree."""
    col = F.col(c) if isinstance(c, str) else c
    return F.round(F.round(col, 9), 4)


def guarded_corr(x, y) -> Column:
    """Pearson correlation over complete pairs; NULL for a constant column.

    ``corr`` raises DIVIDE_BY_ZERO on a constant column under ANSI mode, so
    the ratio is written with ``try_divide`` over values masked to the rows
    where both sides are present.
    """
    xc = F.col(x).cast("double")
    yc = F.col(y).cast("double")
    xm = F.when(yc.isNotNull(), xc)
    ym = F.when(xc.isNotNull(), yc)
    return F.try_divide(F.covar_pop(xm, ym), F.stddev_pop(xm) * F.stddev_pop(ym))


def target_corr(df: DataFrame, label: str, cols: Sequence[str]) -> DataFrame:
    """A18 + U2 + L1: correlation of each column with the label, sorted by |r|."""
    wide = df.agg(*[round4(guarded_corr(c, label)).alias(c) for c in cols])
    long = wide.unpivot([], list(cols), "Predictor", "Correlation_with_Target")
    # one row per column: a single sorted partition (no range-sampling job)
    return long.coalesce(1).sortWithinPartitions(F.abs("Correlation_with_Target").desc_nulls_last(), "Predictor")


def class_balance(df: DataFrame, label: str = "TARGET") -> DataFrame:
    """A23 + P7 + W1: count per class and its share (``round(n/sum(n), 4)``).

    The share uses a window over the grouped result, which has one row per
    class, so the single-partition window is bounded by the class count.
    """
    counts = df.groupBy(F.col(label).alias("Default")).agg(F.count(F.lit(1)).alias("Count"))
    total = F.sum("Count").over(Window.partitionBy())
    return counts.withColumn("Proportion", round4(F.col("Count") / total))


def group_rate(df: DataFrame, group: str, label: str = "TARGET") -> DataFrame:
    """A24 + L6: default rate and count per level, ordered by the rate."""
    return (df.groupBy(group).agg(F.avg(F.col(label).cast("double")).alias("Default_Rate"),
                                  F.count(F.lit(1)).alias("Count"))
            .orderBy("Default_Rate", group))


def _long_levels(df: DataFrame, cols: Sequence[str], extra: Sequence[str] = ()) -> DataFrame:
    return df.select(*extra, *[F.col(c).cast("string").alias(c) for c in cols]).unpivot(
        list(extra), list(cols), "variable", "level")


def rate_spread(df: DataFrame, cat_cols: Sequence[str], label: str = "TARGET") -> DataFrame:
    """``max(rate) - min(rate)`` over the levels of each categorical column.

    One unpivot, then two aggregations; the NULL level is its own group.
    """
    long = _long_levels(df, cat_cols, [label])
    rates = long.groupBy("variable", "level").agg(F.avg(F.col(label).cast("double")).alias("r"))
    return (rates.groupBy(F.col("variable").alias("Predictor"))
            .agg((F.max("r") - F.min("r")).alias("Max_Proportion_Diff"))
            .coalesce(1).sortWithinPartitions(F.col("Max_Proportion_Diff").desc(), "Predictor"))


def level_freq(df: DataFrame, cat_cols: Sequence[str]) -> DataFrame:
    """A26 + L2: rows per (variable, level), NULL level included."""
    return (_long_levels(df, cat_cols).groupBy("variable", "level")
            .agg(F.count(F.lit(1)).alias("n")).orderBy("variable", F.col("n").desc(), "level"))


def missing_summary(df: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    """A19 + F2: NULL count per column (> 0 only) with its share of rows."""
    cols = [c for c in df.columns if c not in exclude]
    wide = df.agg(F.count(F.lit(1)).alias("_rows"),
                  *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    long = wide.unpivot(["_rows"], cols, "Variable", "Count")
    return (long.where(F.col("Count") > 0)
            .select("Variable", "Count", round4(F.col("Count") / F.col("_rows")).alias("Proportion"))
            .coalesce(1).sortWithinPartitions(F.col("Count").desc(), "Variable"))


def numeric_summary(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """R ``summary``: min, Q1, median, mean, Q3, max and NA count per column.

    Min / mean / max / NA come from one aggregate; the quartiles from the
    exact distributed selection.  NaN counts as NA.
    """
    cols = list(cols)
    long = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).unpivot(
        [], cols, "variable", "value")
    v = clean_value(F.col("value"))
    stats = long.groupBy("variable").agg(
        F.min(v).alias("Min"), F.avg(v).alias("Mean"), F.max(v).alias("Max"),
        F.count_if(v.isNull()).alias("NAs"))
    q = quantile_frame(long, ["variable"], [0.25, 0.5, 0.75])
    return stats.join(q, "variable", "left").select(
        "variable", "Min", F.col("q0").alias("Q1"), F.col("q1").alias("Median"), "Mean",
        F.col("q2").alias("Q3"), "Max", "NAs")


def box_stats(df: DataFrame, value_cols: Sequence[str], group: str = "TARGET") -> DataFrame:
    """Box-plot statistics per (variable, group): quartiles, 1.5 IQR whiskers, outliers.

    Quartiles come from the exact distributed selection; the whiskers and the
    outlier count from one more aggregate after joining the quartile table
    back (one row per variable and group; AQE decides how).  NaN counts as NULL.
    """
    long = df.select(F.col(group).alias("grp"), *[F.col(c).cast("double").alias(c) for c in value_cols]) \
        .unpivot(["grp"], list(value_cols), "variable", "value") \
        .withColumn("value", clean_value(F.col("value"))).where(F.col("value").isNotNull())
    q = quantile_frame(long, ["variable", "grp"], [0.25, 0.5, 0.75]).select(
        F.col("variable").alias("variable_q"), F.col("grp").alias("grp_q"), F.col("q0").alias("q1"),
        F.col("q1").alias("median"), F.col("q2").alias("q3"))
    j = long.join(q, same_keys(long, q, ["variable", "grp"], "_q"))
    iqr = F.col("q3") - F.col("q1")
    lo_fence, hi_fence = F.col("q1") - 1.5 * iqr, F.col("q3") + 1.5 * iqr
    v = F.col("value")
    return (j.groupBy("variable", "grp", "q1", "median", "q3").agg(
        F.min(F.when(v >= lo_fence, v)).alias("lower_whisker"),
        F.max(F.when(v <= hi_fence, v)).alias("upper_whisker"),
        F.count_if((v < lo_fence) | (v > hi_fence)).alias("n_outliers"),
        F.count(F.lit(1)).alias("n"))
        .withColumnRenamed("grp", group))


def histogram(df: DataFrame, col: str, bins: int = 150) -> DataFrame:
    """Equal-width bins over [min, max]; the maximum falls in the last bin.

    Every bin is reported, empty ones with count 0 (the bin grid is a
    ``range`` of ``bins`` rows joined to the per-bin counts).
    """
    spark = df.sparkSession
    x = F.col(col).cast("double")
    r = df.agg(F.min(x).alias("lo"), F.max(x).alias("hi")).first()
    lo, hi = r["lo"], r["hi"]
    if lo is None:
        return spark.createDataFrame([], "bin int, lower double, upper double, count long")
    width = (hi - lo) / bins if hi > lo else 1.0
    b = F.least(F.floor((x - F.lit(lo)) * bins / F.lit(hi - lo if hi > lo else 1.0)).cast("int") + 1,
                F.lit(bins))
    counts = df.where(x.isNotNull()).groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    grid = spark.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"))
    return (grid.join(counts, "bin", "left").fillna(0, ["count"])
            .withColumn("lower", F.lit(lo) + (F.col("bin") - 1) * F.lit(width))
            .withColumn("upper", F.lit(lo) + F.col("bin") * F.lit(width))
            .select("bin", "lower", "upper", "count"))


def union_train_test(train: DataFrame, test: DataFrame, label: str = "TARGET") -> DataFrame:
    """U1 + P8: stack train and test by name; test gets a NULL label and a tag."""
    tr = train.withColumn("dataset", F.lit("train"))
    te = test.withColumn(label, F.lit(None).cast(dict(train.dtypes)[label])) \
        .withColumn("dataset", F.lit("test"))
    return tr.unionByName(te, allowMissingColumns=True)


def unpivot_long(df: DataFrame, ids: Sequence[str], cols: Sequence[str], name: str = "Source",
                 value: str = "Value") -> DataFrame:
    """Wide -> long; mixed types are cast to string first (unpivot needs one type)."""
    types = {dict(df.dtypes)[c] for c in cols}
    sel = [F.col(c) for c in ids] + [F.col(c).cast("string" if len(types) > 1 else list(types)[0]).alias(c)
                                     for c in cols]
    return df.select(*sel).unpivot(list(ids), list(cols), name, value)
