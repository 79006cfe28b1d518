"""Exact quantiles and modes without gathering a column into one task.

Spark's exact ``percentile`` keeps a value -> count map of a whole group in
a single final task, and ``percentile_approx`` is not exact.  The reference
needs R's type-7 quantiles exactly.  One path serves every size:

1. ``groupBy(key, value).count`` collapses ties (pre-aggregated per task);
2. the distinct values are range-partitioned by (key, value) and written
   once to the shared folder, so no partition holds more than its share and
   the partition boundaries are fixed;
3. counts per (key, partition) give each partition's offset (a window over
   one row per partition and key), a window inside (key, partition) gives
   each value its rank range;
4. the values whose range holds a wanted rank are picked and interpolated.

NaN counts as NULL; infinities and outliers need no special care, and the
number of jobs does not depend on the data.  Only the answers (one number
per key and probability) are collected, and only by the dict interfaces.

Modes use ``unpivot`` + ``groupBy(variable, level).count`` + ``min_by``;
ties go to the smallest level.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditlens.session import checkpoint_dir


def shared_table(df: DataFrame, name: str) -> DataFrame:
    """Write a frame once to the shared checkpoint folder and read it back; deleted with the JVM."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hpath)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def clean_value(v: Column) -> Column:
    """The value as a double, NaN as NULL."""
    d = v.cast("double")
    return F.when(~F.isnan(d), d)


def same_keys(a: DataFrame, b: DataFrame, keys: Sequence[str], suffix: str) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & a[k].eqNullSafe(b[f"{k}{suffix}"])
    return cond


def quantile_frame(long: DataFrame, keys: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """Type-7 quantiles of ``value`` per key: columns ``keys``, ``n`` and ``q0, q1, ...`` (one per probability).

    Keys without a value are absent.  NULL keys are keys.
    """
    keys = list(keys)
    counts = (long.select(*keys, clean_value(F.col("value")).alias("value")).where(F.col("value").isNotNull())
              .groupBy(*keys, "value").agg(F.count(F.lit(1)).alias("c")))
    placed = shared_table(counts.repartitionByRange(*keys, "value").withColumn("_part", F.spark_partition_id()),
                          "quantiles")
    parts = placed.groupBy(*keys, "_part").agg(F.sum("c").alias("_c"))
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(*[F.col(k).alias(f"{k}_o") for k in keys], F.col("_part").alias("_part_o"),
                         F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_before"),
                         F.sum("_c").over(Window.partitionBy(*keys)).alias("n"))
    j = placed.join(parts, same_keys(placed, parts, keys, "_o") & (placed["_part"] == parts["_part_o"]))
    upto = Window.partitionBy(*keys, "_part").orderBy("value")
    ranked = j.select(*keys, "value", "n", "c", (F.sum("c").over(upto) + F.col("_before")).alias("_end"))
    picks = []
    for i, p in enumerate(probs):
        h = (F.col("n") - 1) * F.lit(float(p))
        for name, rank in ((f"lo{i}", F.floor(h)), (f"hi{i}", F.ceil(h))):
            inside = (rank < F.col("_end")) & (rank >= F.col("_end") - F.col("c"))
            picks.append(F.max(F.when(inside, F.col("value"))).alias(name))
    got = ranked.groupBy(*keys, "n").agg(*picks)
    out = []
    for i, p in enumerate(probs):
        h = (F.col("n") - 1) * F.lit(float(p))
        frac = h - F.floor(h)
        lo, hi = F.col(f"lo{i}"), F.col(f"hi{i}")
        out.append(F.when((frac == 0) | (lo == hi), lo).otherwise((1 - frac) * lo + frac * hi).alias(f"q{i}"))
    return got.select(*keys, "n", *out)


SHIFTS = (44, 22)     # low bits left out by each round of buckets
LEAF = 1 << 18        # values a bucket may hold when its distinct values are ranked


def _with_key(long: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys, value and ``_key``: a long that orders like the value (its bits, those of negative values turned over)."""
    v = long.select(*keys, (clean_value(F.col("value")) + F.lit(0.0)).alias("value")).where(F.col("value").isNotNull())
    bits = F.expr("CAST(java_method('java.lang.Double', 'doubleToLongBits', value) AS BIGINT)")
    return v.withColumn("_bits", bits).select(
        *keys, "value", F.when(F.col("_bits") < 0, F.col("_bits").bitwiseXOR(F.lit((1 << 63) - 1)))
        .otherwise(F.col("_bits")).alias("_key"))


def _holding(counts: DataFrame, within: Sequence[str], by: str, probs: Sequence[float], n: str | None) -> DataFrame:
    """Rows of ``counts(within, by, c)`` that hold a wanted rank, with ``n``, values ``_before`` and the ``_ranks``.

    ``n`` and ``_start`` (values before the bucket that was split) are columns
    of ``counts`` from the second round on.
    """
    before = Window.partitionBy(*within).orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
    first = n is None
    total = F.sum("c").over(Window.partitionBy(*within)) if first else F.col("n")
    start = F.lit(0) if first else F.col("_start")
    placed = counts.withColumn("n", total) \
        .withColumn("_before", F.coalesce(F.sum("c").over(before), F.lit(0)) + start)
    h = [(F.col("n") - 1) * F.lit(float(p)) for p in probs]
    ranks = F.array_distinct(F.array(*[f(x) for x in h for f in (F.floor, F.ceil)]))
    return placed.withColumn("_ranks", F.filter(ranks, lambda r: (r >= F.col("_before"))
                                                & (r < F.col("_before") + F.col("c")))).where(F.size("_ranks") > 0)


def long_quantiles(long: DataFrame, keys: Sequence[str], probs: Sequence[float]) -> dict[tuple, list]:
    """``quantile_frame`` as ``{key_tuple: [q(p) ...]}``, for keys that are column names (few).

    Radix selection: one aggregate counts the values of every key by the
    leading bits of an order-preserving key; only buckets that hold a wanted
    rank are counted again by more bits, until they hold at most LEAF values,
    whose distinct ones are ranked.  No value is written or shuffled beyond
    these buckets' counts; the driver gets a row per key and rank.
    """
    keys = list(keys)
    spark = long.sparkSession
    base = _with_key(long, keys)
    kinds = [f"`{k}` {base.schema[k].dataType.simpleString()}" for k in keys]

    def among(buckets: list) -> DataFrame:
        """Values of the collected buckets; a row per bucket is broadcast."""
        shift = buckets[0]["_shift"]
        told = spark.createDataFrame(
            [(*[r[k] for k in keys], r["_bucket"], r["n"], r["_before"]) for r in buckets],
            ", ".join([*[k.replace("` ", "_o` ", 1) for k in kinds], "_bucket_o long", "n long", "_start long"]))
        mine = base.withColumn("_bucket", F.shiftright("_key", shift))
        return mine.join(F.broadcast(told), same_keys(mine, told, keys, "_o")
                         & (mine["_bucket"] == told["_bucket_o"])) \
            .select(*keys, F.col("_bucket").alias("_old"), "n", "_start", "value", "_key")

    found = []
    todo = None
    for shift in SHIFTS:
        rows = base if todo is None else among(todo)
        held = [] if todo is None else ["_old", "n", "_start"]
        counts = rows.groupBy(*keys, *held, F.shiftright("_key", shift).alias("_bucket")) \
            .agg(F.count(F.lit(1)).alias("c"))
        got = _holding(counts, [*keys, *held], "_bucket", probs, None if todo is None else "n") \
            .select(*keys, "_bucket", "n", "_before", "c", F.lit(shift).alias("_shift")).collect()
        found += [r for r in got if r["c"] <= LEAF]
        todo = [r for r in got if r["c"] > LEAF]
        if not todo:
            break
    values: dict = {}
    for shift in SHIFTS:
        leaves = [r for r in found if r["_shift"] == shift] + (todo if shift == SHIFTS[-1] else [])
        if not leaves:
            continue
        counts = among(leaves).groupBy(*keys, "_old", "n", "_start", "value").agg(F.count(F.lit(1)).alias("c"))
        for r in _holding(counts, [*keys, "_old", "n", "_start"], "value", probs, "n").collect():
            one = values.setdefault(tuple(r[k] for k in keys), (r["n"], {}))
            one[1].update({rank: r["value"] for rank in r["_ranks"]})
    out = {}
    for key, (n, at) in values.items():
        line = []
        for p in probs:
            h = (n - 1) * float(p)
            lo, hi = at[math.floor(h)], at[math.ceil(h)]
            frac = h - math.floor(h)
            line.append(lo if frac == 0 or lo == hi else (1 - frac) * lo + frac * hi)
        out[key] = line
    return out


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float]) -> dict[str, list]:
    """R ``quantile(x, probs, type=7, na.rm=TRUE)`` per column; all-NULL gives NULLs."""
    cols = list(cols)
    if not cols:
        return {}
    long = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).unpivot(
        [], cols, "variable", "value")
    got = long_quantiles(long, ["variable"], probs)
    return {c: got.get((c,), [None] * len(probs)) for c in cols}


def exact_medians(df: DataFrame, cols: Sequence[str]) -> dict[str, float]:
    return {c: v[0] for c, v in exact_quantiles(df, cols, [0.5]).items()}


def mode_frame(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(variable, mode, n) per column: most frequent non-NULL level, smallest on ties."""
    cols = list(cols)
    long = df.select(*[F.col(c).cast("string").alias(c) for c in cols]).unpivot(
        [], cols, "variable", "level").where(F.col("level").isNotNull())
    counts = long.groupBy("variable", "level").agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy("variable").agg(
        F.min_by(F.col("level"), F.struct(-F.col("n"), F.col("level"))).alias("mode"),
        F.max("n").alias("n"))


def column_modes(df: DataFrame, cols: Sequence[str]) -> dict[str, str | None]:
    """Driver-side dict of modes; one row per column is collected."""
    got = {r["variable"]: r["mode"] for r in mode_frame(df, cols).collect()}
    return {c: got.get(c) for c in cols}


def group_mode(df: DataFrame, keys: Sequence[str], col: str, name: str = "mode") -> DataFrame:
    """Most frequent non-NULL value of ``col`` per group; alphabetical tie rule.

    Two aggregations (per (key, level) count, then ``min_by`` per key), so a
    hot key is pre-aggregated on every map task.
    """
    counts = df.where(F.col(col).isNotNull()).groupBy(*keys, col).agg(F.count(F.lit(1)).alias("_n"))
    return counts.groupBy(*keys).agg(F.min_by(F.col(col), F.struct(-F.col("_n"), F.col(col))).alias(name))
