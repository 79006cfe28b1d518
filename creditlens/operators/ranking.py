"""Global order statistics without a single-partition window.

A window with no ``partitionBy`` sends every row to one task.  The helpers
here split the order into buckets first:

1. each row gets a bucket that is monotone in the ordering column (a fixed
   grid for values known to be uniform in [0, 1) such as hash draws, or
   approximate-quantile splits otherwise);
2. per-bucket totals are aggregated on the cluster (one row per bucket);
3. exclusive prefix sums over the bucket totals are a window over at most
   ``buckets`` rows, broadcast back by bucket id (size bounded by
   construction);
4. inside a bucket a window partitioned by the bucket finishes the job.

Each bucket holds about n / buckets rows, so no task sees more than its
share, and a hot key cannot pile up in one bucket because ties are
collapsed (``groupBy`` of the ordering value) before ranking where the
caller allows it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# 16k buckets: at 10^10 rows a bucket holds ~600k rows (one task's sort),
# and the offsets table (one row per bucket) is still small to broadcast.
BUCKETS = 16384


def uniform_bucket(u: Column, buckets: int = BUCKETS) -> Column:
    """Bucket of a value in [0, 1) on a fixed grid (monotone in u)."""
    return F.least(F.floor(u * buckets).cast("int"), F.lit(buckets - 1))


def quantile_buckets(df: DataFrame, col: str, out: str = "_bkt", buckets: int = BUCKETS,
                     rel_error: float = 0.001) -> DataFrame:
    """Add a bucket id monotone in ``col`` with roughly equal rows per bucket.

    Split points come from ``approxQuantile`` (a bounded sketch, merged on
    the cluster); ``Bucketizer`` assigns buckets by binary search in the JVM.
    NULLs go to their own bucket after every value.
    """
    probs = [i / buckets for i in range(1, buckets)]
    splits = sorted(set(df.approxQuantile(col, probs, rel_error)))
    splits = [float("-inf")] + [s for s in splits if s not in (float("-inf"), float("inf"))] + [float("inf")]
    b = Bucketizer(splits=splits, inputCol=col, outputCol=out, handleInvalid="keep")
    return b.transform(df)


def prefix_sums(df: DataFrame, bucket: str, order: Sequence[str], measures: Sequence[str],
                tie: Sequence[str] = ()) -> DataFrame:
    """Add ``<m>_before`` (sum over rows strictly earlier in the order) per measure.

    Rows are ordered by ``bucket`` then ``order`` then ``tie``; ``bucket`` must
    be monotone in ``order``.
    """
    totals = df.groupBy(bucket).agg(*[F.sum(m).alias(f"_t_{m}") for m in measures])
    w_b = Window.orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(bucket, *[F.coalesce(F.sum(f"_t_{m}").over(w_b), F.lit(0)).alias(f"_o_{m}")
                                      for m in measures])
    # one row per bucket: bounded by the bucket count, safe to broadcast
    joined = df.join(F.broadcast(offsets), bucket)
    w_in = Window.partitionBy(bucket).orderBy(*order, *tie).rowsBetween(Window.unboundedPreceding, -1)
    return joined.select(
        *[F.col(c) for c in df.columns],
        *[(F.col(f"_o_{m}") + F.coalesce(F.sum(m).over(w_in), F.lit(0))).alias(f"{m}_before")
          for m in measures])


def global_row_number(df: DataFrame, u: str, tie: str, partition: Sequence[str] = (),
                      buckets: int = BUCKETS, out: str = "rn") -> DataFrame:
    """0-based row number ordered by ``(u, tie)`` within ``partition``.

    ``u`` must lie in [0, 1) (e.g. an md5 draw), so the fixed grid balances
    the buckets.
    """
    part = list(partition)
    b = df.withColumn("_bkt", uniform_bucket(F.col(u), buckets)).withColumn("_one", F.lit(1))
    totals = b.groupBy(*part, "_bkt").agg(F.count(F.lit(1)).alias("_n"))
    w_b = Window.partitionBy(*part).orderBy("_bkt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*part, "_bkt", F.coalesce(F.sum("_n").over(w_b), F.lit(0)).alias("_off"))
    # NULL partitions keep their rows; AQE broadcasts the offsets when they are small
    offsets = offsets.withColumnsRenamed({c: f"{c}_o" for c in [*part, "_bkt"]})
    cond = b["_bkt"] == offsets["_bkt_o"]
    for c in part:
        cond = cond & b[c].eqNullSafe(offsets[f"{c}_o"])
    joined = b.join(offsets, cond).drop(*[f"{c}_o" for c in [*part, "_bkt"]])
    w_in = Window.partitionBy(*part, "_bkt").orderBy(u, tie)
    return joined.withColumn(out, F.col("_off") + F.row_number().over(w_in) - 1) \
        .drop("_bkt", "_one", "_off")
