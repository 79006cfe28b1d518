"""Seeded sampling and splitting.

Randomness is an md5 draw of ``id:seed``: the same rows are chosen on one
executor or a thousand, in any partitioning, and the DuckDB oracle can
reproduce the draw exactly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from creditlens.functions.scalar import md5_uniform
from creditlens.operators.ranking import global_row_number, uniform_bucket


def kfold_assign(df: DataFrame, id_col: str, k: int = 3, seed: int = 42, out: str = "fold") -> DataFrame:
    """Balanced random folds 1..k (sizes differ by at most one).

    Rows are put in a random order (md5 draw, id breaks ties) and dealt round
    robin, like ``sample(rep(1:k, length.out = n))``.
    """
    u = df.withColumn("_u", md5_uniform(id_col, seed))
    ranked = global_row_number(u, "_u", id_col, out="_rn")
    return ranked.withColumn(out, (F.col("_rn") % k + 1).cast("int")).drop("_u", "_rn")


def stratified_split(df: DataFrame, id_col: str, label: str, p: float = 0.8, seed: int = 42,
                     out: str = "split") -> DataFrame:
    """R2 + J5: per class, the ``ceil(p * n_class)`` rows first in random order are
    ``train``; the rest (the complement) are ``validation``.  Rows without a label
    are a class of their own."""
    u = df.withColumn("_u", md5_uniform(id_col, seed))
    ranked = global_row_number(u, "_u", id_col, partition=[label], out="_rn")
    sizes = df.groupBy(F.col(label).alias("_class")).agg(F.ceil(F.count(F.lit(1)) * p).alias("_keep"))
    j = ranked.join(sizes, F.col(label).eqNullSafe(F.col("_class")))
    return j.withColumn(out, F.when(F.col("_rn") < F.col("_keep"), F.lit("train"))
                        .otherwise(F.lit("validation"))).drop("_u", "_rn", "_keep", "_class")


def sample_n(df: DataFrame, id_col: str, n: int, seed: int = 42) -> DataFrame:
    """``sample_n(n)``: the n rows first in the seeded random order."""
    return first_n(df.withColumn("_u", md5_uniform(id_col, seed)), "_u", id_col, n)


def first_n(df: DataFrame, u: str, tie: str, n: int) -> DataFrame:
    """The n rows first in the order ``(u, tie)``, without ``u`` (a draw in [0, 1)).

    Rows are counted per bucket of the draw; buckets before the one that
    holds row n are kept whole, and only that one bucket is ranked, so no
    task merges n rows of every partition.
    """
    cols = [c for c in df.columns if c != u]
    df = df.withColumn("_bkt", uniform_bucket(F.col(u)))
    upto = Window.orderBy("_bkt")  # one row per bucket, at most BUCKETS
    run = df.groupBy("_bkt").agg(F.count(F.lit(1)).alias("_n")).select(
        "_bkt", (F.sum("_n").over(upto) - F.col("_n")).alias("_before"))
    edge = run.where(F.col("_before") < n).agg(F.max("_bkt").alias("_edge"), F.max("_before").alias("_before"))
    j = df.join(F.broadcast(edge), F.col("_bkt") <= F.col("_edge"))  # one row
    whole = j.where(F.col("_bkt") < F.col("_edge"))
    last = j.where(F.col("_bkt") == F.col("_edge")) \
        .withColumn("_rn", F.row_number().over(Window.partitionBy("_bkt").orderBy(u, tie))) \
        .where(F.col("_rn") + F.col("_before") <= n)
    return whole.select(*cols).unionByName(last.select(*cols))
