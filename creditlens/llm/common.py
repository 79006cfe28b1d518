"""Shared helpers: table readers, the word pattern, shared-folder tables, connected components."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditlens.session import checkpoint_dir, ship  # noqa: F401  (operators import ship from here)

# A word is a maximal run of code points outside ASCII white space (fixed by the contract).
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder, deleted when the session's JVM ends."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hpath)
    return path


def table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: cuts the lineage
    (a lost executor re-reads the files) and keeps column pruning."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def words_column(text) -> "F.Column":
    """Array of the words of a text (NULL text: no words)."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def components(nodes: DataFrame, edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components by alternating large-star and small-star steps.

    ``nodes(id long)``, ``edges(a long, b long)`` in any direction -> ``(id, comp)``
    with the smallest id reachable.  Every step is a min-aggregation (partial
    before the shuffle, so a hub is pre-aggregated) and a join back (AQE splits
    a skewed hub).  Each round is written to the shared folder; the loop ends
    when no edge changes and raises if it does not within ``max_rounds``
    (the number of rounds is logarithmic in practice).
    """
    e = table(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
              .filter("u <> v").distinct(), "cc")
    if e.isEmpty():
        return nodes.select("id", F.col("id").alias("comp"))
    stamp = None
    for _ in range(max_rounds):
        # large star: link every larger neighbour of u to the smallest of u's neighbourhood
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        big = e.select(F.col("v").alias("u"), F.col("u").alias("w")).join(low, "u") \
            .select(F.col("w").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        # small star: link u's smaller neighbours and u itself to the smallest of them
        low2 = big.groupBy("u").agg(F.min("v").alias("m"))
        e = big.join(low2, "u").select(
            F.explode(F.array(F.struct(F.col("u").alias("u"), F.col("m").alias("v")),
                              F.struct(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v"))))
            .alias("s")).select("s.u", "s.v").filter("u <> v").distinct()
        e = table(e, "cc")
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == stamp:
            break
        stamp = tuple(now)
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = e.groupBy(F.col("u").alias("id")).agg(F.min("v").alias("comp"))
    return nodes.select("id").join(roots, "id", "left").select("id", F.coalesce("comp", "id").alias("comp"))


FILTER_CELLS = 1 << 18  # rows of the broadcast id filter at most


def thinned(docs: DataFrame, ids: DataFrame, how: str = "left_semi", key: str = "id") -> DataFrame:
    """Rows of ``docs`` whose hashed ``key`` is (``left_anti``: is not) among the hashed ids of ``ids``.

    The broadcast side has at most FILTER_CELLS rows whatever the corpus; a
    join on the ids themselves follows where it matters.  NULL keys are never
    among them.
    """
    def cell():
        return F.when(F.col(key).isNull(), -1).otherwise(F.pmod(F.xxhash64(F.col(key).cast("long")),
                                                                F.lit(FILTER_CELLS)))

    cells = ids.filter(F.col(key).isNotNull()).select(cell().alias("_cell")).distinct()
    return docs.withColumn("_cell", cell()).join(F.broadcast(cells), "_cell", how).drop("_cell")


def without(docs: DataFrame, ids: DataFrame, key: str = "doc_id") -> DataFrame:
    """``docs`` without the rows whose ``key`` is in ``ids``; only rows that may be hit are shuffled."""
    free = thinned(docs, ids, "left_anti", key)
    hit = thinned(docs, ids, "left_semi", key)
    return free.unionByName(hit.join(ids.select(key).distinct(), key, "left_anti").select(*docs.columns))
