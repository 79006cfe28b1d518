"""Mixing sources to target weights by hash-threshold histograms (DataFrame functions only).

1. Size of a document = its words.  A narrow table (id, source, size, draw)
   is written once; ``draw`` is a 30-bit md5 number of the id, so reruns agree.
2. Targets: ``share`` of all words is split over the sources by weight; a
   target stops at ``max_copies`` times its source, and the excess goes to
   the others by weight until none is above (the water level is found from
   sorted prefix sums over one row per source).
3. A target of T words over a source of S words is floor(T / S) whole passes
   and a rest of R words.  The rest is chosen by a threshold on ``draw``:
   words are summed by (source, top 10 bits), the bucket where the running
   sum passes R is found, and only that boundary bucket is summed again by
   the next 10 bits, and once more.  The thresholds are nested, so a larger
   budget takes a superset.  Documents below the threshold get one more
   pass; nothing is sorted.  The last 1/2^30 bucket is included when that
   brings the source closer to R.

No group is gathered: sums are pre-aggregated by bucket, a window sees at
most 1,024 buckets of a source, and the per-source table is broadcast only
after a count.

Defined cases: NULL text has size 0 and takes nothing; NULL source is a
source, the last; a NULL id draws like an empty one; rows with one id move
together; an empty table gives an empty result; sources without words have
target 0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from creditlens.llm.common import WORD, table
from creditlens.operators.joins import checked_broadcast

WEIGHTS = (5, 2, 1)       # fixed by the contract, repeating over the ordered sources
SHARE_PERCENT = 150       # fixed by the contract
MAX_COPIES = 2            # fixed by the contract
LEVEL_BITS, LEVELS = 10, 3


def sizes(docs: DataFrame, id_col: str = "doc_id", keep: list[str] | None = None) -> DataFrame:
    """(id, source, size, draw): draw in [0, 2^30)."""
    draw = F.conv(F.substring(F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 1, 8), 16, 10)
    return docs.select(
        *(keep or []), F.col(id_col), "source",
        F.coalesce(F.regexp_count(F.col("text"), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.shiftright(draw.cast("long"), 2).alias("draw"))


def targets(sized: DataFrame) -> DataFrame:
    """(source, source_size, target): one row per source."""
    src = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    n = len(WEIGHTS)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in WEIGHTS]),
                          ((F.row_number().over(by_name) - 1) % n + 1).cast("int"))
    ranked = src.withColumn("w", weight).withColumn("cap", MAX_COPIES * F.col("source_size").cast("double"))
    everything = Window.partitionBy()
    by_ratio = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    level = ranked.withColumns({
        "budget": F.sum("source_size").over(everything) * (SHARE_PERCENT / 100.0),
        "capped": F.coalesce(F.sum("cap").over(before), F.lit(0.0)),
        "open_w": F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0.0)),
    }).withColumn("lam", (F.col("budget") - F.col("capped")) / F.col("open_w"))
    # the first prefix whose next source stays under its cap has the largest such level
    fits = level.withColumn("level", F.max(F.when(F.col("lam") <= F.col("cap") / F.col("w"), F.col("lam")))
                            .over(everything))
    return fits.select("source", "source_size", F.coalesce(
        F.least(F.col("cap"), F.col("level") * F.col("w")), F.col("cap")).alias("target"))


def nested_thresholds(sized: DataFrame, goals: DataFrame) -> DataFrame:
    """(source, source_size, target, passes, below): documents with draw < below get one more pass."""
    state = goals.withColumns({
        "passes": F.expr("IF(source_size = 0, 0L, cast(floor(target / source_size) as bigint))"),
    }).withColumns({
        "rest": F.col("target") - F.col("passes") * F.col("source_size"),
        "base": F.lit(0).cast("long"),
    })
    for level in range(1, LEVELS + 1):
        shift = LEVEL_BITS * (LEVELS - level)
        s = checked_broadcast(state.select(F.col("source").alias("_s"), "base"))
        inside = sized.join(s, sized["source"].eqNullSafe(F.col("_s"))).filter(
            F.shiftright("draw", shift + LEVEL_BITS) == F.shiftright("base", shift + LEVEL_BITS))
        hist = inside.groupBy("source", F.shiftright("draw", shift).alias("bucket")) \
            .agg(F.sum("size").alias("words"))
        w = Window.partitionBy("source").orderBy("bucket")
        run = hist.withColumn("upto", F.sum("words").over(w)).withColumnRenamed("source", "_s")
        state = state.join(run, state["source"].eqNullSafe(F.col("_s")), "left") \
            .groupBy("source", "source_size", "target", "passes", "rest", "base").agg(
                F.min(F.expr("IF(upto > rest, bucket, null)")).alias("edge"),
                F.coalesce(F.max(F.expr("IF(upto <= rest, upto, 0)")), F.lit(0)).alias("under"),
                F.min(F.expr("IF(upto > rest, upto, null)")).alias("over"))
        # no bucket passes the rest: every document of this range is under the threshold
        top = F.shiftleft(F.shiftright("base", shift + LEVEL_BITS) + 1, shift + LEVEL_BITS)
        last = level == LEVELS
        edge = F.coalesce(F.shiftleft("edge", shift), top)
        if last:
            edge = F.when(F.col("edge").isNotNull() & (F.col("over") - F.col("rest") < F.col("rest") - F.col("under")),
                          F.col("edge") + 1).otherwise(edge)
        state = state.select("source", "source_size", "target", "passes",
                             (F.col("rest") - F.col("under")).alias("rest"), edge.alias("base"))
        state = table(state, "mix")
    return state.select("source", "source_size", "target", "passes", F.col("base").alias("below"))


def copies_column():
    return F.expr("IF(size = 0, 0L, least(passes + IF(draw < below, 1L, 0L), cast(%d as bigint)))" % MAX_COPIES)


def mix(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """docs(id, text, source) -> (id, source, size, source_size, target, copies, taken) per row."""
    sized = table(sizes(docs, id_col), "mix")
    t = nested_thresholds(sized, targets(sized))
    t = checked_broadcast(t.withColumnRenamed("source", "_s"))
    j = sized.join(t, sized["source"].eqNullSafe(F.col("_s")), "left")
    copies = copies_column()
    return j.select(id_col, "source", "size", "source_size", "target", copies.alias("copies"),
                    (copies * F.col("size")).alias("taken"))


def apply_mix(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``docs`` as mixed: every row 0, 1 or 2 times; all columns pass through."""
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")).select(
        "_row", F.col(f"_row.{id_col}").alias("id"), F.col("_row.source").alias("source"))
    sized = table(sizes(docs.select(F.col(id_col).alias("id"), "source", "text"), "id"), "mix")
    t = checked_broadcast(nested_thresholds(sized, targets(sized)).withColumnRenamed("source", "_s"))
    again = sizes(packed.withColumn("text", F.col("_row.text")), "id", keep=["_row"])
    return again.join(t, again["source"].eqNullSafe(F.col("_s"))).withColumn("copies", copies_column()) \
        .filter("copies > 0").withColumn("_n", F.explode(F.expr("sequence(1L, copies)"))).select("_row.*")


ORACLE_CTE = r"""
z AS (SELECT doc_id, source, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+').len() AS size,
  ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT >> 2 AS draw FROM mix_docs),
s0 AS (SELECT source, sum(size)::BIGINT AS source_size, 2.0::DOUBLE * sum(size) AS cap,
  [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source NULLS LAST)) - 1) % 3 + 1]::DOUBLE AS w FROM z GROUP BY source),
s1 AS (SELECT *, ((sum(source_size) OVER ()) * 1.5::DOUBLE
    - coalesce(sum(cap) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
  / ((sum(w) OVER ()) - coalesce(sum(w) OVER (ORDER BY cap / w, source NULLS LAST
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS lam FROM s0),
s2 AS (SELECT source, source_size, least(cap, (max(lam) FILTER (lam <= cap / w) OVER ()) * w) AS target FROM s1),
s3 AS (SELECT *, CASE WHEN source_size = 0 THEN 0 ELSE floor(target / source_size)::BIGINT END AS passes FROM s2),
h AS (SELECT s3.source, draw, target - passes * source_size AS rest,
    sum(sum(size)) OVER (PARTITION BY s3.source ORDER BY draw) AS upto, sum(size) AS here
  FROM z JOIN s3 ON z.source IS NOT DISTINCT FROM s3.source GROUP BY s3.source, draw, target, passes, source_size),
edge AS (SELECT source, min(draw) FILTER (upto > rest) AS e, min(upto) FILTER (upto > rest) AS o,
  coalesce(max(upto) FILTER (upto <= rest), 0) AS u, any_value(rest) AS rest FROM h GROUP BY source),
mixed AS (SELECT doc_id, z.source, size, source_size, target,
  CASE WHEN size = 0 THEN 0 ELSE least(2, passes + (CASE WHEN e IS NULL OR draw < e
    OR (draw = e AND o - rest < rest - u) THEN 1 ELSE 0 END)) END AS copies
  FROM z JOIN s3 ON z.source IS NOT DISTINCT FROM s3.source JOIN edge ON z.source IS NOT DISTINCT FROM edge.source)
"""

ORACLE_SQL = "WITH mix_docs AS (SELECT * FROM documents)," + ORACLE_CTE + """
SELECT doc_id, size::BIGINT AS size, source_size, round(target, 6) AS target, (copies * size)::BIGINT AS taken FROM mixed
"""
