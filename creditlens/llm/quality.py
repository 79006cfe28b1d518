"""Quality rules: adaptive thresholds from mergeable quantile sketches (DataFrame functions only).

Every document gets integer metrics (per million words or characters; one
symbol or exclamation mark alone is no rate).  A log-linear histogram -- 32
buckets per power of two, relative width 1/32 -- is a mergeable quantile
sketch: counts by (language, source, metric, bucket) add up, are
pre-aggregated before the shuffle, and their number per group is bounded by
the bucket scheme.  Upper fences come from the sketch alone: with ``tail`` the
metric's upper quantile (METRICS), ``tail + (tail - q50)``.  A group's fence is
drawn towards its language's, and that towards the whole corpus's, by weights
docs : PRIOR, so small groups change smoothly.  A document above any fence of
its group is rejected.

Defined cases: a NULL text has no words; NULL language or source form groups
of their own; an empty table gives an empty result; repeated rows are judged
one by one; ``apply_rules`` keeps extra columns, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditlens.llm.common import table, words_column
from creditlens.operators.joins import checked_broadcast

MIN_WORDS = 50            # fixed by the contract
MAX_REPEAT_PERCENT = 50   # fixed by the contract

# metric -> percent of its upper quantile: the rest is the share of a group it may suspect at most
METRICS = {"m_symbols": 80, "m_bangs": 95, "m_upper": 99, "m_repeats": 99, "m_dup_lines": 99}
PRIOR = 500  # documents' worth of the wider group's fence
SCALE = 1_000_000


def repeated_words(words: str, n: str) -> str:
    """SQL for (sorted packed window hashes): a 63-bit value holding a window hash above the
    window's index; the index takes as many bits as the word count needs."""
    return (f"sort_array(transform(slice({words}, 1, greatest({n} - 2, 0)), (w, i) -> "
            f"(xxhash64(w, get({words}, i + 1), get({words}, i + 2)) & ~shiftleft(1L, 63) "
            f"& ~(shiftleft(1L, idx_bits) - 1L)) | cast(i as bigint)))")


def with_metrics(df: DataFrame, text: str = "text") -> DataFrame:
    """Add n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and the m_* metrics.

    Windows of three words are compared by a hash of at least 40 bits within
    one document (more for texts of fewer words); sorting it is n log n, so
    long texts stay cheap.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    base = df.withColumns({
        "_w": words_column(F.col(text)),
        "_l": F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")),
        "word_chars": F.length(F.regexp_replace(t, r"[\x20\x09-\x0D]+", "")).cast("long"),
        "n_symbols": (F.length(t) - F.length(F.translate(t, "#*$%&|<>", ""))).cast("long"),
        "_bangs": (F.length(t) - F.length(F.translate(t, "!", ""))).cast("long"),
        "_upper": (F.length(t) - F.length(F.translate(t, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))).cast("long"),
    })
    sized = base.withColumns({
        "n_words": F.size("_w").cast("long"),
        "n_lines": F.size("_l").cast("long"),
        "n_dup_lines": (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long"),
        "idx_bits": F.length(F.bin(F.size("_w").cast("long"))),
    })
    packed = sized.withColumn("_h", F.expr(repeated_words("_w", "cast(n_words as int)")))
    # indexes of windows equal to a neighbour in the sorted array
    hits = packed.withColumn("_p", F.expr(
        "sort_array(array_distinct(flatten(array_compact(zip_with("
        "slice(_h, 1, greatest(size(_h) - 1, 0)), slice(_h, 2, greatest(size(_h) - 1, 0)), (a, b) -> "
        "IF(shiftright(a, idx_bits) = shiftright(b, idx_bits), "
        "array(a & (shiftleft(1L, idx_bits) - 1L), b & (shiftleft(1L, idx_bits) - 1L)), null))))))"))
    counted = hits.withColumn("n_repeat_words", F.expr(
        "IF(size(_p) = 0, 0L, 3L + aggregate(zip_with(slice(_p, 1, greatest(size(_p) - 1, 0)), "
        "slice(_p, 2, greatest(size(_p) - 1, 0)), (a, b) -> least(3L, b - a)), 0L, (s, x) -> s + x))"))
    words = F.greatest("n_words", F.lit(1))
    return counted.withColumns({
        "m_symbols": F.expr(f"{SCALE}L * greatest(n_symbols - 1, 0) div greatest(n_words, 1)"),
        "m_bangs": F.expr(f"{SCALE}L * greatest(_bangs - 1, 0) div greatest(n_words, 1)"),
        "m_upper": F.expr(f"{SCALE}L * _upper div greatest(word_chars, 1)"),
        "m_repeats": F.expr(f"{SCALE}L * n_repeat_words div greatest(n_words, 1)"),
        "m_dup_lines": F.expr(f"{SCALE}L * n_dup_lines div greatest(n_lines, 1)"),
        "base_failed": (F.col("n_words") < MIN_WORDS)
        | (F.lit(100) * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * words),
    }).drop("_w", "_l", "_h", "_p", "_bangs", "_upper", "idx_bits", "n_lines")


def bucket_low(value: Column) -> Column:
    """Lower bound of a value's sketch bucket: the six leading bits are kept."""
    shift = F.greatest(F.length(F.bin(value)) - 6, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, shift), shift)


def sketches(metrics: DataFrame) -> DataFrame:
    """(lang, source, metric, value, n): the mergeable sketch of every group."""
    names = list(METRICS)
    pairs = ", ".join(f"'{m}', {m}" for m in names)
    return (metrics.filter("not base_failed")
            .select("lang", "source", F.expr(f"stack({len(names)}, {pairs}) as (metric, raw)"))
            .select("lang", "source", "metric", bucket_low(F.col("raw")).alias("value"))
            .groupBy("lang", "source", "metric", "value").agg(F.count(F.lit(1)).alias("n")))


def fences(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """Upper fence per metric of every group of ``keys``, with the group's document count."""
    merged = sketch.groupBy(*keys, "metric", "value").agg(F.sum("n").alias("n"))
    w = Window.partitionBy(*keys, "metric")
    ranked = merged.withColumns({
        "upto": F.sum("n").over(w.orderBy("value").rowsBetween(Window.unboundedPreceding, 0)),
        "total": F.sum("n").over(w)})
    percent = F.element_at(F.create_map(*[x for m, p in METRICS.items() for x in (F.lit(m), F.lit(p))]), F.col("metric"))
    q = ranked.withColumn("percent", percent).groupBy(*keys, "metric").agg(
        F.max("total").alias("docs"),
        F.min(F.expr("IF(2 * upto >= total, value, null)")).alias("q50"),
        F.min(F.expr("IF(100 * upto >= percent * total, value, null)")).alias("tail"))
    return q.select(*keys, "metric", "docs", (2 * F.col("tail") - F.col("q50")).alias("fence"))


def thresholds(sketch: DataFrame) -> DataFrame:
    """One row per (lang, source) with a fence column per metric, drawn towards the wider groups' fences."""
    own = fences(sketch, ["lang", "source"])
    lang = fences(sketch, ["lang"]).select(F.col("lang").alias("l"), F.col("metric").alias("lm"),
                                           F.col("docs").alias("ldocs"), F.col("fence").alias("lfence"))
    every = fences(sketch, []).select(F.col("metric").alias("am"), F.col("fence").alias("afence"))
    wider = f"(ldocs * lfence + {PRIOR} * afence) div (ldocs + {PRIOR})"
    chosen = (own.join(lang, own["lang"].eqNullSafe(F.col("l")) & (F.col("metric") == F.col("lm")))
              .join(every, F.col("metric") == F.col("am"))
              .select("lang", "source", "metric",
                      F.expr(f"(docs * fence + {PRIOR} * ({wider})) div (docs + {PRIOR})").alias("fence")))
    return chosen.groupBy("lang", "source").agg(
        *[F.max(F.when(F.col("metric") == m, F.col("fence"))).alias(f"f_{m}") for m in METRICS])


def verdict(metrics: DataFrame, limits: DataFrame) -> DataFrame:
    """``metrics`` and ``kept``: false if the base rules fail or a metric is above its group's fence."""
    # one row per group; counted before it is broadcast, so the documents are not shuffled
    t = checked_broadcast(limits.withColumnsRenamed({"lang": "_tl", "source": "_ts"}))
    above = None
    for name in METRICS:
        term = F.coalesce(F.col(name) > F.col(f"f_{name}"), F.lit(False))
        above = term if above is None else above | term
    joined = metrics.join(t, metrics["lang"].eqNullSafe(F.col("_tl")) & metrics["source"].eqNullSafe(F.col("_ts")),
                          "left")
    return joined.withColumn("kept", ~F.col("base_failed") & ~above).drop(
        "_tl", "_ts", *[f"f_{x}" for x in METRICS])


def judge(docs: DataFrame) -> DataFrame:
    """docs(.., text, lang, source) -> its columns without the text, the metrics and ``kept``.

    The narrow metric table is written once: it is read for the sketch and
    again for the verdict.
    """
    m = table(with_metrics(docs).drop("text"), "quality")
    return verdict(m, thresholds(sketches(m)))


def apply_rules(docs: DataFrame) -> DataFrame:
    """``docs`` without the rejected rows; all columns, whatever their names, pass through.

    One pass measures every text for the fences (a narrow table is written);
    the second pass measures again and filters, so no text is written twice
    or shuffled.
    """
    m = table(with_metrics(docs.select("text", "lang", "source")).drop("text"), "quality")
    limits = thresholds(sketches(m))
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")).select(
        "_row", F.col("_row.lang").alias("lang"), F.col("_row.source").alias("source"))
    judged = verdict(with_metrics(packed, "_row.text"), limits)
    # a plain filter would be pushed down and write the measuring expressions out once per use;
    # exploding an empty array drops a row after they are evaluated once
    return judged.withColumn("_keep", F.explode(F.expr("IF(kept, array(1), cast(array() as array<int>))"))) \
        .select("_row.*")


ORACLE_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS t FROM documents),
w AS (
  SELECT *, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d),
m AS (
  SELECT rid, doc_id, lang, source, w, len(w) AS n_words, len(l) AS n_lines,
    len(l) - len(list_distinct(l)) AS n_dup_lines,
    length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
    length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    length(t) - length(regexp_replace(t, '!', '', 'g')) AS bangs,
    length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) AS upper_n FROM w),
g AS (SELECT rid, i, w[i] || chr(10) || w[i+1] || chr(10) || w[i+2] AS k
  FROM (SELECT rid, w, unnest(range(1, n_words - 1)) AS i FROM m)),
rep AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, k) AS c FROM g) WHERE c > 1),
cov AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest([i, i+1, i+2]) AS p FROM rep) GROUP BY rid),
f AS (SELECT m.rid, doc_id, lang, source, n_words, word_chars, n_symbols, n_dup_lines,
    coalesce(cov.n, 0) AS n_repeat_words,
    1000000 * greatest(n_symbols - 1, 0) // greatest(n_words, 1) AS m_symbols,
    1000000 * greatest(bangs - 1, 0) // greatest(n_words, 1) AS m_bangs,
    1000000 * upper_n // greatest(word_chars, 1) AS m_upper,
    1000000 * coalesce(cov.n, 0) // greatest(n_words, 1) AS m_repeats,
    1000000 * n_dup_lines // greatest(n_lines, 1) AS m_dup_lines,
    n_words < 50 OR 100 * coalesce(cov.n, 0) > 50 * n_words AS base_failed
  FROM m LEFT JOIN cov ON m.rid = cov.rid),
v AS (
  SELECT lang, source, metric, (raw >> sh) << sh AS value FROM (
    SELECT *, greatest(length(bin(raw)) - 6, 0) AS sh FROM (
      SELECT lang, source, unnest(['m_symbols','m_bangs','m_upper','m_repeats','m_dup_lines']) AS metric,
             unnest([m_symbols, m_bangs, m_upper, m_repeats, m_dup_lines]) AS raw
      FROM f WHERE NOT base_failed))),
tail(metric, percent) AS (VALUES ('m_symbols', 80), ('m_bangs', 95), ('m_upper', 99), ('m_repeats', 99), ('m_dup_lines', 99)),
own AS (SELECT lang, source, metric, count(*) AS docs, list_sort(list(value)) AS vs FROM v GROUP BY lang, source, metric),
byl AS (SELECT lang, metric, count(*) AS docs, list_sort(list(value)) AS vs FROM v GROUP BY lang, metric),
alls AS (SELECT metric, count(*) AS docs, list_sort(list(value)) AS vs FROM v GROUP BY metric),
fence AS (SELECT own.lang, own.source, own.metric, (own.docs
    * (2 * own.vs[(percent * own.docs + 99) // 100] - own.vs[(own.docs + 1) // 2]) + 500 * ((byl.docs
    * (2 * byl.vs[(percent * byl.docs + 99) // 100] - byl.vs[(byl.docs + 1) // 2]) + 500
    * (2 * alls.vs[(percent * alls.docs + 99) // 100] - alls.vs[(alls.docs + 1) // 2])) // (byl.docs + 500)))
    // (own.docs + 500) AS fence
  FROM own JOIN byl ON own.lang IS NOT DISTINCT FROM byl.lang AND own.metric = byl.metric
  JOIN alls ON own.metric = alls.metric JOIN tail ON own.metric = tail.metric),
above AS (SELECT DISTINCT f.rid FROM f JOIN fence
  ON f.lang IS NOT DISTINCT FROM fence.lang AND f.source IS NOT DISTINCT FROM fence.source
  AND CASE metric WHEN 'm_symbols' THEN m_symbols WHEN 'm_bangs' THEN m_bangs WHEN 'm_upper' THEN m_upper
      WHEN 'm_repeats' THEN m_repeats ELSE m_dup_lines END > fence)
"""

ORACLE_QUERY = ORACLE_SQL + """
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
  n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
  NOT base_failed AND above.rid IS NULL AS kept
FROM f LEFT JOIN above ON f.rid = above.rid
"""
