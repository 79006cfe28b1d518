"""Token counts: an exact length histogram answers every context limit.

Documents are encoded with a public byte-level BPE vocabulary (its path is a
parameter) inside Arrow batches; only lengths leave the task.  Documents are
aggregated by encoded length, and suffix sums over the histogram give, for
every length L that occurs: documents and tokens of documents with at least
L tokens, the tokens left when every document is cut at L, and the share of
documents no longer than L (so any quantile).

The suffix sums run by blocks of 1,024 lengths: a window over the block
totals and one inside each block.  No document and no list of lengths goes
to the driver.

Defined cases: NULL and empty texts have length 0; special-token strings in
a text are ordinary text; white space of any length is counted; repeated rows count each time; an empty table
gives an empty histogram; extra columns are ignored.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from creditlens.llm.common import table

# Split pattern that belongs to the rank files (fixed value, from their README).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
BLOCK = 1024
# Runs of white space (the pattern's class) too long for the pattern's look-ahead, which recurses
LONG_SPACE = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{10000,}")

_encoders: dict = {}


def encoder(rank_bytes: bytes):
    """tiktoken encoding from the bytes of a rank file (one per worker)."""
    import tiktoken

    key = hash(rank_bytes)
    if key not in _encoders:
        ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in rank_bytes.splitlines() if x)}
        _encoders[key] = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _encoders[key]


def length(enc, text: str) -> int:
    """Number of tokens of a text.

    The pattern takes a run of white space as one piece, but for its last
    place if a word follows; long runs are cut out there and merged directly.
    """
    n = at = 0
    for m in LONG_SPACE.finditer(text):
        end = m.end() - (m.end() < len(text))
        n += len(enc.encode_ordinary(text[at:m.start()])) + len(enc._encode_single_piece(text[m.start():end].encode()))
        at = end
    return n + len(enc.encode_ordinary(text[at:]))


def count_tokens(docs: DataFrame, text: str = "text", ranks: str = RANKS) -> DataFrame:
    """Add ``n_tokens`` to every row; other columns but the text pass through.

    The vocabulary file (under 1 MB) is read on the driver and broadcast.
    """
    spark = docs.sparkSession
    with open(ranks, "rb") as f:
        vocabulary = spark.sparkContext.broadcast(f.read())
    rest = [c for c in docs.columns if c != text]
    schema = StructType([docs.schema[c] for c in rest]).add("n_tokens", "long")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoder(vocabulary.value)
        for b in batches:
            out = b[rest].copy()
            out["n_tokens"] = [length(enc, t) if t else 0 for t in b[text]]
            yield out

    return docs.select(*rest, text).mapInPandas(run, schema)


def histogram(lengths: DataFrame) -> DataFrame:
    """(n_tokens) rows -> one row per length with suffix sums."""
    # written once: the texts are encoded once although the histogram is read twice
    hist = table(lengths.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n_docs")), "token-histogram")
    hist = hist.withColumns({"block": F.shiftright("n_tokens", 10), "tok": F.col("n_tokens") * F.col("n_docs")})
    blocks = hist.groupBy("block").agg(F.sum("n_docs").alias("bd"), F.sum("tok").alias("bt"))
    after = Window.orderBy(F.col("block").desc()).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    blocks = blocks.select(F.col("block").alias("_b"), F.coalesce(F.sum("bd").over(after), F.lit(0)).alias("ad"),
                           F.coalesce(F.sum("bt").over(after), F.lit(0)).alias("at"),
                           F.sum("bd").over(every).alias("all_docs"), F.sum("bt").over(every).alias("all_tokens"))
    inside = Window.partitionBy("block").orderBy(F.col("n_tokens").desc()) \
        .rowsBetween(Window.unboundedPreceding, 0)
    j = hist.join(blocks, F.col("block") == F.col("_b"))
    return j.withColumns({
        "docs_at_least": F.sum("n_docs").over(inside) + F.col("ad"),
        "tokens_at_least": F.sum("tok").over(inside) + F.col("at"),
    }).select(
        "n_tokens", "n_docs", "docs_at_least", "tokens_at_least",
        # documents shorter than L whole, the others L tokens each
        (F.col("all_tokens") - F.col("tokens_at_least") + F.col("n_tokens") * F.col("docs_at_least"))
        .alias("tokens_cut"),
        (F.col("all_docs") - F.col("docs_at_least") + F.col("n_docs")).alias("docs_up_to"),
        "all_docs", "all_tokens")


def at_limits(hist: DataFrame, limits: list[int]) -> DataFrame:
    """(context_limit, docs_over, tokens_kept) for given context limits, from the histogram alone."""
    out = None
    for limit in limits:
        row = hist.agg(
            F.coalesce(F.sum(F.expr(f"IF(n_tokens > {int(limit)}, n_docs, 0)")), F.lit(0)).alias("docs_over"),
            F.coalesce(F.sum(F.expr(f"least(n_tokens, {int(limit)}) * n_docs")), F.lit(0)).alias("tokens_kept"),
        ).select(F.lit(int(limit)).alias("context_limit"), "docs_over", "tokens_kept")
        out = row if out is None else out.unionByName(row)
    return out


def quantile(hist: DataFrame, q: float) -> DataFrame:
    """Smallest length with at least a share ``q`` of the documents no longer."""
    return hist.filter(F.col("docs_up_to") >= F.ceil(F.lit(q) * F.col("all_docs"))) \
        .agg(F.min("n_tokens").alias("n_tokens"))
