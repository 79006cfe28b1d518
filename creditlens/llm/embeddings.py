"""Embedding near-duplicates by randomised-rotation binary codes.

1. Every valid vector is normalised and turned by fixed random rotations;
   the signs of ``BITS`` turned coordinates are its binary code.  With it the
   correction factor f = <code, vector> is stored: for any unit vector q,
   <code, q> / f is an unbiased estimate of the cosine, and its error is
   bounded by eps * sqrt((1 - f^2) / f^2 / (BITS - 1)) * sqrt(1 - cos^2).
2. Candidates share ``k`` code bits of one of ``T`` tables.  ``k`` follows the
   size of the label (bucket sizes stay the same), and ``T`` is set so that a
   pair exactly at the threshold is missed with probability ``MISS`` at most,
   for every size; closer pairs are missed less.
3. In a bucket the estimate and its bound decide which pairs are computed
   again exactly, in double precision from the vectors.  A pair counts in
   the first table it shares, so no pair list is kept: a task emits link
   counts per vector and a spanning forest of its links.

A bucket larger than ``BLOCK`` is dealt as pairs of blocks over many tasks.
Equal vectors of one label are one weighted vector from the start, so
thousands of copies cost nothing.

Defined cases: a NULL label or vector, a zero vector, NULL or non-finite
components: linked with nothing; vectors of different length are not
compared; an empty table gives no rows; rows repeating an id and its vector
are one vector (each row is returned).
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditlens.llm.common import components, table
from creditlens.operators.joins import checked_broadcast

THRESHOLD = 0.93   # fixed by the contract
BITS = 512
MISS = 1e-4        # of a pair exactly at the threshold
BUCKET = 16        # rows of unrelated vectors per bucket aimed at
BLOCK = 2048
EPS = 4.0          # half width of the confidence bound, in standard errors
SEED = 20240607


def key_bits(n: int) -> int:
    """Code bits per table for a label of ``n`` vectors."""
    return max(4, math.ceil(math.log2(max(n, 1) / BUCKET)) if n > BUCKET else 4)


def missed(k: int, tables: int, threshold: float = THRESHOLD) -> float:
    """Chance that a pair exactly at the threshold shares no table.

    Tables draw their bits from the same BITS, so a pair with many differing
    bits misses many of them together: the mean over the number of differing
    bits, not a power of the mean.
    """
    p = math.acos(threshold) / math.pi
    total = 0.0
    for h in range(BITS + 1):
        weight = math.exp(math.lgamma(BITS + 1) - math.lgamma(h + 1) - math.lgamma(BITS - h + 1)
                          + h * math.log(p) + (BITS - h) * math.log1p(-p))
        agree = 0.0 if BITS - h < k else math.exp(
            math.lgamma(BITS - h + 1) - math.lgamma(BITS - h - k + 1)
            - math.lgamma(BITS + 1) + math.lgamma(BITS - k + 1))
        total += weight * (0.0 if agree >= 1.0 else math.exp(tables * math.log1p(-agree)))
    return total


@functools.lru_cache(maxsize=None)
def table_count(k: int, threshold: float = THRESHOLD, miss: float = MISS) -> int:
    """Least number of tables that brings ``missed`` down to ``miss``."""
    low, high = 0, 1
    while missed(k, high, threshold) > miss:
        low, high = high, 2 * high
    while high - low > 1:
        mid = (low + high) // 2
        low, high = (mid, high) if missed(k, mid, threshold) > miss else (low, mid)
    return high


def rotations(dim: int) -> np.ndarray:
    """(BITS, dim) rows of stacked random orthonormal matrices, the same on every task."""
    rng = np.random.default_rng([SEED, dim])
    blocks = [np.linalg.qr(rng.standard_normal((dim, dim)))[0] for _ in range(-(-BITS // dim))]
    return np.concatenate(blocks)[:BITS]


def table_bits(k: int, tables: int) -> np.ndarray:
    """(tables, k) code positions; each table draws without repetition."""
    rng = np.random.default_rng([SEED, k, 1])
    return np.stack([rng.permutation(BITS)[:k] for _ in range(tables)])


def keys_of(signs: np.ndarray, k: int, tables: int) -> np.ndarray:
    """(rows, tables) bucket numbers from sign bits."""
    at = table_bits(k, tables)
    weight = (1 << np.arange(k, dtype=np.int64))
    return signs[:, at].astype(np.int64) @ weight


def valid_vectors(df: DataFrame, vec: str, label: str) -> DataFrame:
    ok = (F.col(label).isNotNull() & F.col(vec).isNotNull()
          & F.coalesce(~F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))), F.lit(False))
          & F.coalesce(F.exists(vec, lambda x: x != 0), F.lit(False)))
    return df.filter(ok)


def bucket_rows(reps: DataFrame) -> DataFrame:
    """reps(rep, weight, grp, n_grp, v array) -> a row per vector and table with the code and the vector."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        turned: dict[int, np.ndarray] = {}
        for b in batches:
            dims = b["v"].map(len).to_numpy()
            ks = np.array([key_bits(int(n)) for n in b["n_grp"]])
            for dim, k in set(zip(dims.tolist(), ks.tolist())):
                part = b[(dims == dim) & (ks == k)]
                if dim not in turned:
                    turned[dim] = rotations(dim)
                x = np.stack(part["v"].to_numpy()).astype(np.float64)
                x /= np.abs(x).max(axis=1, keepdims=True)  # no overflow in the norm
                x /= np.linalg.norm(x, axis=1, keepdims=True)
                z = x @ turned[dim].T
                signs = z > 0
                factor = np.abs(z).sum(axis=1) / math.sqrt(BITS) / math.sqrt(BITS / dim)
                code = np.packbits(signs, axis=1)
                tables = table_count(k)
                keys = keys_of(signs, k, tables)
                rows = len(part)
                step = max(1, 8192 // tables)
                for at in range(0, rows, step):
                    s = slice(at, min(rows, at + step))
                    m = s.stop - s.start
                    yield pd.DataFrame({
                        "grp": np.repeat(part["grp"].to_numpy()[s], tables),
                        "k": np.int32(k),
                        "t": np.tile(np.arange(tables, dtype=np.int32), m),
                        "bucket": keys[s].ravel(),
                        "rep": np.repeat(part["rep"].to_numpy()[s], tables),
                        "weight": np.repeat(part["weight"].to_numpy()[s], tables),
                        "factor": np.repeat(factor[s].astype(np.float32), tables),
                        "code": np.repeat(np.array([c.tobytes() for c in code[s]], dtype=object), tables),
                        "v": np.repeat(np.array([np.asarray(a, np.float64).tobytes() for a in part["v"].to_numpy()[s]],
                                                dtype=object), tables)})

    return reps.select("rep", "weight", "grp", "n_grp", "v").mapInPandas(
        run, "grp long, k int, t int, bucket long, rep long, weight long, factor float, code binary, v binary")


def deal_blocks(rows: DataFrame) -> DataFrame:
    """Add the block pair (bi, bj) and the row's block: one cell for usual buckets, many for hot ones."""
    key = ["grp", "t", "bucket"]
    hot = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("m")).filter(F.col("m") > BLOCK) \
        .select(*key, F.ceil(F.col("m") / BLOCK).cast("int").alias("nb"))
    j = rows.join(checked_broadcast(hot), key, "left").withColumn("nb", F.coalesce("nb", F.lit(1)))
    own = j.withColumn("own", F.pmod(F.xxhash64("rep"), F.col("nb")).cast("int"))
    return own.withColumn("other", F.explode(F.expr("sequence(0, nb - 1)"))) \
        .withColumns({"bi": F.least("own", "other"), "bj": F.greatest("own", "other")}) \
        .drop("nb", "other")


def forest(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the links (a, b)."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (p := parent.setdefault(x, x)) != x:
            parent[x] = x = parent[p]
        return x

    out = []
    for x, y in zip(a.tolist(), b.tolist()):
        rx, ry = root(x), root(y)
        if rx != ry:
            parent[max(rx, ry)] = min(rx, ry)
            out.append((x, y))
    return out


def link_cells(cells: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(a, b, n): b NULL and n the weight linked to a; or a spanning edge (a, b)."""
    def process(g: pd.DataFrame) -> pd.DataFrame:
        """Links of whole cells; rows sorted by cell."""
        cell = g["cell"].to_numpy()
        size = len(cell)
        last = np.searchsorted(cell, cell, side="right")
        vectors, codes = g["v"].to_numpy(), g["code"].to_numpy()
        signs = np.unpackbits(np.frombuffer(b"".join(codes), np.uint8).reshape(size, -1), axis=1)[:, :BITS]
        rep, weight, factor = g["rep"].to_numpy(), g["weight"].to_numpy(), g["factor"].to_numpy().astype(np.float64)
        own, mixed = g["own"].to_numpy(), (g["bi"] != g["bj"]).to_numpy()
        k_of, t_of = g["k"].to_numpy(), g["t"].to_numpy()
        dims = np.array([len(v) >> 3 for v in vectors])
        found_a, found_b = [], []
        for dim in set(dims.tolist()):
            rows = np.flatnonzero(dims == dim)
            x = np.frombuffer(b"".join(vectors[rows]), np.float64).reshape(len(rows), dim)
            unit = x / np.abs(x).max(axis=1, keepdims=True)
            unit = unit / np.linalg.norm(unit, axis=1, keepdims=True)
            # the code's vector in the original space, divided by its factor: its product with a unit vector
            # is the estimate
            rebuilt = (signs[rows].astype(np.float32) * 2 - 1) @ rotations_of(dim).astype(np.float32)
            rebuilt *= (1 / (math.sqrt(BITS) * math.sqrt(BITS / dim)) / factor[rows])[:, None].astype(np.float32)
            query = unit.astype(np.float32)
            f2 = np.minimum(factor[rows] ** 2, 1.0)
            bound = EPS * np.sqrt((1 - f2) / f2 / (BITS - 1)) * math.sqrt(1 - threshold ** 2) + 1e-3
            pos = np.full(size, -1)
            pos[rows] = np.arange(len(rows))
            alive = np.flatnonzero((np.arange(size) + 1 < last) & (pos >= 0))
            shift = 1
            while len(alive):
                for at in range(0, len(alive), 50_000):
                    i = alive[at:at + 50_000]
                    j = i + shift
                    use = (pos[j] >= 0) & ~(mixed[i] & (own[i] == own[j]))
                    i, j = i[use], j[use]
                    if not len(i):
                        continue
                    estimate = np.einsum("ij,ij->i", rebuilt[pos[i]], query[pos[j]])
                    near = estimate + bound[pos[i]] >= threshold
                    i, j = i[near], j[near]
                    exact = np.einsum("ij,ij->i", unit[pos[i]], unit[pos[j]]) >= threshold
                    found_a.append(i[exact])
                    found_b.append(j[exact])
                shift += 1
                alive = alive[alive + shift < last[alive]]
        i = np.concatenate(found_a) if found_a else np.empty(0, np.int64)
        j = np.concatenate(found_b) if found_b else np.empty(0, np.int64)
        first = np.zeros(len(i), bool)
        for k in set(k_of[i].tolist()):
            at_bits = table_bits(k, table_count(k))
            mine = np.flatnonzero(k_of[i] == k)
            for at in range(0, len(mine), 20_000):
                m = mine[at:at + 20_000]
                differ = signs[i[m]] != signs[j[m]]
                agree = ~differ[:, at_bits].any(axis=2)
                first[m] = agree.argmax(axis=1) == t_of[i[m]]
        i, j = i[first], j[first]
        both = np.concatenate([rep[i], rep[j]])
        add = np.concatenate([weight[j], weight[i]])
        ids, where = np.unique(both, return_inverse=True)
        totals = np.bincount(where, weights=add, minlength=len(ids)).astype(np.int64)
        edges = forest(rep[i], rep[j])
        return pd.DataFrame({
            "a": np.concatenate([ids, np.array([e[0] for e in edges], np.int64)]),
            "b": pd.array([None] * len(ids) + [e[1] for e in edges], dtype="Int64"),
            "n": np.concatenate([totals, np.zeros(len(edges), np.int64)])})

    turned: dict[int, np.ndarray] = {}

    def rotations_of(dim: int) -> np.ndarray:
        if dim not in turned:
            turned[dim] = rotations(dim)
        return turned[dim]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        n = 0
        names = ["grp", "t", "bucket", "bi", "bj"]
        for b in batches:
            held.append(b)
            n += len(b)
            ends = [b[c].iloc[-1] for c in names]
            if n < 8192 or all(held[0][c].iloc[0] == e for c, e in zip(names, ends)):
                continue
            g = pd.concat(held, ignore_index=True)
            open_ = np.logical_and.reduce([(g[c] == e).to_numpy() for c, e in zip(names, ends)])
            done = g[~open_].reset_index(drop=True)
            held = [g[open_]]
            n = int(open_.sum())
            yield process(numbered(done, names))
        if n:
            yield process(numbered(pd.concat(held, ignore_index=True), names))

    def numbered(g: pd.DataFrame, names: list[str]) -> pd.DataFrame:
        change = np.zeros(len(g), bool)
        for c in names:
            v = g[c].to_numpy()
            change[1:] |= v[1:] != v[:-1]
        return g.assign(cell=np.cumsum(change))

    key = ["grp", "t", "bucket", "bi", "bj"]
    return cells.repartition(*key).sortWithinPartitions(*key).mapInPandas(run, "a long, b long, n long")


def near_duplicates(df: DataFrame, vec_id: str = "vec_id", vec: str = "embedding", label: str = "label",
                    threshold: float = THRESHOLD) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``df``."""
    rows = df.select(F.col(vec_id).alias("vec_id"), F.col(vec).alias("v"), F.col(label).alias("label"))
    keyed = valid_vectors(rows, "v", "label").withColumn(
        "copy", F.struct(F.xxhash64("label", "v"), F.xxhash64("v", "label", F.lit("second"))))
    member = table(keyed.select("vec_id", "copy").distinct(), "emb-members")
    reps = keyed.groupBy("copy").agg(
        F.min("vec_id").alias("rep"), F.first("v").alias("v"),
        F.first(F.xxhash64("label", F.size("v"))).alias("grp"))
    weights = member.groupBy("copy").agg(F.count(F.lit(1)).alias("weight"))
    reps = table(reps.join(weights, "copy"), "emb-reps")
    sizes = checked_broadcast(reps.groupBy("grp").agg(F.count(F.lit(1)).alias("n_grp")))
    links = table(link_cells(deal_blocks(bucket_rows(reps.join(sizes, "grp"))), threshold), "emb-links")
    counts = links.filter("b is null").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("linked"))
    comp = components(reps.select(F.col("rep").alias("id")), links.filter("b is not null").select("a", "b"))
    per_rep = reps.select("copy", "rep", "weight").join(counts, "rep", "left") \
        .join(comp.withColumnRenamed("id", "rep"), "rep")
    found = member.join(per_rep, "copy").groupBy("vec_id").agg(
        F.sum(F.coalesce("linked", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.min("comp").alias("comp"))
    return rows.select("vec_id").join(found, "vec_id", "left").select(
        F.col("vec_id").alias(vec_id), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("comp", "vec_id").alias("component_id"),
        (F.coalesce("comp", "vec_id") == F.col("vec_id")).alias("kept"))


ORACLE_SQL = r"""
WITH RECURSIVE e AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM e a JOIN e b ON a.label = b.label AND a.vec_id <> b.vec_id
  AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.93),
r(id, root) AS (SELECT vec_id, vec_id FROM e
  UNION SELECT l.b, r.root FROM r JOIN l ON l.a = r.id WHERE r.root < l.b),
c AS (SELECT id, min(root) AS root FROM r GROUP BY id),
n AS (SELECT a, count(DISTINCT b) AS n FROM l GROUP BY a)
SELECT vec_id, coalesce(n.n, 0)::BIGINT AS n_links, coalesce(c.root, vec_id) AS component_id,
  coalesce(c.root, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN n ON n.a = vec_id LEFT JOIN c ON c.id = vec_id
"""
