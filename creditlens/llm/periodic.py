"""Periodic runs of words by recompression.

Every run (maximal stretch with least period q and at least max(12, 2 q)
words) matches itself at distance q over m = max(12 - q, q) places or more.
So on a harmonic grid, for each q every (m - 2)-th place, some place of the
run has three equal words q further on; such places are the candidates (about
n log n grid places, compared as arrays).  The words of the texts that have
candidates are compressed into a run-length grammar (``grammar``), and
one more of the reversed words; their longest common extensions give each
candidate's exact start and end.  A stretch found with several periods keeps
the least, which is its smallest period (periods that fit twice have their
greatest common divisor as a period).

Whole texts, in groups of about ``GROUP_WORDS`` words (a longer text is a
group of its own), grid places in slices of ``SLICE``: memory grows with the
longest text only.  Words are numbered by a dictionary, so equal numbers are
equal words.

Defined cases: NULL or empty text: no words, no run, digests of the empty
string.  Repeated rows are worked on one by one; a NULL id has no planted
tail; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditlens.llm.grammar import Grammar
from creditlens.llm.textnum import mix

LEAST = 12            # words of the shortest run
GROUP_WORDS = 200_000
SLICE = 1 << 20
MAX_PERIODS = 1 << 16  # periods handled in one slice of the grid
KNOWN = 64             # longest runs by which a long text's later candidates are passed over (their run is known)

SCHEMA = ("doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, "
          "n_dropped long, runs_sha256 string, collapsed_sha256 string")


def grid(sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(text, place, period) arrays of the harmonic grid of texts of the given word counts."""
    halves = sizes // 2
    halves = np.where(sizes >= LEAST, halves, 0)
    text = low = 0
    while text < len(sizes):
        # as many whole texts (or periods of one text) as fit a slice of periods
        owner, period = [], []
        room = MAX_PERIODS
        while room > 0 and text < len(sizes):
            take = min(room, int(halves[text]) - low)
            owner.append(np.full(take, text))
            period.append(np.arange(low + 1, low + take + 1))
            room -= max(take, 1)
            low += take
            if low >= halves[text]:
                text, low = text + 1, 0
        owner, period = np.concatenate(owner), np.concatenate(period)
        step = np.maximum(LEAST - period, period) - 2
        places = np.maximum(sizes[owner] - period - 3, -1) // step + 1
        total = np.cumsum(places)
        done = 0
        while done < len(owner):
            base = total[done - 1] if done else 0
            end = max(done + 1, int(np.searchsorted(total, base + SLICE, side="right")))
            n = places[done:end]
            which = np.repeat(np.arange(done, end), n)
            rank = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
            yield owner[which], rank * step[which], period[which]
            done = end


class Stretches:
    """The grammars of some texts, one after the other with a symbol that occurs once after each."""

    def __init__(self, words: list[np.ndarray], held: np.ndarray):
        top = max(int(words[i].max()) for i in held) + 1
        text = np.concatenate([np.append(words[i], top + j) for j, i in enumerate(held)])
        sizes = np.array([len(words[i]) + 1 for i in held])
        self.held, self.begin, self.last = held, np.cumsum(sizes) - sizes, len(text) - 1
        self.forward, self.backward = Grammar(text), Grammar(text[::-1])
        self.known = np.empty((0, 4), np.int64)

    def runs(self, local: np.ndarray, place: np.ndarray, period: np.ndarray) -> np.ndarray:
        """(text, start, length, least period) of the stretches that candidates extend to, if long enough."""
        p, q = self.begin[local] + place, period
        right = self.forward.extensions(p, p + q)
        # reversed, the later place comes first
        left = self.backward.extensions(self.last - (p + q) + 1, self.last - p + 1)
        start, length = p - left, left + right + q
        good = np.flatnonzero(length >= np.maximum(LEAST, 2 * q))
        stretch = start[good] * (self.last + 2) + length[good]
        order = np.lexsort((q[good], stretch))  # of equal stretches the least period stays
        good = good[order][np.append(True, np.diff(stretch[order]) > 0)[:len(order)]]
        local, start = local[good], start[good]
        return np.stack([self.held[local], start - self.begin[local], length[good], q[good]], axis=1)

    def fresh_runs(self, place: np.ndarray, period: np.ndarray) -> np.ndarray:
        """``runs`` of the one text held, without candidates inside a known run whose period divides theirs."""
        if len(self.known):
            cover = np.full(self.last + 1, -1)
            for i in np.argsort(self.known[:, 2]).tolist():  # the longest last
                cover[self.known[i, 1]:self.known[i, 1] + self.known[i, 2]] = i
            run = self.known[cover[place]]
            inside = (cover[place] >= 0) & (period % run[:, 3] == 0) & (place + period < run[:, 1] + run[:, 2])
            place, period = place[~inside], period[~inside]
        new = self.runs(np.zeros(len(place), np.int64), place, period)
        both = np.concatenate([self.known, new])
        self.known = both[np.argsort(-both[:, 2], kind="stable")[:KNOWN]]  # only spares work
        return new


def find_runs(words: list[np.ndarray]) -> list[np.ndarray]:
    """Per text (array of word numbers): rows (start, length, period) sorted by start, then period."""
    sizes = np.array([len(w) for w in words], np.int64)
    if not len(sizes) or sizes.max() < LEAST:
        return [np.empty((0, 3), np.int64)] * len(words)
    flat = np.concatenate(words).astype(np.int64)
    offset = np.cumsum(sizes) - sizes
    three = np.zeros(len(flat) + 3, np.uint64)  # hash of a place's three words; filters only
    if len(flat) > 2:
        x = mix(flat.astype(np.uint64))
        three[:len(flat) - 2] = x[:-2] + x[1:-1] * np.uint64(3) + x[2:] * np.uint64(5)
    runs, long = [np.empty((0, 4), np.int64)], None
    for owner, place, period in grid(sizes):
        at = offset[owner] + place
        hit = np.flatnonzero(three[at] == three[at + period])
        owner, place, period = owner[hit], place[hit], period[hit]
        if not len(hit):
            continue
        held, local = np.unique(owner, return_inverse=True)
        if len(held) > 1:
            runs.append(Stretches(words, held).runs(local, place, period))
        else:  # a long text may fill many slices: its grammar and the runs known so far are kept
            if long is None or long.held[0] != held[0]:
                long = Stretches(words, held)
            runs.append(long.fresh_runs(place, period))
    runs = np.unique(np.concatenate(runs), axis=0)  # by text, start, length, period
    least = np.append(True, (runs[1:, :3] != runs[:-1, :3]).any(axis=1)) if len(runs) else np.empty(0, bool)
    runs = runs[least]
    runs = runs[np.lexsort((runs[:, 3], runs[:, 1], runs[:, 0]))]
    cut = np.searchsorted(runs[:, 0], np.arange(len(words) + 1))
    return [runs[cut[i]:cut[i + 1], 1:] for i in range(len(words))]


def dropped(runs: np.ndarray, n: int) -> np.ndarray:
    """Words that some run holds after its first period."""
    mark = np.zeros(n + 1, np.int64)
    np.add.at(mark, runs[:, 0] + runs[:, 2], 1)
    np.add.at(mark, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(mark[:-1]) > 0


def plant_tail(words: list[bytes], seed: int) -> list[bytes]:
    """The contract's change of every tenth text: its tail repeats a stretch of itself."""
    g, n = seed // 10, len(words)
    if seed % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    tail = words[a:a + p]
    return words[:a] + (tail * ((n - a) // p + 1))[:n - a]


def _rows(ids: list, texts: list[list[bytes]]) -> pd.DataFrame:
    names: dict = defaultdict(count().__next__)
    numbers = [np.fromiter(map(names.__getitem__, w), np.int64, len(w)) for w in texts]
    out = []
    for i, words, runs in zip(ids, texts, find_runs(numbers)):
        gone = dropped(runs, len(words)) if len(runs) else None
        kept = words if gone is None else [w for w, g in zip(words, gone.tolist()) if not g]
        listed = runs.tolist()
        out.append((i, len(words), [{"start": s, "length": n, "period": q} for s, n, q in listed],
                    len(words) - len(kept),
                    hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in listed).encode()).hexdigest(),
                    hashlib.sha256(b" ".join(kept)).hexdigest()))
    return pd.DataFrame(out, columns=["doc_id", "n_words", "runs", "n_dropped", "runs_sha256", "collapsed_sha256"]) \
        .astype({"doc_id": "Int64"})


def detect(docs: DataFrame, planted: bool = False) -> DataFrame:
    """Per row: its runs, the digest of their lines and of the words left after collapsing them.

    ``planted`` first changes every tenth text by its id (the contract's test input).
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            ids, texts, size = [], [], 0
            for i, seed, t in zip(b["doc_id"].tolist(), b["seed"].tolist(), b["text"].tolist()):
                words = t.encode("utf-8", "surrogatepass").split() if t else []
                if planted and seed >= 0:
                    words = plant_tail(words, int(seed))
                if size and size + len(words) > GROUP_WORDS:
                    yield _rows(ids, texts)
                    ids, texts, size = [], [], 0
                ids.append(None if pd.isna(i) else int(i))
                texts.append(words)
                size += len(words)
            if ids:
                yield _rows(ids, texts)

    ready = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        F.coalesce(F.crc32(F.col("doc_id").cast("string")), F.lit(-1)).alias("seed"), "text")
    return ready.mapInPandas(run, SCHEMA)


def digest(found: DataFrame) -> DataFrame:
    """The contract's columns: counts, the longest run (earliest, then least period, on ties), digests."""
    best = F.element_at(F.sort_array(F.transform("runs", lambda r: F.struct(
        (-r["length"]).alias("rank"), r["start"].alias("start"), r["period"].alias("period")))), 1)
    out = found.withColumn("n_runs", F.size("runs").cast("long")) \
        .withColumn("best", F.when(F.size("runs") > 0, best))
    return out.select("doc_id", "n_runs", F.col("best.start").alias("start"), (-F.col("best.rank")).alias("length"),
                      F.col("best.period").alias("period"),
                      F.expr("(1000 * -best.rank) div best.period").alias("exponent_milli"),
                      "runs_sha256", "collapsed_sha256")


# crc32 in SQL, per byte of an ASCII string; {s} is the string
CRC32_SQL = """xor(list_reduce([4294967295::BIGINT] || list_transform(range(1, length({s}) + 1), lambda i: ascii({s}[i])::BIGINT),
  lambda c, b: list_reduce([xor(c, b)] || range(8), lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)"""

ORACLE_SQL = f"""
WITH base AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w,
  {CRC32_SQL.format(s="(doc_id::VARCHAR)")} AS h FROM documents),
seeded AS (SELECT r, doc_id, w, h, h // 10 AS g, len(w) AS n FROM base),
shaped AS (SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN g % n END AS a FROM seeded),
tailed AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM shaped),
docs AS (SELECT r, doc_id, n, CASE WHEN a IS NULL THEN w
  ELSE list_transform(range(n), lambda i: w[CASE WHEN i < a THEN i ELSE a + (i - a) % p END + 1]) END AS w FROM tailed),
token AS (SELECT r, t.i, t.word FROM (SELECT r, unnest(list_transform(w,
  lambda x, i: {{'i': i - 1, 'word': x}})) AS t FROM docs)),
matched AS (SELECT x.r, y.i - x.i AS q, x.i FROM token x JOIN token y ON x.r = y.r AND x.word = y.word AND y.i > x.i
  JOIN docs d ON d.r = x.r WHERE 2 * (y.i - x.i) <= d.n),
island AS (SELECT r, q, i, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS k FROM matched),
stretch AS (SELECT r, min(i) AS s, count(*) + q AS len, q FROM island GROUP BY r, q, k
  HAVING count(*) + q >= greatest(12, 2 * q)),
run AS (SELECT r, s, len, min(q) AS q FROM stretch GROUP BY r, s, len),
gone AS (SELECT DISTINCT t.r, t.i FROM token t JOIN run x ON x.r = t.r AND t.i >= x.s + x.q AND t.i < x.s + x.len),
kept AS (SELECT t.r, string_agg(t.word, ' ' ORDER BY t.i) AS line FROM token t ANTI JOIN gone g ON g.r = t.r AND g.i = t.i
  GROUP BY t.r),
summed AS (SELECT r, count(*) AS n_runs, string_agg(s || ',' || len || ',' || q || chr(10), '' ORDER BY s, q) AS lines,
  arg_min({{'s': s, 'len': len, 'q': q}}, [-len, s, q]) AS best FROM run GROUP BY r)
SELECT d.doc_id, coalesce(m.n_runs, 0)::BIGINT AS n_runs, best.s::BIGINT AS start, best.len::BIGINT AS length,
  best.q::BIGINT AS period, (1000 * best.len // best.q)::BIGINT AS exponent_milli,
  sha256(coalesce(m.lines, '')) AS runs_sha256, sha256(coalesce(k.line, '')) AS collapsed_sha256
FROM docs d LEFT JOIN summed m ON m.r = d.r LEFT JOIN kept k ON k.r = d.r"""
