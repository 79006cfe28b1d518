"""Quality classifier by positive-unlabelled learning.

Features come from whole texts in Arrow batches: hashed byte trigrams
(square roots of their shares) and a few shares -- distinct words, distinct
word pairs, distinct lines, capitals, digits, marks, word length, log word
count.  A linear model minimises the non-negative unbiased risk

    pi * R_p(+1) + max(0, R_u(-1) - pi * R_p(-1))

with the logistic loss: trusted positives are rows labelled 1, unlabelled
rows are web text without its label, ``pi`` is the class prior.  The prior
is estimated from the training labels (share of 1, one pseudo-count each).
Where the bracket is negative its gradient is stepped back (full batch, Adam).

The fit uses bounded samples, drawn by a hash of the id so that reruns
agree: at most about ``MAX_POSITIVE`` positives and ``MAX_UNLABELLED``
unlabelled rows (documented parameters), collected as feature vectors.
Scoring is one pass over all documents with the model broadcast (about
``BINS`` numbers).

Only rows with crc32(id) mod 5 <> 0 are learned from; id, language, source
and labels are never features.  Defined cases: NULL text is empty and gets
the score of an empty text; NULL ids count as the empty string; repeated
rows are scored one by one; without any labelled 1 the score is the prior;
an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditlens.llm.textnum import mix, word_bounds, word_hashes

BINS = 1024
SHARES = 9
MAX_POSITIVE = 3000
MAX_UNLABELLED = 8000
STEPS, RATE, DECAY = 400, 0.05, 1e-4
CUT = 0.3  # fixed by the contract


def remainder(doc_id: Column) -> Column:
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(5))


def features(text: str | None) -> np.ndarray:
    """BINS trigram features and SHARES shares of a whole text."""
    out = np.zeros(BINS + SHARES, np.float32)
    raw = np.frombuffer((text or "").encode("utf-8", "replace"), np.uint8)
    n = len(raw)
    if n >= 3:
        b = raw.astype(np.uint32)
        key = ((b[:-2] << 16) | (b[1:-1] << 8) | b[2:]) * np.uint32(2654435761)
        out[:BINS] = np.sqrt(np.bincount(key >> np.uint32(22), minlength=BINS) / (n - 2))
    words = word_hashes(raw)
    if len(words):
        start, end = word_bounds(raw)
        lines = [x for x in (text or "").split("\n") if x]
        pairs = mix(words[:-1] * np.uint64(3) + words[1:])
        out[BINS:] = (
            len(np.unique(words)) / len(words),
            len(np.unique(pairs)) / max(len(pairs), 1),
            len(set(lines)) / max(len(lines), 1),
            np.count_nonzero((raw >= 65) & (raw <= 90)) / n,
            np.count_nonzero((raw >= 48) & (raw <= 57)) / n,
            np.count_nonzero((raw >= 33) & (raw <= 47) | (raw == 124)) / n,
            np.count_nonzero(raw > 127) / n,
            min((end - start).mean() / 10, 3.0),
            np.log1p(len(words)) / 10)
    return out


assert BINS == 1 << 10  # the trigram hash keeps 10 bits


def sample(df: DataFrame, doc_id: str, text: str, bound: int, salt: str) -> np.ndarray:
    """Feature rows of about ``bound`` rows at most, drawn by a hash of the id (all if there are fewer)."""
    n = df.count()
    if n > bound:
        u = F.pmod(F.xxhash64(F.lit(salt), F.col(doc_id)), F.lit(1 << 30))
        df = df.filter(u < int((1 << 30) * bound / n))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"f": [features(t).tobytes() for t in b[text]]})

    rows = df.select(text).mapInPandas(run, "f binary").collect()
    return np.stack([np.frombuffer(r[0], np.float32) for r in rows]) if rows \
        else np.empty((0, BINS + SHARES), np.float32)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * z))


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> dict:
    """Minimise the non-negative unbiased risk; returns weights on standardised features."""
    pool = unlabelled if len(unlabelled) else positive
    centre = pool.mean(axis=0)
    # trigrams share one scale, so that rare bins do not blow up
    scale = np.ones(BINS + SHARES, np.float32)
    scale[:BINS] = max(float(pool[:, :BINS].std()), 1e-6) * 3
    scale[BINS:] = np.maximum(pool[:, BINS:].std(axis=0), 1e-3)
    p, u = (positive - centre) / scale, (unlabelled - centre) / scale
    w = np.zeros(p.shape[1], np.float32)
    b = np.float32(np.log(prior / (1 - prior)))
    m = np.zeros(len(w) + 1)
    v = np.zeros(len(w) + 1)
    for step in range(1, STEPS + 1):
        zp, zu = p @ w + b, u @ w + b
        # logistic loss: l(z, +1) = log(1 + e^-z), l(z, -1) = log(1 + e^z)
        minus = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        gu, gp = sigmoid(zu) / len(u), sigmoid(zp) / len(p)
        grad_minus = np.append(gu @ u - prior * (gp @ p), gu.sum() - prior * gp.sum())
        if minus >= 0:
            dp = (sigmoid(zp) - 1) / len(p)
            grad = prior * np.append(dp @ p, dp.sum()) + grad_minus
        else:
            grad = -grad_minus
        grad[:-1] += DECAY * w
        m = 0.9 * m + 0.1 * grad
        v = 0.999 * v + 0.001 * grad ** 2
        move = RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
        w = (w - move[:-1]).astype(np.float32)
        b = np.float32(b - move[-1])
    return {"w": (w / scale).astype(np.float32), "b": float(b - centre @ (w / scale)), "prior": prior}


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
          label: str = "quality") -> dict:
    """Fit on rows outside the held-out fold; ``labels``(doc_id, label) may have extra columns."""
    free = docs.select(doc_id, text).filter(remainder(F.col(doc_id)) != 0)
    marked = labels.select(doc_id, F.col(label).alias("_y")).filter(
        (remainder(F.col(doc_id)) != 0) & F.col("_y").isNotNull())
    counts = marked.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum((F.col("_y") == 1).cast("long")), F.lit(0))
                        .alias("n1")).first()
    prior = (counts.n1 + 1) / (counts.n + 2)
    trusted = marked.filter("_y = 1").select(doc_id).distinct()
    n1 = trusted.count()
    if n1 > MAX_POSITIVE:  # the draw is repeated by sample() on what is left
        u = F.pmod(F.xxhash64(F.lit("trusted"), F.col(doc_id)), F.lit(1 << 30))
        trusted = trusted.filter(u < int((1 << 30) * MAX_POSITIVE / n1))
    # the trusted ids are a bounded sample by now, so the texts are not shuffled
    positive = sample(free.join(F.broadcast(trusted), doc_id, "left_semi"), doc_id, text, 2 * MAX_POSITIVE, "p")
    unlabelled = sample(free, doc_id, text, MAX_UNLABELLED, "u")
    if not len(positive) or not len(unlabelled):
        return {"w": np.zeros(BINS + SHARES, np.float32), "b": float(np.log(prior / (1 - prior))), "prior": prior}
    return fit(positive, unlabelled, prior)


def score(docs: DataFrame, model: dict, text: str = "text", out: str = "score") -> DataFrame:
    """Other columns of ``docs`` and ``out`` in [0, 1]."""
    shared = docs.sparkSession.sparkContext.broadcast((model["w"], model["b"]))
    rest = [c for c in docs.columns if c != text]
    schema = docs.select(*rest).schema.add(out, "double")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        w, b = shared.value
        for batch in batches:
            part = batch[rest].copy()
            z = np.array([float(features(t) @ w) + b for t in batch[text]], np.float64)
            part[out] = sigmoid(z)
            yield part

    return docs.select(*rest, text).mapInPandas(run, schema)
