"""SentencePiece encoding and decoding: Aho-Corasick over the pieces drives a one-pass Viterbi.

The best segmentation of a text maximises the sum of its pieces' scores.  An
automaton over all pieces reads the text once; at every position its output
links name the pieces ending there, and each relaxes the best score of that
position.  A character that is no piece costs ``min score - 10`` and is
written as its UTF-8 byte pieces (the unknown id where a model has none).
Of equally good paths the one with the longer last piece wins.

No piece holds a space mark after another character (checked when the model
is read), so the search never has to cross a place where a space mark
follows something else, nor a character that occurs in no longer piece:
chunks between such places are searched alone and remembered, at most
``CACHE`` of them per worker (beyond it they are searched each time).

Whole texts are encoded.  Spaces become U+2581 and one is put in front, as
the model asks; a U+2581 in a text decodes to a space.  Defined cases: NULL
and empty texts have no pieces and decode to the empty string; repeated
rows are encoded one by one; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import ArrayType, IntegerType, StructType

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
UNKNOWN_PENALTY = 10.0
CACHE = 300_000
GROUP = 64  # documents whose ids are held at once inside a batch


class Encoder:
    """Automaton, scores and chunk cache of one model; one per worker process."""

    def __init__(self, model: bytes):
        import ahocorasick
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = sp.vocab_size()
        self.pieces = [sp.id_to_piece(i) for i in range(n)]
        self.byte_value = {i: int(p[3:5], 16) for i, p in enumerate(self.pieces) if sp.is_byte(i)}
        self.byte_id = {v: i for i, v in self.byte_value.items()}
        self.unknown = sp.unk_id()
        self.silent = {i for i in range(n) if sp.is_control(i) or sp.is_unknown(i)}
        normal = [i for i in range(n)
                  if i not in self.silent and i not in self.byte_value and not sp.is_unused(i)]
        self.auto = ahocorasick.Automaton()
        lowest = 0.0
        for i in normal:
            p, s = self.pieces[i], sp.get_score(i)
            lowest = min(lowest, s)
            if MARK in p.lstrip(MARK):
                raise ValueError(f"piece {p!r} holds a space mark after another character")
            self.auto.add_word(p, (i, len(p), s))
        self.auto.make_automaton()
        self.unknown_score = lowest - UNKNOWN_PENALTY
        self.single = {self.pieces[i] for i in normal if len(self.pieces[i]) == 1}
        inside = {c for i in normal if len(self.pieces[i]) > 1 for c in self.pieces[i]}
        alone = "".join(re.escape(chr(c)) for c in range(128) if chr(c) not in inside and chr(c) != " ")
        self.chunks = re.compile(f"[{alone}]|{MARK}+[^{MARK}{alone}]*|[^{MARK}{alone}]+" if alone
                                 else f"{MARK}+[^{MARK}]*|[^{MARK}]+")
        self.cache: dict[str, bytes] = {}

    def viterbi(self, chunk: str) -> list[int]:
        n = len(chunk)
        best = [0.0] + [-np.inf] * n
        back: list = [None] * (n + 1)
        settled = 0  # positions up to here are final
        single, unknown_score = self.single, self.unknown_score

        def settle(to: int) -> None:
            nonlocal settled
            while settled < to:
                i = settled
                if chunk[i] not in single and best[i] + unknown_score > best[i + 1]:
                    best[i + 1], back[i + 1] = best[i] + unknown_score, (-1, 1)
                settled += 1

        for end, (piece, length, score) in self.auto.iter(chunk):
            if settled < end:
                settle(end)
            s = best[end + 1 - length] + score
            if s > best[end + 1]:
                best[end + 1], back[end + 1] = s, (piece, length)
        settle(n)
        out: list[int] = []
        while n:
            piece, length = back[n]
            if piece >= 0:
                out.append(piece)
            else:
                raw = [self.byte_id.get(b) for b in chunk[n - 1].encode("utf-8", "replace")]
                out += [self.unknown] if None in raw else raw[::-1]
            n -= length
        return out[::-1]

    def encode(self, text: str) -> np.ndarray:
        if not text:
            return np.empty(0, np.int32)
        cache, parts = self.cache, []
        for chunk in self.chunks.findall(MARK + text.replace(" ", MARK)):
            ids = cache.get(chunk)
            if ids is None:
                ids = array("i", self.viterbi(chunk)).tobytes()
                if len(cache) < CACHE:
                    cache[chunk] = ids
            parts.append(ids)
        return np.frombuffer(b"".join(parts), np.int32)

    def score(self, ids) -> float:
        """Sum of the scores of pieces and unknown characters (byte runs count as one character each)."""
        total = 0.0
        raw = bytearray()
        for i in ids:
            if i in self.byte_value:
                raw.append(self.byte_value[i])
            else:
                total += self.auto.get(self.pieces[i])[2]
        return total + self.unknown_score * len(raw.decode("utf-8", "replace"))

    def decode(self, ids) -> str:
        out: list[str] = []
        raw = bytearray()
        for i in ids:
            value = self.byte_value.get(i)
            if value is not None:
                raw.append(value)
                continue
            if raw:
                out.append(raw.decode("utf-8", "replace"))
                raw.clear()
            if i == self.unknown:
                out.append(" ⁇ ")  # fixed value: what the public library writes for an unknown piece
            elif i not in self.silent:
                out.append(self.pieces[i])
        if raw:
            out.append(raw.decode("utf-8", "replace"))
        text = "".join(out).replace(MARK, " ")
        return text[1:] if text.startswith(" ") else text


_encoders: dict[int, Encoder] = {}


def worker_encoder(model: bytes) -> Encoder:
    key = hash(model)
    if key not in _encoders:
        _encoders[key] = Encoder(model)
    return _encoders[key]


def broadcast_model(spark: SparkSession, path: str = MODEL) -> Broadcast:
    """The model file (about half a megabyte) is read on the driver and broadcast."""
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def encode(docs: DataFrame, text: str = "text", out: str = "piece_ids", model: str = MODEL) -> DataFrame:
    """Add ``out`` array<int>: the piece ids of the whole text."""
    shared = broadcast_model(docs.sparkSession, model)
    schema = StructType(list(docs.schema.fields)).add(out, ArrayType(IntegerType()))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = worker_encoder(shared.value)
        for b in batches:
            for at in range(0, len(b), GROUP):
                part = b.iloc[at:at + GROUP].copy()
                part[out] = [enc.encode(t) for t in part[text]]
                yield part

    return docs.mapInPandas(run, schema)


def decode(df: DataFrame, ids: str = "piece_ids", out: str = "decoded", model: str = MODEL) -> DataFrame:
    """Add ``out``: the text of the piece ids."""
    shared = broadcast_model(df.sparkSession, model)
    schema = StructType(list(df.schema.fields)).add(out, "string")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = worker_encoder(shared.value)
        for b in batches:
            for at in range(0, len(b), GROUP):
                part = b.iloc[at:at + GROUP].copy()
                part[out] = [enc.decode(x.tolist()) if x is not None else "" for x in part[ids]]
                yield part

    return df.mapInPandas(run, schema)


def round_trip(docs: DataFrame, text: str = "text", model: str = MODEL) -> DataFrame:
    """Other columns of ``docs`` and n_pieces, n_byte_pieces, ids_sha256 (little-endian
    32-bit ids), decoded_sha256 and ``exact`` (the decoded text is the text).

    Encodes and decodes every whole text in one pass over the batches, so no
    id array crosses between the JVM and Python.
    """
    shared = broadcast_model(docs.sparkSession, model)
    rest = [c for c in docs.columns if c != text]
    schema = StructType([docs.schema[c] for c in rest])
    for name, kind in (("n_pieces", "long"), ("n_byte_pieces", "long"), ("ids_sha256", "string"),
                       ("decoded_sha256", "string"), ("exact", "boolean")):
        schema = schema.add(name, kind)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = worker_encoder(shared.value)
        is_byte = np.zeros(len(enc.pieces), bool)
        is_byte[list(enc.byte_value)] = True
        for b in batches:
            rows = []
            for t in b[text]:
                ids = enc.encode(t)
                back = enc.decode(ids.tolist())
                rows.append((len(ids), int(is_byte[ids].sum()), hashlib.sha256(ids.tobytes()).hexdigest(),
                             hashlib.sha256(back.encode()).hexdigest(),
                             back == (t or "").replace(MARK, " ")))
            out = b[rest].copy()
            for name, values in zip([f.name for f in schema.fields[len(rest):]], zip(*rows) if rows else [()] * 5):
                out[name] = list(values)
            yield out

    return docs.select(*rest, text).mapInPandas(run, schema)
