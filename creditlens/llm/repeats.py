"""Removal of repeated byte strings by deep-shallow suffix sorting.

A byte goes when a ``LENGTH``-byte string covering it also starts earlier
(smaller document id, or the same document at a smaller start).  Three passes
over the texts, each a Spark job over whole documents:

1. **Anchors.**  Every window of ``LENGTH`` bytes names the least hash among
   its ``SEED``-byte strings; equal windows name the same one at the same
   place.  Neighbouring windows mostly share it, so a text gives about one
   row per 35 bytes: (hash, document, first window, anchor, windows).
   Streaming the rows in hash order keeps those whose hash occurs again.
2. **Suffixes.**  Only windows of such rows can be repeated.  Their bytes are
   cut from the text.  Inside a task equal cuttings are pre-aggregated: all
   but the earliest are covered at once and need no shuffle.  The others meet
   by anchor hash, and the suffixes (windows) with the same anchor and offset
   are ordered deep-shallow: suffixes equal to the first of their group need
   no order; the others go through a multikey sort on eight bytes at a time
   to ``SHALLOW`` bytes, and blind tries order the groups that still agree.
   Equal neighbours are repeats; all but the earliest are marked.
3. **Cutting.**  Marked runs meet their texts again.

An anchor that occurs more than ``HOT`` times is dealt by whole windows
instead (one key per window and its bytes).  A task sends a window once, the
earliest; later ones are covered at once, so of a line common to a third of
the documents a key gets one row per task.

Defined cases: NULL and empty texts have no bytes; texts under ``LENGTH``
bytes lose nothing; an id names one text (rows repeating it are the same
document, each is returned); rows with a NULL id are returned unchanged; an
empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditlens.llm.common import table, thinned
from creditlens.llm.textnum import mix, powers, _BASE, _INV
from creditlens.operators.joins import checked_broadcast

LENGTH = 100       # fixed by the contract
SEED = 32
SPAN = LENGTH - SEED + 1   # seeds in a window
SHALLOW = 64
HOT = 20_000
CHUNK = 1 << 20    # bytes of text hashed at once
WINDOWS = 400_000  # windows ordered at once


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours (prefix and suffix minima of blocks)."""
    n = len(x) - width + 1
    pad = -len(x) % width
    full = np.concatenate([x, np.full(pad, np.iinfo(np.uint64).max, np.uint64)]).reshape(-1, width)
    prefix = np.minimum.accumulate(full, axis=1).ravel()
    suffix = np.minimum.accumulate(full[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(suffix[:n], prefix[width - 1:width - 1 + n])


def anchors(buf: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs of windows with one anchor in texts laid end to end.

    ``ends`` are the texts' end offsets.  Returns (hash, text number, first
    window start in the text, anchor minus first start, windows - 1).
    """
    n = len(buf)
    none = tuple(np.empty(0, np.int64) for _ in range(5))
    if n < LENGTH:
        return none
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * powers(_BASE, n), out=total[1:])
    seeds = mix((total[SEED:] - total[:-SEED]) * powers(_INV, n)[:n - SEED + 1])
    packed = (seeds & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(seeds), dtype=np.uint64)
    at = (sliding_min(packed, SPAN) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    starts = np.concatenate([[0], ends[:-1]])
    sizes = ends - starts
    count = np.maximum(sizes - LENGTH + 1, 0)
    text = np.repeat(np.arange(len(ends)), count)
    if not len(text):
        return none
    local = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    start = starts[text] + local
    q = at[start]
    new = np.ones(len(q), bool)
    new[1:] = (q[1:] != q[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    length = np.diff(np.append(first, len(q)))
    return ((seeds[q[first]] >> np.uint64(16)).astype(np.int64), text[first], local[first],
            q[first] - start[first], length - 1)


def grouped(ids, texts) -> Iterator[tuple[list, list[bytes]]]:
    """Texts as bytes in groups of about CHUNK bytes."""
    keys, raw, n = [], [], 0
    for key, t in zip(ids, texts):
        b = t.encode("utf-8", "replace") if t else b""
        keys.append(key)
        raw.append(b)
        n += len(b)
        if n >= CHUNK:
            yield keys, raw
            keys, raw, n = [], [], 0
    if keys:
        yield keys, raw


def anchor_rows(docs: DataFrame) -> DataFrame:
    """docs(id, text) -> (hash, id, at): ``at`` packs first start, anchor offset (7 bits), windows - 1 (7 bits)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for keys, raw in grouped(b["id"], b["text"]):
                buf = np.frombuffer(b"".join(raw), np.uint8)
                h, text, start, offset, more = anchors(buf, np.cumsum([len(x) for x in raw]))
                if len(h):
                    yield pd.DataFrame({"hash": h, "id": np.asarray(keys, np.int64)[text],
                                        "at": (start << 14) | (offset << 7) | more})

    return docs.mapInPandas(run, "hash long, id long, at long")


def repeated(rows: DataFrame) -> DataFrame:
    """Rows whose hash occurs again, and (hash, NULL, NULL) for hashes beyond HOT; streamed in hash order."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, seen = None, 0  # rows of the open hash so far
        held = None           # its first row while it is alone
        for b in batches:
            h, i, a = (b[c].to_numpy() for c in ("hash", "id", "at"))
            start = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
            size = np.diff(np.append(start, len(h)))
            keep = np.repeat(size > 1, size)
            head = seen if last is not None and h[0] == last else 0
            out = []
            if head:
                keep[:size[0]] = True
                if held is not None:
                    out.append(held)
            held = None
            total = size.copy()
            total[0] += head
            if size[-1] == 1 and total[-1] == 1:
                held = (h[-1:], i[-1:], a[-1:])
            hot = h[start][(total > HOT) & (total - size <= HOT)]
            out.append((h[keep], i[keep], a[keep]))
            hh, ii, aa = (np.concatenate(x) for x in zip(*out))
            none = np.full(len(hot), -1)
            yield pd.DataFrame({"kind": np.repeat(np.array([0, 1], np.int8), [len(hh), len(hot)]),
                                "hash": np.concatenate([hh, hot]), "id": np.concatenate([ii, none]),
                                "at": np.concatenate([aa, none])})
            last, seen = h[-1], int(total[-1])

    return rows.repartition("hash").sortWithinPartitions("hash").mapInPandas(
        run, "kind byte, hash long, id long, at long")


def cuttings(docs: DataFrame, found: DataFrame) -> DataFrame:
    """(key, id, start, offset, bytes) of the suffixes to order, or bytes NULL and [start, offset) already covered."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        first: dict[bytes, tuple[int, int]] = {}
        for b in batches:
            rows = []
            for key, t, places in zip(b["id"], b["text"], b["places"]):
                raw = t.encode("utf-8", "replace")
                for p in places:
                    h, at, hot = p["hash"], p["at"], p["hot"]
                    start, offset, more = at >> 14, (at >> 7) & 127, at & 127
                    piece = raw[start:start + more + LENGTH]
                    if len(piece) < more + LENGTH:
                        continue  # another text under the same id
                    name = hashlib.blake2b(piece, digest_size=16, key=b"%d" % offset).digest()
                    before = first.setdefault(name, (key, start))
                    if before < (key, start):
                        rows.append((h, key, start, start + len(piece), None))
                        continue
                    first[name] = min(before, (key, start))
                    if not hot:
                        rows.append((h, key, start, offset, piece))
                        continue
                    # a window seen before in this task is covered at once: a window's key gets a row per task
                    ready = None
                    for i in range(more + 1):
                        w = piece[i:i + LENGTH]
                        window = hashlib.blake2b(w, digest_size=16, person=b"window").digest()
                        if first.setdefault(window, (key, start + i)) < (key, start + i):
                            if ready is not None and start + i <= ready[3]:
                                ready = (h, key, ready[2], start + i + LENGTH, None)
                                continue
                            if ready is not None:
                                rows.append(ready)
                            ready = (h, key, start + i, start + i + LENGTH, None)
                            continue
                        rows.append((int.from_bytes(window[:8], "little", signed=True), key, start + i, 0, w))
                    if ready is not None:
                        rows.append(ready)
                if len(rows) >= 20_000:
                    yield pd.DataFrame(rows, columns=["key", "id", "start", "offset", "bytes"])
                    rows = []
            if rows:
                yield pd.DataFrame(rows, columns=["key", "id", "start", "offset", "bytes"])

    hot = checked_broadcast(found.filter("kind = 1").select("hash", F.lit(True).alias("hot")))
    places = found.filter("kind = 0").select("hash", "id", "at").join(hot, "hash", "left") \
        .groupBy("id").agg(F.sort_array(F.collect_list(F.struct(
            F.col("at"), F.col("hash"), F.coalesce("hot", F.lit(False)).alias("hot")))).alias("places"))
    texts = thinned(docs, found.filter("kind = 0").select("id"))
    return texts.join(places, "id").sortWithinPartitions("id").select("id", "text", "places").mapInPandas(
        run, "key long, id long, start long, offset long, bytes binary")


class BlindTrie:
    """Orders strings by their branching bytes; each insertion compares with one stored string."""

    def __init__(self, data: bytes, length: int = LENGTH):
        self.data, self.length = data, length
        self.root: list | None = None  # [depth, {byte: node}, a leaf below] or a leaf: list of members

    def add(self, at: int, member: int) -> None:
        if self.root is None:
            self.root = ("leaf", at, [member])
            return
        data, path, node = self.data, [], self.root
        while node[0] != "leaf":
            path.append(node)
            child = node[1].get(data[at + node[0]])
            if child is None:
                child = next(iter(node[1].values()))
            node = child
        a, b = data[at:at + self.length], data[node[1]:node[1] + self.length]
        if a == b:
            node[2].append(member)
            return
        x = int.from_bytes(a, "big") ^ int.from_bytes(b, "big")
        depth = self.length - 1 - (x.bit_length() - 1) // 8  # first differing byte
        parent = None
        node = self.root
        while node[0] != "leaf" and node[0] < depth:
            parent = node
            node = node[1][a[node[0]]]
        leaf = ("leaf", at, [member])
        if node[0] != "leaf" and node[0] == depth:
            node[1][a[depth]] = leaf
            return
        branch = (depth, {a[depth]: leaf, b[depth]: node})
        if parent is None:
            self.root = branch
        else:
            parent[1][a[parent[0]]] = branch

    def groups(self) -> Iterator[list[int]]:
        """Members of equal strings, in string order."""
        stack = [self.root] if self.root else []
        while stack:
            node = stack.pop()
            if node[0] == "leaf":
                yield node[2]
            else:
                stack += [node[1][c] for c in sorted(node[1], reverse=True)]


def later_windows(data: bytes, at: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Flags of the strings data[at:at + LENGTH] that equal an earlier one of their group.

    ``group`` is ascending; within a group the order given is the order of appearance.
    """
    n = len(at)
    flag = np.zeros(n, bool)
    if n < 2:
        return flag
    raw = np.frombuffer(data + b"\0" * 8, np.uint8)
    words = np.zeros(len(data) + 1, np.uint64)
    for i in range(8):
        words = (words << np.uint64(8)) | raw[i:i + len(words)]
    steps = [*range(0, LENGTH - 8, 8), LENGTH - 8]

    def heads(g: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        new = np.ones(len(g), bool)
        new[1:] = g[1:] != g[:-1]
        start = np.flatnonzero(new)
        return start, np.diff(np.append(start, len(g)))

    def split_equal(idx: np.ndarray, g: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Flag members equal to their group's first; return the others (groups of one drop out)."""
        start, size = heads(g)
        big = np.repeat(size > 1, size)
        first = np.repeat(idx[start], size)[big]
        idx, g = idx[big], g[big]
        same = np.ones(len(idx), bool)
        for s in steps:
            same &= words[at[idx] + s] == words[at[first] + s]
        flag[idx[same & (idx != first)]] = True
        return idx[~same], g[~same]

    idx, g = split_equal(np.arange(n), group)
    # shallow: multikey order on eight bytes at a time, groups of one drop out
    for s in range(0, SHALLOW, 8):
        if not len(idx):
            return flag
        key = words[at[idx] + s]
        order = np.lexsort((key, g))
        idx, g, key = idx[order], g[order], key[order]
        new = np.ones(len(idx), bool)
        new[1:] = (g[1:] != g[:-1]) | (key[1:] != key[:-1])
        g = np.cumsum(new)
        size = np.bincount(g)[g]
        idx, g = idx[size > 1], g[size > 1]
    # deep: what agrees so far is equal or goes through a blind trie
    idx, g = split_equal(idx, g)
    start, size = heads(g) if len(g) else (g, g)
    for a, m in zip(start.tolist(), size.tolist()):
        if m > 1:
            trie = BlindTrie(data)
            for i in idx[a:a + m].tolist():
                trie.add(int(at[i]), i)
            for members in trie.groups():
                flag[members[1:]] = True
    return flag


def marked_runs(cut: DataFrame) -> DataFrame:
    """(id, start, stop): byte ranges covered by repeated windows (ranges may overlap)."""
    def order_suffixes(b: pd.DataFrame) -> pd.DataFrame:
        """Whole keys; returns marked ranges."""
        key, ids, start, offset = (b[c].to_numpy() for c in ("key", "id", "start", "offset"))
        order = np.lexsort((start, ids, key))
        key, ids, start, offset = key[order], ids[order], start[order], offset[order]
        pieces = b["bytes"].to_numpy()[order]
        sizes = np.array([len(p) for p in pieces])
        data = b"".join(pieces)
        windows = sizes - LENGTH + 1
        row = np.repeat(np.arange(len(key)), windows)
        i = np.arange(len(row)) - np.repeat(np.cumsum(windows) - windows, windows)
        at = (np.cumsum(sizes) - sizes)[row] + i
        number = np.cumsum(np.concatenate([[0], key[1:] != key[:-1]]))
        group = number[row] * 128 + (offset[row] - i + 64)
        by = np.argsort(group, kind="stable")
        # a document repeated under its id is the same place, not a later one
        place = np.concatenate([[True], (ids[1:] != ids[:-1]) | (start[1:] != start[:-1]) | (key[1:] != key[:-1])])
        flag = np.zeros(len(row), bool)
        flag[by] = later_windows(data, at[by], group[by])
        again = ~place[row]
        flag &= ~again
        hit = np.flatnonzero(flag)
        if not len(hit):
            return pd.DataFrame({"id": [], "start": [], "stop": []}).astype("int64")
        new = np.ones(len(hit), bool)
        new[1:] = (np.diff(hit) != 1) | (row[hit[1:]] != row[hit[:-1]])
        a = hit[new]
        z = hit[np.append(np.flatnonzero(new)[1:] - 1, len(hit) - 1)]
        return pd.DataFrame({"id": ids[row[a]], "start": start[row[a]] + i[a], "stop": start[row[z]] + i[z] + LENGTH})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        n = 0
        for b in batches:
            ready = b["bytes"].isna()
            if ready.any():
                r = b[ready]
                yield pd.DataFrame({"id": r["id"], "start": r["start"], "stop": r["offset"]})
                b = b[~ready]
            if not len(b):
                continue
            held.append(b)
            n += int(b["bytes"].map(len).sum()) - (LENGTH - 1) * len(b)
            if n < WINDOWS or held[0]["key"].iloc[0] == b["key"].iloc[-1]:
                continue
            g = pd.concat(held, ignore_index=True)
            open_ = (g["key"] == g["key"].iloc[-1]).to_numpy()
            held = [g[open_]]
            n = int(held[0]["bytes"].map(len).sum()) - (LENGTH - 1) * len(held[0])
            yield order_suffixes(g[~open_])
        if held:
            yield order_suffixes(pd.concat(held, ignore_index=True))

    return cut.repartition("key").sortWithinPartitions("key").mapInPandas(run, "id long, start long, stop long")


def union_ranges(start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal ranges of a union (ranges that touch are one)."""
    order = np.argsort(start, kind="stable")
    start, stop = start[order], np.maximum.accumulate(stop[order])
    new = np.ones(len(start), bool)
    new[1:] = start[1:] > stop[:-1]
    first = np.flatnonzero(new)
    return start[first], stop[np.append(first[1:] - 1, len(stop) - 1)]


def once(named: DataFrame) -> DataFrame:
    """(id, text) without rows that repeat both; only rows of repeated ids are shuffled."""
    again = table(named.groupBy("id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("id"), "rep-ids")
    return thinned(named, again, "left_anti").unionByName(thinned(named, again).dropDuplicates(["id", "text"]))


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, kept bytes as binary, n_bytes, n_removed, spans array<struct<start,stop>>) of every row."""
    every = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
    named = once(every.filter("id is not null and octet_length(text) >= %d" % LENGTH))
    found = table(repeated(anchor_rows(named)), "rep-anchors")
    ranges = table(marked_runs(cuttings(named, found)), "rep-ranges")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for key, t, spans in zip(b["id"], b["text"], b["ranges"]):
                raw = t.encode("utf-8", "replace")
                a = np.array([s["start"] for s in spans], np.int64)
                z = np.minimum(np.array([s["stop"] for s in spans], np.int64), len(raw))
                a, z = union_ranges(a, z)
                edges = [0, *np.stack([a, z], axis=1).ravel().tolist(), len(raw)]
                kept = b"".join(raw[x:y] for x, y in zip(edges[::2], edges[1::2]))
                out.append((key, kept, len(raw), int((z - a).sum()),
                            [{"start": int(x), "stop": int(y)} for x, y in zip(a, z)]))
            yield pd.DataFrame(out, columns=["id", "kept", "n_bytes", "n_removed", "spans"])

    schema = "id long, kept binary, n_bytes long, n_removed long, spans array<struct<start:long,stop:long>>"
    per_doc = ranges.groupBy("id").agg(F.collect_list(F.struct("start", "stop")).alias("ranges"))
    touched = thinned(every.filter("id is not null"), ranges.select("id")).join(per_doc, "id", "left")
    cut = touched.filter("ranges is not null").select("id", "text", "ranges").mapInPandas(run, schema)
    whole = thinned(every, ranges.select("id"), "left_anti").unionByName(
        touched.filter("ranges is null").select("id", "text"))
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    same = whole.select("id", raw.alias("kept"), F.octet_length(raw).cast("long").alias("n_bytes"),
                        F.lit(0).cast("long").alias("n_removed"),
                        F.expr("cast(array() as array<struct<start:long,stop:long>>)").alias("spans"))
    return cut.unionByName(same).withColumnRenamed("id", doc_id)


def digest(out: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    return out.select(doc_id, "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"))
