"""Periodic runs, conversation repair and license scans against brute force, with odd rows and hot inputs."""

import hashlib
import random
import re
import time
import zlib

import numpy as np
import pytest

pytest.importorskip("creditlens.llm")

from creditlens.llm import grammar, licenses, periodic, repair  # noqa: E402


def brute_runs(w):
    found = {}
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(12, 2 * q):
                found.setdefault((i, j + q), q)
            i = j + 1
    return sorted((s, e - s, q) for (s, e), q in found.items())


def random_words(r):
    kind, n = r.randint(0, 4), r.randint(0, 120)
    if kind < 2:
        return [r.randrange(2 if kind else 40) for _ in range(n)]
    if kind == 2:
        w = ([r.randrange(3) for _ in range(r.randint(1, 30))] * 121)[:n]
        for _ in range(r.randint(0, 3) if n else 0):
            w[r.randrange(n)] = r.randrange(4)
        return w
    if kind == 3:
        return [0] * n
    a, b = [0], [0, 1]
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


@pytest.mark.parametrize("slices", [False, True])
def test_runs_equal_brute_force(monkeypatch, slices):
    if slices:  # a text over many slices of the grid
        monkeypatch.setattr(periodic, "SLICE", 16)
        monkeypatch.setattr(periodic, "MAX_PERIODS", 5)
    r = random.Random(1)
    for _ in range(150):
        docs = [random_words(r) for _ in range(r.randint(1, 6))]
        got = periodic.find_runs([np.array(w, np.int64) for w in docs])
        for w, g in zip(docs, got):
            assert [tuple(x) for x in g.tolist()] == brute_runs(w)


def test_extensions_equal_comparison():
    r = random.Random(2)
    for _ in range(60):
        w = np.array(random_words(r) + random_words(r) + [7], np.int64)
        w = np.append(w, [98, 99])
        a = np.array([r.randrange(len(w) - 1) for _ in range(40)])
        b = np.array([r.randrange(x + 1, len(w)) for x in a.tolist()])
        for x, y, n in zip(a, b, grammar.Grammar(w).extensions(a, b)):
            same = np.append(w[x:x + len(w) - y] == w[y:], False)
            assert n == int(np.argmin(same))


def test_long_periodic_texts_end():
    start = time.time()
    for w in (np.zeros(400_000, np.int64), np.tile([1, 2], 200_000), np.tile(np.arange(5_000), 80)):
        runs = periodic.find_runs([w])[0]
        assert len(runs) == 1 and runs[0, 1] == len(w)
    assert time.time() - start < 60


def test_runs_of_odd_rows(spark):
    rows = [(1, "a b " * 40, 3), (1, "a b " * 40, 3), (None, "x " * 30, 4), (2, None, 5), (3, "", 6),
            (4, " ".join(map(str, range(3000))), 7), (-7, "äö ü  " * 20, 8), (11, "z\n" * 12, 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_runs int")
    got = periodic.digest(periodic.detect(df)).collect()
    assert len(got) == len(rows)
    want = []
    for i, t, _ in rows:
        w = (t or "").encode().split()
        runs = brute_runs(w)
        best = min(runs, key=lambda x: (-x[1], x[0], x[2])) if runs else (None,) * 3
        gone = {k for s, n, q in runs for k in range(s + q, s + n)}
        want.append((i, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
                     hashlib.sha256("".join("%d,%d,%d\n" % x for x in runs).encode()).hexdigest(),
                     hashlib.sha256(b" ".join(x for k, x in enumerate(w) if k not in gone)).hexdigest()))
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_planted_tail():
    for i in range(200):
        h = zlib.crc32(str(i).encode())
        w = [b"%d" % k for k in range(i % 37)]
        n, g = len(w), h // 10
        want = list(w)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            want = [w[k] if k < a else w[a + (k - a) % p] for k in range(n)]
        assert periodic.plant_tail(w, h) == want


def forward_search(roles, faults):
    """Cheapest, then ASCII-least, edit string by a forward table over (state, insertions)."""
    def step(table):
        out = {}
        for (s, cost, audit) in table:
            for k in range(3):
                out_state, c, a = s, cost, audit
                for _ in range(k):
                    out_state, c, a = (3 if out_state == 2 else 2), c + 5, a + "I"
                out.setdefault((out_state, k), []).append((c, a))
        return [(s, *min(v)) for (s, _), v in out.items()]

    table = [(0, 0, "")]
    for r, f in zip(roles, faults):
        grown = []
        for s, c, a in step(table):
            grown.append((s, c + 2, a + "D"))
            if f not in (1, 2):
                more, then = (5 if f == 3 else 0), (3 if s == 2 else 2)
                if r == "s" and s == 0:
                    grown.append((1, c + more, a + "K"))
                elif r == ("a" if s == 2 else "u"):
                    grown.append((then, c + more, a + "K"))
                grown.append((then, c + more + 1, a + "R"))
        table = [(s, *min((c, a) for t, c, a in grown if t == s)) for s in {g[0] for g in grown}]
    return min((c, a) for s, c, a in step(table) if s in (0, 3))


def test_search_equals_forward_table():
    r = random.Random(4)
    for _ in range(1500):
        n = r.randint(0, 14)
        roles = "".join(r.choice("suuaaa x") for _ in range(n))
        faults = [r.choice((0, 0, 0, 1, 2, 3)) for _ in range(n)]
        assert repair.cheapest_edits(roles, faults) == forward_search(roles, faults)


def test_search_is_linear_in_rows():
    r = random.Random(5)
    n = 100_000
    roles = "".join(r.choice("suuaaa") for _ in range(n))
    faults = bytes(r.choice((0, 0, 0, 1, 2, 3)) for _ in range(n))
    start = time.time()
    cost, audit = repair.cheapest_edits(roles, faults)
    assert time.time() - start < 30 and len(audit.replace("I", "")) == n
    assert cost == forward_search(roles, faults)[0]


def test_repair_of_odd_rows(spark):
    rows = [(1, 0, "system", "Be brief.", 1), (1, 1, "user", "Hi?", 1), (1, 2, "assistant", "Yes.", 1),
            (2, 0, "user", "Hi?", 1), (2, 0, "user", "Hi?", 1), (2, None, "assistant", "Well.", 1),
            (2, 9, "assistant", "So", 1), (3, None, "tool", None, 1), (None, 1, "user", "a!", 1),
            (None, 2, "assistant", "b.  \n", 1), (4, 1, "", "x.", 1)]
    df = spark.createDataFrame([(*r, False) for r in rows],
                               "conv_id long, turn long, role string, text string, cost int, gone boolean") \
        .fillna(" ", ["role", "text"])
    got = {r.conv_id: r for r in repair.repair(df).collect()}
    assert len(got) == 5
    assert (got[1].cost, got[1].audit, got[1].illegal) == (0, "KKK", 0)
    want = "system:Be brief.\nuser:Hi?\nassistant:Yes."
    assert got[1].repaired_sha256 == hashlib.sha256(want.encode()).hexdigest()
    # nulls first: a reply, the question, its repetition, a truncated reply
    assert (got[2].duplicate, got[2].truncated, got[2].gaps, got[2].illegal) == (1, 1, 8, 1)
    assert (got[2].cost, got[2].audit) == forward_search("auua", [0, 0, 2, 3])
    assert (got[3].blank, got[3].audit, got[3].gaps) == (1, "D", 0)
    assert got[3].repaired_sha256 == hashlib.sha256(b"").hexdigest()
    assert got[None].audit == "KK" and got[4].audit == "D"


def brute_license(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    found = []
    for t in licenses.TEMPLATES:
        for s in range(-licenses.REACH, len(w)):
            if all(s + at >= 0 and w[s + at:s + at + len(p)] == p for at, p in t.phrases):
                n = sum(0 <= s + i < len(w) and w[s + i] == x for i, x in enumerate(t.words))
                found.append((t.number, s, n / len(t.words)))
    base = [f for f in found if f[0] < 3]
    names = [",".join(sorted({licenses.TEMPLATES[f[0]].label for f in fs})) for fs in (base, found)]
    starts = [f[1] for f in base]
    return (len(w), len(base), min(starts, default=None), max(starts, default=None), *names,
            max((f[2] for f in found), default=0.0))


@pytest.mark.parametrize("window", [licenses.WINDOW, 7])
def test_licenses_equal_brute_force(spark, monkeypatch, window):
    monkeypatch.setattr(licenses, "WINDOW", window)
    r = random.Random(6)
    texts = [None, "", "?!", "MIT License", "CC BY, cc-by cc.by CC by", "all rights reserved all rights reserved",
             "cc by cc by nc 4.0", "CC BY", "KK", "the GENERAL public\nlicense.", "license " * 500]
    for t in licenses.TEMPLATES:
        texts.append("Word " * r.randint(0, 30) + " ".join(t.words).title() + " tail" * r.randint(0, 30))
        cut = list(t.words)
        cut.insert(r.randrange(len(cut) + 1), "really")
        texts.append(" ".join(cut))
    mixed = [w for t in licenses.TEMPLATES for w in t.words]
    texts += [" ".join(r.choice(mixed) for _ in range(400)) for _ in range(4)]
    texts += texts[3:5]
    df = spark.createDataFrame([(i if i % 9 else None, t, "x") for i, t in enumerate(texts)],
                               "doc_id long, text string, words string")
    got = sorted(repr(tuple(x)) for x in licenses.digest(licenses.scan(df)).collect())
    assert got == sorted(repr((i if i % 9 else None, *brute_license(t))) for i, t in enumerate(texts))


def test_license_words_absent_from_the_corpus(spark):
    df = spark.createDataFrame([(1, "plain words"), (2, None)], "doc_id long, text string")
    assert [r.labels for r in licenses.digest(licenses.scan(df)).collect()] == ["", ""]


def test_hot_license_text(spark):
    text = "license general cc by " * 250_000
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    r = licenses.digest(licenses.scan(df)).first()
    assert (r.n_words, r.n_base, r.first_word, r.last_word) == (1_000_000, 250_000, 2, 999_998)
