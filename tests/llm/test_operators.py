"""Parts of the operators on small inputs, and the pipeline stage by stage."""

import random
import zlib

import numpy as np
import pytest

pytest.importorskip("creditlens.llm")

from creditlens.llm import (  # noqa: E402
    classifier, embeddings, formatting, jaccard, mixing, pieces, quality, repeats, secret_scan,
)
from creditlens.llm.common import components  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_components(spark):
    r = random.Random(1)
    edges = [(r.randrange(200), r.randrange(200)) for _ in range(120)] + [(300 + i, 301 + i) for i in range(40)] \
        + [(500, 500 + i) for i in range(50)] + [(7, 7)]
    nodes = sorted({x for e in edges for x in e} | {999})
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    got = components(spark.createDataFrame([(n,) for n in nodes], "id long"),
                     spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.id: r.comp for r in got} == {n: root(n) for n in nodes}


def test_jaccard_bands_cover_linked_sizes():
    starts = jaccard.bands(100_000)
    band = np.searchsorted(starts, np.arange(1, 60_000), side="right") - 1
    for a in (*range(1, 200), 999, 4321, 40_000):
        b = 100 * a // 80  # largest linked partner
        assert band[b - 1] - band[a - 1] <= 1
        if band[b - 1] > band[a - 1]:
            assert 100 * a >= 80 * starts[band[a - 1] + 1]


@pytest.mark.parametrize("size", [1, 2, 4, 5, 7, 13, 40, 200, 1500])
def test_jaccard_signatures_meet(size):
    """Every linked pair, at the edge of the threshold too, shares a signature one of them probes."""
    rng = np.random.default_rng(size)
    weight = rng.integers(1, 1000, jaccard.CELLS).astype(float)
    starts = jaccard.bands(10_000) + [10 ** 6, 10 ** 7]
    for _ in range(60):
        a = rng.integers(0, 2 ** 63, size, dtype=np.uint64) * np.uint64(2)
        drop = int(rng.integers(0, size))
        extra = rng.integers(0, 2 ** 63, int(rng.integers(0, size // 4 + 2)), dtype=np.uint64)
        b = np.concatenate([a[drop // 4:], extra])
        a, b = np.unique(a), np.unique(b)
        shared = len(np.intersect1d(a, b))
        if not len(b) or 100 * shared < 80 * (len(a) + len(b) - shared):
            continue
        sa, pa = jaccard.file_signatures(a, starts, weight)
        sb, pb = jaccard.file_signatures(b, starts, weight)
        assert set(sa[pa]) & set(sb) or set(sb[pb]) & set(sa)


def test_jaccard_allocation_buys_every_unit():
    rng = np.random.default_rng(2)
    sizes = rng.integers(0, 6, 40)
    one, two = jaccard.allocate(42, sizes, rng.random(40) * 100, 3)
    assert len(one) + len(two) == 42 and set(two) <= set(range(3)) and set(two) <= set(one)


@pytest.mark.parametrize("k", [5, 14, 20])
def test_embedding_tables_miss_few_pairs_at_the_threshold(k):
    """Pairs whose 512 bits differ as those of a pair at 0.93 do share a table but for about one in 10,000."""
    tables = embeddings.table_bits(k, embeddings.table_count(k))
    rng = np.random.default_rng(k)
    p = np.arccos(embeddings.THRESHOLD) / np.pi
    lost = n = 0
    for _ in range(40):
        differs = rng.random((500, embeddings.BITS)) < p
        shared = np.zeros(500, bool)
        for t in tables:
            shared |= ~differs[:, t].any(axis=1)
        lost, n = lost + int((~shared).sum()), n + 500
    assert embeddings.missed(k, len(tables)) <= embeddings.MISS and lost <= 10, (lost, n)


def test_embedding_recall_and_blocks(spark, monkeypatch):
    """Pairs near the threshold are found, also when buckets are dealt as pairs of blocks."""
    rng = np.random.default_rng(4)
    base = rng.standard_normal((40, 32))
    rows = [base[i % 40] + rng.standard_normal(32) * 0.2 for i in range(400)] + [base[0]] * 30
    x = np.stack(rows)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = unit @ unit.T >= embeddings.THRESHOLD
    np.fill_diagonal(near, False)
    df = spark.createDataFrame([(i, [float(v) for v in r], 1) for i, r in enumerate(rows)],
                               "vec_id long, embedding array<double>, label int")
    for block in (embeddings.BLOCK, 16):
        monkeypatch.setattr(embeddings, "BLOCK", block)
        got = {r.vec_id: r.n_links for r in embeddings.near_duplicates(df).collect()}
        total, found = int(near.sum()), sum(got.values())
        assert 0.999 * total <= found <= total


def test_embedding_estimate_is_unbiased_and_bounded():
    rng = np.random.default_rng(6)
    dim = 64
    r = embeddings.rotations(dim)
    x = rng.standard_normal((400, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y = x + 0.3 * rng.standard_normal((400, dim)) / 8
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    z = x @ r.T
    scale = np.sqrt(embeddings.BITS) * np.sqrt(embeddings.BITS / dim)
    f = np.abs(z).sum(axis=1) / scale
    estimate = np.einsum("ij,ij->i", (np.where(z > 0, 1, -1) @ r) / scale, y) / f
    exact = np.einsum("ij,ij->i", x, y)
    assert abs((estimate - exact).mean()) < 0.01
    bound = embeddings.EPS * np.sqrt((1 - f ** 2) / f ** 2 / (embeddings.BITS - 1)) * np.sqrt(1 - exact ** 2)
    assert (np.abs(estimate - exact) <= bound + 1e-3).mean() > 0.99


def test_blind_trie_orders_and_groups():
    rng = random.Random(8)
    strings = [bytes(rng.choice(b"ab") for _ in range(12)) for _ in range(300)]
    data = b"".join(strings)
    trie = repeats.BlindTrie(data, 12)
    for i in range(300):
        trie.add(12 * i, i)
    groups = list(trie.groups())
    assert [strings[g[0]] for g in groups] == sorted(set(strings))
    assert all(len({strings[i] for i in g}) == 1 for g in groups) and sum(map(len, groups)) == 300


def test_repeats_hot_anchor_is_dealt_by_windows(spark, monkeypatch):
    """With every anchor hot the result is the same."""
    import hashlib

    rng = random.Random(3)
    line = "".join(rng.choice("abcdefgh ") for _ in range(90))
    rows = [(i, "".join(rng.choice("xyz") for _ in range(150)) + line + "".join(rng.choice("uvw") for _ in range(40)))
            for i in range(30)] + [(40, line * 3), (41, line * 3), (42, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    seen, want = set(), {}
    for i, t in rows:
        b = (t or "").encode()
        cover = bytearray(len(b))
        for p in range(len(b) - 99):
            if b[p:p + 100] in seen:
                cover[p:p + 100] = b"\1" * 100
            seen.add(b[p:p + 100])
        want[i] = hashlib.sha256(bytes(c for c, v in zip(b, cover) if not v)).hexdigest()
    for hot in (repeats.HOT, 1):
        monkeypatch.setattr(repeats, "HOT", hot)
        got = {r.doc_id: r.kept_sha256 for r in repeats.digest(repeats.remove_repeats(df)).collect()}
        assert got == want


def test_viterbi_agrees_with_the_library():
    """The same pieces and scores in the public library's Viterbi (its unigram mode)."""
    sentencepiece = pytest.importorskip("sentencepiece")
    pb = pytest.importorskip("sentencepiece.sentencepiece_model_pb2")
    raw = open(pieces.MODEL, "rb").read()
    m = pb.ModelProto()
    m.ParseFromString(raw)
    m.trainer_spec.model_type = 1
    lib = sentencepiece.SentencePieceProcessor(model_proto=m.SerializeToString())
    enc = pieces.Encoder(raw)
    rng = random.Random(1)
    letters = "abcdeiknorstuéüß.,"
    for _ in range(400):
        text = " ".join("".join(rng.choice(letters) for _ in range(rng.randint(1, 12))) for _ in range(4))
        ours, theirs = enc.encode(text).tolist(), lib.encode(text)
        assert ours == theirs or abs(enc.score(ours) - enc.score(theirs)) < 1e-3 * abs(enc.score(theirs)) \
            and enc.score(ours) >= enc.score(theirs) - 1e-6
        assert enc.decode(ours) == text


def test_pieces_interfaces(spark):
    df = spark.createDataFrame([(1, "Hello  world\n", 3), (2, None, 4), (3, "", 5), (4, "a▁b 😀 \x00", 6)],
                               "doc_id long, text string, n_pieces int")
    out = pieces.decode(pieces.encode(df)).collect()
    assert {r.doc_id: r.decoded for r in out} == {1: "Hello  world\n", 2: "", 3: "", 4: "a b 😀 \x00"}


def test_secret_checksums():
    auto = secret_scan.automaton()
    body = "Zx" * 15
    good = f"ghp_{body}{secret_scan.base62_crc(body)}"
    assert ("ghtoken" in {k for _, _, k in secret_scan.scan(f"key {good} end", auto)})
    bad = good[:-1] + ("A" if good[-1] != "A" else "B")
    assert "ghtoken" not in {k for _, _, k in secret_scan.scan(f"key {bad} end", auto)}
    assert [s[2] for s in secret_scan.scan("pay 4111 1111 1111 1111 now", auto)] == ["card"]
    assert secret_scan.scan("pay 4111 1111 1111 1112 now", auto) == []
    jwt = "eyJhbGciOiJIUzI1NiJ9.eyJhIjoxfQ.abc"
    assert [s[2] for s in secret_scan.scan(jwt, auto)] == ["jwt"]
    assert secret_scan.redact("a secret=abcdef z", secret_scan.scan("a secret=abcdef z", auto)) == "a [SECRET] z"
    assert zlib.crc32(b"") == 0 and secret_scan.base62_crc("") == "000000"


def test_formatting_reads_back(spark):
    rows = [(1, 0, "user", "x"), (1, 1, "user", "<|im_start|>"), (1, 2, "assistant", "a\n<|im_sep|>\\|<\\|")]
    df = formatting.format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    r = formatting.read_back(df).first()
    assert [(t.role, t.text) for t in r.turns] == [x[2:] for x in rows]
    assert r.formatted.count("<|im_start|>") == 2 and r.loss_text == rows[2][3]


def water_level(sizes, weights, budget, most):
    target, open_ = {}, set(sizes)
    while open_:
        left = budget - sum(target.values())
        w = sum(weights[s] for s in open_)
        over = [s for s in open_ if left * weights[s] / w > most * sizes[s]]
        if not over:
            return target | {s: left * weights[s] / w for s in open_}
        for s in over:
            target[s] = most * sizes[s]
        open_ -= set(over)
    return target


def test_mixing_meets_targets(spark):
    r = random.Random(2)
    rows = [(i, "w " * r.randint(0, 80), r.choice(["a", "b", "B", "é", None, "tiny"][: 5 if i else 6]))
            for i in range(3000)]
    out = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    size = {}
    for x in out:
        size[x.source] = size.get(x.source, 0) + x.size
    names = sorted((s for s in size if s is not None)) + ([None] if None in size else [])
    weights = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(names)}
    want = water_level(size, weights, 1.5 * sum(size.values()), 2)
    for s in names:
        mine = [x for x in out if x.source == s]
        taken = sum(x.taken for x in mine)
        assert abs(mine[0].target - want[s]) < 1e-6 and mine[0].source_size == size[s]
        assert abs(taken - want[s]) <= 80 and all(x.taken <= 2 * x.size for x in mine)


def test_mixing_thresholds_are_nested(spark):
    df = spark.createDataFrame([(i, "w " * (i % 50 + 1), "s") for i in range(2000)],
                               "doc_id long, text string, source string")
    sized = mixing.sizes(df)
    total = sized.groupBy().sum("size").first()[0]
    below = [mixing.nested_thresholds(sized, spark.createDataFrame(
        [("s", total, total * share)], "source string, source_size long, target double")).first().below
        for share in (0.1, 0.3, 0.7)]
    assert below == sorted(below)


def test_quality_keeps_clean_and_rejects_junk(spark):
    path = "/root/testdata/sf0.01"
    from creditlens.llm.queries import QUERIES

    labels = spark.read.parquet(f"{path}/labels.parquet")
    rows = QUERIES["op8_quality_rules"](spark, path).join(labels, "doc_id").filter("not base_failed").collect()
    good = [r.kept for r in rows if r.quality == 1]
    bad = [r.kept for r in rows if r.quality == 0]
    assert sum(good) >= 0.99 * len(good) and sum(bad) <= 0.05 * len(bad)


def test_quality_sketch_error():
    for v in (0, 1, 31, 32, 63, 64, 1000, 123_456):
        shift = max(len(bin(v)) - 2 - 6, 0)
        low = (v >> shift) << shift
        assert low <= v and v - low <= v / 32


def test_classifier_separates_from_positives_and_unlabelled():
    """Over several draws: nearly all unlabelled positives above, nearly all negatives below, and in rank order."""
    above, below = [], []
    k = classifier.BINS + classifier.SHARES
    for seed in range(6):
        rng = np.random.default_rng(seed)
        p = np.zeros((200, k), np.float32)
        u = np.zeros((400, k), np.float32)
        p[:, 0] = rng.normal(1, 0.3, 200)
        u[:300, 0] = rng.normal(1, 0.3, 300)
        u[300:, 0] = rng.normal(-1, 0.3, 100)
        m = classifier.fit(p, u, 0.75)
        z = u @ m["w"] + m["b"]
        above.append((z[:300] > 0).mean())
        below.append((z[300:] < 0).mean())
        assert z[:300].min() > z[300:].max()
    assert np.mean(above) > 0.95 and np.mean(below) > 0.95


def test_pipeline_stages(spark, tmp_path):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    from pyspark.sql import functions as F

    docs = docs.withColumns({"kept": F.lit("x"), "size": F.lit(1), "id": F.lit("clash")})
    frames = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        path = str(tmp_path / name)
        out.write.parquet(path)
        frames[name] = (docs, spark.read.parquet(path))
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns
        docs = frames[name][1]
    before, after = frames["quality_rules"]
    kept = {r.doc_id for r in quality.judge(before.drop("kept", "size", "id")).filter("kept").collect()}
    assert {r.doc_id for r in after.collect()} == kept
    before, after = frames["near_duplicates"]
    comp = jaccard.join(before).collect()
    assert sorted(r.doc_id for r in after.collect()) == sorted(r.doc_id for r in comp if r.component_id == r.doc_id)
    before, after = frames["secrets"]
    texts = {r.doc_id: r for r in after.collect()}
    auto = secret_scan.automaton()
    for r in before.collect():
        clean = secret_scan.redact(r.text, secret_scan.scan(r.text, auto))
        assert texts[r.doc_id].text == clean and texts[r.doc_id].n_chars == (len(clean) if clean != r.text else r.n_chars)
    before, after = frames["source_mix"]
    times = {r.doc_id: r.copies for r in mixing.mix(before).collect()}
    got = {r.doc_id: r["count"] for r in after.groupBy("doc_id").count().collect()}
    assert got == {k: v for k, v in times.items() if v}
    before, after = frames["encode"]
    enc = pieces.Encoder(open(pieces.MODEL, "rb").read())
    texts = {r.doc_id: r.text for r in before.collect()}
    rows = after.collect()
    assert len(rows) == before.count()
    assert all(r.piece_ids == enc.encode(texts[r.doc_id]).tolist() and r.n_pieces == len(r.piece_ids) for r in rows)
    assert corpus_pipeline.run(spark, SF).count() == len(rows)


def test_repeated_rows_and_null_ids(spark):
    text = " ".join(f"word{i}" for i in range(120))
    rows = [(1, text, "en", "s"), (1, text, "en", "s"), (None, text, "en", "s"), (2, text + " more", "en", "s")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    assert sorted((r.doc_id or 0, r.component_id or 0) for r in jaccard.join(df).collect()) \
        == [(0, 0), (1, 1), (1, 1), (2, 1)]
    cut = sorted((r.doc_id or 0, r.n_removed) for r in repeats.digest(repeats.remove_repeats(df)).collect())
    assert cut == [(0, 0), (1, 0), (1, 0), (2, len(text))]
    assert mixing.mix(df).count() == 4 and quality.judge(df).count() == 4
