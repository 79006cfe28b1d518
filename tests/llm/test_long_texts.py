"""Very long and unfriendly texts end, with the results of the plain methods where those survive."""

import random
import time

import pytest

pytest.importorskip("creditlens.llm")

from creditlens.llm import secret_scan, tokencounts  # noqa: E402


@pytest.fixture(scope="module")
def enc():
    return tokencounts.encoder(open(tokencounts.RANKS, "rb").read())


@pytest.mark.parametrize("n", [9_999, 10_000, 10_001, 25_000, 300_000])
def test_token_lengths_with_long_white_space(enc, n):
    r = random.Random(n)
    kinds = [" " * n, "\n" * n, " \t\n " * (n // 4), "".join(r.choice(" \n\t\r ") for _ in range(n))]
    for run in kinds:
        for text in (run, "a" + run, run + "b", "word." + run + "!x", run + "\x1c" + run + " tail", f"x{run}y{run}"):
            assert tokencounts.length(enc, text) == len(enc.encode_ordinary(text))


def test_five_million_spaces(spark, enc):
    df = spark.createDataFrame([(1, " " * 5_000_000 + "a"), (2, "a" + " " * 1_500_000), (3, None)],
                               "doc_id long, text string")
    got = {r.doc_id: r.n_tokens for r in tokencounts.count_tokens(df).collect()}
    assert got[3] == 0
    assert got[1] == len(enc._encode_single_piece(b" " * 4_999_999)) + len(enc.encode_ordinary(" a"))


def test_repeated_jwt_prefix_is_linear():
    auto = secret_scan.automaton()
    start = time.time()
    assert secret_scan.scan("eyJ" * 400_000, auto) == []
    assert time.time() - start < 5
    # a token after a failed run, and one whose first part holds the keyword again
    token = "eyJhbGciOiJIUzI1NiJ9.eyJzdWIiOiIxIn0.c2ln"
    text = "eyJ" * 50 + " " + token + " eyJeyJ.eyJ " + token
    spans = [(s, e) for s, e, k in secret_scan.scan(text, auto) if k == "jwt"]
    assert spans == [(151, 151 + len(token)), (len(text) - len(token), len(text))]


def test_hot_windows_meet_once_per_task(spark, monkeypatch):
    """A passage common to all documents after different openings: a key holds at most one row of a task."""
    from pyspark.sql import functions as F

    from creditlens.llm import repeats

    monkeypatch.setattr(repeats, "HOT", 50)
    r = random.Random(8)
    passage = "".join(r.choice("abcdefgh ") for _ in range(300))
    rows = [(i, "".join(r.choice("xyz") for _ in range(140)) + passage + "".join(r.choice("uvw") for _ in range(40)))
            for i in range(600)]
    df = spark.createDataFrame(rows, "id long, text string").repartition(4)
    cut = repeats.cuttings(df, repeats.table(repeats.repeated(repeats.anchor_rows(df)), "hot-test"))
    cut = cut.withColumn("task", F.spark_partition_id()).cache()
    sent = cut.filter("bytes is not null")
    assert sent.groupBy("key", "bytes", "offset", "task").count().agg(F.max("count")).first()[0] == 1
    # 600 documents share the windows, but no key gathers a row of each
    assert sent.groupBy("key").count().agg(F.max("count")).first()[0] <= 50
    out = repeats.remove_repeats(df.withColumnRenamed("id", "doc_id")).collect()
    # letters beside the passage may repeat with it
    assert all(300 <= x.n_removed <= 330 for x in out if x.doc_id) and [x.n_removed for x in out if x.doc_id == 0] == [0]


def test_many_equal_rows_of_one_id(spark):
    from creditlens.llm import repeats

    r = random.Random(9)
    text = "".join(r.choice("abcdefgh ") for _ in range(3_000))
    start = time.time()
    df = spark.createDataFrame([(7, text)] * 10_000 + [(8, text), (9, None)], "doc_id long, text string").repartition(8)
    got = [(x.doc_id, x.n_removed) for x in repeats.remove_repeats(df).collect()]
    assert sorted(got) == [(7, 0)] * 10_000 + [(8, 3_000), (9, 0)]
    assert time.time() - start < 60
