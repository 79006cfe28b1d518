"""License scans by a positional index over rare words (DataFrame expressions only).

A template is a notice with mandatory phrases at fixed word offsets.  The
index holds, for every template, the ``RARE`` words of its mandatory phrases
that fewest documents hold (a whole-corpus count; words no document holds can
match nothing and are left out), each with its offset.  A text's words are
looked up in the index; each hit proposes the place where its template would
start, and a place is kept when all the template's postings propose it
(sorted places, equal neighbours).  Since the postings come from phrases that
must be there, no match is lost.  Then the mandatory phrases are compared
word by word, and the score is the share of the notice's words found in place.

Texts are worked through in windows of ``WINDOW`` words (overlapping by the
longest template), so the postings held at once do not grow with a text; one
row in, one row out, without a shuffle.  The document counts are one
aggregate over at most as many words as the templates have.

Defined cases: NULL or empty text: no words, counts 0, places NULL, labels
"" and score 0.0.  Repeated rows and NULL ids are scanned one by one; extra
columns are ignored; an empty table gives no rows.  Places of a phrase may
overlap; all count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values: word separators, the base phrases and the notices with their mandatory phrases ---
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BASE = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))
NOTICES = (
    ("mit", "released under the mit license", ("mit license",)),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
            "associated documentation files the software to deal in the software without restriction",
     ("permission is hereby granted free of charge", "to deal in the software without restriction")),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is "
            "hereby granted", ("permission to use copy modify", "with or without fee is hereby granted")),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided "
            "that the following conditions are met",
     ("redistribution and use in source and binary forms", "are permitted provided that")),
    ("bsd", "released under the bsd license", ("bsd license",)),
    ("apache-2.0", "licensed under the apache license version 2 0", ("apache license version 2 0",)),
    ("gpl-notice", "this program is free software you can redistribute it and or modify it under the terms of the gnu "
                   "general public license as published by the free software foundation",
     ("free software you can redistribute it", "general public license as published by the free software foundation")),
    ("lgpl", "gnu lesser general public license", ("lesser general public license",)),
    ("agpl", "gnu affero general public license", ("affero general public license",)),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0",
     ("mozilla public license",)),
    ("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",)),
    ("cc-by-sa", "licensed under cc by sa 4 0", ("cc by sa",)),
    ("cc-by-nd", "licensed under cc by nd 4 0", ("cc by nd",)),
    ("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights "
            "to this work", ("has waived all copyright and related or neighboring rights",)),
    ("unlicense", "this is free and unencumbered software released into the public domain",
     ("free and unencumbered software released into the public domain",)),
)
RARE = 3        # postings per template at most
WINDOW = 4_096  # words worked through at once


class Template:
    def __init__(self, number: int, label: str, text: str, phrases: tuple[str, ...]):
        self.number, self.label, self.words = number, label, text.split(" ")
        self.phrases = []  # (offset, words)
        for p in phrases:
            w = p.split(" ")
            at = next(i for i in range(len(self.words)) if self.words[i:i + len(w)] == w)
            self.phrases.append((at, w))

    def postings(self, seen: dict[str, int]) -> list[tuple[str, int]]:
        """The rarest (word, offset) of the mandatory phrases; none if a mandatory word is in no document."""
        spots = sorted({(w, at + i) for at, ws in self.phrases for i, w in enumerate(ws)})
        if any(w not in seen for w, _ in spots):
            return []
        return sorted(spots, key=lambda s: (seen[s[0]], s))[:RARE]


TEMPLATES = [Template(i, label, text, phrases) for i, (label, text, phrases) in enumerate(
    [(label, phrase, (phrase,)) for phrase, label in BASE] + list(NOTICES))]
REACH = max(len(t.words) for t in TEMPLATES)


def words(text: Column) -> Column:
    return F.filter(F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), GAP), lambda w: w != "")


def document_counts(docs: DataFrame, text: str = "text") -> dict[str, int]:
    """Documents per mandatory word; as many rows as the templates have words at most."""
    vocabulary = sorted({w for t in TEMPLATES for _, ws in t.phrases for w in ws})
    held = F.array_distinct(F.filter(words(F.col(text)), lambda w: w.isin(vocabulary)))
    rows = docs.select(F.explode(held).alias("word")).groupBy("word").count().collect()
    return {r["word"]: r["count"] for r in rows}


def _let(value: Column, body) -> Column:
    """``body`` of a value computed once per row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _strings(values) -> Column:
    return F.array(*[F.lit(v) for v in values])


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` plus ``n_words`` and ``found``: array of (template, start, share), every verified place."""
    seen = document_counts(docs, text)
    index = {t.number: t.postings(seen) for t in TEMPLATES}
    by_word: dict[str, list[tuple[int, int]]] = {}
    for number, spots in index.items():
        for w, at in spots:
            by_word.setdefault(w, []).append((number, at))
    held = docs.withColumn("_words", words(F.col(text)))
    kind = "array<struct<template:int,start:int,share:double>>"
    if not by_word:
        return held.withColumn("n_words", F.size("_words").cast("long")) \
            .withColumn("found", F.array().cast(kind)).drop("_words")
    postings = F.create_map(*[c for w, spots in sorted(by_word.items()) for c in (
        F.lit(w), F.array(*[F.struct(F.lit(n).alias("template"), F.lit(at).alias("at")) for n, at in spots]))])
    needs = F.array(*[F.lit(max(1, len(index[t.number]))) for t in TEMPLATES])
    notices = F.array(*[_strings(t.words) for t in TEMPLATES])
    phrases = F.array(*[F.array(*[F.struct(F.lit(at).alias("at"), _strings(ws).alias("words"))
                                  for at, ws in t.phrases]) for t in TEMPLATES])
    all_words = F.col("_words")

    def places(low: Column) -> Column:
        """Verified places that start in [low, low + WINDOW)."""
        first = F.greatest(low, F.lit(0))
        part = F.slice(all_words, first + 1, F.lit(WINDOW + REACH))
        hits = F.filter(F.transform(part, lambda w, i: F.when(
            w.isin(sorted(by_word)), F.struct(w.alias("word"), (first + i).alias("at")))), F.isnotnull)
        proposed = F.flatten(F.transform(hits, lambda h: F.transform(
            F.element_at(postings, h["word"]),
            lambda p: F.struct(p["template"].alias("template"), (h["at"] - p["at"]).alias("start")))))
        own = F.sort_array(F.filter(proposed, lambda s: (s["start"] >= low) & (s["start"] < low + WINDOW)))
        agreed = _let(own, lambda s: F.filter(s, lambda x, j: F.coalesce(
            F.get(s, j + F.element_at(needs, x["template"] + 1) - 1) == x, F.lit(False))))
        return F.filter(agreed, lambda c: F.forall(
            F.element_at(phrases, c["template"] + 1),
            lambda p: (c["start"] + p["at"] >= 0) & (
                F.slice(all_words, F.greatest(c["start"] + p["at"] + 1, F.lit(1)), F.size(p["words"]))
                == p["words"])))

    def share(c: Column) -> Column:
        notice = F.element_at(notices, c["template"] + 1)
        here = F.filter(notice, lambda w, i: (c["start"] + i >= 0) & F.coalesce(
            F.get(all_words, c["start"] + i) == w, F.lit(False)))
        return F.size(here) / F.size(notice)

    lows = F.sequence(F.lit(-REACH), F.size("_words"), F.lit(WINDOW))
    found = F.transform(F.flatten(F.transform(lows, places)), lambda c: F.struct(
        c["template"].alias("template"), c["start"].alias("start"), share(c).alias("share")))
    return held.withColumns({"n_words": F.size("_words").cast("long"), "found": found}).drop("_words")


def digest(scanned: DataFrame) -> DataFrame:
    """The contract's columns from ``scan``'s places."""
    labels = _strings([t.label for t in TEMPLATES])

    def names(places: Column) -> Column:
        return F.concat_ws(",", F.sort_array(F.array_distinct(F.transform(
            places, lambda f: F.element_at(labels, f["template"] + 1)))))

    out = scanned.select("doc_id", "n_words", "found",
                         F.filter("found", lambda f: f["template"] < len(BASE)).alias("base"))
    return out.select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"),
        F.array_min(F.transform("base", lambda f: f["start"])).cast("long").alias("first_word"),
        F.array_max(F.transform("base", lambda f: f["start"])).cast("long").alias("last_word"),
        names(F.col("base")).alias("base_labels"), names(F.col("found")).alias("labels"),
        F.coalesce(F.array_max(F.transform("found", lambda f: f["share"])), F.lit(0.0)).alias("score"))


def _oracle() -> str:
    def text(s):
        return "'" + s + "'"

    notices = ", ".join(f"({t.number}, {text(t.label)}, {[*t.words]})" for t in TEMPLATES)
    keys = ", ".join(f"({t.number}, {at}, {ws})" for t in TEMPLATES for at, ws in t.phrases)
    return rf"""
WITH notice(t, label, words) AS (VALUES {notices}),
phrase(t, off, words) AS (VALUES {keys}),
docs AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
  translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
token AS (SELECT r, w.word, w.off FROM (SELECT r, unnest(list_transform(words,
  lambda x, i: {{'word': x, 'off': i - 1}})) AS w FROM docs)),
first_word_of AS (SELECT t, off, words, words[1] AS head FROM phrase),
whole AS (  -- every place of every mandatory phrase, as the start of its notice
  SELECT DISTINCT k.r, p.t, p.off, k.off - p.off AS start FROM token k JOIN first_word_of p ON k.word = p.head
  JOIN docs d ON d.r = k.r WHERE d.words[k.off + 1:k.off + len(p.words)] = p.words),
place AS (SELECT r, t, start FROM whole GROUP BY r, t, start
  HAVING count(*) = (SELECT count(*) FROM phrase p WHERE p.t = whole.t)),
scored AS (SELECT c.r, c.t, c.start, n.label,
  len(list_filter(n.words, lambda w, i: c.start + i >= 1 AND coalesce(d.words[c.start + i] = w, false)))
    / len(n.words)::DOUBLE AS share
  FROM place c JOIN notice n ON n.t = c.t JOIN docs d ON d.r = c.r),
summed AS (SELECT r, count(*) FILTER (t < {len(BASE)}) AS n_base, min(start) FILTER (t < {len(BASE)}) AS first_word,
  max(start) FILTER (t < {len(BASE)}) AS last_word,
  list_sort(list_distinct(list(label) FILTER (t < {len(BASE)}))) AS base_labels,
  list_sort(list_distinct(list(label))) AS labels, max(share) AS score FROM scored GROUP BY r)
SELECT d.doc_id, len(d.words)::BIGINT AS n_words, coalesce(s.n_base, 0)::BIGINT AS n_base,
  s.first_word::BIGINT AS first_word, s.last_word::BIGINT AS last_word,
  coalesce(array_to_string(s.base_labels, ','), '') AS base_labels,
  coalesce(array_to_string(s.labels, ','), '') AS labels, coalesce(s.score, 0.0)::DOUBLE AS score
FROM docs d LEFT JOIN summed s ON s.r = d.r"""


ORACLE_SQL = _oracle()
