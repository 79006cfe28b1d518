"""Secret scans: keyword automaton, anchored expressions only near hits, embedded checksums.

Each text is scanned once by an Aho-Corasick automaton over the kinds'
keywords (the text is folded for A-Z only, one code point stays one).  An
anchored expression is tried only at a hit, from left to right, never inside
the kind's previous match; this is the same as searching the whole text with
the expression, because every match starts with a keyword.  ``hex`` has no
keyword: its runs are found by one pass over hex digits, preceded by a
search for 24 of them.

Kinds beyond the contract's base ones carry a checksum that must hold:
``ghtoken`` (GitHub-style prefix, 30 characters and 6 of base-62 CRC-32),
``card`` (13 to 19 digits by the Luhn sum, no digit or letter beside them)
and ``jwt`` (first part decodes to a JSON object with "alg").  ``private``
(a PEM private key with both its lines) has none.

Defined cases: NULL text is empty: no spans, digest of the empty string;
repeated rows are scanned one by one; an empty table gives no rows.  Offsets
are code points, ends exclusive.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

# --- fixed values: the base kinds ---
ASSIGN = re.compile(
    r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"""
    r"""|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
HEX_HINT = re.compile(r"[0-9a-f]{24}")
ASSIGN_MIN, ACCESS_MIN, HEX_MIN = 6, 20, 24
BASE = ("assign", "access", "hex")
# --- fixed values: the further kinds ---
GHTOKEN = re.compile(r"gh[pousr]_[A-Za-z0-9]{36}(?![A-Za-z0-9])")
JWT = re.compile(r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+")
JWT_PART = re.compile(r"[A-Za-z0-9_-]+")
PRIVATE = re.compile(r"-----BEGIN ([A-Z]+ )?PRIVATE KEY-----[A-Za-z0-9+/=\s]*-----END ([A-Z]+ )?PRIVATE KEY-----")
CARD = re.compile(r"(?<![0-9A-Za-z])[0-9](?:[ -]?[0-9]){12,18}(?![0-9A-Za-z])")
CARD_HINT = re.compile(r"[0-9](?:[ -]?[0-9]){12}")
KEYWORDS = {
    "password": "assign", "passwd": "assign", "secret": "assign", "token": "assign", "apikey": "assign",
    "api_key": "assign", "akia": "access", "ghp_": "ghtoken", "gho_": "ghtoken", "ghu_": "ghtoken",
    "ghs_": "ghtoken", "ghr_": "ghtoken", "eyj": "jwt", "-----begin ": "private",
}
ORDER = {k: i for i, k in enumerate(("assign", "access", "hex", "ghtoken", "jwt", "private", "card"))}
FOLD = {i: i + 32 for i in range(65, 91)}
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"

Span = tuple[int, int, str]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0 and len(set(digits)) > 1


def base62_crc(body: str) -> str:
    n, out = zlib.crc32(body.encode()), ""
    while n:
        n, r = divmod(n, 62)
        out = BASE62[r] + out
    return out.rjust(6, "0")


def jwt_header(token: str) -> bool:
    head = token.split(".")[0]
    try:
        value = json.loads(base64.urlsafe_b64decode(head + "=" * (-len(head) % 4)))
    except ValueError:
        return False
    return isinstance(value, dict) and "alg" in value


# kind -> (anchored expression, test of a match)
RULES = {
    "assign": (ASSIGN, lambda m: len(m.group(2)) >= ASSIGN_MIN),
    "access": (ACCESS, lambda m: m.end() - m.start() >= ACCESS_MIN),
    "ghtoken": (GHTOKEN, lambda m: base62_crc(m.group()[4:34]) == m.group()[34:]),
    "jwt": (JWT, lambda m: jwt_header(m.group())),
    "private": (PRIVATE, lambda m: True),
}


def automaton():
    import ahocorasick

    a = ahocorasick.Automaton()
    for word, kind in KEYWORDS.items():
        a.add_word(word, (len(word), kind))
    a.make_automaton()
    return a


def scan(text: str, auto) -> list[Span]:
    """All spans of a text, sorted by start, then kind."""
    found: list[Span] = []
    free = dict.fromkeys(RULES, 0)
    hits = sorted((end + 1 - n, kind) for end, (n, kind) in auto.iter(text.translate(FOLD)))
    for start, kind in hits:
        if start < free[kind]:
            continue
        expression, valid = RULES[kind]
        m = expression.match(text, start)
        if m:
            free[kind] = m.end()
            if valid(m):
                found.append((start, m.end(), kind))
        elif kind == "jwt":  # its first part runs on to the same end from every keyword inside
            free[kind] = JWT_PART.match(text, start).end()
    if HEX_HINT.search(text):
        found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text) if m.end() - m.start() >= HEX_MIN]
    if CARD_HINT.search(text):
        found += [(m.start(), m.end(), "card") for m in CARD.finditer(text)
                  if luhn(re.sub("[ -]", "", m.group()))]
    return sorted(found, key=lambda s: (s[0], ORDER[s[2]]))


def redact(text: str, spans: list[Span], mark: str = "[SECRET]") -> str:
    """The text with every covered stretch (overlapping spans joined) replaced by ``mark``."""
    out, at, last = [], 0, 0
    for start, end, _ in sorted(spans):
        if start >= last:
            out += [text[at:start], mark]
        last = max(last, end)
        at = last
    return "".join(out) + text[at:]


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, e, k in spans)


def scan_documents(docs: DataFrame, text: str = "text") -> DataFrame:
    """Other columns of ``docs`` and n_assign, n_access, n_hex, base_sha256, spans, clean_text."""
    rest = [c for c in docs.columns if c != text]
    schema = StructType([docs.schema[c] for c in rest])
    for name, kind in (("n_assign", "long"), ("n_access", "long"), ("n_hex", "long"),
                       ("base_sha256", "string"), ("spans", "string"), ("clean_text", "string")):
        schema = schema.add(name, kind)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        auto = automaton()
        for b in batches:
            out = b[rest].copy()
            per = [scan(t, auto) if t else [] for t in b[text]]
            for kind in BASE:
                out[f"n_{kind}"] = [sum(x[2] == kind for x in s) for s in per]
            out["base_sha256"] = [hashlib.sha256(joined([x for x in s if x[2] in BASE]).encode()).hexdigest()
                                  for s in per]
            out["spans"] = [joined(s) for s in per]
            out["clean_text"] = [redact(t, s) if s else t for t, s in zip(b[text], per)]
            yield out

    return docs.select(*rest, text).mapInPandas(run, schema)


def clean(docs: DataFrame, text: str = "text", size: str = "n_chars") -> DataFrame:
    """``docs`` with secrets replaced in the text and the size column following it; other columns pass through."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        auto = automaton()
        for b in batches:
            texts = list(b[text])
            hit = np.zeros(len(b), bool)
            for i, t in enumerate(texts):
                spans = scan(t, auto) if t else []
                if spans:
                    texts[i], hit[i] = redact(t, spans), True
            out = b.copy()
            out[text] = texts
            if size in b.columns and hit.any():
                out.loc[hit, size] = [len(t) for t, h in zip(texts, hit) if h]
            yield out

    return docs.mapInPandas(run, docs.schema)
