"""Vectorised word hashing on UTF-8 bytes (numpy, inside tasks).

Hashes are polynomials modulo 2^64 with an odd base taken over bytes, mixed
by the splitmix64 finaliser, so equal words have equal hashes everywhere.
"""

from __future__ import annotations

import numpy as np

_BASE = 0x9E3779B97F4A7C15
_INV = pow(_BASE, -1, 1 << 64)
_GROWN: dict[int, np.ndarray] = {}
_STEP = np.uint64(0xD1342543DE82EF95)
_PLACES: list = [_STEP]


def powers(base: int, n: int) -> np.ndarray:
    have = _GROWN.get(base)
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        p = np.full(size, base, np.uint64)
        p[0] = 1
        _GROWN[base] = have = np.multiply.accumulate(p)
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser (public constants)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_bounds(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words (runs of bytes that are no ASCII white space)."""
    if not len(buf):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    inside = np.empty(len(buf) + 2, np.int8)
    inside[0] = inside[-1] = 0
    inside[1:-1] = ~((buf == 32) | ((buf >= 9) & (buf <= 13)))
    change = np.diff(inside)
    return np.flatnonzero(change == 1), np.flatnonzero(change == -1)


def word_hashes(buf: np.ndarray) -> np.ndarray:
    """One 64-bit hash per word of a byte string."""
    start, end = word_bounds(buf)
    if not len(start):
        return np.empty(0, np.uint64)
    total = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * powers(_BASE, len(buf)), out=total[1:])
    h = (total[end] - total[start]) * powers(_INV, len(buf))[start]
    return mix(h + (end - start).astype(np.uint64) * _STEP)


def lower_ascii(raw: bytes) -> np.ndarray:
    """Bytes with A-Z lowered only."""
    return np.frombuffer(raw.lower(), np.uint8)


def place(i: int) -> np.uint64:
    """Odd factor of the i-th word of a run."""
    while len(_PLACES) <= i:
        _PLACES.append(mix(np.array(_PLACES[-1:], np.uint64))[0] | np.uint64(1))
    return _PLACES[i]


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``k`` words; fewer words make one run, none no run."""
    n = len(words)
    if n == 0:
        return words
    size = min(k, n)
    # the words are mixed hashes, so a sum with odd factors by place keeps order and content
    out = words[:n - size + 1] * _PLACES[0]
    for i in range(1, size):
        out += words[i:n - size + 1 + i] * place(i)
    return np.unique(mix(out + np.uint64(size)))
