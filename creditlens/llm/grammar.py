"""Recompression of integer sequences and longest common extensions on the grammar (numpy, inside tasks).

Levels alternate block compression (a maximal run of one symbol becomes one
symbol, named by letter and length) and pair compression (letters are dealt
into left and right by a hash bit; every left letter followed by a right one
becomes one symbol).  Equal stretches are cut alike except near their ends,
so two positions are compared by climbing while both start symbols of the
next level and descending from the first difference: a few steps a level.
Symbol names come from sorting, so answers are exact.  All queries of a call
move together, level by level.
"""

from __future__ import annotations

import numpy as np

from creditlens.llm.textnum import mix

SMALL = 16        # a sequence this short is not compressed further
MAX_LEVELS = 200  # never reached in practice: both kinds of round shrink


class Level:
    """Symbols of one level (a -1 after the last), their first child below and their parent above."""

    def __init__(self, symbols: np.ndarray, first: np.ndarray | None, blocks: bool):
        self.symbols = np.append(symbols, -1)
        self.first, self.blocks = first, blocks
        self.parent: np.ndarray | None = None


def _named(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Dense names of the pairs (a, b)."""
    _, names = np.unique(a * (int(b.max(initial=0)) + 1) + b, return_inverse=True)
    return names.astype(np.int64)


def _pairs(s: np.ndarray, level: int) -> np.ndarray:
    """Places whose letter is left and whose next letter is right, for a deal that pairs an eighth of the places.

    Neighbours differ, so a deal pairs a quarter on average and a few trials do.
    """
    for trial in range(1 << 16):
        salt = np.uint64((level << 40) + (trial << 52))
        left = (mix(s.astype(np.uint64) + salt) & np.uint64(1)).astype(bool)
        paired = left[:-1] & ~left[1:]
        if 8 * np.count_nonzero(paired) >= len(s):
            break
    return paired


class Grammar:
    """Run-length grammar of ``symbols`` (non-negative integers below 2**31)."""

    def __init__(self, symbols: np.ndarray):
        self.levels = [Level(symbols.astype(np.int64), None, False)]
        blocks = True
        while len(self.levels) < MAX_LEVELS and len(self.levels[-1].symbols) - 1 > SMALL:
            low = self.levels[-1]
            s = low.symbols[:-1]
            n = len(s)
            if blocks:
                starts = np.flatnonzero(np.append(True, s[1:] != s[:-1]))
                size = np.diff(np.append(starts, n))
                names = _named(s[starts], size)
            else:
                paired = _pairs(s, len(self.levels))
                starts = np.flatnonzero(~np.append(False, paired))
                has = np.append(paired, False)[starts]
                other = np.where(has, s[np.minimum(starts + 1, n - 1)] + 1, 0)
                names = _named(s[starts], other)
            if len(starts) < n:  # a round of blocks may find none
                low.parent = np.append(np.repeat(np.arange(len(starts)), np.diff(np.append(starts, n))), len(starts))
                self.levels.append(Level(names, np.append(starts, [n, n]), blocks))
            blocks = not blocks

    def extensions(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the longest common prefix of the suffixes at a < b, per query."""
        origin = a
        a, b = a.astype(np.int64).copy(), b.astype(np.int64).copy()
        stop = np.full(len(a), len(self.levels) - 1)
        live = np.arange(len(a))
        for k in range(len(self.levels) - 1):  # climb
            low, up = self.levels[k], self.levels[k + 1]
            x, y = a[live], b[live]
            px, py = low.parent[x], low.parent[y]
            both = (up.first[px] == x) & (up.first[py] == y)
            left_x, left_y = up.first[px + 1] - x, up.first[py + 1] - y
            same = ~both & (low.symbols[x] == low.symbols[y])
            step = np.where(same, np.minimum(left_x, left_y), 0)
            x, y = x + step, y + step
            up_now = both | (same & (left_x == left_y))
            a[live], b[live] = np.where(up_now, low.parent[x], x), np.where(up_now, low.parent[y], y)
            stop[live[~up_now]] = k
            live = live[up_now]
            if not len(live):
                break
        for k in range(len(self.levels) - 1, -1, -1):  # match on the level, then descend
            here = self.levels[k]
            at = np.flatnonzero(stop >= k)
            if not len(at):
                continue
            up = self.levels[k + 1] if k + 1 < len(self.levels) else None
            go = at
            while len(go):
                x, y = a[go], b[go]
                same = here.symbols[x] == here.symbols[y]
                go, x, y = go[same], x[same], y[same]
                if up is not None and up.blocks:
                    step = np.minimum(up.first[here.parent[x] + 1] - x, up.first[here.parent[y] + 1] - y)
                else:
                    step = 1
                a[go], b[go] = x + step, y + step
            if k:
                a[at], b[at] = here.first[a[at]], here.first[b[at]]
        return a - origin
