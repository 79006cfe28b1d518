"""Scalar Column builders."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the DAYS_EMPLOYED placeholder of the public application table.
DAYS_EMPLOYED_SENTINEL = 365243


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def missing_flag(c) -> Column:
    """``as.integer(is.na(x))``."""
    return _c(c).isNull().cast("int")


def smoothed_ratio(num, den) -> Column:
    """``a / (b + 1)``; NULL where ``b = -1`` (R gives Inf, ANSI ``/`` raises)."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double") + 1)


def r_ifelse(cond: Column, yes: Column, no: Column) -> Column:
    """``ifelse``: a NULL condition gives NULL (unlike ``otherwise``)."""
    return F.when(cond, yes).when(~cond, no)


def sentinel_repair(c, sentinel: float = DAYS_EMPLOYED_SENTINEL) -> Column:
    """F4 + X8: ``ifelse(x == 365243, 0, abs(x))``; NULL stays NULL."""
    col = _c(c)
    return r_ifelse(col == sentinel, F.lit(0.0), F.abs(col).cast("double"))


def days_to_years(c) -> Column:
    """``abs(days) / 365``."""
    return F.abs(_c(c)).cast("double") / 365


def format_g(x: float, digits: int) -> str:
    """C ``%.{digits}g`` (what R's ``formatC`` uses for ``cut`` labels)."""
    return "%.*g" % (digits, x)


def cut_labels(edges: Sequence[float], dig_lab: int = 3) -> list[str]:
    """Labels R's ``cut(x, edges, include.lowest=TRUE)`` gives its intervals.

    Edges are formatted with ``dig_lab`` significant digits, raised one at a
    time (up to 12) until neighbouring edges print differently.
    """
    if len(set(edges)) != len(edges):
        raise ValueError(f"bin edges are not unique: {list(edges)}")
    for dig in range(dig_lab, max(12, dig_lab) + 1):
        nb = [format_g(e, dig) for e in edges]
        if all(a != b for a, b in zip(nb[:-1], nb[1:])):
            break
    labels = [f"({a},{b}]" for a, b in zip(nb[:-1], nb[1:])]
    labels[0] = "[" + labels[0][1:]
    return labels


def _right_closed_case(col: Column, edges: Sequence[float], values: Sequence) -> Column:
    expr = F.when((col >= edges[0]) & (col <= edges[1]), F.lit(values[0]))
    for i in range(2, len(edges)):
        expr = expr.when((col > edges[i - 1]) & (col <= edges[i]), F.lit(values[i - 1]))
    return expr


def right_closed_bin_index(c, edges: Sequence[float]) -> Column:
    """1-based bin of ``cut(..., include.lowest=TRUE)``; NULL outside the edges.

    Not ``Bucketizer``: that one is left-closed.
    """
    return _right_closed_case(_c(c), edges, list(range(1, len(edges))))


def right_closed_bin_sql(col: str, edges: Sequence[float], labels: Sequence[str] | None = None) -> str:
    """SQL form of ``right_closed_bin_label`` (one expression string, exact double literals)."""
    labels = list(labels or cut_labels(edges))
    e = [f"{float(x)!r}D" for x in edges]
    parts = [f"WHEN `{col}` >= {e[0]} AND `{col}` <= {e[1]} THEN '{labels[0]}'"]
    for i in range(2, len(edges)):
        parts.append(f"WHEN `{col}` > {e[i - 1]} AND `{col}` <= {e[i]} THEN '{labels[i - 1]}'")
    return "CASE " + " ".join(parts) + " END"


def right_closed_bin_label(c, edges: Sequence[float], labels: Sequence[str] | None = None) -> Column:
    """X10 with R's interval labels, e.g. ``[20.5,34]`` and ``(34,45.2]``."""
    return _right_closed_case(_c(c), edges, list(labels or cut_labels(edges)))


def md5_uniform(id_col, seed: int | str) -> Column:
    """Deterministic uniform number in [0, 1) from ``md5(id:seed)``.

    Independent of partitioning and of row order, so every seeded operator
    gives the same rows on 1 or 1000 executors.  The same value is
    ``('0x' || substr(md5(id || ':' || seed), 1, 8))::BIGINT / 2^32`` in DuckDB.
    """
    h = F.md5(F.concat(_c(id_col).cast("string"), F.lit(f":{seed}")))
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("bigint") / 4294967296.0
