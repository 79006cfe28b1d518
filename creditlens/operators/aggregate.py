"""Spec-driven (multi-level) aggregation.

A spec is a list of ``(output, kind, source)`` triples; ``kind`` names one of
the reducers below and ``source`` is a column name or, for the conditional
reducers, a SQL condition such as ``"STATUS = 'C'"``.  Each reducer is one
SQL aggregate expression with the reference's NULL semantics (see
``functions.aggs``); building them as expression strings keeps plan
construction to one call per aggregate.

``two_level`` reduces a fact table first to (client, loan) and then to
client.  Both steps are plain ``groupBy().agg()``: Spark runs a partial
aggregate before each exchange, so the first shuffle moves one partial row
per (client, loan, map task) instead of every monthly row, and a client
holding a third of all rows is pre-aggregated on every map task before it
reaches its reducer.

``loan_partitioned=True`` shuffles the raw rows once by client instead
(a hash partitioning on the client satisfies both groupings, so the plan
has one exchange).  It is cheaper only when rows per loan are few; the
default keeps map-side combining.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Spec = Sequence[tuple[str, str, object]]

# reducer -> SQL template; {x} is the source column or condition
_REDUCERS = {
    "count": "count(1)",
    "mean": "avg(CAST({x} AS DOUBLE))",            # safe_mean: NULL if all NULL
    "sum": "sum(CAST({x} AS DOUBLE))",             # safe_sum: NULL if all NULL
    "min": "min(CAST({x} AS DOUBLE))",
    "max": "max(CAST({x} AS DOUBLE))",
    "sum0": "coalesce(sum(CAST({x} AS DOUBLE)), 0D)",  # sum(na.rm=TRUE): 0 if all NULL
    "count_where": "count_if({x})",                # sum(cond, na.rm=TRUE)
    "rate_where": "avg(CAST({x} AS DOUBLE))",      # safe_mean(cond)
    "n_distinct_na": "count(DISTINCT {x}) + coalesce(max(CAST({x} IS NULL AS INT)), 0)",
    "count_distinct": "count(DISTINCT {x})",
}
_IDENT = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*$")


def _src(src) -> str:
    if src is None:
        return "1"
    return f"`{src}`" if _IDENT.match(src) else f"({src})"


def agg_exprs(spec: Spec) -> list[Column]:
    out = []
    for name, kind, src in spec:
        try:
            template = _REDUCERS[kind]
        except KeyError as exc:  # pragma: no cover - programming error
            raise ValueError(f"unknown reducer {kind!r} for {name}") from exc
        out.append(F.expr(f"{template.format(x=_src(src))} AS `{name}`"))
    return out


def aggregate(df: DataFrame, keys: Sequence[str], spec: Spec) -> DataFrame:
    return df.groupBy(*keys).agg(*agg_exprs(spec))


def with_ever_flags(df: DataFrame, flags: Sequence[tuple[str, str]]) -> DataFrame:
    """Add ``as.integer(max > 0)`` columns: ``[(flag_name, max_column)]``; NULL stays NULL."""
    if not flags:
        return df
    return df.withColumns({name: F.expr(f"CAST(`{src}` > 0 AS INT)") for name, src in flags})


def two_level(df: DataFrame, client: str, loan: str, loan_spec: Spec,
              client_spec: Spec, loan_flags: Sequence[tuple[str, str]] = (),
              loan_partitioned: bool = False) -> DataFrame:
    if loan_partitioned:
        df = df.repartition(client)
    loans = with_ever_flags(aggregate(df, [client, loan], loan_spec), loan_flags)
    return aggregate(loans, [client], client_spec)
