"""Aggregate Column builders with the reference's null semantics.

Three families are needed (see SURVEY 2.5):

* ``safe_*`` : ignore NULL, NULL when every input is NULL.  Spark's own
  ``avg/sum/min/max`` already behave like this, so these are thin names that
  keep plans readable and cast measures to double first (ANSI mode raises on
  integer overflow in ``sum``).
* raw R reducers with ``na.rm = TRUE``: ``sum`` gives 0 on an all-NULL group
  (``sum0``); ``mean`` gives NaN and ``max`` -Inf, both mapped to NULL.
* counting helpers: conditional counts / rates, an ever-flag, and a distinct
  count that counts NULL as one value (``n_distinct_na``).

Everything is a built-in JVM expression, so it stays inside whole-stage
codegen and gets partial (map-side) aggregation before any shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _d(c) -> Column:
    return _c(c).cast("double")


def safe_mean(c) -> Column:
    return F.avg(_d(c))


def safe_sum(c) -> Column:
    return F.sum(_d(c))


def safe_min(c) -> Column:
    return F.min(_d(c))


def safe_max(c) -> Column:
    return F.max(_d(c))


def sum0(c) -> Column:
    """``sum(x, na.rm=TRUE)``: 0 when every value is NULL."""
    return F.coalesce(F.sum(_d(c)), F.lit(0.0))


def count_rows() -> Column:
    return F.count(F.lit(1))


def count_where(cond: Column) -> Column:
    """``sum(cond, na.rm=TRUE)``: rows where ``cond`` is true; NULL counts 0."""
    return F.count_if(cond)


def rate_where(cond: Column) -> Column:
    """``safe_mean(cond)``: share of true among rows where ``cond`` is not NULL."""
    return F.avg(cond.cast("double"))


def ever_flag(max_col) -> Column:
    """``as.integer(max > 0)``: NULL stays NULL."""
    return (_c(max_col) > 0).cast("int")


def n_distinct_na(c) -> Column:
    """``n_distinct(x)``: distinct values with NULL counted as one value."""
    col = _c(c)
    return F.count_distinct(col) + F.coalesce(F.max(col.isNull().cast("int")), F.lit(0))


REPORT_DIGITS = 6
SNAP_DIGITS = 9


def report_round(c) -> Column:
    """Round a double for a report that must agree across engines.

    Summation order changes the last bits of a double between engines; a
    first rounding to 9 decimals snaps both to the same decimal, the second
    (half-up) gives 6 decimals (SURVEY 5.2).
    """
    return F.round(F.round(_c(c), SNAP_DIGITS), REPORT_DIGITS)


def round_frame(df):
    """Apply ``report_round`` to every double column (one projection)."""
    exprs = []
    for f in df.schema.fields:
        q = f"`{f.name}`"
        if f.dataType.typeName() in ("double", "float"):
            exprs.append(f"round(round({q}, {SNAP_DIGITS}), {REPORT_DIGITS}) AS {q}")
        else:
            exprs.append(q)
    return df.selectExpr(*exprs)
