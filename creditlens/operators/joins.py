"""Joins.

Every right side of a client join is reduced to one row per key before the
join, so a left join never changes the row count of the application frame.
The broadcast decision is left to Spark: with AQE on, a side whose
*measured* post-shuffle size is under ``spark.sql.autoBroadcastJoinThreshold``
is broadcast at run time, anything larger stays a sort-merge join.  Only
lookups whose size is bounded by construction (a reason map, a threshold
grid) are broadcast explicitly, and only after a size check.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Row bound under which an explicit broadcast hint is allowed for a lookup.
BROADCAST_ROW_LIMIT = 100_000


def left_enrich(app: DataFrame, right: DataFrame, key: str = "SK_ID_CURR") -> DataFrame:
    """Left equi-join to a one-row-per-key frame."""
    return app.join(right, key, "left")


def augment_star(app: DataFrame, aggregates: Sequence[DataFrame], key: str = "SK_ID_CURR") -> DataFrame:
    """Chained left joins of client aggregates on one key.

    All aggregates come out of a ``groupBy(key)`` and are hash-partitioned
    on it, so each join only needs the application side shuffled (once per
    join, or broadcast when AQE measures a side as small).
    """
    out = app
    for right in aggregates:
        out = out.join(right, key, "left")
    return out


def suffix_join(left: DataFrame, right: DataFrame, key: str, how: str = "left",
                suffixes: tuple[str, str] = ("_x", "_y")) -> DataFrame:
    """Join keeping both copies of clashing columns, suffixed ``_x`` / ``_y``."""
    clash = [c for c in left.columns if c in right.columns and c != key]
    if clash:
        left = left.withColumnsRenamed({c: c + suffixes[0] for c in clash})
        right = right.withColumnsRenamed({c: c + suffixes[1] for c in clash})
    return left.join(right, key, how)


def checked_broadcast(df: DataFrame, limit: int = BROADCAST_ROW_LIMIT) -> DataFrame:
    """Broadcast a lookup only if its row count is proven under ``limit``.

    Counting costs one small job; callers use it only for lookups that are
    small by construction (mapping tables, threshold grids), where the check
    guards against misuse rather than being the common path.
    """
    n = df.limit(limit + 1).count()
    return F.broadcast(df) if n <= limit else df


def lookup(df: DataFrame, mapping: DataFrame, key: str, how: str = "left") -> DataFrame:
    """Join a lookup table (e.g. feature -> reason) with a checked broadcast."""
    return df.join(checked_broadcast(mapping), key, how)
