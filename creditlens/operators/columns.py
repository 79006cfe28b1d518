"""Column selection and schema operators.

Column groups are resolved in Python from ``df.schema`` before the plan is
built; the plan itself is a plain projection, so Parquet scans read only the
selected columns.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
                 T.DecimalType)


def r_class(dtype: T.DataType) -> str:
    """The R class a column of this type has after ``read_csv``."""
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType)):
        return "integer"
    if isinstance(dtype, NUMERIC_TYPES):
        return "numeric"
    if isinstance(dtype, T.BooleanType):
        return "logical"
    return "character"


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """``where(is.numeric)``."""
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, NUMERIC_TYPES) and f.name not in exclude]


def string_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """``where(is.character)``."""
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.StringType) and f.name not in exclude]


def columns_by_prefix(df: DataFrame, prefix: str) -> list[str]:
    """Case-sensitive ``^prefix`` match (``colRegex`` would ignore case)."""
    pat = re.compile("^" + re.escape(prefix))
    return [c for c in df.columns if pat.match(c)]


def setdiff(a: Sequence[str], b: Sequence[str]) -> list[str]:
    """R ``setdiff`` (order of ``a`` kept, duplicates dropped)."""
    seen, out = set(b), []
    for x in a:
        if x not in seen:
            out.append(x)
            seen.add(x)
    return out


def intersect(a: Sequence[str], b: Sequence[str]) -> list[str]:
    """R ``intersect`` (order of ``a`` kept)."""
    bs, out = set(b), []
    for x in a:
        if x in bs and x not in out:
            out.append(x)
    return out


def select_drop(df: DataFrame, drop: Sequence[str] = (), keep: Sequence[str] | None = None) -> DataFrame:
    """``select(all_of(keep))`` then ``select(-drop)``."""
    if keep is not None:
        df = df.select(*keep)
    return df.drop(*drop)


def type_profile(df: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    """Per R class the number of columns and of their values present (one aggregate pass)."""
    classes = {f.name: r_class(f.dataType) for f in df.schema.fields if f.name not in exclude}
    wide = df.agg(*[F.count(F.col(c)).alias(c) for c in classes])
    long = wide.unpivot([], list(classes), "_column", "_present")
    kind = F.create_map(*[F.lit(x) for pair in classes.items() for x in pair])
    return long.groupBy(F.element_at(kind, F.col("_column")).alias("Data_Type")).agg(
        F.count(F.lit(1)).alias("Count"), F.sum("_present").alias("Present"))


def dictionary_filter(dictionary: DataFrame, table: str, description: str | None = None,
                    special: str | None = None) -> DataFrame:
    """Dictionary rows of one table with a given description or tag."""
    cond = F.col("Table") == table
    if description is not None:
        cond = cond & (F.col("Description") == description)
    if special is not None:
        cond = cond & (F.col("Special") == special)
    return dictionary.where(cond).select("Row")


def dict_select(dictionary: DataFrame, table: str, description: str,
                exclude: Sequence[str] = ()) -> list[str]:
    """``filter(...) |> pull(Row) |> setdiff(exclude)``.

    The dictionary has one row per column of a table, so the collected list
    is bounded by the table's width.
    """
    rows = [r["Row"] for r in dictionary_filter(dictionary, table, description).collect()]
    return setdiff(rows, exclude)
