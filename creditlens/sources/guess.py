"""Column types of a CSV without a declared schema.

A type is a lattice element: void (no value), boolean, bigint, double, date,
timestamp, string.  One aggregate over (column, value) pairs keeps, per
column, which types every value so far fits; flags of two parts merge by
AND, so the pass is pre-aggregated per task and its result has one row per
column.  The narrowest type that all values fit is taken, from all rows (a
prefix of the file decides nothing).  ``misfits`` counts, against a declared
schema, the values that do not fit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# fixed values: what a value of each type looks like, narrowest type first
LOOKS = {
    "boolean": r"^(TRUE|FALSE|T|F|true|false)$",
    "bigint": r"^[+-]?[0-9]{1,18}$",
    "double": r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]{1,3})?$",
    "date": r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$",
    "timestamp": r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([T ][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,6})?)?Z?)?$",
}


def fits(value: Column, kind: str) -> Column:
    """Whether a text is a value of the type (days and times must exist); NULL for NULL."""
    looks = value.rlike(LOOKS[kind])
    if kind in ("date", "timestamp"):
        return F.when(value.isNotNull(), looks & value.try_cast(kind).isNotNull())
    return looks


def read_text(spark: SparkSession, path: str) -> DataFrame:
    """All columns as text; ``NA`` and the empty field are missing."""
    df = spark.read.option("header", True).option("nullValue", "NA").option("inferSchema", False).csv(path)
    return df.select(*[F.when(F.col(f"`{c}`") != "", F.col(f"`{c}`")).alias(c) for c in df.columns])


def guess_types(text: DataFrame) -> DataFrame:
    """(column, type, n_values, n_missing), one row per column of a frame of texts."""
    long = text.unpivot([], list(text.columns), "column", "value")
    flags = long.groupBy("column").agg(
        F.count("value").alias("n_values"), F.sum(F.col("value").isNull().cast("long")).alias("n_missing"),
        *[F.bool_and(fits(F.col("value"), k)).alias(k) for k in LOOKS])
    kind = F.when(F.col("n_values") == 0, F.lit("void"))
    for k in LOOKS:
        kind = kind.when(F.col(k), F.lit(k))
    return flags.select("column", kind.otherwise(F.lit("string")).alias("type"), "n_values", "n_missing")


def guess_schema(text: DataFrame) -> T.StructType:
    """The guessed schema in column order (a column without a value is text); one row per column is collected."""
    got = {r["column"]: r["type"] for r in guess_types(text).collect()}
    kinds = {c: got.get(c, "void") for c in text.columns}
    return T.StructType([T.StructField(c, T.StringType() if k in ("void", "string")
                                       else T._parse_datatype_string(k)) for c, k in kinds.items()])


def misfits(text: DataFrame, schema: T.StructType) -> DataFrame:
    """(column, expected, actual, n): texts that are no value of their declared type, with their counts."""
    names = {"int": "bigint", "smallint": "bigint", "tinyint": "bigint", "float": "double"}
    parts = []
    for f in schema.fields:
        kind = f.dataType.simpleString()
        kind = names.get(kind, kind)
        if kind in LOOKS and f.name in text.columns:
            parts.append(F.when(~fits(F.col(f"`{f.name}`"), kind), F.struct(
                F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("expected"),
                F.col(f"`{f.name}`").alias("actual"))))
    if not parts:
        return text.sparkSession.createDataFrame([], "column string, expected string, actual string, n long")
    return text.select(F.explode(F.array_compact(F.array(*parts))).alias("m")).select("m.*") \
        .groupBy("column", "expected", "actual").agg(F.count(F.lit(1)).alias("n"))
