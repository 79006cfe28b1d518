"""Readers for the driver tables and CSV sources (S1), plus sinks.

Every reader returns a lazy DataFrame; column pruning and filter pushdown
reach the Parquet scan because nothing here forces a projection of all
columns or an action.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                 "events", "documents", "embeddings", "pages", "benchmark", "labels",
                 "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


class Tables:
    """Lazy accessor: ``Tables(spark, dir).orders`` reads orders.parquet once, NaN as NULL."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._cache: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in DRIVER_TABLES:
            raise AttributeError(name)
        if name not in self._cache:
            self._cache[name] = nan_to_null(read_table(self.spark, self.sf_dir, name))
        return self._cache[name]


def nan_to_null(df: DataFrame) -> DataFrame:
    """R treats NaN as NA; Spark aggregates propagate NaN.  Normalise at ingest."""
    exprs = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            exprs.append(F.when(F.isnan(F.col(f.name)), F.lit(None)).otherwise(F.col(f.name))
                         .cast(f.dataType).alias(f.name))
        else:
            exprs.append(F.col(f.name))
    return df.select(*exprs)


def read_csv_na(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """CSV with a header where ``NA`` and the empty field are missing.

    A declared schema is preferred (no inference pass over the data); when it
    is absent the schema is inferred, and ``nullValue="NA"`` keeps a numeric
    column with ``NA`` tokens numeric.
    """
    reader = spark.read.option("header", True).option("nullValue", "NA")
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", True)
    return nan_to_null(reader.csv(path))


def write_csv_na(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """S3: CSV sink with a header; NULL written as ``NA`` like the reference."""
    (df.write.mode(mode).option("header", True).option("nullValue", "NA")
       .option("emptyValue", "").csv(path))
