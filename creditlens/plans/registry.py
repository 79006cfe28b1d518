"""Query registry: name -> (spark, sf_dir) -> DataFrame, and name -> oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from creditlens.functions.aggs import round_frame

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def query(name: str, oracle: str | None = None, rounded: bool = True):
    """Register a query; its result gets the report rounding of double columns."""

    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            df = fn(spark, sf_dir)
            return round_frame(df) if rounded else df

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        run.__module__ = fn.__module__
        run.__wrapped__ = fn
        QUERIES[name] = run
        if oracle is not None:
            ORACLE[name] = oracle
        return fn

    return deco


def load_all() -> None:
    """Import every query module so that its queries register."""
    from creditlens.plans import (  # noqa: F401
        q_history, q_features, q_profile, q_eda, q_evaluate, q_model,
    )
