"""creditlens: credit-risk feature engineering, profiling and scoring on Spark.

Layout
------
sources/    table readers, fixture views, CSV / Parquet sinks
functions/  Column builders: null-safe aggregates, flags, ratios, bins, hashing
operators/  DataFrame operators: selection, joins, two-level aggregation,
            imputation, recoding, profiling, ranking, sampling, evaluation,
            fairness, modelling
plans/      end-to-end plans (feature matrix, EDA augment) and the query
            registry used by ``__spark_entry__``
streaming/  (the reference has no streaming operators; see README)
"""

from creditlens.session import get_spark, checkpoint_dir  # noqa: F401

__all__ = ["get_spark", "checkpoint_dir"]
