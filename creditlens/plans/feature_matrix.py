"""End-to-end feature build: history aggregates -> augment ->
zero-fill -> fit on train -> clean train and test -> recode.

Plan shape: each history table is reduced to one row per client by
``groupBy`` (partial aggregation before every exchange), then joined to the
application rows by ``SK_ID_CURR``.  The five aggregates are hash
partitioned on that key by their final aggregation, so the joins only move
the application side.  The fit is a handful of small aggregate jobs on the
training rows; the transform is projections only.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from creditlens.operators import history, impute, joins, recode
from creditlens.operators.columns import dict_select
from creditlens.session import checkpoint_dir
from creditlens.sources import fixtures
from creditlens.sources.tables import Tables


def client_aggregates(t: Tables) -> list[DataFrame]:
    """The five client-level history aggregates, in the reference's join order."""
    return [
        history.pos_client(fixtures.pos_cash(t)),
        history.bureau_client(fixtures.bureau(t), fixtures.bureau_balance(t)),
        history.card_client(fixtures.credit_card_balance(t)),
        history.prev_app_client(fixtures.previous_application(t)),
        history.install_client(fixtures.installments(t)),
    ]


def raw_applications(t: Tables, aggregates: list[DataFrame] | None = None) -> DataFrame:
    """Application rows joined with the client aggregates, nothing filled: what a saved pipeline scores."""
    return joins.augment_star(fixtures.application(t), client_aggregates(t) if aggregates is None else aggregates)


def augment(app: DataFrame, aggregates: list[DataFrame]) -> DataFrame:
    """Star of five left joins, then zero-fill and HAS flags."""
    return impute.zero_fill_flags(joins.augment_star(app, aggregates))


def building_vars(app: DataFrame) -> list[str]:
    """Numeric building columns named by the dictionary (S2, as a Spark filter)."""
    d = fixtures.data_dictionary(app)
    return dict_select(d, fixtures.APPLICATION_TABLE_NAME, fixtures.BUILDING_DESCRIPTION,
                       exclude=fixtures.BUILDING_CATEGORICAL)


def building_vars_schema_only(app: DataFrame) -> list[str]:
    """Same selection as ``building_vars`` on the schema-sized dictionary rows, without a job."""
    rows = [r[1] for r in fixtures.dictionary_rows(app)
            if r[0] == fixtures.APPLICATION_TABLE_NAME and r[2] == fixtures.BUILDING_DESCRIPTION]
    return [r for r in rows if r not in fixtures.BUILDING_CATEGORICAL]


@dataclass
class FeatureBuild:
    train: DataFrame
    test: DataFrame
    stats: impute.TrainStats
    building: list[str]
    raw: DataFrame  # augmented application rows, nothing filled


def build(spark: SparkSession, sf_dir: str, materialize: bool = False) -> FeatureBuild:
    """Feature matrices for train and test from one pass over the history tables.

    All clients go through the star join and the (row-wise) cleaning
    together; train and test are filters of that one frame, so the five
    history aggregations run once even when both matrices are needed.  A
    query for one side only gets the split filter pushed into the
    application scan by Catalyst.  ``materialize=True`` checkpoints the
    client aggregates and then the combined frame (shared folder) for repeated
    use: no task holds the hash tables and sorts of more than one aggregate,
    nor those beside the joins'.
    """
    t = Tables(spark, sf_dir)
    train_app = fixtures.application_train(t)
    # The fitted statistics read application columns only; the joins do not
    # change the row count, so fitting on the raw training rows is the same.
    stats = impute.fit_train_stats(train_app)
    bvars = building_vars_schema_only(train_app)
    aggregates = client_aggregates(t)
    if materialize:
        checkpoint_dir(spark)  # the session's shared folder (a scratch one only when unset)
        with ThreadPoolExecutor(max_workers=len(aggregates)) as ex:
            aggregates = list(ex.map(lambda a: a.checkpoint(), aggregates))
    raw = raw_applications(t, aggregates)
    everyone = recode.recode_levels(impute.clean_application(impute.zero_fill_flags(raw), stats, bvars))
    if materialize:
        everyone = everyone.checkpoint()
    train = everyone.where(~fixtures.is_test())
    test = everyone.where(fixtures.is_test()).drop("TARGET")
    return FeatureBuild(train, test, stats, bvars, raw)
