"""Physical-plan properties that matter at scale."""

import re

from conftest import SF001
from creditlens.operators import evaluate, history, sampling
from creditlens.sources import fixtures
from creditlens.sources.tables import Tables


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_two_level_aggregation_is_partial_before_shuffle(spark):
    plan = _plan(history.pos_client(fixtures.pos_cash(Tables(spark, SF001))))
    # map-side combine: partial aggregates run before each exchange
    assert "partial_avg" in plan and "partial_max" in plan and "partial_count" in plan


def test_scan_reads_only_needed_columns(spark):
    df = history.pos_client(fixtures.pos_cash(Tables(spark, SF001)))
    text = df._jdf.queryExecution().toString()
    li = [s for s in re.findall(r"ReadSchema: struct<([^>]*)>", text) if "l_orderkey" in s]
    assert li, text[:2000]
    # POS rows need quantity, flags and line number only: prices and dates are pruned
    assert all("l_extendedprice" not in s and "l_shipdate" not in s for s in li)
    # POS rows come from every order: its scan reads the two keys only and filters nothing but NULL keys
    orders = [s for s in re.findall(r"ReadSchema: struct<([^>]*)>", text) if "o_orderkey" in s]
    assert orders and all(set(x.split(":")[0] for x in s.split(",")) == {"o_orderkey", "o_custkey"} for s in orders)
    assert "o_orderpriority" not in "".join(re.findall(r"PushedFilters: \[([^\]]*)\]", text))


def test_no_single_partition_window_over_rows(spark):
    """Global order uses bucketed windows: every window over rows is partitioned."""
    train = fixtures.application_train(Tables(spark, SF001))
    for df in (sampling.kfold_assign(train, "SK_ID_CURR", 3),
               sampling.stratified_split(train, "SK_ID_CURR", "TARGET")):
        plan = _plan(df)
        windows = re.findall(r"Window \[[^\n]*\]", plan)
        row_windows = [w for w in windows if "row_number" in w]
        assert row_windows and all("_bkt" in w for w in row_windows)


def test_train_only_query_filters_history_by_the_split(spark):
    """The train matrix is a filter of the all-clients star join; Catalyst pushes
    the split into the application scan and infers it for the history sides."""
    from creditlens.plans import feature_matrix as fm
    text = fm.build(spark, SF001).train._jdf.queryExecution().optimizedPlan().toString()
    split_filters = re.findall(r"Filter .*% 5\) = 0\)", text)
    assert len(split_filters) >= 3  # customer scan plus history inputs keyed by client


def test_auc_collapses_ties_before_ranking(spark):
    scored = fixtures.scored_rows(Tables(spark, SF001))
    plan = _plan(evaluate.roc_auc(scored, "p_default", "TARGET"))
    assert "HashAggregate" in plan
