"""Queries D16-D22: the profiling notebook's single-level client aggregates."""

from __future__ import annotations

from creditlens.operators import columns, eda, profile
from creditlens.plans.oracle_sql import APP_DOUBLES, rnd, rounded, with_fixtures
from creditlens.plans.registry import query
from creditlens.sources import fixtures
from creditlens.sources.tables import Tables

EDA_POS = """eda_pos AS (SELECT SK_ID_CURR, count(DISTINCT SK_ID_PREV) AS POS_CASH_LOANS,
  count(*) AS MONTHS_HISTORY, avg(CNT_INSTALMENT) AS CNT_INSTALMENT_MEAN,
  avg(CNT_INSTALMENT_FUTURE) AS CNT_INSTALMENT_FUTURE_MEAN, avg(SK_DPD) AS SK_DPD_MEAN,
  avg(SK_DPD_DEF) AS SK_DPD_DEF_MEAN FROM pos GROUP BY SK_ID_CURR)"""
EDA_POS_D = ["CNT_INSTALMENT_MEAN", "CNT_INSTALMENT_FUTURE_MEAN", "SK_DPD_MEAN", "SK_DPD_DEF_MEAN"]

EDA_BB = """bb_months AS (SELECT SK_ID_BUREAU, count(*) AS MONTHS_BUREAU FROM bb GROUP BY SK_ID_BUREAU),
bb_mode AS (SELECT SK_ID_BUREAU, STATUS FROM bb WHERE STATUS IS NOT NULL GROUP BY SK_ID_BUREAU, STATUS
  QUALIFY row_number() OVER (PARTITION BY SK_ID_BUREAU ORDER BY count(*) DESC, STATUS) = 1),
eda_bb AS (SELECT SK_ID_BUREAU, MONTHS_BUREAU, bb_mode.STATUS AS STATUS_MOST_COMMON
  FROM bb_months LEFT JOIN bb_mode USING (SK_ID_BUREAU))"""

EDA_BUREAU = EDA_BB + """,
eda_bureau AS (SELECT SK_ID_CURR, count(DISTINCT SK_ID_BUREAU) AS BUREAU_CREDITS,
  count(*) FILTER (WHERE CREDIT_ACTIVE = 'Active') AS CREDIT_ACTIVE_COUNT,
  COALESCE(sum(AMT_CREDIT_SUM), 0) AS AMT_CREDIT_SUM,
  COALESCE(sum(AMT_CREDIT_SUM_OVERDUE), 0) AS AMT_CREDIT_SUM_OVERDUE,
  max(AMT_CREDIT_MAX_OVERDUE) AS AMT_CREDIT_MAX_OVERDUE, avg(MONTHS_BUREAU) AS MONTHS_BUREAU_MEAN
  FROM bureau LEFT JOIN eda_bb USING (SK_ID_BUREAU) GROUP BY SK_ID_CURR)"""
EDA_BUREAU_D = ["AMT_CREDIT_SUM", "AMT_CREDIT_SUM_OVERDUE", "AMT_CREDIT_MAX_OVERDUE", "MONTHS_BUREAU_MEAN"]

EDA_CARD = """eda_card AS (SELECT SK_ID_CURR, count(DISTINCT SK_ID_PREV) AS CC_LOANS, count(*) AS MONTHS_CC,
  avg(AMT_BALANCE) AS AMT_BALANCE_MEAN, avg(AMT_CREDIT_LIMIT_ACTUAL) AS AMT_CREDIT_LIMIT_MEAN,
  avg(AMT_PAYMENT_CURRENT) AS AMT_PAYMENT_MEAN, avg(SK_DPD) AS SK_DPD_MEAN,
  avg(SK_DPD_DEF) AS SK_DPD_DEF_MEAN FROM cc GROUP BY SK_ID_CURR)"""
EDA_CARD_D = ["AMT_BALANCE_MEAN", "AMT_CREDIT_LIMIT_MEAN", "AMT_PAYMENT_MEAN", "SK_DPD_MEAN",
              "SK_DPD_DEF_MEAN"]

EDA_PREV = """eda_prev AS (SELECT SK_ID_CURR, count(*) AS NUM_PREV_APPS,
  avg(AMT_APPLICATION) AS AMT_APPLICATION_MEAN, avg(AMT_CREDIT) AS AMT_CREDIT_MEAN,
  count(*) FILTER (WHERE NAME_CONTRACT_STATUS = 'Approved') AS NUM_APPROVED,
  count(*) FILTER (WHERE NAME_CONTRACT_STATUS = 'Refused') AS NUM_REFUSED FROM prev GROUP BY SK_ID_CURR)"""
EDA_PREV_D = ["AMT_APPLICATION_MEAN", "AMT_CREDIT_MEAN"]

EDA_INST = """eda_inst AS (SELECT SK_ID_CURR, count(*) AS NUM_INSTALLMENTS,
  COALESCE(sum(AMT_INSTALMENT), 0) AS AMT_INSTALMENT_TOTAL, COALESCE(sum(AMT_PAYMENT), 0) AS AMT_PAYMENT_TOTAL,
  avg(DAYS_ENTRY_PAYMENT - DAYS_INSTALMENT) AS DAYS_LATE_MEAN FROM install GROUP BY SK_ID_CURR)"""
EDA_INST_D = ["AMT_INSTALMENT_TOTAL", "AMT_PAYMENT_TOTAL", "DAYS_LATE_MEAN"]


def _t(spark, sf):
    return Tables(spark, sf)


@query("eda_pos_client", with_fixtures(["pos"], rounded("SELECT * FROM eda_pos", EDA_POS_D), [EDA_POS]))
def q_eda_pos_client(spark, sf):
    """Row-weighted POS means per client."""
    return eda.eda_pos_client(fixtures.pos_cash(_t(spark, sf)))


@query("eda_bb_credit", with_fixtures(["bb"], "SELECT * FROM eda_bb", [EDA_BB]))
def q_eda_bb_credit(spark, sf):
    """D17 + A17: months and most common status per bureau credit."""
    return eda.eda_bb_credit(fixtures.bureau_balance(_t(spark, sf)))


@query("eda_bureau_client", with_fixtures(["bureau", "bb"], rounded("SELECT * FROM eda_bureau", EDA_BUREAU_D),
                                          [EDA_BUREAU]))
def q_eda_bureau_client(spark, sf):
    """D18 + J2 + A6-A10: bureau summary per client."""
    t = _t(spark, sf)
    return eda.eda_bureau_client(fixtures.bureau(t), fixtures.bureau_balance(t))


@query("eda_card_client", with_fixtures(["cc"], rounded("SELECT * FROM eda_card", EDA_CARD_D), [EDA_CARD]))
def q_eda_card_client(spark, sf):
    """Card summary per client."""
    return eda.eda_card_client(fixtures.credit_card_balance(_t(spark, sf)))


@query("eda_prev_client", with_fixtures(["prev"], rounded("SELECT * FROM eda_prev", EDA_PREV_D), [EDA_PREV]))
def q_eda_prev_client(spark, sf):
    """Previous applications summary per client."""
    return eda.eda_prev_client(fixtures.previous_application(_t(spark, sf)))


@query("eda_install_client", with_fixtures(["install"], rounded("SELECT * FROM eda_inst", EDA_INST_D),
                                           [EDA_INST]))
def q_eda_install_client(spark, sf):
    """Instalment totals and mean lateness per client."""
    return eda.eda_install_client(fixtures.installments(_t(spark, sf)))


_AUG_SQL = """SELECT train.*,
  p.* EXCLUDE (SK_ID_CURR, SK_DPD_MEAN, SK_DPD_DEF_MEAN), p.SK_DPD_MEAN AS SK_DPD_MEAN_x,
  p.SK_DPD_DEF_MEAN AS SK_DPD_DEF_MEAN_x, b.* EXCLUDE (SK_ID_CURR),
  c.* EXCLUDE (SK_ID_CURR, SK_DPD_MEAN, SK_DPD_DEF_MEAN), c.SK_DPD_MEAN AS SK_DPD_MEAN_y,
  c.SK_DPD_DEF_MEAN AS SK_DPD_DEF_MEAN_y, pr.* EXCLUDE (SK_ID_CURR), i.* EXCLUDE (SK_ID_CURR)
FROM train LEFT JOIN eda_pos p USING (SK_ID_CURR) LEFT JOIN eda_bureau b USING (SK_ID_CURR)
  LEFT JOIN eda_card c USING (SK_ID_CURR) LEFT JOIN eda_prev pr USING (SK_ID_CURR)
  LEFT JOIN eda_inst i USING (SK_ID_CURR)"""
_AUG_D = (APP_DOUBLES + ["CNT_INSTALMENT_MEAN", "CNT_INSTALMENT_FUTURE_MEAN", "SK_DPD_MEAN_x",
                         "SK_DPD_DEF_MEAN_x", "SK_DPD_MEAN_y", "SK_DPD_DEF_MEAN_y"]
          + EDA_BUREAU_D + EDA_CARD_D[:3] + EDA_PREV_D + EDA_INST_D)


@query("eda_augment", with_fixtures(["train", "pos", "bureau", "bb", "cc", "prev", "install"],
                                    rounded(_AUG_SQL, _AUG_D),
                                    [EDA_POS, EDA_BUREAU, EDA_CARD, EDA_PREV, EDA_INST]))
def q_eda_augment(spark, sf):
    """D22 + J4: training rows joined to the five summaries; clashing names suffixed."""
    t = _t(spark, sf)
    return _augmented(t, fixtures.application_train(t))


_AUG_TABLES = ["pos", "bureau", "bb", "cc", "prev", "install"]
_AUG_CTES = [EDA_POS, EDA_BUREAU, EDA_CARD, EDA_PREV, EDA_INST, f"aug AS ({_AUG_SQL})"]
_COUNTS = ["POS_CASH_LOANS", "MONTHS_HISTORY", "BUREAU_CREDITS", "CREDIT_ACTIVE_COUNT", "CC_LOANS", "MONTHS_CC",
           "NUM_PREV_APPS", "NUM_APPROVED", "NUM_REFUSED", "NUM_INSTALLMENTS"]
_AUG_NUMERIC = _AUG_D + _COUNTS


def _augmented(t, app):
    return eda.eda_augment(
        app, eda.eda_pos_client(fixtures.pos_cash(t)),
        eda.eda_bureau_client(fixtures.bureau(t), fixtures.bureau_balance(t)),
        eda.eda_card_client(fixtures.credit_card_balance(t)),
        eda.eda_prev_client(fixtures.previous_application(t)),
        eda.eda_install_client(fixtures.installments(t)))


@query("eda_augment_test", with_fixtures(["test", *_AUG_TABLES], rounded(
    _AUG_SQL.replace("train.*", "test.*").replace("FROM train", "FROM test"), _AUG_D), _AUG_CTES[:-1]))
def q_eda_augment_test(spark, sf):
    """The unlabelled rows joined to the five summaries."""
    t = _t(spark, sf)
    return _augmented(t, fixtures.application_test(t))


@query("target_corr_augmented", with_fixtures(["train", *_AUG_TABLES], " UNION ALL ".join(
    f"SELECT '{c}' AS Predictor, {rnd(rnd(f'CASE WHEN stddev_pop({c}) > 0 THEN corr({c}, CAST(TARGET AS DOUBLE)) END', 9), 4)} AS Correlation_with_Target "
    f"FROM aug" for c in _AUG_NUMERIC), _AUG_CTES))
def q_target_corr_augmented(spark, sf):
    """Correlations with the label over the augmented frame."""
    t = _t(spark, sf)
    train = _augmented(t, fixtures.application_train(t))
    return profile.target_corr(train, "TARGET", columns.numeric_columns(train, exclude=["TARGET", "SK_ID_CURR"]))


_BOX_AUG = ["AMT_CREDIT_SUM", "NUM_REFUSED", "DAYS_LATE_MEAN", "AMT_BALANCE_MEAN", "MONTHS_BUREAU_MEAN"]


@query("box_stats_augmented", with_fixtures(["train", *_AUG_TABLES], rounded(
    "SELECT variable, TARGET, q1, median, q3, "
    "min(value) FILTER (WHERE value >= q1 - 1.5 * (q3 - q1)) AS lower_whisker, "
    "max(value) FILTER (WHERE value <= q3 + 1.5 * (q3 - q1)) AS upper_whisker, "
    "count(*) FILTER (WHERE value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)) AS n_outliers, "
    "count(*) AS n FROM long JOIN q USING (variable, TARGET) GROUP BY variable, TARGET, q1, median, q3",
    ["q1", "median", "q3", "lower_whisker", "upper_whisker"]), _AUG_CTES + [
        "long AS (" + " UNION ALL ".join(
            f"SELECT '{c}' AS variable, TARGET, CAST({c} AS DOUBLE) AS value FROM aug WHERE {c} IS NOT NULL"
            for c in _BOX_AUG) + ")",
        "q AS (SELECT variable, TARGET, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median, "
        "quantile_cont(value, 0.75) AS q3 FROM long GROUP BY variable, TARGET)"]))
def q_box_stats_augmented(spark, sf):
    """Box-plot statistics of history summaries by class."""
    t = _t(spark, sf)
    return profile.box_stats(_augmented(t, fixtures.application_train(t)), _BOX_AUG, "TARGET")


@query("join_suffix", with_fixtures(["pos", "cc"], rounded(
    "SELECT SK_ID_CURR, p.* EXCLUDE (SK_ID_CURR, SK_DPD_MEAN, SK_DPD_DEF_MEAN), "
    "p.SK_DPD_MEAN AS SK_DPD_MEAN_x, p.SK_DPD_DEF_MEAN AS SK_DPD_DEF_MEAN_x, "
    "c.* EXCLUDE (SK_ID_CURR, SK_DPD_MEAN, SK_DPD_DEF_MEAN), c.SK_DPD_MEAN AS SK_DPD_MEAN_y, "
    "c.SK_DPD_DEF_MEAN AS SK_DPD_DEF_MEAN_y FROM eda_pos p LEFT JOIN eda_card c USING (SK_ID_CURR)",
    ["CNT_INSTALMENT_MEAN", "CNT_INSTALMENT_FUTURE_MEAN", "SK_DPD_MEAN_x", "SK_DPD_DEF_MEAN_x",
     "SK_DPD_MEAN_y", "SK_DPD_DEF_MEAN_y"] + EDA_CARD_D[:3]), [EDA_POS, EDA_CARD]))
def q_join_suffix(spark, sf):
    """Both sides carry SK_DPD_MEAN / SK_DPD_DEF_MEAN; both kept as _x / _y."""
    from creditlens.operators.joins import suffix_join
    t = _t(spark, sf)
    return suffix_join(eda.eda_pos_client(fixtures.pos_cash(t)),
                       eda.eda_card_client(fixtures.credit_card_balance(t)), "SK_ID_CURR", "left")
