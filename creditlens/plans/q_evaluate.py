"""Queries R1-R3 and M1, M13-M22: sampling, evaluation, decisions, fairness.

All of them run on ``scored_rows``: the labelled clients with a
deterministic md5-derived default probability, so every report is
oracle-checkable without a learned model.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from creditlens.functions import scalar
from creditlens.operators import evaluate, fairness, impute, profile, sampling
from creditlens.operators.columns import numeric_columns
from creditlens.plans.oracle_sql import APP_DOUBLES, rnd, rounded, with_fixtures
from creditlens.plans.q_features import STATS_CTE
from creditlens.plans.registry import query
from creditlens.sources import fixtures
from creditlens.sources.tables import Tables

U = "('0x' || substr(md5(CAST(SK_ID_CURR AS VARCHAR) || ':42'), 1, 8))::BIGINT / 4294967296.0::DOUBLE"


def _scored(spark, sf):
    return fixtures.scored_rows(Tables(spark, sf))


def _some_scored(spark, sf):
    return _scored(spark, sf).withColumn("p_default", F.when(F.col("SK_ID_CURR") % 37 != 0, F.col("p_default")))


def _train(spark, sf):
    return fixtures.application_train(Tables(spark, sf))


@query("kfold_assign", with_fixtures(["train"],
    f"SELECT SK_ID_CURR, TARGET, CAST((row_number() OVER (ORDER BY {U}, SK_ID_CURR) - 1) % 3 + 1 AS INTEGER) "
    "AS fold FROM train"))
def q_kfold_assign(spark, sf):
    """R1 + F3: three balanced seeded folds."""
    return sampling.kfold_assign(_train(spark, sf), "SK_ID_CURR", 3, 42).select("SK_ID_CURR", "TARGET", "fold")


@query("stratified_split", with_fixtures(["train"],
    "SELECT SK_ID_CURR, TARGET, CASE WHEN row_number() OVER (PARTITION BY TARGET ORDER BY "
    f"{U}, SK_ID_CURR) - 1 < ceil(0.8 * count(*) OVER (PARTITION BY TARGET)) THEN 'train' "
    "ELSE 'validation' END AS split FROM (SELECT SK_ID_CURR, "
    "CASE WHEN SK_ID_CURR % 41 <> 0 THEN TARGET END AS TARGET FROM train)"))
def q_stratified_split(spark, sf):
    """R2 + J5: exact 80/20 split within each class; some rows have no label."""
    rows = _train(spark, sf).withColumn("TARGET", F.when(F.col("SK_ID_CURR") % 41 != 0, F.col("TARGET")))
    return sampling.stratified_split(rows, "SK_ID_CURR", "TARGET", 0.8, 42) \
        .select("SK_ID_CURR", "TARGET", "split")


@query("sample_n", with_fixtures(["train"],
    f"SELECT SK_ID_CURR, TARGET FROM train ORDER BY {U}, SK_ID_CURR LIMIT 60"))
def q_sample_n(spark, sf):
    """Seeded sample of 60 rows."""
    return sampling.sample_n(_train(spark, sf), "SK_ID_CURR", 60, 42).select("SK_ID_CURR", "TARGET")


_AUC_SQL = ("SELECT (sum(r) FILTER (WHERE TARGET = 1) - n1 * (n1 + 1) / 2.0) / (n1 * n0) AS auc FROM ("
            "SELECT TARGET, rank() OVER (ORDER BY p_default) + (count(*) OVER (PARTITION BY p_default) - 1) / 2.0 "
            "AS r, count(*) FILTER (WHERE TARGET = 1) OVER () AS n1, count(*) FILTER (WHERE TARGET = 0) OVER () "
            "AS n0 FROM scored) GROUP BY n1, n0")


@query("roc_auc", with_fixtures(["scored"], rounded(_AUC_SQL, ["auc"])))
def q_roc_auc(spark, sf):
    """M13 + W4: exact ROC AUC with mid-ranks (scores have ties)."""
    return evaluate.roc_auc(_scored(spark, sf), "p_default", "TARGET")


@query("majority_baseline", with_fixtures(["train"], rounded(
    "SELECT 'Baseline Accuracy' AS Metric, avg(CAST(TARGET = 0 AS DOUBLE)) AS Value FROM train "
    "UNION ALL SELECT 'Baseline AUC', (sum(r) FILTER (WHERE TARGET = 1) - n1 * (n1 + 1) / 2.0) / (n1 * n0) FROM ("
    "SELECT TARGET, (count(*) OVER () + 1) / 2.0 AS r, count(*) FILTER (WHERE TARGET = 1) OVER () AS n1, "
    "count(*) FILTER (WHERE TARGET = 0) OVER () AS n0 FROM train) GROUP BY n1, n0", ["Value"])))
def q_majority_baseline(spark, sf):
    """M1 + A27: majority-class accuracy and the AUC of a constant score."""
    return evaluate.majority_baseline(_train(spark, sf), "TARGET")


@query("sens_spec", with_fixtures(["scored"], rounded(
    f"SELECT ({_AUC_SQL}) AS ROC, "
    "count(*) FILTER (WHERE p_default >= 0.5 AND TARGET = 1) / count(*) FILTER (WHERE TARGET = 1) AS Sens, "
    "count(*) FILTER (WHERE p_default < 0.5 AND TARGET = 0) / count(*) FILTER (WHERE TARGET = 0) AS Spec "
    "FROM scored", ["ROC", "Sens", "Spec"])))
def q_sens_spec(spark, sf):
    """twoClassSummary (ROC AUC, sensitivity, specificity at 0.5)."""
    return evaluate.sens_spec(_scored(spark, sf), "p_default", "TARGET", 0.5)


@query("confusion_metrics", with_fixtures(["scored"], rounded(
    "SELECT tn, fp, fn, tp, (tp + tn) / (tp + tn + fp + fn) AS accuracy, tp / NULLIF(tp + fp, 0) AS precision, "
    "tp / NULLIF(tp + fn, 0) AS recall, (tn + fn) / (tp + tn + fp + fn) AS approval_rate FROM ("
    "SELECT count(*) FILTER (WHERE p_default < 0.65 AND TARGET = 0) AS tn, "
    "count(*) FILTER (WHERE p_default >= 0.65 AND TARGET = 0) AS fp, "
    "count(*) FILTER (WHERE p_default < 0.65 AND TARGET = 1) AS fn, "
    "count(*) FILTER (WHERE p_default >= 0.65 AND TARGET = 1) AS tp FROM scored)",
    ["accuracy", "precision", "recall", "approval_rate"])))
def q_confusion_metrics(spark, sf):
    """M15 + Q14: confusion matrix and rates at 0.65; approval rate computed."""
    return evaluate.confusion_metrics(_scored(spark, sf), "p_default", "TARGET", 0.65)


# some clients have no score
SWEEP = ("partly AS (SELECT TARGET, CASE WHEN SK_ID_CURR % 37 <> 0 THEN p_default END AS p_default FROM scored),\n"
         "sweep AS (SELECT CAST(k AS DOUBLE) / 100 AS threshold, "
         "CAST(100 AS DOUBLE) * count(*) FILTER (WHERE p_default < CAST(k AS DOUBLE) / 100) / count(*) AS approval_rate, "
         "count(*) FILTER (WHERE p_default < CAST(k AS DOUBLE) / 100 AND TARGET = 0) AS good_approved, "
         "count(*) FILTER (WHERE p_default < CAST(k AS DOUBLE) / 100 AND TARGET = 1) AS bad_approved, "
         "count(*) AS n FROM (SELECT range AS k FROM range(1, 100)) AS grid, partly GROUP BY k),\n"
         "sweep2 AS (SELECT threshold, approval_rate, good_approved, bad_approved, "
         "good_approved * CAST(0.12 AS DOUBLE) + bad_approved * CAST(-0.60 AS DOUBLE) AS profit, "
         "(good_approved * CAST(0.12 AS DOUBLE) + bad_approved * CAST(-0.60 AS DOUBLE)) / n AS profit_per_applicant "
         "FROM sweep)")
_SWEEP_D = ["threshold", "approval_rate", "profit", "profit_per_applicant"]


@query("threshold_sweep", with_fixtures(["scored"], rounded("SELECT * FROM sweep2", _SWEEP_D), [SWEEP]))
def q_threshold_sweep(spark, sf):
    """M17 + J6 + X15: 99-threshold profit sweep (approve iff p < t)."""
    return evaluate.threshold_sweep(_some_scored(spark, sf), "p_default", "TARGET")


@query("top_thresholds", with_fixtures(["scored"], rounded(
    "SELECT threshold, printf('%.2f%%', approval_rate) AS approval_rate, good_approved, bad_approved, profit, "
    "profit = (SELECT max(profit) FROM sweep2) AS is_max_profit "
    "FROM (SELECT * FROM sweep2 ORDER BY profit DESC, threshold LIMIT 10)", ["threshold", "profit"]), [SWEEP]))
def q_top_thresholds(spark, sf):
    """M18 + L3 + L4 + X13: top ten thresholds by profit."""
    return evaluate.top_thresholds(evaluate.threshold_sweep(_some_scored(spark, sf), "p_default", "TARGET"))


@query("optimal_threshold", with_fixtures(["scored"], rounded(
    "SELECT threshold AS optimal_threshold, profit_per_applicant FROM sweep2 "
    "ORDER BY profit_per_applicant DESC, threshold LIMIT 1",
    ["optimal_threshold", "profit_per_applicant"]), [SWEEP]))
def q_optimal_threshold(spark, sf):
    """M19 + L5: profit-maximising threshold (first on ties)."""
    return evaluate.optimal_threshold(evaluate.threshold_sweep(_some_scored(spark, sf), "p_default", "TARGET"))


@query("threshold_sensitivity", with_fixtures(["scored"], rounded(
    "SELECT CAST(round(s.threshold * 100) - round(o.threshold * 100) AS INTEGER) AS offset_steps, "
    "s.threshold, s.profit_per_applicant FROM sweep2 s, (SELECT threshold FROM sweep2 "
    "ORDER BY profit_per_applicant DESC, threshold LIMIT 1) o "
    "WHERE round(s.threshold * 100) - round(o.threshold * 100) IN (-5, 0, 5)",
    ["threshold", "profit_per_applicant"]), [SWEEP]))
def q_threshold_sensitivity(spark, sf):
    """Profit per applicant at the optimum and 0.05 either side."""
    return evaluate.threshold_sensitivity(evaluate.threshold_sweep(_some_scored(spark, sf), "p_default", "TARGET"))


_AGE = "abs(DAYS_BIRTH) / 365"
_BIN = (f"COALESCE(labels[CASE WHEN {_AGE} >= e[1] AND {_AGE} <= e[2] THEN 1 WHEN {_AGE} > e[2] AND {_AGE} <= e[3] "
        f"THEN 2 WHEN {_AGE} > e[3] AND {_AGE} <= e[4] THEN 3 WHEN {_AGE} > e[4] AND {_AGE} <= e[5] THEN 4 END], "
        "labels[mode_bin])")


@query("approval_by_group", with_fixtures(["scored"], rounded(
    "WITH s AS (SELECT CAST(p_default < 0.65 AS DOUBLE) AS a, CODE_GENDER, NAME_EDUCATION_TYPE, "
    f"{_BIN} AS AGE_BIN FROM scored CROSS JOIN stats) "
    + " UNION ALL ".join(f"SELECT '{g}' AS \"group\", {g} AS level, avg(a) * 100 AS Approval_Rate, "
                         f"count(*) AS n FROM s GROUP BY {g}"
                         for g in ["CODE_GENDER", "NAME_EDUCATION_TYPE", "AGE_BIN"]),
    ["Approval_Rate"]), [STATS_CTE]))
def q_approval_by_group(spark, sf):
    """Approval rate and count by gender, education and age bin at 0.65."""
    t = Tables(spark, sf)
    stats = impute.fit_age_bins(fixtures.application_train(t))
    age = scalar.days_to_years("DAYS_BIRTH")
    scored = _scored(spark, sf).withColumn("AGE_BIN", F.coalesce(
        scalar.right_closed_bin_label(age, stats.age_edges, stats.age_labels), F.lit(stats.age_mode_label)))
    return fairness.approval_by_group(scored, "p_default", ["CODE_GENDER", "NAME_EDUCATION_TYPE", "AGE_BIN"])


def _map_values_sql() -> str:
    rows = ", ".join("('{}', '{}', '{}', {})".format(f, i.replace("'", "''"), r.replace("'", "''"),
                                                    "true" if a else "false")
                     for f, i, r, a in fairness.ADVERSE_ACTION_MAP)
    return f"(VALUES {rows}) AS m(Feature, Interpretation, Reason, allowed)"


@query("adverse_action_map", with_fixtures(["train"],
    "SELECT c.Predictor, c.Correlation_with_Target, m.Interpretation, "
    "CASE WHEN c.Predictor = 'CODE_GENDER' THEN NULL ELSE m.Reason END AS Reason, "
    "COALESCE(m.allowed, c.Predictor <> 'CODE_GENDER') AS allowed FROM ("
    + " UNION ALL ".join(f"SELECT '{c}' AS Predictor, {rnd(rnd(f'corr({c}, CAST(TARGET AS DOUBLE))', 9), 4)} "
                         "AS Correlation_with_Target FROM train" for c in APP_DOUBLES)
    + f" UNION ALL SELECT 'EXT_SOURCE_1_missing', "
      f"{rnd(rnd('corr(CAST(EXT_SOURCE_1 IS NULL AS DOUBLE), CAST(TARGET AS DOUBLE))', 9), 4)} FROM train"
    + f") AS c LEFT JOIN {_map_values_sql()} ON c.Predictor = m.Feature"))
def q_adverse_action_map(spark, sf):
    """M22 + J7: ranked predictors mapped to adverse-action reasons; protected ones withheld.

    A missing flag is a predictor of its own and has no reason.
    """
    train = impute.missing_flags(_train(spark, sf), ["EXT_SOURCE_1"])
    imp = profile.target_corr(train, "TARGET", numeric_columns(train, exclude=["TARGET", "SK_ID_CURR"]))
    return fairness.adverse_action_map(imp, spark, feature="Predictor")
