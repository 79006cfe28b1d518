"""Queries M2-M12, M16, R4, S1, S3-S5: learned or file-system operators.

Model outputs are learned, so they get the driver's rows-only check; the
two sink/source round trips are deterministic and have oracles.
"""

from __future__ import annotations

import os
import uuid

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from creditlens.operators import evaluate, fairness, glm, lockstep, modeling, sampling
from creditlens.operators.fairness import adverse_action_map
from creditlens.operators.modeling import ID, LABEL
from creditlens.operators.smote import smote
from creditlens.plans import training
from creditlens.plans.oracle_sql import APP_DOUBLES, rounded, with_fixtures
from creditlens.plans.q_features import _feature_matrix_sql
from creditlens.plans.q_profile import _NON_ID
from creditlens.plans.registry import query
from creditlens.session import checkpoint_dir
from creditlens.sources import fixtures, guess, read_csv_na, write_csv_na
from creditlens.sources.tables import Tables


def _scratch(spark, name: str) -> str:
    """A fresh folder under the shared checkpoint root named by the session."""
    return os.path.join(checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex[:12]}")


def _build(spark, sf):
    return training.feature_build(spark, sf)


@query("scan_csv_na", with_fixtures(["app"], rounded("SELECT * FROM app", APP_DOUBLES)))
def q_scan_csv_na(spark, sf):
    """CSV with NA tokens read back with a declared schema (no inference pass)."""
    app = fixtures.application(Tables(spark, sf))
    path = _scratch(spark, "application-csv")
    write_csv_na(app, path)
    return read_csv_na(spark, path, app.schema)


@query("csv_types", with_fixtures(["app"], " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CASE WHEN count({c}) = 0 THEN 'void' WHEN typeof(any_value({c})) = 'VARCHAR' "
    f"THEN 'string' WHEN typeof(any_value({c})) = 'DOUBLE' THEN 'double' ELSE 'bigint' END AS type, "
    f"count({c}) AS n_values, count(*) - count({c}) AS n_missing FROM app" for c in ["SK_ID_CURR", "TARGET", *_NON_ID])))
def q_csv_types(spark, sf):
    """The narrowest type of every column of a CSV without a schema, from all its rows in one pass."""
    path = _scratch(spark, "application-csv")
    write_csv_na(fixtures.application(Tables(spark, sf)), path)
    return guess.guess_types(guess.read_text(spark, path))


@query("sink_roundtrip", _feature_matrix_sql("train"))
def q_sink_roundtrip(spark, sf):
    """S3: the training feature matrix written as CSV (NA for NULL) and read back."""
    train = _build(spark, sf).train
    path = _scratch(spark, "train-final-csv")
    write_csv_na(train, path)
    return read_csv_na(spark, path, train.schema)


@query("design_matrix")
def q_design_matrix(spark, sf):
    """M2: dummy-coded design matrix (first level dropped) as id + feature array."""
    train = _build(spark, sf).train
    num, cat = modeling.feature_columns(train)
    from pyspark.ml import Pipeline
    design = Pipeline(stages=modeling.design_pipeline(num, cat)).fit(train)
    return design.transform(train).select(ID, LABEL, vector_to_array("features").alias("x"))


def _folds(spark, sf):
    train = _build(spark, sf).train
    return train, *modeling.feature_columns(train)


@query("fit_logistic")
def q_fit_logistic(spark, sf):
    """M3: unpenalised logistic regression; coefficient table."""
    train, num, cat = _folds(spark, sf)
    return modeling.fit(train, modeling.logistic(), num, cat).coefficients(spark)


@query("glm_coefficients")
def q_glm_coefficients(spark, sf):
    """M3: unpenalised logistic regression as glm reports it: aliased columns NULL, standard errors, z values."""
    train, num, cat = _folds(spark, sf)
    from pyspark.ml import Pipeline
    design = Pipeline(stages=modeling.design_pipeline(num, cat)).fit(train)
    names = modeling.FittedModel(design, num, cat, {}, {}).attribute_names()
    blocks = lockstep.pack(design.transform(train).withColumn("tag", F.lit(0)), LABEL, "tag")
    return glm.coefficient_table(spark, glm.fit_glm(blocks, names))


@query("fit_lasso_cv")
def q_fit_lasso_cv(spark, sf):
    """M4: L1 logistic regression, penalty chosen by inner 10-fold CV on log-loss."""
    train, num, cat = _folds(spark, sf)
    return modeling.cv_lasso(train, num, cat).coefficients(spark)


@query("fit_forest")
def q_fit_forest(spark, sf):
    """M5: random forest with 200 trees; feature importances."""
    train, num, cat = _folds(spark, sf)
    m = modeling.fit(train, modeling.forest(200, 42), num, cat)
    imp = m.model.stages[-1].featureImportances.toArray().tolist()
    names = m.attribute_names()
    return spark.createDataFrame(list(zip(names, [float(v) for v in imp])), "Feature string, Importance double")


def _oof(spark, sf):
    return training.oof_cached(spark, sf)


@query("oof_predictions")
def q_oof_predictions(spark, sf):
    """M6: out-of-fold scores of the three candidate models on the application columns (3 seeded folds)."""
    return _oof(spark, sf)[0]


@query("model_comparison")
def q_model_comparison(spark, sf):
    """M7: CV AUC and predictor count per candidate model."""
    oof, n_pred = _oof(spark, sf)
    return training.model_comparison(spark, oof, n_pred)


@query("feature_set_comparison")
def q_feature_set_comparison(spark, sf):
    """M8: LASSO CV AUC on application-only columns vs all columns."""
    # the application-only LASSO scores are the ones of M6 (same folds and seed): reused
    app_only = _oof(spark, sf)[0].where(F.col("model") == "LASSO")
    full = training.oof_lasso_full(spark, sf)
    rows = [("Application Only", training.auc_of(app_only)),
            ("Application + Supplementary", training.auc_of(full))]
    return spark.createDataFrame(rows, "Feature_Set string, CV_AUC double")


@query("tune_grid")
def q_tune_grid(spark, sf):
    """ROC, Sens and Spec (mean, SD over folds) of a 20 x 20 grid with penalties from the data, on all
    training rows, with and without SMOTE."""
    return training.tuned_grid(spark, sf)


@query("tune_comparison")
def q_tune_comparison(spark, sf):
    """M9: best cross-validated AUC without and with SMOTE."""
    return training.tune_comparison(training.tuned_grid(spark, sf))


@query("final_fit")
def q_final_fit(spark, sf):
    """Chosen grid point and its 5-fold SMOTE CV AUC."""
    ff = training.final_fit(spark, sf)
    return spark.createDataFrame([(ff.reg, ff.alpha, ff.cv_auc)],
                                 "regParam double, elasticNetParam double, cv_auc double")


@query("top_features")
def q_top_features(spark, sf):
    """M11 + L1 + L3: the 20 largest coefficients by absolute value, with reasons."""
    ff = training.final_fit(spark, sf)
    coef = ff.model.coefficients(spark)
    top = coef.orderBy(F.abs("Coefficient").desc(), "Feature").limit(20)
    return adverse_action_map(top, spark, feature="Feature", sources=ff.model.sources())


@query("score_batch")
def q_score_batch(spark, sf):
    """Test rows scored with the final pipeline (unseen levels mapped first)."""
    ff = training.final_fit(spark, sf)
    return ff.model.score(_build(spark, sf).test).select(ID, "p_default")


@query("submission")
def q_submission(spark, sf):
    """Submission file (SK_ID_CURR, TARGET = probability) written and read back."""
    ff = training.final_fit(spark, sf)
    sub = ff.model.score(_build(spark, sf).test).select(ID, F.col("p_default").alias(LABEL))
    path = _scratch(spark, "submission")
    write_csv_na(sub, path)
    return read_csv_na(spark, path, sub.schema)


@query("artifact_roundtrip")
def q_artifact_roundtrip(spark, sf):
    """Every artefact written under one root and read back; the reloaded
    model re-scores the saved validation rows, the reloaded pipeline the raw
    ones (one row per artefact: rows read back, and for model and pipeline the
    rows whose score matches the saved one)."""
    b = _build(spark, sf)
    # two workflows over the same stored matrix, neither needs the other
    ff, _ = training.side_by_side(lambda: training.final_fit(spark, sf), lambda: training.oof_lasso_full(spark, sf))
    root = _scratch(spark, "artifacts")
    paths = training.save_artifacts(spark, sf, root, ff)
    reloaded = modeling.FittedModel(PipelineModel.load(paths["model"]), ff.model.numeric,
                                    ff.model.categorical, ff.model.levels, ff.model.modes)
    val = spark.read.parquet(paths["validation"]).select(ID, F.col("p_default").alias("p_saved"))
    same = F.abs(F.col("p_default") - F.col("p_saved")) < 1e-12
    rescored = reloaded.score(b.train.join(val, ID))
    raw = training.score_raw(PipelineModel.load(paths["pipeline"]), b.raw)
    rows = [("model", rescored.where(same).count()), ("pipeline", raw.join(val, ID).where(same).count())]
    rows += [(name, spark.read.parquet(p).count()) for name, p in paths.items() if name not in ("model", "pipeline")]
    return spark.createDataFrame(rows, "artifact string, rows long")


@query("score_raw")
def q_score_raw(spark, sf):
    """S5 + M12: raw test rows scored by the pipeline after saving and loading it (fitted cleaning included)."""
    path = _scratch(spark, "pipeline")
    b = _build(spark, sf)
    training.scoring_pipeline(b, training.final_fit(spark, sf).model).write().save(path)
    return training.score_raw(PipelineModel.load(path), b.raw.where(fixtures.is_test()))


@query("performance_table")
def q_performance_table(spark, sf):
    """Cross-validated vs validation AUC."""
    return training.performance_table(spark, training.final_fit(spark, sf))


@query("smote")
def q_smote(spark, sf):
    """SMOTE on the design matrix of the 80 % training part."""
    train, num, cat = _folds(spark, sf)
    split = sampling.stratified_split(train, ID, LABEL, 0.8, 42).where(F.col("split") == "train")
    from pyspark.ml import Pipeline
    design = Pipeline(stages=modeling.design_pipeline(num, cat)).fit(split)
    x = design.transform(split).select(ID, "features", LABEL)
    return smote(x, ID, "features", LABEL).select(ID, LABEL, "synthetic",
                                                   vector_to_array("features").alias("x"))


def _validation(spark, sf):
    """The validation rows' learned scores (id, label, groups, p_default)."""
    return training.final_fit(spark, sf).validation


@query("validation_confusion")
def q_validation_confusion(spark, sf):
    """M15 on the final model's validation scores."""
    return evaluate.confusion_metrics(_validation(spark, sf), "p_default", LABEL, 0.65)


@query("validation_sweep")
def q_validation_sweep(spark, sf):
    """M17 on the final model's validation scores."""
    return evaluate.threshold_sweep(_validation(spark, sf), "p_default", LABEL)


@query("validation_top_thresholds")
def q_validation_top_thresholds(spark, sf):
    """M18 on the final model's validation scores."""
    return evaluate.top_thresholds(q_validation_sweep(spark, sf))


@query("validation_sensitivity")
def q_validation_sensitivity(spark, sf):
    """M19 + M20 on the final model's validation scores: the optimum (offset 0) and 0.05 either side."""
    return evaluate.threshold_sensitivity(q_validation_sweep(spark, sf))


@query("validation_approval")
def q_validation_approval(spark, sf):
    """M21 on the final model's validation scores."""
    return fairness.approval_by_group(_validation(spark, sf), "p_default",
                                      ["CODE_GENDER", "NAME_EDUCATION_TYPE", "AGE_BIN"])
