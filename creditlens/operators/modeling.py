"""Model fit, scoring and model reports on Spark ML.

* ``design_pipeline`` (M2): ``StringIndexer`` ordered ``alphabetDesc`` plus
  ``OneHotEncoder(dropLast=True)`` drops the alphabetically first level,
  like R's treatment contrasts; ``full_first=True`` keeps every level of the
  first factor (R's ``y ~ . - 1``).  ``VectorAssembler(handleInvalid="error")``
  fails loudly on an unfilled column.  Levels unseen in training are mapped
  to the training mode before scoring (``align_levels``) so indexing can
  stay on ``error``.
* Fits are Spark ML estimators; cross validation uses
  the seeded, balanced folds of R1.
* Scores are ``vector_to_array(probability)[1]`` keyed by id.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark import SparkContext
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditlens.operators import lockstep, sampling
from creditlens.session import checkpoint_dir

ID, LABEL = "SK_ID_CURR", "TARGET"


def feature_columns(df: DataFrame, exclude: Sequence[str] = (ID, LABEL)) -> tuple[list[str], list[str]]:
    """(numeric, categorical) predictor columns of a feature matrix."""
    num, cat = [], []
    for f in df.schema.fields:
        if f.name in exclude or f.name.startswith("_"):
            continue
        if isinstance(f.dataType, T.StringType):
            cat.append(f.name)
        elif isinstance(f.dataType, T.NumericType):
            num.append(f.name)
    return num, cat


def design_pipeline(numeric: Sequence[str], categorical: Sequence[str], full_first: bool = False,
                    features: str = "features") -> list:
    stages: list = []
    vec_inputs = list(numeric)
    if categorical:
        idx = [f"_{c}_idx" for c in categorical]
        oh = [f"_{c}_oh" for c in categorical]
        stages.append(StringIndexer(inputCols=list(categorical), outputCols=idx,
                                    stringOrderType="alphabetDesc", handleInvalid="error"))
        if full_first:
            stages.append(OneHotEncoder(inputCols=idx[:1], outputCols=oh[:1], dropLast=False))
            if len(idx) > 1:
                stages.append(OneHotEncoder(inputCols=idx[1:], outputCols=oh[1:], dropLast=True))
        else:
            stages.append(OneHotEncoder(inputCols=idx, outputCols=oh, dropLast=True))
        vec_inputs += oh
    stages.append(VectorAssembler(inputCols=vec_inputs, outputCol=features, handleInvalid="error"))
    return stages


def align_levels(df: DataFrame, levels: dict[str, list[str]], fallback: dict[str, str]) -> DataFrame:
    """Map levels unseen in training (and NULL) to the training mode of the column."""
    return df.withColumns({c: F.when(F.col(c).isin(list(lv)), F.col(c)).otherwise(F.lit(fallback[c]))
                           for c, lv in levels.items()})


def training_levels(df: DataFrame, categorical: Sequence[str]) -> tuple[dict, dict]:
    """Levels and modal level per categorical column, in one aggregate pass.

    The collected table has one row per (column, level): bounded by the
    columns' cardinality, not by the row count.
    """
    cats = list(categorical)
    if not cats:
        return {}, {}
    long = df.select(*[F.col(c).cast("string") for c in cats]).unpivot([], cats, "v", "level") \
        .where(F.col("level").isNotNull())
    rows = long.groupBy("v", "level").count().collect()
    levels: dict[str, list[str]] = {c: [] for c in cats}
    best: dict[str, tuple] = {}
    for r in rows:
        levels[r["v"]].append(r["level"])
        key = (-r["count"], r["level"])
        if r["v"] not in best or key < best[r["v"]]:
            best[r["v"]] = key
    return levels, {c: best[c][1] if c in best else None for c in cats}


ROWS_PER_PARTITION = 100_000
FEWEST_ROWS = 5_000  # rows that are worth a task of their own


def right_size(df: DataFrame, rows: int | None = None, spread: bool = False) -> DataFrame:
    """Coalesce a small training frame to ~``ROWS_PER_PARTITION`` rows per partition.

    Iterative optimisers run one ``treeAggregate`` job per loss evaluation;
    on a small frame spread over many partitions that is mostly task and
    shuffle overhead.  Large frames keep their partitioning (coalesce never
    increases or reshuffles).  ``spread`` keeps a partition per task slot (of
    ``FEWEST_ROWS`` at least): a forest's passes are few and long.
    """
    n = df.count() if rows is None else rows
    slots = min(df.sparkSession.sparkContext.defaultParallelism, n // FEWEST_ROWS) if spread else 1
    want = max(1, -(-n // ROWS_PER_PARTITION), slots)
    return df.coalesce(want) if want < df.rdd.getNumPartitions() else df


def stored(df: DataFrame) -> DataFrame:
    """Checkpointed rows for the many passes of folds and fits.

    A stored frame has the partitions its size calls for (adaptive execution
    merges those of its shuffles); a persisted one keeps
    ``spark.sql.shuffle.partitions`` of them however few its rows, and every
    pass of every fold pays a task for each.
    """
    checkpoint_dir(df.sparkSession)  # the session's shared folder (a scratch one only when unset)
    return df.checkpoint()


def logistic(reg: float = 0.0, alpha: float = 0.0, max_iter: int = 100) -> LogisticRegression:
    return LogisticRegression(featuresCol="features", labelCol=LABEL, regParam=reg,
                              elasticNetParam=alpha, maxIter=max_iter, standardization=True)


def forest(num_trees: int = 200, seed: int = 42, max_depth: int = 12) -> RandomForestClassifier:
    """M5.  The reference grows trees without a depth limit; Spark ML needs one (30 at most) and keeps a
    node table that doubles per level, so ``max_depth`` is a parameter: 12 levels hold 4,096 leaves.  512 MB of
    node statistics per task take half as many passes over the rows as Spark's default, and stored node ids spare a
    walk from the root per row, tree and pass; the trees are the same."""
    return RandomForestClassifier(featuresCol="features", labelCol=LABEL, numTrees=num_trees, seed=seed,
                                  maxDepth=max_depth, maxMemoryInMB=512, cacheNodeIds=True)


def with_probability(pred: DataFrame, out: str = "p_default") -> DataFrame:
    """The positive-class probability as a plain double column."""
    return pred.withColumn(out, vector_to_array(F.col("probability")).getItem(1))


def lambda_grid(n: int = 8, hi: float = 0.1, ratio: float = 1e-3) -> list[float]:
    """Log-spaced penalty path from ``hi`` down to ``hi * ratio`` (glmnet-like)."""
    if n == 1:
        return [hi]
    return [hi * ratio ** (i / (n - 1)) for i in range(n)]


@dataclass
class FittedModel:
    model: PipelineModel
    numeric: list[str]
    categorical: list[str]
    levels: dict
    modes: dict

    def score(self, df: DataFrame, out: str = "p_default") -> DataFrame:
        aligned = align_levels(df, self.levels, self.modes)
        return with_probability(self.model.transform(aligned), out)

    def coefficients(self, spark: SparkSession) -> DataFrame:
        """(Feature, Coefficient) with names from the assembler metadata."""
        lr = self.model.stages[-1]
        coef = lr.coefficients.toArray().tolist()
        names = self.attribute_names()
        return spark.createDataFrame(list(zip(names, [float(c) for c in coef])),
                                     "Feature string, Coefficient double")

    def attribute_names(self) -> list[str]:
        out: list[str] = []
        idx_model = [s for s in self.model.stages if s.__class__.__name__ == "StringIndexerModel"]
        labels = dict(zip(self.categorical, idx_model[0].labelsArray)) if idx_model else {}
        oh = [s for s in self.model.stages if s.__class__.__name__ == "OneHotEncoderModel"]
        drop_last = {}
        for m in oh:
            for c in m.getInputCols():
                drop_last[c[1:-4]] = m.getDropLast()
        out += list(self.numeric)
        for c in self.categorical:
            lv = list(labels.get(c, []))
            if drop_last.get(c, True):
                lv = lv[:-1]
            out += [f"{c}_{v}" for v in lv]
        return out

    def sources(self) -> dict[str, str]:
        """Source column of every design column, from the fitted indexer."""
        idx = [s for s in self.model.stages if s.__class__.__name__ == "StringIndexerModel"]
        labels = dict(zip(self.categorical, idx[0].labelsArray)) if idx else {}
        return {c: c for c in self.numeric} | {f"{c}_{v}": c for c, lv in labels.items() for v in lv}

    def nonzero(self) -> int:
        lr = self.model.stages[-1]
        return int(sum(1 for c in lr.coefficients.toArray() if c != 0))


def fit(df: DataFrame, estimator, numeric: Sequence[str], categorical: Sequence[str],
        full_first: bool = False) -> FittedModel:
    levels, modes = training_levels(df, categorical)
    design = Pipeline(stages=design_pipeline(numeric, categorical, full_first)).fit(df)
    x = design_rows(design.transform(df), spread=isinstance(estimator, RandomForestClassifier))
    model = PipelineModel(stages=design.stages + [estimator.fit(x)])
    return FittedModel(model, list(numeric), list(categorical), levels, modes)


TREES_SENT = 40  # trees that a task is sent at once


def _parts(forest: RandomForestClassificationModel, size: int) -> list[RandomForestClassificationModel]:
    """Forests of ``size`` consecutive trees at most."""
    gateway = SparkContext._gateway
    kinds = gateway.jvm.org.apache.spark.ml.classification
    trees, out = forest._java_obj.trees(), []
    for lo in range(0, len(trees), size):
        some = gateway.new_array(kinds.DecisionTreeClassificationModel, min(size, len(trees) - lo))
        for i in range(len(some)):
            some[i] = trees[lo + i]
        out.append(RandomForestClassificationModel(
            kinds.RandomForestClassificationModel(some, forest.numFeatures, forest.numClasses)))
    return out


def forest_scores(m: FittedModel, df: DataFrame, cols: Sequence[str], out: str = "p_default") -> DataFrame:
    """``cols`` and the probability of ``m.score`` (of a forest), stored.

    A job is sent the trees it scores with: all 200 at once, written to bytes
    beside the forest itself, fill the driver.  Votes are summed over jobs of
    ``TREES_SENT`` trees; rows lie in a partition per task slot, as each of
    their tasks reads the trees.
    """
    *design, forest = m.model.stages
    x = PipelineModel(stages=design).transform(align_levels(df, m.levels, m.modes))
    x = design_rows(x, [*cols, "features"], spread=True) \
        .withColumns({"_no": F.lit(0.0), "_yes": F.lit(0.0)})
    votes = vector_to_array("rawPrediction")
    for part in _parts(forest, TREES_SENT):
        x = stored(part.transform(x).select(*cols, "features", (F.col("_no") + votes[0]).alias("_no"),
                                            (F.col("_yes") + votes[1]).alias("_yes")))
    return x.select(*cols, (F.col("_yes") / (F.col("_no") + F.col("_yes"))).alias(out))


def design_rows(x: DataFrame, cols: Sequence[str] = ("features", LABEL), spread: bool = False) -> DataFrame:
    """Materialise design rows before an iterative fit.

    An optimiser runs one job per loss evaluation and every task carries
    the lineage of its input; ``checkpoint()`` (to the shared
    ``spark.checkpoint.dir``) leaves a one-step lineage of stored vectors
    and survives executor loss.  Rows are counted on the stored ones: the
    input's plan (which may hold SMOTE's search) runs once, on all its
    partitions.
    """
    checkpoint_dir(x.sparkSession)  # the session's shared folder (a scratch one only when unset)
    return right_size(x.select(*cols).checkpoint(), spread=spread)


def cv_lasso(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], n_lambda: int = 100,
             inner_folds: int = 10, seed: int = 42, full_first: bool = True) -> FittedModel:
    """M4: L1 logistic regression with the penalty chosen by inner cross validation.

    As ``cv.glmnet``: one penalty path from the data, ``lambda.min`` by the
    held-out binomial deviance (log-loss over all rows, the larger penalty on
    ties).  All folds' paths and the whole rows' path move in lockstep
    (``lockstep``); the chosen penalty's model is a Spark ML fit.
    """
    levels, modes = training_levels(df, categorical)
    design_model = Pipeline(stages=design_pipeline(numeric, categorical, full_first)).fit(df)
    x = design_rows(design_model.transform(df), (ID, "features", LABEL))
    regs = best_penalty(sampling.kfold_assign(x, ID, inner_folds, seed), inner_folds, n_lambda)
    best = logistic(regs, 1.0).fit(x)
    model = PipelineModel(stages=design_model.stages + [best])
    return FittedModel(model, list(numeric), list(categorical), levels, modes)


def best_penalty(folded: DataFrame, folds: int, n_lambda: int = 100) -> float:
    """The path's penalty with the least held-out log-loss over design rows with a ``fold`` column 1..folds."""
    every = set(range(1, folds + 1))
    blocks = lockstep.pack(folded, LABEL, "fold")
    fit = lockstep.Lockstep(blocks, [lockstep.Group(every, set(), [])]
                            + [lockstep.Group(every - {f}, {f}, []) for f in sorted(every)])
    regs = fit.path(0, n_lambda)
    for g in fit.groups:
        g.points = [(r, 1.0) for r in regs]
    fit.fit()
    return regs[int(np.argmin(fit.held_out_loss()))]


def save(model: FittedModel, path: str) -> None:
    """The fitted pipeline is written with Spark ML's own persistence."""
    model.model.write().overwrite().save(path)
