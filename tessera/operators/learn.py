"""Regressors, cross-validation, importances and parameter search.

Learners are ``pyspark.ml`` tree ensembles: the reference's random forest
maps to ``RandomForestRegressor``; its three boosted-tree libraries share one
role and map to ``GBTRegressor`` presets. Parameters Spark has no equivalent
for (L1/L2 penalties, leaf count, per-tree column sampling) are dropped and
listed in ``DROPPED``. Folds come from a hash of the key (no shuffle, stable
under retries); every fit is a distributed job.
"""

from __future__ import annotations

import json
import math
import random
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.errors import IllegalArgumentException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.columns import q
from ..session import ensure_checkpoint_dir
from .evaluate import metrics
from ..session import materialized
from .split import fold_of

FEATURES = "__features"

# The reference's learner defaults.
FOREST_DEFAULTS = {"numTrees": 200, "maxDepth": 15, "minInstancesPerNode": 2,
                   "featureSubsetStrategy": "sqrt"}
GBT_PRESETS = {
    "xgboost": {"maxIter": 500, "maxDepth": 6, "stepSize": 0.05, "subsamplingRate": 0.8,
                "featureSubsetStrategy": "0.8"},
    "catboost": {"maxIter": 500, "maxDepth": 6, "stepSize": 0.05, "subsamplingRate": 0.8},
    "lightgbm": {"maxIter": 500, "maxDepth": 6, "stepSize": 0.05, "subsamplingRate": 0.8,
                 "featureSubsetStrategy": "0.8"},
}
#: Parameters that a search draws, by learner. The declared ranges.
SEARCH_SPACES = {
    "random_forest": {"numTrees": ("int", 100, 500), "maxDepth": ("int", 10, 30), "minInstancesPerNode": ("int", 1, 5),
                      "featureSubsetStrategy": ("choice", ["sqrt", "log2"])},
    "xgboost": {"maxDepth": ("int", 3, 10), "stepSize": ("float", 0.001, 0.3), "subsamplingRate": ("float", 0.5, 1.0)},
}
SEARCH_SPACES["catboost"] = SEARCH_SPACES["lightgbm"] = SEARCH_SPACES["xgboost"]
DROPPED = {
    "random_forest": ["min_samples_split=5"],
    "xgboost": ["reg_alpha=0.01", "reg_lambda=1"],
    "catboost": [],
    "lightgbm": ["num_leaves=31", "reg_alpha=0.01", "reg_lambda=1"],
}


def forest(seed: int = 42, **params) -> RandomForestRegressor:
    p = {**FOREST_DEFAULTS, **params}
    return RandomForestRegressor(featuresCol=FEATURES, seed=seed, checkpointInterval=10, **p)


def gbt(preset: str = "xgboost", seed: int = 42, validation_col: str | None = None,
        validation_tol: float = 0.01, **params) -> GBTRegressor:
    """Boosted trees with one of three presets; ``validation_col`` enables early
    stopping on the rows where that boolean column is true."""
    if preset not in GBT_PRESETS:
        raise ValueError(f"unknown boosted-tree preset: {preset}")
    p = {**GBT_PRESETS[preset], **params}
    if validation_col:
        p.update(validationIndicatorCol=validation_col, validationTol=validation_tol)
    return GBTRegressor(featuresCol=FEATURES, seed=seed, checkpointInterval=10, **p)


def pipeline(features: Sequence[str], label: str, estimator) -> Pipeline:
    va = VectorAssembler(inputCols=list(features), outputCol=FEATURES)
    estimator = estimator.copy().setLabelCol(label).setPredictionCol("prediction")
    return Pipeline(stages=[va, estimator])


def assembled(df: DataFrame, features: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """``keep`` columns and the vector of ``features``, as ``pipeline`` builds it."""
    va = VectorAssembler(inputCols=list(features), outputCol=FEATURES)
    return va.transform(df).select(*[F.col(q(c)) for c in keep], FEATURES)


def fit_assembled(df: DataFrame, label: str, estimator):
    """The fitted learner alone, on a frame that has the vectors."""
    ensure_checkpoint_dir(df.sparkSession)
    return estimator.copy().setLabelCol(label).setPredictionCol("prediction").fit(df)


def fit(df: DataFrame, features: Sequence[str], label: str, estimator) -> PipelineModel:
    ensure_checkpoint_dir(df.sparkSession)
    return pipeline(features, label, estimator).fit(df)


def best_round(errors: Sequence[float], patience: int) -> tuple[int, bool]:
    """``(rounds to keep, whether the search ended)``: the round of the smallest error
    before ``patience`` rounds in a row brought none smaller."""
    best, at = math.inf, 0
    for i, e in enumerate(errors, 1):
        if e < best:
            best, at = e, i
        elif i - at >= patience:
            return at, True
    return at, False


def fit_early(df: DataFrame, features: Sequence[str], label: str, estimator: GBTRegressor, validation: Column,
              patience: int = 50) -> tuple[PipelineModel, list[float]]:
    """Boosted trees cut at the best round by validation error: ``(model, errors by
    round)``. ``validation`` marks the rows that are not trained on.

    The trees are grown in steps (``2 * patience`` rounds, then twice as many, up to the
    estimator's ``maxIter``) and each step's rounds are scored together on the validation
    rows, until ``patience`` rounds pass without a smaller error. A boosted model's
    first k trees are those of a fit of k rounds with the same seed and rows, so the
    model is then fitted with the best number of rounds. In all that is at most three
    times the rounds that were needed.
    """
    ensure_checkpoint_dir(df.sparkSession)
    data = materialized(df.select(*[F.col(q(c)) for c in features], F.col(q(label)), F.coalesce(validation, F.lit(False)).alias("__val")))
    train, val = data.where(~F.col("__val")).drop("__val"), data.where("__val").drop("__val")
    most = estimator.getMaxIter()
    if val.where(F.col(q(label)).isNotNull()).isEmpty():
        return fit(train, features, label, estimator), []
    rounds = min(most, 2 * patience)
    while True:
        model = pipeline(features, label, estimator.copy().setMaxIter(rounds)).fit(train)
        scored = model.stages[0].transform(val.where(F.col(q(label)).isNotNull()))
        errors = list(model.stages[-1].evaluateEachIteration(scored, estimator.getLossType()))
        at, ended = best_round(errors, patience)
        if ended or rounds >= most:
            break
        rounds = min(most, 2 * rounds)
    if at < rounds:
        model = pipeline(features, label, estimator.copy().setMaxIter(max(1, at))).fit(train)
    return model, errors


def fit_many(df: DataFrame, features: Sequence[str], label: str, estimators: Mapping,
             parallelism: int = 2) -> dict[str, PipelineModel]:
    """Fit several independent learners on the same frame as concurrent jobs
    (driver threads); returns ``{name: model}`` in the given order."""
    ensure_checkpoint_dir(df.sparkSession)
    names = list(estimators)
    with ThreadPoolExecutor(max(1, min(parallelism, len(names)))) as ex:
        models = list(ex.map(lambda n: pipeline(features, label, estimators[n]).fit(df), names))
    return dict(zip(names, models))


def predict(model: PipelineModel, df: DataFrame, key: str, keep: Sequence[str] = ()) -> DataFrame:
    return model.transform(df).select(F.col(q(key)), *[F.col(q(c)) for c in keep], "prediction")


def train_score(model: PipelineModel, df: DataFrame, label: str, by: Sequence[str] = ()) -> DataFrame:
    """RMSE / MAE / R² / MAPE of the fitted model on ``df`` (grouped by ``by``)."""
    p = model.transform(df)
    return metrics(p, label, "prediction", by=by)


def feature_importance(model: PipelineModel, features: Sequence[str]) -> list[tuple[str, float]]:
    """Impurity importances of the tree ensemble zipped with the input names."""
    imp = model.stages[-1].featureImportances.toArray()
    names = list(features) if len(features) == len(imp) else [f"Feature_{i}" for i in range(len(imp))]
    return [(n, float(v)) for n, v in zip(names, imp)]


def split_counts(model: PipelineModel, features: Sequence[str]) -> DataFrame:
    """How often each feature is split on across all trees (boosted-tree
    "weight" importance; a feature never used → 0).

    The tree stage is written with Spark ML's writer to the shared checkpoint
    folder and its node table is read back: one group-by over the internal
    nodes (leaves carry feature index -1), joined to the feature names.
    """
    import uuid

    spark = SparkSession.getActiveSession()
    base = ensure_checkpoint_dir(spark)
    path = f"{base.rstrip('/')}/models/{uuid.uuid4().hex}"
    model.stages[-1].write().overwrite().save(path)
    nodes = spark.read.parquet(f"{path}/data")
    counts = (nodes.where(F.col("nodeData.split.featureIndex") >= 0)
              .groupBy(F.col("nodeData.split.featureIndex").alias("__i"))
              .agg(F.count("*").alias("splits")))
    names = spark.createDataFrame(list(enumerate(features)), "__i int, feature string")
    return (names.join(counts, "__i", "left")
            .select("feature", F.coalesce("splits", F.lit(0)).cast("bigint").alias("splits")))


def cross_validate(df: DataFrame, features: Sequence[str], label: str, estimator, key: str,
                   k: int = 5, seed: int = 42, method: str = "hash", metric: str = "rmse",
                   parallelism: int = 1) -> DataFrame:
    """Per-fold scores of ``estimator``: ``(fold, n, rmse, mae, r2, mape)`` plus
    the mean and population std of ``metric`` over folds (unknown metric → rmse)."""
    data = _fold_frame(df, features, label, key, k, seed, method)
    try:
        return _fold_scores(data, label, estimator, k, metric, parallelism)
    finally:
        data.unpersist()


def _fold_frame(df: DataFrame, features: Sequence[str], label: str, key: str, k: int, seed: int, method: str) -> DataFrame:
    """Rows with their fold and vector, kept while every fold (and trial) reads them several
    times: else each pass of each fit reads the columns and builds the vectors again."""
    df = materialized(df)
    keep = [c for c in df.columns if c == label or c not in features]
    return assembled(df.withColumn("__fold", fold_of(key, k, seed, method)), features,
                     [*keep, "__fold"]).persist(StorageLevel.MEMORY_AND_DISK)


def _fold_scores(data: DataFrame, label: str, estimator, k: int, metric: str, parallelism: int) -> DataFrame:
    metric = metric if metric in ("rmse", "mae", "r2") else "rmse"

    def one(f):
        m = fit_assembled(data.where(F.col("__fold") != f), label, estimator)
        pred = m.transform(data.where(F.col("__fold") == f))
        return metrics(pred, label, "prediction").withColumn("fold", F.lit(f))

    with ThreadPoolExecutor(max(1, parallelism)) as ex:
        parts = list(ex.map(one, range(k)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    rows = out.collect()          # k rows
    vals = [r[metric] for r in rows]
    mean = sum(vals) / len(vals)
    std = math.sqrt(sum((v - mean) ** 2 for v in vals) / len(vals))
    return data.sparkSession.createDataFrame(
        [(int(r["fold"]), int(r["n"]), r["rmse"], r["mae"], r["r2"], r["mape"], mean, std)
         for r in rows],
        "fold int, n bigint, rmse double, mae double, r2 double, mape double, "
        "cv_mean double, cv_std double")


# ------------------------------------------------------------------ search

def sample_space(space: Mapping, n_trials: int, seed: int = 42) -> list[dict]:
    """Typed search space: ``("int", lo, hi)``, ``("float", lo, hi)``,
    ``("log", lo, hi)``, ``("choice", [..])``, or a fixed value."""
    rng = random.Random(seed)
    trials = []
    for _ in range(n_trials):
        t = {}
        for name, spec in space.items():
            if isinstance(spec, tuple) and spec and spec[0] == "int":
                t[name] = rng.randint(spec[1], spec[2])
            elif isinstance(spec, tuple) and spec and spec[0] == "float":
                t[name] = rng.uniform(spec[1], spec[2])
            elif isinstance(spec, tuple) and spec and spec[0] == "log":
                t[name] = math.exp(rng.uniform(math.log(spec[1]), math.log(spec[2])))
            elif isinstance(spec, tuple) and spec and spec[0] == "choice":
                t[name] = rng.choice(list(spec[1]))
            else:
                t[name] = spec
        trials.append(t)
    return trials


def random_search(df: DataFrame, features: Sequence[str], label: str, make_estimator,
                  space: Mapping, key: str, n_trials: int = 10, k: int = 3, seed: int = 42,
                  parallelism: int = 2, method: str = "hash", cv_parallelism: int = 1) -> DataFrame:
    """Seeded random search minimising mean CV RMSE; a trial whose
    parameters the learner refuses scores +∞, any other error is raised.

    Trials run concurrently from driver threads (``parallelism``), and each
    trial's folds too (``cv_parallelism``); every fold is a distributed Spark
    job. Returns ``(trial, params, value)``.
    """
    trials = sample_space(space, n_trials, seed)
    data = _fold_frame(df, features, label, key, k, seed, method)

    def run(i):
        try:
            cv = _fold_scores(data, label, make_estimator(**trials[i]), k, "rmse", cv_parallelism)
            return (i, json.dumps(trials[i], sort_keys=True), cv.first()["cv_mean"])
        except (IllegalArgumentException, TypeError, ValueError):  # parameters that the learner refuses
            return (i, json.dumps(trials[i], sort_keys=True), float("inf"))

    try:
        with ThreadPoolExecutor(max(1, parallelism)) as ex:
            rows = list(ex.map(run, range(n_trials)))
    finally:
        data.unpersist()
    if rows and all(r[2] == float("inf") for r in rows):
        raise ValueError("no trial of the search could be fitted")
    return df.sparkSession.createDataFrame(rows, "trial int, params string, value double")


def best_params(history: DataFrame, defaults: Mapping | None = None) -> dict:
    """Best trial's parameters merged over the defaults."""
    best = history.agg(F.min_by("params", "value").alias("p")).first()["p"]
    return {**(defaults or {}), **json.loads(best)}


def search_history(history: DataFrame) -> DataFrame:
    """History with the running best (min value up to each trial) and the best
    row flagged; a failed trial's ``+inf`` never wins. One row per trial."""
    w = Window.orderBy("trial").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    best = Window.orderBy(F.col("value").asc(), F.col("trial"))
    return (history.withColumn("best_so_far", F.min("value").over(w))
            .withColumn("is_best", F.row_number().over(best) == 1))


def fold_summary(fold_metrics: DataFrame, metric: str = "rmse") -> DataFrame:
    """Mean and population std of a per-fold metric (scores, mean, std)."""
    return fold_metrics.agg(F.avg(metric).alias("cv_mean"), F.stddev_pop(metric).alias("cv_std"))
