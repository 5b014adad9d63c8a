"""One saved artifact of a training job: feature steps, preprocessing chain,
selected features and models. It is loaded in another session and scores raw rows
as the job did.

Everything is kept in open forms: the chain's statistics and category maps as
tables, the models by Spark ML's writers, the rest as one JSON row.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import q
from ..operators import ensemble, features, learn
from ..operators.base import load as load_fitted
from ..operators.ensemble import Ridge
from ..session import materialized
from .chain import FittedChain


class Steps:
    """Generated columns: domain rules and crosses before the chain, squares and
    products after it. All of it is plain values, so it can be saved."""

    def __init__(self, domain: Mapping | None = None, cross: Sequence[str] = (), max_crosses: int | None = None,
                 polynomial: Sequence[str] = (), limits: Mapping | None = None):
        self.domain, self.cross, self.max_crosses = dict(domain or {}), list(cross), max_crosses
        self.polynomial, self.limits = list(polynomial), dict(limits or {})

    def before(self, df: DataFrame, exclude: Sequence[str]) -> DataFrame:
        for name, rule in self.domain.items():
            if rule["kind"] == "sum":
                df = features.row_sum(df, rule["patterns"], name, exclude)
            elif rule["kind"] == "mean":
                df = features.row_mean(df, rule["patterns"], name, exclude)
            else:
                df = features.difference(df, rule["a"], rule["b"], name)
        return features.crosses(df, [c for c in self.cross if c in df.columns], max_crosses=self.max_crosses)

    def after(self, df: DataFrame) -> DataFrame:
        return features.polynomial_features(df, self.polynomial, **self.limits)


class Scorer:
    """What a job has fitted; ``members`` and ``combined`` score raw rows."""

    def __init__(self, key: str, label: str, steps: Steps, chain: FittedChain, columns: Sequence[str],
                 models: Mapping[str, PipelineModel], weights: Mapping[str, float] | None = None, stack: Ridge | None = None):
        self.key, self.label, self.steps, self.chain = key, label, steps, chain
        self.columns, self.models, self.weights, self.stack = list(columns), dict(models), weights, stack

    def prepare(self, df: DataFrame, all_columns: bool = False) -> DataFrame:
        """Key, label (null if absent) and the model's features of raw rows."""
        if self.label not in df.columns:
            df = df.withColumn(self.label, F.lit(None).cast("double"))
        out = self.steps.after(self.chain.transform(self.steps.before(df, [self.key, self.label])))
        return out if all_columns else out.select(*[F.col(q(c)) for c in (self.key, self.label, *self.columns)])

    def members(self, df: DataFrame) -> DataFrame:
        """``(model, key, label, prediction)``, a row per model and row of ``df``."""
        ready = self.prepare(df)
        if len(self.models) > 1:
            ready = materialized(ready)     # prepared once, scored by each model
        out = None
        for name, model in self.models.items():
            part = learn.predict(model, ready, self.key, keep=[self.label]).withColumn("model", F.lit(name))
            out = part if out is None else out.unionByName(part)
        return out.select("model", F.col(q(self.key)), F.col(q(self.label)), "prediction")

    def combined(self, members: DataFrame) -> DataFrame:
        """``(key, prediction)``: the stacked meta-learner if there is one, else the weighted average."""
        if self.stack is not None:
            return self.stack.predict(members, self.key, pred_col="prediction")
        return ensemble.weighted_average(members, self.key, self.weights, models=list(self.models), pred_col="prediction")

    def save(self, path: str) -> None:
        path = path.rstrip("/")
        self.chain.save(f"{path}/chain")
        for name, model in self.models.items():
            model.write().overwrite().save(f"{path}/models/{name}")
        stack = self.stack and {"models": self.stack.models, "coefficients": self.stack.coefficients,
                                "intercept": self.stack.intercept, "n": self.stack.n}
        meta = {"key": self.key, "label": self.label, "steps": vars(self.steps), "columns": self.columns,
                "models": list(self.models), "weights": self.weights, "stack": stack}
        spark = SparkSession.getActiveSession()
        spark.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1).write.mode("overwrite").json(f"{path}/scorer")


def load_scorer(spark: SparkSession, path: str) -> Scorer:
    path = path.rstrip("/")
    meta = json.loads(spark.read.schema("meta string").json(f"{path}/scorer").first()["meta"])
    stack = meta["stack"] and Ridge(**meta["stack"])
    return Scorer(meta["key"], meta["label"], Steps(**meta["steps"]), load_fitted(spark, f"{path}/chain"), meta["columns"],
                  {m: PipelineModel.load(f"{path}/models/{m}") for m in meta["models"]}, meta["weights"], stack)
