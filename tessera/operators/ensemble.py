"""Ensembles over the long prediction table ``(model, key, prediction)``.

Weighted average and voting are one ``groupBy(key)`` aggregate each; the
weight table has one row per model (bounded by the model list) and is
broadcast. Stacking pivots the members to columns — a fixed, known model list
— and fits ridge regression with ``pyspark.ml.regression.LinearRegression``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import q
from ..functions.joins import BROADCAST_LIMIT, fits_broadcast, hot_keys, lookup_join, table_size
from ..session import cut_lineage

# The reference's configured ensemble weights.
DEFAULT_WEIGHTS = {
    "random_forest": 0.15,
    "xgboost": 0.25,
    "catboost": 0.25,
    "lightgbm": 0.20,
    "tabnet": 0.15,
}


def group_mean_predictions(df: DataFrame, key: str, label: str,
                           models: Mapping[str, str], train=None,
                           carry: Sequence[str] = ()) -> DataFrame:
    """Baseline predictors: the train-mean label of each row's group.

    Returns ``(model, key, carry…, y, p)``. All models are fitted in **one**
    pass: every train row is exploded into one ``(model, group value)`` row
    per model and averaged by that pair (partial aggregation; one row per
    group value). The scored rows are exploded the same way and joined once
    on ``(model, group value)`` with ``lookup_join``: broadcast when the
    counted means table is small, a sort-merge join with hot groups salted
    otherwise. A null group value gets no prediction.
    """
    def tags():       # one (model, group value) row per model and input row
        return F.explode(F.array(*[
            F.struct(F.lit(name).alias("model"), F.col(q(g)).cast("string").alias("__g"))
            for name, g in models.items()])).alias("__m")

    def mkey(model: Column, g: Column) -> Column:   # null group value → null key
        return F.concat(model, F.lit("\u0001"), g)

    y = F.col(q(label)).cast("double")
    fit = df.where(train) if train is not None else df
    # one row per (model, group value); written once, its size counted, hot
    # groups (> 0.1 % of the train rows) listed — all bounded by the groups
    means = cut_lineage(
        fit.select(y.alias("__y"), tags())
        .groupBy(mkey(F.col("__m.model"), F.col("__m.__g")).alias("__mk"))
        .agg(F.avg("__y").alias("p"), F.count("*").alias("__n")))
    small = fits_broadcast(table_size(means), BROADCAST_LIMIT)
    hot = [] if small else hot_keys(means, "__mk", "__n", 1e-3).get(None, [])
    rows = (df.select(F.col(q(key)), *[F.col(q(c)) for c in carry], y.alias("y"), tags())
            .select(F.col("__m.model").alias("model"),
                    mkey(F.col("__m.model"), F.col("__m.__g")).alias("__k"),
                    F.col(q(key)), *[F.col(q(c)) for c in carry], "y"))
    j = lookup_join(rows, means.select("__mk", "p"), F.col("__k"), "__mk",
                    broadcast=small, hot=hot)
    return j.select("model", F.col(q(key)), *[F.col(q(c)) for c in carry], "y", "p")


def normalized_weights(weights: Mapping[str, float]) -> dict[str, float]:
    total = sum(weights.values())
    return {m: w / total for m, w in weights.items()}


def weighted_average(preds: DataFrame, key: str, weights: Mapping[str, float] | None = None,
                     models: Sequence[str] | None = None, model_col: str = "model",
                     pred_col: str = "p") -> DataFrame:
    """``sum(w·p) / sum(w)`` per key.

    Configured weights are normalised to 1; a model without a weight gets
    ``1 / n_models``; the average renormalises over the members present.
    """
    weights = normalized_weights(dict(weights or DEFAULT_WEIGHTS))
    if models is None:
        models = [r[0] for r in preds.select(model_col).distinct().limit(10001).collect()]
        if len(models) > 10000:
            raise ValueError("too many models for a weighted ensemble")
    n = len(models)
    rows = [(m, float(weights.get(m, 1.0 / n))) for m in models]
    wt = preds.sparkSession.createDataFrame(rows, f"{model_col} string, __w double")
    j = preds.join(F.broadcast(wt), model_col, "inner")
    return j.groupBy(F.col(q(key))).agg(
        (F.sum(F.col("__w") * F.col(q(pred_col))) /
         F.sum(F.when(F.col(q(pred_col)).isNotNull(), F.col("__w")))).alias("prediction"))


def mean_vote(preds: DataFrame, key: str, pred_col: str = "p") -> DataFrame:
    """Voting ensemble: simple mean of the members per key."""
    return preds.groupBy(F.col(q(key))).agg(F.avg(F.col(q(pred_col))).alias("prediction"))


def wide_members(preds: DataFrame, key: str, models: Sequence[str], label: str | None = None,
                 model_col: str = "model", pred_col: str = "p") -> DataFrame:
    """Pivot members into columns (explicit model list: no extra distinct pass)."""
    aggs = [F.first(F.when(F.col(model_col) == m, F.col(q(pred_col))), ignorenulls=True).alias(m)
            for m in models]
    if label:
        aggs.append(F.first(F.col(q(label)), ignorenulls=True).alias(label))
    return preds.groupBy(F.col(q(key))).agg(*aggs)


def fit_stacking(preds: DataFrame, key: str, label: str, models: Sequence[str],
                 alpha: float = 1.0, model_col: str = "model", pred_col: str = "p"):
    """Ridge(α) meta-learner with intercept on the members' predictions.

    ``LinearRegression`` minimises ``1/(2n)·SSE + λ/2·‖w‖²`` on the label scaled
    by its std, so the closed-form ridge ``SSE + α‖w‖²`` needs
    ``λ = α · std_pop(y) / n`` with standardization off.
    """
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression

    wide = wide_members(preds, key, models, label, model_col, pred_col).dropna()
    st = wide.agg(F.count("*").alias("n"), F.stddev_pop(F.col(q(label))).alias("s")).first()
    reg = alpha * (st["s"] or 1.0) / max(st["n"], 1)
    va = VectorAssembler(inputCols=list(models), outputCol="__f")
    lr = LinearRegression(featuresCol="__f", labelCol=label, predictionCol="prediction",
                          regParam=reg, elasticNetParam=0.0, standardization=False,
                          fitIntercept=True, solver="normal")
    model = lr.fit(va.transform(wide))
    return va, model


def predict_stacking(va, model, preds: DataFrame, key: str, models: Sequence[str],
                     model_col: str = "model", pred_col: str = "p") -> DataFrame:
    """A row for every key; the prediction is null where a member has none."""
    wide = wide_members(preds, key, models, None, model_col, pred_col)
    has_all = F.lit(True)
    for m in models:
        has_all = has_all & F.col(q(m)).isNotNull()
    filled = wide.select(F.col(q(key)), has_all.alias("__all"), *[F.coalesce(F.col(q(m)), F.lit(0.0)).alias(m) for m in models])
    return model.transform(va.transform(filled)).select(F.col(q(key)), F.when(F.col("__all"), F.col("prediction")).alias("prediction"))


def group_mean_cv(df: DataFrame, key: str, label: str, groups: Sequence[str], k: int = 5,
                  seed: int = 42, method: str = "hash") -> DataFrame:
    """K-fold CV of the group-mean predictor without k refits.

    One aggregate gives label sums per ``(group, fold)``; the out-of-fold mean
    of a row's group is ``(S_g − S_g,f) / (N_g − N_g,f)`` (falling back to the
    out-of-fold global mean when the group is absent from the other folds).
    Rows find their group's sums — one row per group, holding its k folds — by
    ``lookup_join``: broadcast when counted small, else hot groups salted.
    Returns ``(fold, key, y, p)``.
    """
    from .split import fold_of
    y = F.col(q(label)).cast("double")
    names = [F.col(q(g)) for g in groups]
    text = names[0].cast("string") if len(names) == 1 else F.to_json(F.struct(*names))
    known = F.lit(True)
    for c in names:
        known = known & c.isNotNull()
    d = df.select(F.col(q(key)), F.when(known, text).alias("__g"), y.alias("__y"),
                  fold_of(key, k, seed, method).alias("fold"))
    # one row per (group, fold); written once to the shared folder so its uses
    # below do not re-aggregate the data
    s = cut_lineage(d.groupBy("__g", "fold").agg(F.sum("__y").alias("__s"),
                                                 F.count("__y").alias("__n"),
                                                 F.count("*").alias("__rows")))
    of = s.where(F.col("__g").isNotNull()).groupBy(F.col("__g").alias("__key")).agg(
        F.sum("__s").alias("__st"), F.sum("__n").alias("__nt"), F.sum("__rows").alias("__rows"),
        F.map_from_entries(F.collect_list(F.struct("fold", F.struct("__s", "__n")))).alias("__f"))
    fs = s.groupBy("fold").agg(F.sum("__s").alias("__fs"), F.sum("__n").alias("__fn"))
    g = s.agg(F.sum("__s").alias("__gs"), F.sum("__n").alias("__gn")).first()
    small = fits_broadcast(table_size(of), BROADCAST_LIMIT)
    hot = [] if small else hot_keys(of, "__key", "__rows", 1e-3).get(None, [])
    j = lookup_join(d, of.drop("__rows"), F.col("__g"), "__key", broadcast=small, hot=hot) \
        .join(F.broadcast(fs), "fold", "left")
    own = F.try_element_at(F.col("__f"), F.col("fold"))
    # a fold without labels has a null sum: nothing to take off
    grp = F.try_divide(F.col("__st") - F.coalesce(own["__s"], F.lit(0.0)),
                       (F.col("__nt") - own["__n"]).cast("double"))
    glob = F.try_divide(F.lit(g["__gs"]) - F.coalesce(F.col("__fs"), F.lit(0.0)),
                        (F.lit(g["__gn"]) - F.col("__fn")).cast("double"))
    return j.select("fold", F.col(q(key)), F.col("__y").alias("y"),
                    F.coalesce(grp, glob).alias("p"))


# ------------------------------------------------ out-of-fold stacking

def group_mean_oof(df: DataFrame, key: str, label: str, models: Mapping[str, str], k: int = 5,
                   seed: int = 42, method: str = "hash") -> DataFrame:
    """``(model, key, fold, y, p)``: every group-mean member's predictions of each
    fold from the other folds, in one long table."""
    out = None
    for name, group in models.items():
        part = group_mean_cv(df, key, label, [group], k, seed, method).select(
            F.lit(name).alias("model"), F.col(q(key)), "fold", "y", "p")
        out = part if out is None else out.unionByName(part)
    return out


def out_of_fold(df: DataFrame, features: Sequence[str], label: str, members: Mapping, key: str, k: int = 5,
                seed: int = 42, method: str = "hash", parallelism: int = 2) -> DataFrame:
    """``(model, key, fold, y, p)``: each learner of ``members`` is fitted on all folds
    but one and predicts that one; ``k`` fits a member, as concurrent jobs. The
    table is written once. A fold without rows, or without rows outside it, is skipped."""
    from concurrent.futures import ThreadPoolExecutor

    from . import learn
    from .split import fold_of
    data = cut_lineage(df.select(F.col(q(key)), F.col(q(label)).cast("double").alias("y"), *[F.col(q(c)) for c in features if c != key],
                                 fold_of(key, k, seed, method).alias("fold")).where(F.col("y").isNotNull()))
    folds = sorted(r[0] for r in data.select("fold").distinct().collect())      # at most k

    def one(job):
        name, f = job
        model = learn.fit(data.where(F.col("fold") != f), features, "y", members[name])
        return model.transform(data.where(F.col("fold") == f)).select(
            F.lit(name).alias("model"), F.col(q(key)), "fold", "y", F.col("prediction").alias("p"))

    jobs = [(name, f) for name in members for f in folds] if len(folds) > 1 else []
    with ThreadPoolExecutor(max(1, parallelism)) as ex:
        parts = list(ex.map(one, jobs))
    if not parts:
        raise ValueError("out-of-fold predictions need rows in at least two folds")
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return cut_lineage(out)


class Ridge:
    """A linear meta-learner on member predictions."""

    def __init__(self, models: Sequence[str], coefficients: Sequence[float], intercept: float, n: int):
        self.models, self.coefficients = list(models), [float(c) for c in coefficients]
        self.intercept, self.n = float(intercept), int(n)

    def predict(self, preds: DataFrame, key: str, model_col: str = "model", pred_col: str = "p") -> DataFrame:
        """``(key, prediction)``, a row for every key; null where a member has none."""
        wide = wide_members(preds, key, self.models, None, model_col, pred_col)
        total = F.lit(self.intercept)
        for m, c in zip(self.models, self.coefficients):
            total = total + F.lit(c) * F.col(q(m))
        return wide.select(F.col(q(key)), total.alias("prediction"))


def fit_ridge(preds: DataFrame, key: str, models: Sequence[str], alpha: float = 1.0, label: str = "y",
              model_col: str = "model", pred_col: str = "p") -> Ridge:
    """``SSE + alpha |w|²`` with a free intercept, from one distributed Gram matrix:
    rows with all members and the label give the sums (``functions.gram``), the driver
    solves a system of ``len(models)``. Without a complete row the weights are 0."""
    from ..functions.gram import pair_sums
    models = list(models)
    wide = wide_members(preds, key, models, label, model_col, pred_col).dropna(subset=[*models, label])
    sums = pair_sums(cut_lineage(wide.select(*[F.col(q(c)) for c in [*models, label]])), [*models, label])
    n = sums["n"][0, 0]
    if not n:
        return Ridge(models, [0.0] * len(models), 0.0, 0)
    mean = np.diag(sums["x"]) / n                      # all columns are complete
    centred = sums["xy"] - n * np.outer(mean, mean)
    m = len(models)
    w = np.linalg.solve(centred[:m, :m] + alpha * np.eye(m), centred[:m, m])
    mean = mean + sums["shift"]
    return Ridge(models, w, mean[m] - w @ mean[:m], n)
