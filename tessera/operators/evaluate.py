"""Evaluation and report data: metrics, comparison, ranking, error analysis,
long / pivoted reports, chart data (top-N, binned scatter, histogram, box,
correlation matrix).

Every metric is one aggregate over the long prediction table grouped by
``model`` (and split) — not a loop over models. Tables that are one row per
model (rankings, reports) are tiny by construction.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import q
from ..functions.quantiles import group_quantiles, quantiles
from ..functions.joins import small_side
from ..session import cut_lineage, materialized

METRICS = ("rmse", "mae", "r2", "mape")


def metric_exprs(y: Column, p: Column, prefix: str = "") -> list[Column]:
    """RMSE, MAE, R² = 1 − SSE/SST, MAPE as a ratio over y ≠ 0 (∞ if none)."""
    e = y - p
    sse = F.sum(e * e)
    sst = F.var_pop(y) * F.count(y)
    r2 = (F.when(sst == 0, F.when(sse == 0, F.lit(1.0)).otherwise(F.lit(0.0)))
          .otherwise(F.lit(1.0) - sse / sst))
    mape = F.when(F.count_if(y != 0) == 0, F.lit(float("inf"))).otherwise(
        F.avg(F.when(y != 0, F.abs(e) / F.abs(y))))
    return [F.sqrt(F.avg(e * e)).alias(f"{prefix}rmse"),
            F.avg(F.abs(e)).alias(f"{prefix}mae"),
            r2.alias(f"{prefix}r2"),
            mape.alias(f"{prefix}mape")]


def _pairs(df: DataFrame, y: str, p: str) -> DataFrame:
    return df.where(F.col(q(y)).isNotNull() & F.col(q(p)).isNotNull())


def metrics(df: DataFrame, y: str = "y", p: str = "p", by: Sequence[str] = (),
            prefix: str = "") -> DataFrame:
    """One row of metrics per group of ``by`` (one row in total without)."""
    d = _pairs(df, y, p)
    yc, pc = F.col(q(y)).cast("double"), F.col(q(p)).cast("double")
    ex = [F.count("*").alias(f"{prefix}n"), *metric_exprs(yc, pc, prefix)]
    return d.groupBy(*[F.col(q(b)) for b in by]).agg(*ex)


def metric_bundle(df: DataFrame, y: str = "y", p: str = "p", by: Sequence[str] = ("model",),
                  split_col: str = "split", splits: Sequence[str] = ("train", "test"),
                  folds: DataFrame | None = None, metric: str = "rmse") -> DataFrame:
    """Train / test metrics side by side with ``train_`` / ``test_`` prefixes, in
    one aggregate (each split's metrics over its masked rows, no pivot). With
    ``folds`` (per-fold metrics, ``(*by, fold, n, rmse, …)``) the cross-validation part
    joins it: ``cv_folds``, ``cv_scores`` (``metric`` of each fold, in fold order),
    ``cv_mean`` and ``cv_std`` (population); null for a group without folds."""
    if folds is not None and not by:
        raise ValueError("folds are joined by the columns of by")
    d = _pairs(df, y, p)
    ex = []
    for s in splits:
        m = F.col(q(split_col)) == F.lit(s)
        ym = F.when(m, F.col(q(y)).cast("double"))
        pm = F.when(m, F.col(q(p)).cast("double"))
        ex += [F.count(ym).alias(f"{s}_n"), *metric_exprs(ym, pm, f"{s}_")]
    out = d.groupBy(*[F.col(q(b)) for b in by]).agg(*ex)
    if folds is None:
        return out
    scores = F.array_sort(F.collect_list(F.struct("fold", F.col(q(metric)).alias("__s"))))   # one entry a fold
    cv = folds.groupBy(*[F.col(q(b)) for b in by]).agg(
        F.count("*").alias("cv_folds"), F.transform(scores, lambda x: x["__s"]).alias("cv_scores"),
        F.avg(F.col(q(metric))).alias("cv_mean"), F.stddev_pop(F.col(q(metric))).alias("cv_std"))
    return out.join(cv, list(by), "left")


def compare_with_truth(pred: DataFrame, truth: DataFrame, key: str, label: str,
                       pred_col: str | None = None) -> DataFrame:
    """Inner equi-join of predictions with labels, ``_pred``/``_true`` suffixes,
    absolute and relative error (relative is null where the label is 0)."""
    pred_col = pred_col or label
    pv, tv = f"{label}_pred", f"{label}_true"
    j = (pred.select(F.col(q(key)), F.col(q(pred_col)).cast("double").alias(pv))
         .join(truth.select(F.col(q(key)), F.col(q(label)).cast("double").alias(tv)), key, "inner"))
    return j.select(F.col(q(key)), F.col(pv), F.col(tv),
                    F.abs(F.col(tv) - F.col(pv)).alias("Absolute_Error"),
                    F.abs(F.try_divide(F.col(tv) - F.col(pv), F.col(tv))).alias("Relative_Error"))


def rank_models(metric_table: DataFrame, metric: str = "rmse",
                model_col: str = "model") -> DataFrame:
    """Rank by the metric ascending (ties by name). The input has one row per
    model, so the global window is over a handful of rows."""
    w = Window.orderBy(F.col(metric).asc_nulls_last(), F.col(model_col))
    r = metric_table.withColumn("rank", F.row_number().over(w).cast("bigint"))
    return r.withColumn("is_best", F.col("rank") == 1)


def error_analysis(df: DataFrame, y: str = "y", p: str = "p",
                   by: Sequence[str] = ("model",), exact: bool = True) -> DataFrame:
    """mean / population std / min / max of (y − p); median, p90, p95 of |y − p|."""
    d = _pairs(df, y, p).select(*[F.col(q(b)) for b in by],
                                (F.col(q(y)) - F.col(q(p))).alias("__e"))
    d = materialized(d.withColumn("__a", F.abs("__e")))      # read by 2 aggregates
    mom = d.groupBy(*[F.col(q(b)) for b in by]).agg(
        F.avg("__e").alias("mean_error"), F.stddev_pop("__e").alias("std_error"),
        F.min("__e").alias("min_error"), F.max("__e").alias("max_error"))
    names = ["median_abs_error", "percentile_90_error", "percentile_95_error"]
    if not by:
        values = quantiles(d, ["__a"], [0.5, 0.9, 0.95], exact=exact)[((), "__a")]
        return mom.select("*", *[F.lit(v).alias(c) for c, v in zip(names, values)])
    return _with_quantiles(mom, d, "__a", [0.5, 0.9, 0.95], by, exact, names)


def _with_quantiles(table: DataFrame, d: DataFrame, col: str, probs: Sequence[float], by: Sequence[str], exact: bool,
                    names: Sequence[str]) -> DataFrame:
    """``table`` (rows with the columns ``by``) with the groups' quantiles of ``col`` (null
    where a group has only NaN); any number of groups."""
    if exact:
        qt = cut_lineage(group_quantiles(d, col, probs, by))
    else:
        qt = d.groupBy(*[F.col(q(b)) for b in by]).agg(F.percentile_approx(col, list(probs)).alias("__q")).select(
            *[F.col(q(b)) for b in by], *[F.get("__q", F.lit(i)).alias(f"q{i}") for i in range(len(probs))])
    # null groups are groups too
    keys = qt.select(*[F.col(q(b)).alias(f"__k{i}") for i, b in enumerate(by)], *[F.col(f"q{i}").alias(n) for i, n in enumerate(names)])
    cond = F.lit(True)
    for i, b in enumerate(by):
        cond = cond & F.col(q(b)).eqNullSafe(F.col(f"__k{i}"))
    return table.join(small_side(keys), cond, "left").drop(*[f"__k{i}" for i in range(len(by))])


def metric_report(metric_table: DataFrame, model_col: str = "model",
                  metrics_: Sequence[str] = METRICS) -> DataFrame:
    """Long ``(Model, Metric, Value)`` report of a per-model metric table."""
    return (metric_table.select(F.col(model_col).alias("Model"),
                                *[F.col(m).cast("double") for m in metrics_])
            .unpivot(["Model"], list(metrics_), "Metric", "Value"))


def metric_pivot(report: DataFrame, metrics_: Sequence[str]) -> DataFrame:
    """Models × metrics from the long report; a metric a model lacks is null
    (the comparison bars read it as 0)."""
    return report.groupBy("Model").pivot("Metric", list(metrics_)).agg(F.first("Value"))


def comparison_bars(report: DataFrame, metric: str = "rmse") -> DataFrame:
    """``(Model, value)`` of one metric for a bar chart; a model without it reads 0."""
    models = report.select("Model").distinct()
    vals = report.where(F.col("Metric") == metric).select("Model", F.col("Value"))
    return models.join(vals, "Model", "left").select(
        "Model", F.coalesce(F.col("Value"), F.lit(0.0)).alias(metric))


def top_n(scores: DataFrame, n: int = 30, score: str = "importance",
          feature: str = "feature") -> DataFrame:
    """Top-N report: a limit that *is* the feature; ties broken by name."""
    w = Window.orderBy(F.col(score).desc(), F.col(feature))
    return scores.withColumn("rank", F.row_number().over(w).cast("bigint")) \
                 .where(F.col("rank") <= n)


def _ungrouped(report, df: DataFrame, y: str, p: str, **options) -> DataFrame:
    """``report`` over the whole table as one group."""
    one = df.select(F.col(q(y)), F.col(q(p)), F.lit("all").alias("__all"))
    return report(one, y, p, ("__all",), **options).drop("__all")


def scatter_bins(df: DataFrame, y: str = "y", p: str = "p", by: Sequence[str] = ("model",),
                 bins: int = 20) -> DataFrame:
    """Actual-vs-predicted as 2-D binned counts over the common [lo, hi] bound.

    The bound is ``least(min y, min p)`` / ``greatest(max y, max p)`` per group
    (of the whole table without ``by``).
    """
    if not by:
        return _ungrouped(scatter_bins, df, y, p, bins=bins)
    byc = [F.col(q(b)) for b in by]
    d = materialized(_pairs(df, y, p).select(*byc, F.col(q(y)), F.col(q(p))))   # read twice
    bound = d.groupBy(*byc).agg(F.least(F.min(q(y)), F.min(q(p))).alias("lo"),
                                F.greatest(F.max(q(y)), F.max(q(p))).alias("hi"))
    bound = cut_lineage(bound)                               # one row per group, computed once
    j = d.join(small_side(bound), list(by), "inner")

    def b(c):
        return F.coalesce(F.least(F.floor(F.try_divide(F.col(q(c)) - F.col("lo"),
                                                       F.col("hi") - F.col("lo")) * bins),
                                  F.lit(bins - 1)), F.lit(0)).cast("bigint")
    return (j.groupBy(*byc, "lo", "hi", b(y).alias("bin_true"), b(p).alias("bin_pred"))
            .agg(F.count("*").alias("n")))


def error_histogram(df: DataFrame, y: str = "y", p: str = "p", by: Sequence[str] = ("model",),
                    bins: int = 50) -> DataFrame:
    """Equal-width histogram of y − p from min to max, last bin closed; empty
    bins are listed (``sequence`` explode on the per-group bounds, no cross join)."""
    if not by:
        return _ungrouped(error_histogram, df, y, p, bins=bins)
    byc = [F.col(q(b)) for b in by]
    e = materialized(_pairs(df, y, p).select(*byc, (F.col(q(y)) - F.col(q(p))).alias("__e")))
    rng = e.groupBy(*byc).agg(F.min("__e").alias("lo"), F.max("__e").alias("hi"))
    b = F.coalesce(F.least(F.floor(F.try_divide(F.col("__e") - F.col("lo"),
                                                F.col("hi") - F.col("lo")) * bins),
                           F.lit(bins - 1)), F.lit(0)).cast("bigint")
    rng = cut_lineage(rng)                                   # one row per group
    counts = cut_lineage(e.join(small_side(rng), list(by), "inner")
                         .groupBy(*byc, b.alias("bin")).agg(F.count("*").alias("n")))
    grid = rng.select(*byc, "lo", "hi",
                      F.explode(F.sequence(F.lit(0).cast("bigint"),
                                           F.lit(bins - 1).cast("bigint"))).alias("bin"))
    width = (F.col("hi") - F.col("lo")) / bins
    return (grid.join(small_side(counts), [*by, "bin"], "left")   # ≤ groups × bins rows
            .select(*byc, "bin",
                    (F.col("lo") + F.col("bin") * width).alias("left"),
                    (F.col("lo") + (F.col("bin") + 1) * width).alias("right"),
                    F.coalesce(F.col("n"), F.lit(0)).cast("bigint").alias("n")))


def error_box(df: DataFrame, y: str = "y", p: str = "p", by: Sequence[str] = ("model",),
              whisker: float = 1.5, exact: bool = True) -> DataFrame:
    """Box-plot numbers of y − p: Q1, median, Q3 and the whiskers (the extreme
    values inside [Q1 − 1.5·IQR, Q3 + 1.5·IQR])."""
    if not by:
        return _ungrouped(error_box, df, y, p, whisker=whisker, exact=exact)
    d = materialized(_pairs(df, y, p).select(*[F.col(q(b)) for b in by],
                                             (F.col(q(y)) - F.col(q(p))).alias("__e")))
    boxed = _with_quantiles(d, d, "__e", [0.25, 0.5, 0.75], by, exact, ["q1", "median", "q3"])
    lo = F.col("q1") - whisker * (F.col("q3") - F.col("q1"))
    hi = F.col("q3") + whisker * (F.col("q3") - F.col("q1"))
    return (boxed.groupBy(*[F.col(q(b)) for b in by], "q1", "median", "q3")
            .agg(F.min(F.when(F.col("__e") >= lo, F.col("__e"))).alias("whisker_low"),
                 F.max(F.when(F.col("__e") <= hi, F.col("__e"))).alias("whisker_high"),
                 F.count_if((F.col("__e") < lo) | (F.col("__e") > hi)).alias("n_outliers")))


def correlation_matrix(df: DataFrame, cols: Sequence[str] | None = None,
                       limit: int | None = None) -> DataFrame:
    """Pearson r for every ordered pair (pairwise-complete), stacked to
    ``(feature_a, feature_b, r)``; null without spread or common rows.

    One scan, with or without nulls: masked sums of products by pair
    (``functions.gram``), added on the executors.
    """
    from ..functions.columns import numeric_cols
    from ..functions.gram import correlations, pair_sums
    cols = list(cols) if cols is not None else numeric_cols(df)[:limit]
    r = correlations(pair_sums(df, cols)) if cols else []
    rows = [(a, b, None if r[i][j] != r[i][j] else float(r[i][j])) for i, a in enumerate(cols) for j, b in enumerate(cols)]
    return df.sparkSession.createDataFrame(rows, "feature_a string, feature_b string, r double")
