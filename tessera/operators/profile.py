"""Profiling, validation and label matching."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import q
from ..functions.quantiles import column_quantiles
from ..functions.stats import agg_values
from ..session import materialized


def missing_summary(df: DataFrame) -> DataFrame:
    """``(Feature, Missing_Count, Missing_Percent)`` for columns with nulls or NaNs,
    highest share first (ties by name). One aggregate over all columns."""
    cols, types = df.columns, dict(df.dtypes)
    vals = agg_values(df, {"__n": F.count(F.lit(1)),
                           **{f"m{i}": F.count_if(F.col(q(c)).isNull() | (F.isnan(F.col(q(c))) if types[c] in ("double", "float")
                                                                         else F.lit(False))) for i, c in enumerate(cols)}})
    n = vals["__n"]
    rows = [(c, int(vals[f"m{i}"]), 100.0 * vals[f"m{i}"] / n)
            for i, c in enumerate(cols) if n and vals[f"m{i}"] > 0]
    rows.sort(key=lambda r: (-r[2], r[0]))
    rows = [(*r, k + 1) for k, r in enumerate(rows)]
    return df.sparkSession.createDataFrame(
        rows, "Feature string, Missing_Count bigint, Missing_Percent double, rank bigint")


def label_stats(df: DataFrame, label: str, exact: bool = True) -> DataFrame:
    """rows, nulls, min, max, mean, median of the label column."""
    x = F.col(q(label)).cast("double")
    v = agg_values(df, {"n_rows": F.count(F.lit(1)), "n_null": F.count_if(x.isNull()),
                        "min": F.min(x), "max": F.max(x), "mean": F.avg(x)})
    med = column_quantiles(df, [label], [0.5], exact=exact)[label][0]
    return df.sparkSession.createDataFrame(
        [(label, v["n_rows"], v["n_null"], v["min"], v["max"], v["mean"], med)],
        "label string, n_rows bigint, n_null bigint, min double, max double, "
        "mean double, median double")


def dedupe_last(labels: DataFrame, key: str, label: str, order: str) -> DataFrame:
    """One label per key; with duplicates the **last** (highest ``order``, then the
    largest label) wins. A table has no order of its own, so a column must name it."""
    return labels.groupBy(F.col(q(key))).agg(
        F.max_by(F.col(q(label)), F.struct(F.col(q(order)), F.col(q(label)))).alias(label))


def match_labels(ids: DataFrame, labels: DataFrame, key: str, label: str,
                 order: str) -> DataFrame:
    """Label of every requested id (missing → null): left equi-join after the
    dedupe by ``order`` (a table of unique keys may name any column). Both sides are keyed on ``key``; Spark shuffles both on it (or AQE
    broadcasts the label side when it is small at run time)."""
    lab = dedupe_last(labels.select(*[F.col(q(c)) for c in dict.fromkeys((key, label, order))]), key, label, order)
    return ids.select(F.col(q(key))).join(lab, key, "left")


def unmatched_ids(ids: DataFrame, labels: DataFrame, key: str, first: int = 10) -> DataFrame:
    """Ids without a label (left anti-join, run once): their total and the first ``first``."""
    miss = materialized(ids.select(F.col(q(key))).join(labels.select(F.col(q(key))), key, "left_anti"))
    total = miss.count()
    # top-k without a global sort of all misses (TakeOrderedAndProject: each
    # task keeps its k smallest); the window then ranks at most k rows
    w = Window.orderBy(F.col(q(key)))
    return (miss.orderBy(F.col(q(key))).limit(first)
            .select(F.row_number().over(w).cast("bigint").alias("rank"), F.col(q(key)),
                    F.lit(total).cast("bigint").alias("n_unmatched")))


def validate_labels(df: DataFrame, key: str, label: str, template_cols: Sequence[str] | None = None,
                    contract: Sequence[tuple[str, str]] | None = None) -> DataFrame:
    """Contract of a label table, one row a check: ``(check, severity, violations, passed)``.

    Errors: columns that are not the template's in its order (``columns_match``, 1 if
    so), null keys, a label that is not numeric, null labels. Non-positive labels only warn.
    With ``contract`` (``scan.contract_of`` of a template) its columns are the template's
    and three checks more run: ``column_set`` (columns missing or not wanted),
    ``column_types`` (shared columns of another type) and ``duplicate_key`` (rows beyond the
    first of their key, null keys left out). A table without the key or the label
    violates its checks with every row.
    """
    if contract is not None:
        template_cols = [c for c, _ in contract]
    if template_cols is None:
        raise ValueError("validate_labels needs template_cols or a contract")
    same_cols = list(df.columns) == list(template_cols)
    numeric = isinstance(df.schema[label].dataType, T.NumericType) if label in df.columns else False
    every = F.lit(True)
    value = F.col(q(label)) if label in df.columns else None
    v = agg_values(df, {"nk": F.count_if(F.col(q(key)).isNull() if key in df.columns else every),
                        "nl": F.count_if(every if value is None else value.isNull()),
                        "np": F.count_if(F.lit(False) if value is None else value.try_cast("double") <= 0)})
    rows = [("columns_match", "error", 0 if same_cols else 1),
            ("null_key", "error", v["nk"]),
            ("numeric_label", "error", 0 if numeric else 1),
            ("null_label", "error", v["nl"]),
            ("non_positive_label", "warning", v["np"])]
    if contract is not None:
        types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
        repeats = 0
        if key in df.columns:
            repeats = (df.where(F.col(q(key)).isNotNull()).groupBy(F.col(q(key))).count()
                       .agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("n")).first()["n"])
        rows += [("column_set", "error", len(set(types) ^ set(template_cols))),
                 ("column_types", "error", sum(c in types and types[c] != t for c, t in contract)),
                 ("duplicate_key", "error", repeats)]
    return df.sparkSession.createDataFrame(
        [(c, s, int(n), int(n) == 0) for c, s, n in rows],
        "check string, severity string, violations bigint, passed boolean")
