"""Sinks: the long prediction table, search results, fitted stats; and the
summary of a written prediction catalog.

Predictions are one long table ``(model, key, prediction)`` written
partitioned by ``model``: reading one model back prunes to its folder, and a
summary is one ``groupBy(model)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import q

FORMATS = ("parquet", "csv", "json")


def write_predictions(preds: DataFrame, path: str, fmt: str = "parquet",
                      model_col: str = "model", replace_all: bool = False) -> None:
    """One folder per model (``partitionBy``). Writing replaces the folders of the
    models in ``preds`` and leaves the others (dynamic partition overwrite), so a
    model can be written again; ``replace_all`` replaces the whole table."""
    if fmt not in FORMATS:
        raise ValueError(f"unknown format: {fmt}")
    w = preds.write.mode("overwrite").partitionBy(model_col) \
        .option("partitionOverwriteMode", "static" if replace_all else "dynamic")
    if fmt == "csv":
        w = w.option("header", True)
    getattr(w, fmt)(path)


def read_predictions(spark: SparkSession, path: str, fmt: str = "parquet",
                     schema: str | None = None) -> DataFrame:
    r = spark.read
    if fmt == "csv":
        r = r.option("header", True)
        if schema is None:
            r = r.option("inferSchema", True)
    if schema is not None:
        r = r.schema(schema)
    return getattr(r, fmt)(path)


def prediction_summary(preds: DataFrame, model_col: str = "model",
                       pred_col: str = "prediction") -> DataFrame:
    """Rows per model and the range of its predictions (one aggregate)."""
    return preds.groupBy(F.col(q(model_col))).agg(
        F.count("*").alias("n_rows"), F.min(F.col(q(pred_col))).alias("min_prediction"),
        F.max(F.col(q(pred_col))).alias("max_prediction"))


def write_search_results(history: DataFrame, path: str) -> None:
    """Search history (trial, params, value …) as JSON lines."""
    history.write.mode("overwrite").json(path)
