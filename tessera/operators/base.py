"""Fit / transform protocol.

``op.fit(df)`` runs a few aggregations and returns a ``Fitted`` whose state is a
small stats table; ``Fitted.transform(df)`` only extends the logical plan (one
projection, or a join with a category map), so Catalyst collapses a chain of
transforms and pushes filters / column pruning through it.
"""

from __future__ import annotations

import json
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import q


class NotFittedError(RuntimeError):
    pass


class Fitted:
    """Base for fitted operators: ``transform`` plus a long stats table."""

    kind = "fitted"

    def transform(self, df: DataFrame) -> DataFrame:  # pragma: no cover - abstract
        raise NotImplementedError

    def stats(self, spark: SparkSession) -> DataFrame:
        """Long ``(feature, stat, value)`` table of the fitted numbers."""
        rows = [(f, s, None if v is None else float(v))
                for f, d in self.numbers().items() for s, v in d.items()]
        return spark.createDataFrame(rows, "feature string, stat string, value double")

    def numbers(self) -> dict[str, dict[str, float]]:
        return {}

    def params(self) -> dict:
        return {}

    def save(self, path: str) -> None:
        spark = SparkSession.getActiveSession()
        self.stats(spark).write.mode("overwrite").parquet(os.path.join(path, "stats"))
        meta = {"kind": self.kind, "params": self.params()}
        spark.createDataFrame([(json.dumps(meta),)], "meta string") \
             .write.mode("overwrite").json(os.path.join(path, "meta"))


def load_meta(spark: SparkSession, path: str) -> tuple[dict, DataFrame]:
    meta = json.loads(spark.read.json(os.path.join(path, "meta")).first()["meta"])
    return meta, spark.read.parquet(os.path.join(path, "stats"))


def load(spark: SparkSession, path: str) -> Fitted:
    """Rebuild a fitted operator (or chain) written by ``Fitted.save``."""
    from . import clean, encode, scale
    meta, stats = load_meta(spark, path)
    kind, p = meta["kind"], meta["params"]
    if kind == "chain":
        from ..plans.chain import FittedChain
        return FittedChain([load(spark, os.path.join(path, f"stage_{i}"))
                            for i in range(len(p["stages"]))])
    if kind == "imputer":
        return clean.FittedImputer(p["strategy"], p["values"])
    if kind == "absence":
        return clean._FittedAbsence(p["codes"])
    if kind == "outliers":
        return clean.FittedClipper(p["method"], {c: tuple(b) for c, b in p["bounds"].items()},
                                   p["means"], p["stds"], p["threshold"])
    if kind == "scaler":
        return scale.FittedScaler(p["strategy"], p["center"], p["scale"])
    if kind == "onehot":
        return encode.FittedOneHot(p["cols"], p["categories"], p["keep"])
    if kind == "sparse_onehot":
        return encode.FittedSparseOneHot(load(spark, os.path.join(path, "labels")), p["sizes"])
    if kind == "category_map":
        literal, table = None, None
        if p["literal"]:
            literal = {c: {} for c in p["cols"]}
            for r in stats.collect():
                literal[r["feature"]][r["stat"]] = r["value"]
        else:
            table = spark.read.parquet(os.path.join(path, "table"))
        return encode.FittedMap(p["strategy"], p["cols"], table, p["size"], p["literal_limit"],
                                p["default"], p["null_code"], p["handle_unseen"], literal,
                                p.get("broadcast", False), p.get("hot"), p.get("salts", 64))
    raise ValueError(f"unknown fitted kind: {kind}")


def stats_to_numbers(stats: DataFrame) -> dict[str, dict[str, float]]:
    out: dict[str, dict[str, float]] = {}
    for r in stats.collect():
        out.setdefault(r["feature"], {})[r["stat"]] = r["value"]
    return out


def replace_columns(df: DataFrame, new: dict, drop: set | None = None,
                    append: list | None = None) -> DataFrame:
    """One ``select`` that swaps some columns for expressions, keeping frame order."""
    drop = drop or set()
    exprs = []
    for c in df.columns:
        if c in drop:
            continue
        exprs.append(new[c].alias(c) if c in new else F.col(q(c)))
    return df.select(*exprs, *(append or []))
