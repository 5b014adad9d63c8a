"""Scalers: standard (population std), robust (median / IQR), min-max.

Fit is one aggregate (or the distributed exact quantile passes for
``robust``); transform is ``(x − center) / scale`` in one projection, and the
inverse is ``x · scale + center``. Zero spread → scale 1. Nulls are ignored by
the fit and kept by the transform.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import numeric_cols, q
from ..functions.quantiles import column_quantiles
from ..functions.stats import moments
from .base import Fitted, replace_columns


class FittedScaler(Fitted):
    kind = "scaler"

    def __init__(self, strategy: str, center: dict, scale: dict):
        self.strategy, self.center, self.scale = strategy, center, scale

    def transform(self, df: DataFrame) -> DataFrame:
        if self.strategy == "none":
            return df
        return replace_columns(df, {
            c: (F.col(q(c)).cast("double") - F.lit(self.center[c])) / F.lit(self.scale[c])
            for c in self.center if c in df.columns and self.center[c] is not None})

    def inverse_transform(self, df: DataFrame) -> DataFrame:
        if self.strategy == "none":
            return df
        return replace_columns(df, {
            c: F.col(q(c)).cast("double") * F.lit(self.scale[c]) + F.lit(self.center[c])
            for c in self.center if c in df.columns and self.center[c] is not None})

    def numbers(self):
        """The reference's stat names: standard {mean, std}; robust {center, scale};
        min-max {min, scale} with scale = 1 / (max − min)."""
        out = {}
        for c in self.center:
            m, s = self.center[c], self.scale[c]
            if self.strategy == "standard":
                out[c] = {"mean": m, "std": s}
            elif self.strategy == "robust":
                out[c] = {"center": m, "scale": s}
            elif self.strategy == "minmax":
                out[c] = {"min": m, "scale": None if s is None else 1.0 / s}
        return out

    def stats(self, spark: SparkSession) -> DataFrame:
        rows = [(self.strategy, f, s, None if v is None else float(v))
                for f, d in self.numbers().items() for s, v in d.items()]
        return spark.createDataFrame(
            rows, "scaler string, feature string, stat string, value double")

    def params(self):
        return {"strategy": self.strategy, "center": self.center, "scale": self.scale}


class Scaler:
    STRATEGIES = ("standard", "robust", "minmax", "none")

    def __init__(self, strategy: str = "robust", cols: Sequence[str] | None = None,
                 exclude: Sequence[str] = (), exact: bool = True):
        if strategy not in self.STRATEGIES:
            raise ValueError(f"unknown scaling strategy: {strategy}")
        self.strategy, self.cols, self.exclude, self.exact = strategy, cols, exclude, exact

    def fit(self, df: DataFrame) -> FittedScaler:
        cols = list(self.cols) if self.cols is not None else numeric_cols(df, self.exclude)
        center, scale = {}, {}
        if self.strategy == "none" or not cols:
            return FittedScaler(self.strategy, {}, {})
        if self.strategy == "robust":
            qs = column_quantiles(df, cols, [0.25, 0.5, 0.75], exact=self.exact)
            for c in cols:
                q1, med, q3 = qs[c]
                center[c] = med
                scale[c] = None if q1 is None else ((q3 - q1) or 1.0)
        else:
            mo = moments(df, cols)
            for c in cols:
                m = mo[c]
                if self.strategy == "standard":
                    center[c] = m["mean"]
                    scale[c] = None if m["std"] is None else (m["std"] or 1.0)
                else:
                    center[c] = m["min"]
                    scale[c] = None if m["min"] is None else ((m["max"] - m["min"]) or 1.0)
        return FittedScaler(self.strategy, center, scale)
