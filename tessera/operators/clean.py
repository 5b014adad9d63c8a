"""Cleaning: absence codes, imputation, outlier handling.

Order inside the reference cleaner's transform: absence codes → numeric
impute → categorical impute → outliers. Each step here is a fit (global
aggregates, a few numbers per column) plus a one-``select`` transform.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import number, numeric_cols, q, string_cols
from ..functions.joins import small_side
from ..functions.quantiles import column_quantiles
from ..functions.stats import agg_values
from ..session import cut_lineage
from .base import Fitted, replace_columns

# The housing table's "absent" codes (column → category).
ABSENCE_CODES = {
    "GarageType": "No Garage",
    "GarageQual": "None",
    "GarageCond": "None",
    "GarageFinish": "None",
    "BsmtQual": "None",
    "BsmtCond": "None",
    "BsmtFinType1": "None",
    "BsmtFinType2": "None",
    "BsmtExposure": "None",
    "Alley": "None",
    "Fence": "None",
    "MiscFeature": "None",
    "PoolQC": "None",
    "FireplaceQu": "None",
}


def fill_absence(df: DataFrame, codes: Mapping[str, str] = ABSENCE_CODES,
                 na_literal: str = "NA") -> DataFrame:
    """Null or the literal ``'NA'`` becomes the column's absence category.

    Columns of ``codes`` missing from the frame are skipped.
    """
    new = {c: F.coalesce(F.nullif(F.col(q(c)), F.lit(na_literal)), F.lit(v))
           for c, v in codes.items() if c in df.columns}
    return replace_columns(df, new)


class _FittedAbsence(Fitted):
    kind = "absence"

    def __init__(self, codes):
        self.codes = dict(codes)

    def transform(self, df: DataFrame) -> DataFrame:
        return fill_absence(df, self.codes)

    def params(self):
        return {"codes": self.codes}


class fill_absence_stage:
    """Chain stage form of ``fill_absence`` (nothing to learn)."""

    def __init__(self, codes: Mapping[str, str] = ABSENCE_CODES):
        self.codes = codes

    def fit(self, df: DataFrame) -> Fitted:
        return _FittedAbsence(self.codes)


# ---------------------------------------------------------------- imputation

class FittedImputer(Fitted):
    kind = "imputer"

    def __init__(self, strategy: str, values: dict):
        self.strategy = strategy
        self.values = values

    def transform(self, df: DataFrame) -> DataFrame:
        new = {}
        for c, v in self.values.items():
            if c not in df.columns:
                continue
            if isinstance(v, str):
                new[c] = F.coalesce(F.col(q(c)), F.lit(v))
            else:
                x = F.col(q(c)).cast("double")
                x = F.when(F.isnan(x), F.lit(None).cast("double")).otherwise(x)
                new[c] = F.coalesce(x, F.lit(v).cast("double"))
        return replace_columns(df, new)

    def numbers(self):
        return {c: {self.strategy: v} for c, v in self.values.items()
                if not isinstance(v, str)}

    def params(self):
        return {"strategy": self.strategy, "values": self.values}


class Imputer:
    """Column-generic imputer.

    Numeric strategies: ``median`` (exact, distributed), ``mean``,
    ``most_frequent`` / ``mode``, ``constant``, ``none``. Categorical
    strategies: ``most_frequent`` / ``mode`` (tie → smallest value),
    ``constant``, ``none``; ``drop_missing`` and ``forward_fill`` cover the
    documented ``drop`` and ``forward_fill`` strategies.
    Statistics come from the frame passed to ``fit`` only.
    """

    NUMERIC = ("median", "mean", "most_frequent", "mode", "constant", "none")

    def __init__(self, strategy: str = "median", cols: Sequence[str] | None = None,
                 kind: str = "numeric", fill_value=None, exclude: Sequence[str] = (),
                 exact: bool = True):
        if strategy not in self.NUMERIC:
            raise ValueError(f"unknown imputation strategy: {strategy}")
        if strategy == "constant" and fill_value is None:
            raise ValueError("constant imputation needs fill_value")
        self.strategy, self.cols, self.kind = strategy, cols, kind
        self.fill_value, self.exclude, self.exact = fill_value, exclude, exact

    def fit(self, df: DataFrame) -> FittedImputer:
        pick = numeric_cols if self.kind == "numeric" else string_cols
        cols = list(self.cols) if self.cols is not None else pick(df, self.exclude)
        if not cols or self.strategy == "none":       # "none": leave values as they are
            return FittedImputer(self.strategy, {})
        if self.strategy == "constant":
            return FittedImputer(self.strategy, {c: self.fill_value for c in cols})
        if self.strategy == "median":
            med = column_quantiles(df, cols, [0.5], exact=self.exact)
            return FittedImputer(self.strategy, {c: med[c][0] for c in cols})
        if self.strategy == "mean":
            vals = agg_values(df, {f"m{i}": F.avg(number(c)) for i, c in enumerate(cols)})
            return FittedImputer(self.strategy, {c: vals[f"m{i}"] for i, c in enumerate(cols)})
        modes = most_frequent(df, cols)
        if self.kind == "numeric":
            modes = {c: (None if v is None else float(v)) for c, v in modes.items()}
        return FittedImputer(self.strategy, modes)


def most_frequent(df: DataFrame, cols: Sequence[str]) -> dict:
    """Mode of every column in one shuffle; ties → smallest value.

    One unpivot to ``(feature, value)``; the group-by is partially aggregated
    map-side, so a hot value costs one counter per task, not one row.
    """
    cols = list(cols)
    types = dict(df.dtypes)
    numeric = {c for c in cols if types[c] not in ("string",)}
    # numeric values rank by number, strings by text: carry both sort keys
    long = (df.select(*[F.struct(number(c).alias("d") if c in numeric
                                 else F.lit(None).cast("double").alias("d"),
                                 F.when(~F.isnan(F.col(q(c)).cast("double")), F.col(q(c)).cast("string")).alias("s")
                                 if c in numeric else F.col(q(c)).alias("s")).alias(c)
                        for c in cols])
            .unpivot([], cols, "feature", "v")
            .where(F.col("v.s").isNotNull()))
    counts = long.groupBy("feature", F.col("v.d").alias("d"), F.col("v.s").alias("s")) \
                 .agg(F.count("*").alias("n"))
    # pick per feature with an aggregate (partial per task), not a window that
    # would rank all distinct values of a feature in one task:
    # highest count, then smallest value
    best = counts.groupBy("feature").agg(F.min_by(
        F.struct("d", "s"), F.struct((-F.col("n")).alias("m"), "d", "s")).alias("v"))
    out = {c: None for c in cols}
    for r in best.collect():
        out[r["feature"]] = r["v"]["d"] if r["feature"] in numeric else r["v"]["s"]
    return out


#: Rows of a key that one window may hold before the key is cut.
CHUNK_ROWS = 1_000_000


def forward_fill(df: DataFrame, cols: Sequence[str], partition_by: Sequence[str],
                 order_by: Sequence[str], chunk_by: Column | None = None,
                 chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Carry the last non-null value forward inside each partition.

    Both partition and order keys are required: an unpartitioned window would
    pull the whole table into one task. ``chunk_by`` (an expression that never
    decreases along ``order_by``, e.g. ``date_trunc('day', ts)``) splits a hot
    partition key into many window partitions: the fill runs per
    ``(key, chunk)``, each chunk's last non-null value is carried across
    chunks on the small ``(key, chunk)`` table, and joined back — so a key
    holding a third of all rows is spread over many tasks.

    Without ``chunk_by``, keys of more than ``chunk_rows`` rows are counted, and their
    range of the first order column is cut where approximate quantiles of it lie, one
    cut for each ``chunk_rows`` rows; other keys are one chunk. Equal values are never
    cut apart. Order columns that are no numbers, dates or times are not cut.
    """
    if not partition_by or not order_by:
        raise ValueError("forward_fill needs partition_by and order_by")
    order, columns = [F.col(q(c)) for c in order_by], df.columns
    if chunk_by is None:
        df, chunk_by = _cut_hot_keys(df, partition_by, order_by[0], chunk_rows)
    if chunk_by is None:
        w = (Window.partitionBy(*[F.col(q(c)) for c in partition_by]).orderBy(*order)
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
        return replace_columns(df, {c: F.last(F.col(q(c)), ignorenulls=True).over(w)
                                    for c in cols})
    keys = [*partition_by, "__chunk"]
    d = df.withColumn("__chunk", chunk_by).select(*[F.col(q(c)) for c in columns], "__chunk")
    w1 = (Window.partitionBy(*[F.col(q(c)) for c in keys]).orderBy(*order)
          .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = replace_columns(d, {c: F.last(F.col(q(c)), ignorenulls=True).over(w1) for c in cols})
    # each chunk's last non-null value, aggregated straight from the input:
    # partial aggregation map-side, so only one row per (key, chunk) is
    # shuffled (reading it off the window output would shuffle every row twice)
    ordering = F.struct(*order)
    tails = d.groupBy(*[F.col(q(c)) for c in keys]).agg(
        *[F.max_by(F.col(q(c)), F.when(F.col(q(c)).isNotNull(), ordering)).alias(f"__t{i}")
          for i, c in enumerate(cols)])
    w2 = (Window.partitionBy(*[F.col(q(c)) for c in partition_by]).orderBy("__chunk")
          .rowsBetween(Window.unboundedPreceding, -1))
    carry = tails.select(*[F.col(q(c)) for c in keys],
                         *[F.last(f"__t{i}", ignorenulls=True).over(w2).alias(f"__c{i}")
                           for i in range(len(cols))])
    # null-safe keys: a null partition key is one partition, as in the plain window
    carry = carry.select(*[F.col(q(c)).alias(f"__k{i}") for i, c in enumerate(keys)],
                         *[f"__c{i}" for i in range(len(cols))])
    cond = None
    for i, c in enumerate(keys):
        e = F.col(q(c)).eqNullSafe(F.col(f"__k{i}"))
        cond = e if cond is None else cond & e
    j = local.join(carry, cond, "left")
    out = [F.coalesce(F.col(q(c)), F.col(f"__c{cols.index(c)}")).alias(c) if c in cols
           else F.col(q(c)) for c in columns]
    return j.select(*out)


def _cut_hot_keys(df: DataFrame, partition_by: Sequence[str], order: str, chunk_rows: int) -> tuple[DataFrame, Column | None]:
    """``df`` with the cuts of its hot keys as ``__cuts``, and the chunk they give; no
    chunk if no key is hot. A row's chunk is the number of cuts at or before it; nulls
    come first, as in the window's order."""
    kind = dict(df.dtypes)[order]
    if not kind.startswith(("tinyint", "smallint", "int", "bigint", "float", "double", "decimal", "date", "timestamp")):
        return df, None
    keys = [F.col(q(c)).alias(f"__h{i}") for i, c in enumerate(partition_by)]
    names = [f"__h{i}" for i in range(len(keys))]
    hot = cut_lineage(df.select(*keys).groupBy(*names).agg(F.count("*").alias("__n")).where(F.col("__n") > chunk_rows))
    top = hot.agg(F.count("*"), F.max("__n")).first()     # at most rows / chunk_rows hot keys
    if not top[0]:
        return df, None
    small = small_side(hot.select(*names, "__n"))
    same = lambda a, b: reduce(lambda x, y: x & y, [F.col(q(c)).eqNullSafe(F.col(f"{h}{b}")) for c, h in zip(a, names)])
    rows = df.select(*[F.col(q(c)) for c in dict.fromkeys([*partition_by, order])]).join(small, same(partition_by, ""))
    steps = min(10_000, -(-top[1] // chunk_rows))
    at = [i / steps for i in range(1, steps)]
    # every hot key gets the same number of cuts; partial sketches meet by key, so a key is no one task's
    cuts = cut_lineage(rows.groupBy(*names).agg(F.array_distinct(F.percentile_approx(F.col(q(order)), at, 10 * steps)).alias("__cuts"))
                       .select(*[F.col(n).alias(f"{n}c") for n in names], "__cuts"))
    with_cuts = df.join(small_side(cuts), same(partition_by, "c"), "left").drop(*[f"{n}c" for n in names])
    chunk = F.coalesce(F.size(F.filter("__cuts", lambda c: c <= F.col(q(order)))), F.lit(0))
    return with_cuts, F.when(F.col("__cuts").isNull() | F.col(q(order)).isNull(), F.lit(0)).otherwise(chunk)


def drop_missing(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Categorical strategy ``drop``: rows with a null in ``cols`` go."""
    return df.dropna(subset=list(cols))


# ------------------------------------------------------------------ outliers

class FittedClipper(Fitted):
    kind = "outliers"

    def __init__(self, method: str, bounds: dict, means: dict | None = None,
                 stds: dict | None = None, threshold: float | None = None):
        self.method = method
        self.bounds = bounds            # col → (lo, hi) for clipping / z range
        self.means = means or {}
        self.stds = stds or {}
        self.threshold = threshold

    def _clip(self, c: str) -> Column:
        lo, hi = self.bounds[c]
        x = F.col(q(c))
        if lo is None:
            return x
        if self.method == "zscore":
            if hi is None:  # zero spread: nothing is an outlier
                return x
            mu, sd = self.means[c], self.stds[c]
            z = F.abs((x.cast("double") - F.lit(mu)) / F.lit(sd))
            return F.when(z > F.lit(self.threshold), F.lit(mu)).otherwise(x.cast("double"))
        # greatest / least skip nulls, so a missing value must stay missing explicitly
        return F.when(x.isNull(), F.lit(None).cast("double")).otherwise(
            F.least(F.greatest(x.cast("double"), F.lit(lo)), F.lit(hi)))

    def transform(self, df: DataFrame) -> DataFrame:
        return replace_columns(df, {c: self._clip(c) for c in self.bounds if c in df.columns})

    def outside(self, c: str) -> Column:
        lo, hi = self.bounds[c]
        x = F.col(q(c))
        if lo is None or hi is None:
            return F.lit(False)
        if self.method == "zscore":
            z = F.abs((x.cast("double") - F.lit(self.means[c])) / F.lit(self.stds[c]))
            return x.isNotNull() & (z > F.lit(self.threshold))
        return x.isNotNull() & ((x < F.lit(lo)) | (x > F.lit(hi)))

    def numbers(self):
        out = {}
        for c, (lo, hi) in self.bounds.items():
            out[c] = {"lower": lo, "upper": hi}
            if c in self.means:
                out[c]["mean"] = self.means[c]
                out[c]["std"] = self.stds.get(c)
        return out

    def params(self):
        return {"method": self.method, "bounds": self.bounds, "means": self.means,
                "stds": self.stds, "threshold": self.threshold}


class OutlierClipper:
    """``iqr``: clip to [Q1 − t·IQR, Q3 + t·IQR]; ``quantile``: clip to [p_lo, p_hi];
    ``zscore``: values with |z| > t (population std) become the mean.

    Bounds are learned at fit and frozen: applying to another frame never
    recomputes them.
    """

    def __init__(self, method: str = "iqr", threshold: float | None = None,
                 cols: Sequence[str] | None = None, exclude: Sequence[str] = (),
                 lower: float = 0.01, upper: float = 0.99, exact: bool = True):
        if method not in ("iqr", "zscore", "quantile"):
            raise ValueError(f"unknown outlier method: {method}")
        self.method = method
        self.threshold = threshold if threshold is not None else (1.5 if method == "iqr" else 3.0)
        self.cols, self.exclude = cols, exclude
        self.lower, self.upper, self.exact = lower, upper, exact

    def fit(self, df: DataFrame) -> FittedClipper:
        cols = list(self.cols) if self.cols is not None else numeric_cols(df, self.exclude)
        if self.method == "iqr":
            qs = column_quantiles(df, cols, [0.25, 0.75], exact=self.exact)
            t = self.threshold
            bounds = {}
            for c in cols:
                q1, q3 = qs[c]
                bounds[c] = (None, None) if q1 is None else \
                    (q1 - t * (q3 - q1), q3 + t * (q3 - q1))
            return FittedClipper("iqr", bounds)
        if self.method == "quantile":
            qs = column_quantiles(df, cols, [self.lower, self.upper], exact=self.exact)
            return FittedClipper("quantile", {c: tuple(qs[c]) for c in cols})
        vals = agg_values(df, {k: e for i, c in enumerate(cols) for k, e in (
            (f"m{i}", F.avg(number(c))), (f"s{i}", F.stddev_pop(number(c))))})
        bounds, means, stds = {}, {}, {}
        for i, c in enumerate(cols):
            mu, sd = vals[f"m{i}"], vals[f"s{i}"]
            means[c], stds[c] = mu, sd
            if mu is None:
                bounds[c] = (None, None)
            elif not sd:
                bounds[c] = (mu, None)
            else:
                bounds[c] = (mu - self.threshold * sd, mu + self.threshold * sd)
        return FittedClipper("zscore", bounds, means, stds, self.threshold)


def outlier_counts(df: DataFrame, fitted: FittedClipper) -> DataFrame:
    """``(feature, lower, upper, n_outliers)``: values a fitted clipper would touch."""
    spark = df.sparkSession
    cols = [c for c in fitted.bounds if c in df.columns]
    vals = agg_values(df, {f"o{i}": F.count_if(fitted.outside(c)) for i, c in enumerate(cols)})
    rows = [(c, fitted.bounds[c][0], fitted.bounds[c][1], int(vals[f"o{i}"]))
            for i, c in enumerate(cols)]
    return spark.createDataFrame(
        rows, "feature string, lower double, upper double, n_outliers bigint")

