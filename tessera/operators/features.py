"""Generated columns: squares, pairwise products, name-pattern row sums and
means, differences, categorical crosses, and the documented generic rules
(weighted sums, age against a reference year, ratios).

All of them are column expressions added in **one** ``select`` (never a
``withColumn`` loop), so they stay inside whole-stage codegen and Catalyst
analyses the plan once however many columns are generated.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import numeric_cols, q, string_cols
from .encode import NULL_TOKEN


def _append(df: DataFrame, new: list[Column]) -> DataFrame:
    return df.select(*[F.col(q(c)) for c in df.columns], *new)


def polynomial_plan(cols: Sequence[str], degree: int = 2, max_squares: int | None = 10,
                    max_pairs_cols: int | None = 8, max_interactions: int | None = 50):
    """Names of squares and products, in the order they are generated, both of
    degree 2. ``max_interactions`` counts both together; ``None`` is no limit."""
    if degree < 2:
        return []
    out = [("square", c, c) for c in cols[:max_squares]]
    out += [("product", a, b) for a, b in combinations(cols[:max_pairs_cols], 2)]
    return out[:max_interactions]


def polynomial_features(df: DataFrame, cols: Sequence[str] | None = None,
                        exclude: Sequence[str] = (), degree: int = 2,
                        squares: bool = True, products: bool = True,
                        max_squares: int | None = None, max_pairs_cols: int | None = None,
                        max_interactions: int | None = None) -> DataFrame:
    """``{f}_squared`` for the numeric columns and ``{a}_x_{b}`` over their pairs.
    All given columns are used unless the caller sets a limit."""
    cols = list(cols) if cols is not None else numeric_cols(df, exclude)
    new = []
    for kind, a, b in polynomial_plan(cols, degree, max_squares, max_pairs_cols, max_interactions):
        x, y = F.col(q(a)).cast("double"), F.col(q(b)).cast("double")
        if kind == "square" and squares:
            new.append((x * x).alias(f"{a}_squared"))
        elif kind == "product" and products:
            new.append((x * y).alias(f"{a}_x_{b}"))
    return _append(df, new)


def matching(df: DataFrame, patterns: Sequence[str], exclude: Sequence[str] = ()) -> list[str]:
    return [c for c in df.columns if c not in exclude and any(p in c for p in patterns)]


def row_sum(df: DataFrame, patterns: Sequence[str], name: str = "Total_Area",
            exclude: Sequence[str] = ()) -> DataFrame:
    """Sum of every numeric column whose name contains a pattern; nulls count 0."""
    num = set(numeric_cols(df))
    cols = [c for c in matching(df, patterns, exclude) if c in num]
    if not cols:
        return df
    total = sum((F.coalesce(F.col(q(c)).cast("double"), F.lit(0.0)) for c in cols[1:]),
                F.coalesce(F.col(q(cols[0])).cast("double"), F.lit(0.0)))
    return _append(df, [total.alias(name)])


def row_mean(df: DataFrame, patterns: Sequence[str], name: str = "Quality_Score",
             exclude: Sequence[str] = ()) -> DataFrame:
    """Mean over matching columns after a safe numeric cast: text that is not a
    number is missing, missing values are skipped, all missing → null."""
    cols = matching(df, patterns, exclude)
    if not cols:
        return df
    vals = [F.col(q(c)).try_cast("double") for c in cols]
    s = sum((F.coalesce(v, F.lit(0.0)) for v in vals[1:]), F.coalesce(vals[0], F.lit(0.0)))
    n = sum((v.isNotNull().cast("int") for v in vals[1:]), vals[0].isNotNull().cast("int"))
    return _append(df, [F.try_divide(s, n.cast("double")).alias(name)])


def difference(df: DataFrame, a: str, b: str, name: str = "House_Age") -> DataFrame:
    """``a − b`` if both columns exist (timestamps: difference of their years)."""
    if a not in df.columns or b not in df.columns:
        return df
    types = dict(df.dtypes)

    def val(c):
        return F.year(F.col(q(c))) if types[c].startswith(("timestamp", "date")) else F.col(q(c))
    return _append(df, [(val(a) - val(b)).alias(name)])


def crosses(df: DataFrame, cols: Sequence[str] | None = None, first: int | None = None,
            max_crosses: int | None = None, exclude: Sequence[str] = ()) -> DataFrame:
    """``{a}_{b}`` = both values joined by ``_`` for pairs of the
    categorical columns (all, unless the caller sets a limit); a missing value reads ``nan``."""
    cols = list(cols) if cols is not None else string_cols(df, exclude)
    new = []
    for a, b in list(combinations(cols[:first], 2))[:max_crosses]:
        new.append(F.concat_ws("_", F.coalesce(F.col(q(a)), F.lit(NULL_TOKEN)),
                               F.coalesce(F.col(q(b)), F.lit(NULL_TOKEN))).alias(f"{a}_{b}"))
    return _append(df, new)


def weighted_sum(df: DataFrame, weights: Mapping[str, float], name: str) -> DataFrame:
    """Σ wᵢ·xᵢ over the given columns (missing → 0)."""
    terms = [F.lit(float(w)) * F.coalesce(F.col(q(c)).cast("double"), F.lit(0.0))
             for c, w in weights.items() if c in df.columns]
    if not terms:
        return df
    return _append(df, [sum(terms[1:], terms[0]).alias(name)])


def age_from(df: DataFrame, col: str, ref_year: int, name: str) -> DataFrame:
    """``ref_year − year(col)`` (or ``ref_year − col`` for a year number)."""
    types = dict(df.dtypes)
    v = F.year(F.col(q(col))) if types[col].startswith(("timestamp", "date")) else F.col(q(col))
    return _append(df, [(F.lit(ref_year) - v).alias(name)])


def ratio(df: DataFrame, num: str, den: str, name: str) -> DataFrame:
    """``num / den``; a zero denominator gives null instead of an error."""
    return _append(df, [F.try_divide(F.col(q(num)).cast("double"),
                                     F.col(q(den)).cast("double")).alias(name)])
