"""Column roles and small expression helpers shared by all operators."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The tokens a CSV reader with default settings reads as missing.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)


def numeric_cols(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """Numeric columns in frame order (booleans and timestamps excluded)."""
    skip = set(exclude)
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.NumericType) and f.name not in skip]


def string_cols(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    skip = set(exclude)
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.StringType) and f.name not in skip]


def q(name: str) -> str:
    """Back-quote a column name for use inside Spark SQL expressions."""
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    return F.col(q(name))


def number(name: str) -> Column:
    """A column as double, NaN as null: a missing value, however it was written."""
    x = F.col(q(name)).cast("double")
    return F.when(~F.isnan(x), x)




def round6(c: Column, places: int = 6) -> Column:
    """Round for oracle comparison as ``floor(x·10⁶ + 0.5) / 10⁶``.

    The same three IEEE operations give bit-identical results in any engine
    (decimal ``round`` implementations disagree on ties and on values past
    2^53 / 10⁶); ``+ 0.0`` folds ``-0.0`` into ``0.0``. Values beyond ±1e12
    and non-finite ones pass through unchanged.
    """
    x = c.cast("double")
    k = float(10 ** places)
    r = F.floor(x * F.lit(k) + F.lit(0.5)).cast("double") / F.lit(k)
    return F.when(F.abs(x) < F.lit(1e12), r).otherwise(x) + F.lit(0.0)




def chunks(seq: Sequence, size: int) -> list[Sequence]:
    return [seq[i:i + size] for i in range(0, len(seq), size)]
