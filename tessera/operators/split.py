"""Deterministic hold-out splits and k-fold assignment from a key column.

A split is a pure function of the key (no ``randomSplit``, no ``rand()``), so
a retried task or a lost executor recomputes exactly the same assignment, and
no shuffle is needed. ``method='hash'`` (default) uses ``xxhash64(key, seed)``;
``method='modulo'`` uses ``key mod k`` for portable oracles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import q


def fold_of(key: str, k: int, seed: int = 42, method: str = "hash") -> Column:
    if method == "modulo":
        return F.pmod(F.col(q(key)), F.lit(k)).cast("int")
    if method != "hash":
        raise ValueError(f"unknown split method: {method}")
    return F.pmod(F.xxhash64(F.col(q(key)), F.lit(seed)), F.lit(k)).cast("int")


def holdout(df: DataFrame, key: str, test_fraction: float = 0.2, seed: int = 42,
            method: str = "hash", col: str = "split") -> DataFrame:
    """Add ``split`` ∈ {train, test}; ``test_fraction`` = 1/k for an integer k."""
    k = round(1.0 / test_fraction)
    if abs(k * test_fraction - 1.0) > 1e-9:
        raise ValueError("test_fraction must be 1/k for an integer k")
    return df.withColumn(col, F.when(fold_of(key, k, seed, method) == 0, F.lit("test"))
                         .otherwise(F.lit("train")))


def with_folds(df: DataFrame, key: str, k: int = 5, seed: int = 42, method: str = "hash",
               col: str = "fold") -> DataFrame:
    return df.withColumn(col, fold_of(key, k, seed, method))


def is_train(key: str, k: int = 5, method: str = "modulo", seed: int = 42) -> Column:
    return fold_of(key, k, seed, method) != 0
