"""One-pass multi-column statistics.

Every fit in the engine is a handful of global aggregations whose result is a
few numbers per column. ``agg_values`` runs them as one job per chunk of
expressions (partial aggregation on the executors, one small row to the
driver), so the driver only ever sees O(columns) values.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .columns import chunks, q, number

# Expressions per aggregate job: keeps each job's generated per-row code small
# enough for the JIT to compile (methods over 8 KB of bytecode run interpreted).
AGG_CHUNK = 16


def agg_values(df: DataFrame, exprs: Mapping[str, Column]) -> dict:
    """Evaluate named aggregate expressions over ``df``; returns ``{name: value}``.

    Chunks of ``AGG_CHUNK`` expressions run as concurrent jobs; each reads only
    the columns its expressions need.
    """
    from concurrent.futures import ThreadPoolExecutor
    names = list(exprs)
    parts = chunks(names, AGG_CHUNK)

    def run(part):
        row = df.agg(*[exprs[n].alias(n) for n in part]).first()
        return {n: (row[n] if row is not None else None) for n in part}

    out: dict = {}
    if len(parts) == 1:
        return run(parts[0])
    with ThreadPoolExecutor(min(4, len(parts))) as ex:
        for r in ex.map(run, parts):
            out.update(r)
    return out


def moments(df: DataFrame, cols: list[str]) -> dict[str, dict[str, float]]:
    """count / mean / population std / min / max of each column, one pass."""
    exprs: dict[str, Column] = {}
    for i, c in enumerate(cols):
        x = number(c)
        exprs[f"n{i}"] = F.count(x)
        exprs[f"mean{i}"] = F.avg(x)
        exprs[f"std{i}"] = F.stddev_pop(x)
        exprs[f"min{i}"] = F.min(x)
        exprs[f"max{i}"] = F.max(x)
    vals = agg_values(df, exprs)
    return {c: {"count": vals[f"n{i}"], "mean": vals[f"mean{i}"],
                "std": vals[f"std{i}"], "min": vals[f"min{i}"],
                "max": vals[f"max{i}"]} for i, c in enumerate(cols)}


def long_values(df: DataFrame, cols: list[str], ids: list[str] | None = None,
                cast: str = "string", feature: str = "feature",
                value: str = "value") -> DataFrame:
    """Unpivot ``cols`` into ``(ids…, feature, value)`` — one row per cell."""
    ids = list(ids or [])
    wide = df.select(*[F.col(q(i)) for i in ids],
                     *[F.col(q(c)).cast(cast).alias(c) for c in cols])
    return wide.unpivot([F.col(q(i)) for i in ids], [F.col(q(c)) for c in cols],
                        feature, value)
