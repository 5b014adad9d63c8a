"""Sums of products of many columns, pairwise complete, in one scan.

Each task multiplies its batches as matrices: with ``M`` the mask of present
values and ``X`` the values (0 where missing), ``MᵀM`` counts the rows that both
columns of a pair have, ``XᵀM`` and ``(X²)ᵀM`` sum one of them over those rows and
``XᵀX`` their products. A task returns one row per column (its row of the four
matrices); rows of the same column are added on the executors, and the driver gets
one row per column.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .columns import q

SHIFT_ROWS = 1000


def pair_sums(df: DataFrame, cols: Sequence[str]) -> dict[str, np.ndarray]:
    """``n``, ``x``, ``y``, ``xx``, ``yy``, ``xy`` (columns x columns): over the rows
    where both columns of a pair have a value (NaN counts as missing), the number of
    rows and the sums of the values and products, each less ``shift``, a value of its
    column from the first ``SHIFT_ROWS`` rows (it only keeps sums small, so constant
    columns have a variance of exactly 0).
    """
    c = len(cols)
    double = [F.nanvl(F.col(q(x)).cast("double"), F.lit(None).cast("double")).alias(f"c{i}") for i, x in enumerate(cols)]
    data = df.select(*double)
    first = data.limit(SHIFT_ROWS).agg(*[F.first(f"c{i}", ignorenulls=True) for i in range(c)]).first()
    shift = np.array([0.0 if v is None or not np.isfinite(v) else v for v in first])

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((4, c, c))
        for b in batches:
            x = np.stack([b.column(i).to_numpy(zero_copy_only=False) for i in range(c)], axis=1) - shift
            m = ~np.isnan(x)
            x, m = np.where(m, x, 0.0), m.astype(float)
            total += np.stack([m.T @ m, x.T @ m, (x * x).T @ m, x.T @ x])
        if total[0].any():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(c, dtype=np.int32)), pa.array([total[:, i].tobytes() for i in range(c)], pa.binary())], ["i", "part"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for i, part in zip(b.column("i").to_pylist(), b.column("part").to_pylist()):
                total[i] = total.get(i, 0.0) + np.frombuffer(part).reshape(4, c)
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([t.tobytes() for t in total.values()], pa.binary())],
                                         ["i", "part"])

    schema = "i int, part binary"
    out = np.zeros((4, c, c))
    for i, part in data.mapInArrow(multiply, schema).repartition("i").mapInArrow(add, schema).collect():
        out[:, i] = np.frombuffer(part).reshape(4, c)
    n, x, xx, xy = out
    return {"n": n, "x": x, "y": x.T, "xx": xx, "yy": xx.T, "xy": xy, "shift": shift}


def correlations(sums: dict[str, np.ndarray]) -> np.ndarray:
    """Pearson's r of every pair; NaN without rows or spread."""
    n, x, y = sums["n"], sums["x"], sums["y"]
    with np.errstate(invalid="ignore", divide="ignore"):
        vx, vy = sums["xx"] - x * x / n, sums["yy"] - y * y / n
        r = (sums["xy"] - x * y / n) / np.sqrt(vx * vy)
        return np.where((vx > 0) & (vy > 0), r, np.nan)
