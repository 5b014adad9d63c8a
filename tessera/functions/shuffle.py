"""Keyed column shuffle without a global sort.

A global ``row_number`` would put the whole table in one task. Instead rows
are spread over ``buckets`` hash buckets of the key by one exchange; inside each
bucket a row's *slot* and its *donor* rank come from two independent hashes of the
key, and a task hands the row at slot i the values of the bucket's i-th donor
(two sorts of hashes on the bucket's Arrow table; as two windows and a self-join
the same took four exchanges). That is a uniformly random
permutation inside each bucket, stable under
task retries (hashes, not ``rand()``), and no bucket is large: the bucket is
a hash of a unique key, so a hot *value* cannot concentrate rows.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from .columns import q


ROWS_PER_BUCKET = 2_000_000
CELLS_PER_BUCKET = 1 << 24


def bucket_count(df: DataFrame, rows: int, columns: int) -> int:
    """At least the shuffle partitions, and enough that a bucket holds about
    ``ROWS_PER_BUCKET`` rows and ``CELLS_PER_BUCKET`` cells at most."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    return max(parts, -(-rows // ROWS_PER_BUCKET), -(-rows * columns // CELLS_PER_BUCKET))


def donor_values(df: DataFrame, key: str, cols: Sequence[str], seed: int = 0,
                 buckets: int | None = None, prefix: str = "__d_") -> DataFrame:
    """``df`` plus ``{prefix}{col}``: the values of ``cols`` from a donor row.

    ``key`` must be unique. ``buckets`` defaults to ``bucket_count``: a task holds
    one bucket at a time, so that table stays bounded whatever the table size.
    """
    if buckets is None:
        buckets = bucket_count(df, df.count(), len(df.columns) + len(cols))
    k, names = F.col(q(key)), df.columns
    hashed = df.select(*[F.col(q(c)) for c in names],
                       F.pmod(F.xxhash64(k, F.lit("b"), F.lit(seed)), F.lit(buckets)).alias("__b"),
                       F.xxhash64(k, F.lit("s"), F.lit(seed)).alias("__slot"), F.xxhash64(k, F.lit("d"), F.lit(seed)).alias("__donor"))

    def order(t: pa.Table, by: str):
        h = t.column(by).to_numpy()
        o = np.argsort(h)
        if (h[o][1:] == h[o][:-1]).any():     # equal hashes: by key
            return pc.sort_indices(t.select([by, key]), [(by, "ascending"), (key, "ascending")])
        return pa.array(o)

    def deal(t: pa.Table) -> pa.Table:
        out, donors = t.select(names).take(order(t, "__slot")), t.select(list(cols)).take(order(t, "__donor"))
        for c in cols:
            out = out.append_column(f"{prefix}{c}", donors.column(c))
        return out

    donated = [StructField(f"{prefix}{c}", f.dataType, f.nullable, f.metadata) for c, f in ((c, df.schema[c]) for c in cols)]
    return hashed.groupBy("__b").applyInArrow(deal, StructType([*df.schema.fields, *donated]))
