"""Distributed dense index: position of each distinct row inside its group in
sort order, without a window partitioned by the group.

A window ``partitionBy(group).orderBy(value)`` ranks a whole group in one
task; a group with hundreds of millions of distinct values would not fit.
Here the rows are range-partitioned and sorted on ``(group, value)`` (a
distributed sort), each row's position inside its partition comes from
``monotonically_increasing_id`` (partition id in the high bits, row index in
the low bits), and the partitions' row counts — one row per partition — give
prefix offsets. A group's codes are its global positions minus the group's
first position. The numbered table is checkpointed so the count job and the
final job see the same range partitioning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .columns import q


def dense_index(df: DataFrame, group: str, order: str, out: str = "code") -> DataFrame:
    """``(group, order, out)`` with ``out`` = 0..k-1 inside each group (rows must
    be distinct on ``(group, order)``)."""
    pid = F.spark_partition_id()
    numbered = (df.select(F.col(q(group)), F.col(q(order)))
                .repartitionByRange(F.col(q(group)), F.col(q(order)))
                .sortWithinPartitions(F.col(q(group)), F.col(q(order)))
                .select(F.col(q(group)), F.col(q(order)), pid.alias("__pid"),
                        (F.monotonically_increasing_id() -
                         F.shiftleft(pid.cast("long"), 33)).alias("__loc")))
    numbered = cut_lineage(numbered)
    counts = dict(numbered.groupBy("__pid").count().collect())   # one row per partition
    n_parts = (max(counts) + 1) if counts else 1
    offsets, acc = [], 0
    for p in range(n_parts):
        offsets.append((p, acc))
        acc += counts.get(p, 0)
    starts = df.sparkSession.createDataFrame(offsets, "__pid int, __o bigint")
    t = numbered.join(F.broadcast(starts), "__pid").select(      # one row per partition
        F.col(q(group)), F.col(q(order)), (F.col("__o") + F.col("__loc")).alias("__g"))
    starts = t.groupBy(F.col(q(group))).agg(F.min("__g").alias("__s"))   # one row per group
    return (t.join(F.broadcast(starts), group, "inner")
            .select(F.col(q(group)), F.col(q(order)), (F.col("__g") - F.col("__s")).alias(out)))
