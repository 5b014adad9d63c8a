"""Size-checked lookup joins: a big table looks values up in a fitted table.

* the lookup table's rows and bytes are known (counted at fit): up to
  ``BROADCAST_LIMIT`` rows and ``BROADCAST_BYTES`` bytes it is broadcast — a
  proven size bound — and the join is a hash lookup with no shuffle of the
  big side;
* above that the join is a sort-merge join. Keys listed as *hot* (each holds
  a large share of the big side's rows; at most ``1 / share`` of them, so the
  list is bounded) are salted: a hot row gets ``hash(row, partition) mod
  salts``, the hot lookup row is replicated once per salt, and the join runs
  on ``(key, salt)``. A key holding a third of all rows then spreads over
  ``salts`` join tasks instead of one, equal rows too (by their partition).
  The salt does not depend on the order of rows, so a retried task assigns
  the same salts. Rows without a key match nothing, so in a left join they are
  dealt over the salts as well.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .columns import q

BROADCAST_LIMIT = 200_000
BROADCAST_BYTES = 64 << 20
SALTS = 64


def lookup_join(big: DataFrame, small: DataFrame, big_key: Column, small_key: str,
                broadcast: bool, hot: Sequence = (), how: str = "left",
                salts: int = SALTS) -> DataFrame:
    """``big ⋈ small`` on ``big_key = small[small_key]`` (see module doc).
    ``broadcast`` must come from a counted size (``fits_broadcast``)."""
    cond = big_key == F.col(q(small_key))
    if broadcast:
        return big.join(F.broadcast(small), cond, how)
    if not hot and how != "left":
        return big.join(small, cond, how)
    hot_set = [F.lit(h) for h in hot]
    row = F.xxhash64(F.spark_partition_id(), *[F.col(q(c)) for c in big.columns])
    spread, copies = big_key.isNull(), F.array(F.lit(0))
    if hot:
        spread = spread | big_key.isin(*hot_set)
        copies = F.when(F.col(q(small_key)).isin(*hot_set), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(copies)
    salted = big.withColumn("__salt", F.when(spread, F.pmod(row, F.lit(salts))).otherwise(F.lit(0)).cast("int"))
    rep = small.select("*", F.explode(copies).alias("__msalt"))
    return salted.join(rep, cond & (F.col("__salt") == F.col("__msalt")), how) \
                 .drop("__salt", "__msalt")


def _size_aggs(df: DataFrame) -> list[Column]:
    width = F.lit(8)
    for f in df.schema.fields:
        text = F.col(q(f.name)).cast("string")
        width = width + F.coalesce(F.octet_length(text), F.lit(0)) + F.lit(8)
    return [F.count("*").alias("n"), F.sum(width.cast("bigint")).alias("b")]


def table_size(df: DataFrame) -> tuple[int, int]:
    """Rows and (about) bytes of ``df``, counted in one job."""
    r = df.agg(*_size_aggs(df)).first()
    return r["n"], r["b"] or 0


def table_sizes(df: DataFrame, by: str) -> dict:
    """``table_size`` of each group of ``by``, counted in one job (few groups)."""
    return {r[0]: (r["n"], r["b"] or 0) for r in df.groupBy(by).agg(*_size_aggs(df)).collect()}


def fits_broadcast(size: tuple[int, int], limit: int = BROADCAST_LIMIT) -> bool:
    return size[0] <= limit and size[1] <= BROADCAST_BYTES


def broadcast_tables(sizes: dict, limit: int = BROADCAST_LIMIT) -> list:
    """The tables to broadcast: the smallest ones, as many as together stay within
    ``limit`` rows and ``BROADCAST_BYTES``."""
    out, rows, size = [], 0, 0
    for k, (n, b) in sorted(sizes.items(), key=lambda s: (s[1], s[0])):
        rows, size = rows + n, size + b
        if not fits_broadcast((rows, size), limit):
            break
        out.append(k)
    return out


def small_side(df: DataFrame, limit: int = BROADCAST_LIMIT) -> DataFrame:
    """``df`` marked for broadcast when its counted size is within ``limit``
    rows and ``BROADCAST_BYTES`` (a proven bound); otherwise left for a
    shuffled join."""
    return F.broadcast(df) if fits_broadcast(table_size(df), limit) else df


def hot_keys(counts: DataFrame, key: str, n: str, share: float, by: str | None = None) -> dict:
    """Keys whose count exceeds ``share`` of their group's total (``by``
    column, or the whole table): ``{group: [keys]}``, at most ``1 / share``
    keys per group."""
    if by is None:
        total = counts.agg(F.sum(n)).first()[0] or 0
        rows = counts.where(F.col(n) > F.lit(total * share)).select(key).collect()
        return {None: [r[0] for r in rows]} if rows else {}
    totals = counts.groupBy(by).agg(F.sum(n).alias("__t"))
    rows = (counts.join(F.broadcast(totals), by)
            .where(F.col(n) > F.col("__t") * F.lit(share)).select(by, key).collect())
    out: dict = {}
    for r in rows:
        out.setdefault(r[0], []).append(r[1])
    return out
