"""Mixing sources to target weights with a multivariate-hypergeometric tree.

1. A source's documents, in the order of the md5 of their ids, are one stream
   of words, cut in blocks of ``block_words`` words.
2. Targets: sources share ``share`` of all words by weight; none gets more than
   ``most`` times its own words, and the excess goes to the others by weight.
   A target is drawn as whole passes over the source plus some of its blocks,
   in the order of a modular permutation; the last block is cut to fit.
3. The draws of all sources are dealt to output shards by a splitting tree: a
   node splits its shards in halves, and the left half's quota of each source is
   one multivariate-hypergeometric draw. Every node's draw has a seed of its
   own, so a task walks from the root to the shards it needs; nobody holds all
   quotas. A shard's quota of a source is a range of the source's draws, so
   shards are disjoint.
4. Inside a shard, pieces are shuffled by a hash.

A document taken partly is taken as word ranges. Null sources are a source of
their own (last); null or empty texts have no words and are never taken.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from .common import cut_lineage, prepare_python, stored

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
SHARE, MOST = 1.5, 2.0
BLOCK_WORDS = 4096
SHARD_WORDS = 1 << 22
MULTIPLIER = 2147483647
SEED = 6
GROUP_ROWS = 50_000


def targets(sizes: dict[str | None, int], weights=WEIGHTS, share: float = SHARE,
            most: float = MOST) -> dict[str | None, float]:
    """Target words by source; sources by code point, null last."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    out, free, left = {}, list(order), share * sum(sizes.values())
    while free:
        each = left / sum(weight[s] for s in free)
        over = [s for s in free if weight[s] * each > most * sizes[s]]
        if not over:
            return out | {s: weight[s] * each for s in free}
        out |= {s: most * sizes[s] for s in over}
        left -= sum(most * sizes[s] for s in over)
        free = [s for s in free if s not in out]
    return out


PART = 500_000_000


class Tree:
    """Splits the sources' draws among ``shards`` shards (numbers 0 to shards - 1)."""

    def __init__(self, draws: list[int], shards: int, seed: int = SEED):
        self.draws, self.shards, self.seed = tuple(int(d) for d in draws), shards, seed
        self._left = lru_cache(maxsize=4096)(self._split)

    def __reduce__(self):
        return Tree, (self.draws, self.shards, self.seed)

    def _split(self, low: int, high: int, quota: tuple[int, ...]) -> tuple[int, ...]:
        mid, total = (low + high) // 2, sum(quota)
        take = total * (mid - low) // (high - low)
        rng = np.random.default_rng([self.seed, low, high])
        # numpy draws from fewer than 10 ** 9: more are split in equal parts, with an equal share of each
        parts = max(1, -(-total // PART))
        out, seen, done = [0] * len(quota), 0, 0
        for i in range(parts):
            part = [q * (i + 1) // parts - q * i // parts for q in quota]
            seen += sum(part)
            drawn = take * seen // total - done if total else 0
            done += drawn
            if sum(part):
                out = [a + b for a, b in zip(out, rng.multivariate_hypergeometric(part, drawn, method="marginals").tolist())]
        return tuple(out)

    def shards_of(self, source: np.ndarray, draw: np.ndarray) -> np.ndarray:
        """The shard of each draw (a number below its source's draws)."""
        out = np.zeros(len(draw), np.int64)
        todo = [(0, self.shards, self.draws, np.arange(len(draw)), draw)]
        while todo:
            low, high, quota, rows, at = todo.pop()
            if not len(rows):
                continue
            if high - low == 1:
                out[rows] = low
                continue
            left = self._left(low, high, quota)
            edge = np.array(left, np.int64)[source[rows]]
            is_left = at < edge
            mid = (low + high) // 2
            todo.append((low, mid, left, rows[is_left], at[is_left]))
            todo.append((mid, high, tuple(q - x for q, x in zip(quota, left)), rows[~is_left],
                         (at - edge)[~is_left]))
        return out

    def quotas(self, shard: int) -> tuple[int, ...]:
        low, high, quota = 0, self.shards, self.draws
        while high - low > 1:
            left, mid = self._left(low, high, quota), (low + high) // 2
            if shard < mid:
                high, quota = mid, left
            else:
                low, quota = mid, tuple(q - x for q, x in zip(quota, left))
        return quota


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def _streams(docs: DataFrame, meta: DataFrame, carry: list[str], rows: int) -> DataFrame:
    """``carry``, ``__source``, ``__size`` and ``__start`` (words before, in the source's
    order). The prefix sum has two levels: groups of a source by the first
    digits of the md5, some ``GROUP_ROWS`` rows each, then rows in a group."""
    digits = min(6, max(1, int(np.ceil(np.log(max(1, rows / GROUP_ROWS)) / np.log(16)))))
    group = F.substring("__md5", 1, digits)
    base = docs.withColumn("__g", group)
    # a sum of sizes by (source, group): sources x 16 ** digits rows
    sums = meta.withColumn("__g", group).groupBy("__source", "__g").agg(F.sum("__size").alias("__sum"))
    up = Window.partitionBy("__source").orderBy("__g").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(F.col("__source").alias("__s2"), F.col("__g").alias("__g2"),
                       F.coalesce(F.sum("__sum").over(up), F.lit(0)).alias("__before"))
    inner = (Window.partitionBy("__source", "__g").orderBy("__md5", "__id", "__size")
             .rowsBetween(Window.unboundedPreceding, -1))
    return (base.withColumn("__in", F.coalesce(F.sum("__size").over(inner), F.lit(0)))
            .join(cut_lineage(sums), F.col("__source").eqNullSafe(F.col("__s2"))
                  & (F.col("__g") == F.col("__g2")))
            .select(*carry, "__source", "__size", "__source_size", "__target", "__no",
                    (F.col("__before") + F.col("__in")).alias("__start")))


def mix_ranges(docs: DataFrame, carry: list[str] | None = None, **options) -> DataFrame:
    """One row per row of ``docs``: the ``carry`` columns (default: all), then
    ``__size``, ``__source_size``, ``__target`` and ``__pieces``, an array of
    ``(shard, key, pass, low, high)``: the words from ``low`` to before ``high``
    go to ``shard``, in the order of ``key``."""
    carry = docs.columns if carry is None else carry
    placed, run, schema = _plan(docs, carry, **options)
    return placed.mapInArrow(run, schema).toDF(*carry, "__size", "__source_size", "__target", "__pieces")


def _plan(docs: DataFrame, carry: list[str], weights=WEIGHTS, share: float = SHARE, most: float = MOST,
          block_words: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS):
    """The placed rows, the task function that finds their pieces, and its schema;
    carried columns are called c0, c1 and so on."""
    spark = docs.sparkSession
    prepare_python(spark)
    named = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(carry)],
                        F.col("doc_id").cast("bigint").alias("__id"),
                        F.col("source").cast("string").alias("__source"),
                        n_words(F.col("text").cast("string")).alias("__size"))
    short = [f"c{i}" for i in range(len(carry))]
    # sizes are written once; texts, if carried, are not
    narrow = "text" not in carry
    meta = stored(named if narrow else named.select("__id", "__source", "__size"), "mix")
    named = meta if narrow else named
    # one row a source: the mix's metadata, held by the driver
    rows = meta.groupBy("__source").agg(F.sum("__size"), F.count("*")).collect()
    sizes = {r[0]: int(r[1]) for r in rows}
    goal = targets(sizes, weights, share, most)
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    total_rows = sum(r[2] for r in rows)
    block = block_words
    plan, draws = [], []
    for no, s in enumerate(order):
        size, words = sizes[s], int(goal[s])
        blocks = -(-size // block)
        passes = words // size if size else 0
        rest = words - passes * size
        whole, cut = divmod(rest, block)
        # whole passes, whole blocks of the last pass, and a part of one more
        plan.append((s, no, size, float(goal[s]), blocks, passes, whole, cut))
        draws.append(passes * blocks + whole + (cut > 0))
    tree = Tree(draws or [0], max(1, -(-int(sum(goal.values())) // shard_words)))
    info = spark.createDataFrame(plan, "s2 string, __no int, __source_size bigint, __target double, "
                                       "blocks bigint, passes bigint, whole bigint, cut bigint")
    known = named.join(F.broadcast(info) if len(plan) <= 100_000 else info,
                       F.col("__source").eqNullSafe(F.col("s2")))
    digest = F.md5(F.coalesce(F.col("__id").cast("string"), F.lit("")).cast("binary"))
    known = known.select(*short, "__id", "__source", "__size", "__source_size", "__target", "__no",
                         digest.alias("__md5"))
    placed = _streams(known, meta.withColumn("__md5", digest), short, total_rows)
    numbers = np.array([p[4:] for p in plan] or [(0, 0, 0, 0)], np.int64)

    piece = pa.struct([("shard", pa.int64()), ("key", pa.int64()), ("pass", pa.int32()),
                       ("low", pa.int64()), ("high", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            size, start = (b.column(c).to_numpy(zero_copy_only=False) for c in ("__size", "__start"))
            no = b.column("__no").to_numpy(zero_copy_only=False).astype(np.int64)
            first, last = start // block, np.where(size > 0, (start + size - 1) // block + 1, start // block)
            row = np.repeat(np.arange(len(size)), last - first)
            at = np.arange(len(row)) - np.repeat(np.cumsum(last - first) - (last - first), last - first) + first[row]
            blocks, passes, whole, cut = numbers[no[row]].T
            full = blocks - 1  # the last block may be short: it is drawn last
            rank = np.where(at == full, full, (at * (MULTIPLIER % np.maximum(full, 1))) % np.maximum(full, 1))
            low = np.maximum(at * block, start[row]) - start[row]
            high = np.minimum((at + 1) * block, (start + size)[row]) - start[row]
            part = np.minimum(high, at * block + cut - start[row])
            found = []
            for k in range(int(passes.max(initial=0)) + 1):
                stop = np.where(k < passes, high, np.where(rank < whole, high, np.where(rank == whole, part, low)))
                take = np.flatnonzero((k <= passes) & (stop > low))
                found.append((row[take], k * blocks[take] + rank[take], np.full(len(take), k),
                              low[take], stop[take]))
            r, draw, k, lo, hi = (np.concatenate(x) for x in zip(*found))
            shard = tree.shards_of(no[r], draw)
            o = np.lexsort((lo, k, r))
            r, draw, k, lo, hi, shard = r[o], draw[o], k[o], lo[o], hi[o], shard[o]
            mixed = ((draw + 1) * 0x9E3779B1 + (lo + 1) * 0x85EBCA77 + no[r] * 0xC2B2AE3D) & 0x7FFFFFFF
            key = (mixed * 0x27D4EB2F + shard) & 0x7FFFFFFFFFFF
            values = pa.StructArray.from_arrays(
                [pa.array(shard), pa.array(key), pa.array(k.astype(np.int32)), pa.array(lo), pa.array(hi)],
                fields=list(piece))
            offsets = np.concatenate(([0], np.cumsum(np.bincount(r, minlength=len(size))))).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in (*short, "__size", "__source_size", "__target")),
                 pa.ListArray.from_arrays(pa.array(offsets), values)],
                [*short, "__size", "__source_size", "__target", "__pieces"])

    placed = placed.select(*short, "__size", "__source_size", "__target", "__no", "__start")
    schema = StructType([f for f in placed.schema.fields if f.name not in ("__no", "__start")])
    return placed, run, _with_pieces(schema)


def _with_pieces(schema: StructType) -> StructType:
    from pyspark.sql.types import ArrayType, IntegerType

    piece = StructType().add("shard", LongType()).add("key", LongType()).add("pass", IntegerType()) \
        .add("low", LongType()).add("high", LongType())
    return schema.add("__pieces", ArrayType(piece))


def taken(docs: DataFrame, **options) -> DataFrame:
    """``(doc_id, size, source_size, target, taken)``, one row per row of ``docs``."""
    made = mix_ranges(docs, carry=["doc_id"], **options)
    total = F.aggregate("__pieces", F.lit(0).cast("bigint"), lambda a, p: a + p["high"] - p["low"])
    return made.select("doc_id", F.col("__size").alias("size"), F.col("__source_size").alias("source_size"),
                       F.col("__target").alias("target"), total.alias("taken"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself, with the columns of ``docs``: a row for each pass and run
    of adjacent words taken, its text cut to them (a whole document keeps its
    text as it is) and ``n_chars``, if there, counted anew. A shard's rows are in
    one partition, in the order of the shuffle's key."""
    columns = docs.columns
    word, text_at = re.compile(WORD), f"c{columns.index('text')}"
    placed, ranges, made = _plan(docs, columns, **options)

    # ranges and texts in one function: a second one would be a second worker a task
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in ranges(batches):
            rows, shards, keys, texts = [], [], [], []
            for i, (text, size, pieces) in enumerate(zip(*(b.column(c).to_pylist() for c in (
                    text_at, "__size", "__pieces")))):
                runs = []
                for p in pieces:
                    if runs and runs[-1][0] == p["pass"] and runs[-1][2] == p["low"]:
                        runs[-1][2] = p["high"]
                    else:
                        runs.append([p["pass"], p["low"], p["high"], p["shard"], p["key"]])
                spans = None
                for _, low, high, shard, key in runs:
                    if (low, high) != (0, size):
                        spans = spans or [m.span() for m in word.finditer(text)]
                    texts.append(text if (low, high) == (0, size) else text[spans[low][0]:spans[high - 1][1]])
                    rows.append(i), shards.append(shard), keys.append(key)
            got = b.select([f"c{i}" for i in range(len(columns)) if columns[i] != "text"]).take(pa.array(rows, pa.int64()))
            cols = []
            for i, c in enumerate(columns):
                if c == "text":
                    cols.append(pa.array(texts, pa.string()))
                elif c == "n_chars":
                    cols.append(pa.array([len(t) for t in texts], pa.int64()).cast(got.column(f"c{i}").type))
                else:
                    cols.append(got.column(f"c{i}"))
            yield pa.RecordBatch.from_arrays([*cols, pa.array(shards, pa.int64()), pa.array(keys, pa.int64())],
                                             [*(f"c{i}" for i in range(len(columns))), "__shard", "__key"])

    schema = StructType(made.fields[:len(columns)]).add("__shard", LongType()).add("__key", LongType())
    cut = placed.mapInArrow(run, schema)
    return (cut.repartition("__shard").sortWithinPartitions("__shard", "__key").drop("__shard", "__key")
            .toDF(*columns))
