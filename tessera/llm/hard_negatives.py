"""Hard negatives by blocked integer matrix products.

Vectors become integers (``floor(SCALE * x)``), so scores are exact. Anchors are
broadcast in blocks of bounded size; every task reads its candidates in tiles, and
the scores of a block and a tile come from one matrix product: Strassen's recursion
on int64 matrices padded with zeros, down to leaves of ``LEAF``. Its sums may wrap
around in between, as products do modulo 2 ** 64; the result is exact because
``usable`` lets only components through whose inner products fit with room to spare.

Two passes a block, each ending in heaps that merge:

1. positives: the best rows of the anchor's label; a task keeps the best of all its
   tiles, the shuffle has ``positives`` rows an anchor and task at most;
2. windows: for each positive the best rows of other labels within its window of
   scores, kept and merged in the same way.

What a pass finds is written before the next block is broadcast, and the block's
broadcast is dropped. The driver holds one block at a time.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut_lineage, prepare_python, stored

SCALE = 256
POSITIVES = 5
NEGATIVES = 5
LOW, HIGH = 80, 100
LEAF = 8
TILE = 2048
ANCHORS = 256
BLOCK_BYTES = 32 << 20
ROOM = 1 << 55


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """``a @ b`` of int64 matrices. Odd sizes are padded with zeros; a size of
    ``leaf`` or less ends the recursion."""
    n, k, m = a.shape[0], a.shape[1], b.shape[1]
    if min(n, k, m) <= leaf:
        return a @ b
    if n % 2 or k % 2 or m % 2:
        a = np.pad(a, ((0, n % 2), (0, k % 2)))
        b = np.pad(b, ((0, k % 2), (0, m % 2)))
    i, j, l = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2  # noqa: E741
    a11, a12, a21, a22 = a[:i, :j], a[:i, j:], a[i:, :j], a[i:, j:]
    b11, b12, b21, b22 = b[:j, :l], b[:j, l:], b[j:, :l], b[j:, l:]
    p1 = strassen(a11 + a22, b11 + b22, leaf)
    p2 = strassen(a21 + a22, b11, leaf)
    p3 = strassen(a11, b12 - b22, leaf)
    p4 = strassen(a22, b21 - b11, leaf)
    p5 = strassen(a11 + a12, b22, leaf)
    p6 = strassen(a21 - a11, b11 + b12, leaf)
    p7 = strassen(a12 - a22, b21 + b22, leaf)
    out = np.empty((2 * i, 2 * l), np.int64)
    out[:i, :l] = p1 + p4 - p5 + p7
    out[:i, l:] = p3 + p5
    out[i:, :l] = p2 + p4
    out[i:, l:] = p1 - p2 + p3 + p6
    return out[:n, :m]


class Heaps:
    """The best ``k`` of each of ``n`` groups by higher score, then smaller id; mergeable."""

    def __init__(self, n: int, k: int):
        self.score = np.full((n, k), np.iinfo(np.int64).min)
        self.id = np.full((n, k), np.iinfo(np.int64).max)
        self.used = np.zeros(n, np.int64)

    def merge(self, group: int, score: np.ndarray, ids: np.ndarray) -> None:
        k, held = self.score.shape[1], self.used[group]
        score = np.concatenate((self.score[group, :held], score))
        ids = np.concatenate((self.id[group, :held], ids))
        best = np.lexsort((ids, -score))[:k]
        self.used[group] = len(best)
        self.score[group, :len(best)], self.id[group, :len(best)] = score[best], ids[best]

    def worst(self, group: int) -> int:
        """What a score must reach to get in."""
        full = self.used[group] == self.score.shape[1]
        return int(self.score[group, -1]) if full else int(np.iinfo(np.int64).min)

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(group, score, id)`` of all that is held."""
        held = np.arange(self.score.shape[1])[None, :] < self.used[:, None]
        return np.nonzero(held)[0], self.score[held], self.id[held]


def best_of(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the best ``k``, ties at the edge by id."""
    if len(score) > k:
        edge = np.partition(score, len(score) - k)[len(score) - k]
        keep = np.flatnonzero(score >= edge)
    else:
        keep = np.arange(len(score))
    return keep[np.lexsort((ids[keep], -score[keep]))[:k]]


def usable(vectors: DataFrame, label: Column, scale: int, id_col: str, vec_col: str) -> DataFrame:
    """``(id, label, v)`` with integer components: rows without a null in id, label
    or vector and with finite components, all of the most frequent length. Vectors
    with a component beyond ``sqrt(ROOM / length)`` after scaling take no part:
    a hundred times their scores would not fit a long."""
    v = F.col(f"`{vec_col}`").cast("array<double>")
    d = (vectors.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), label.cast("bigint").alias("label"), v.alias("v"))
         .where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0))
         .where(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))))
    top = d.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    if top is None:
        return d.select("id", "label", F.col("v").cast("array<bigint>").alias("v")).where("false")
    most = float(math.isqrt(ROOM // top["n"]))
    return (d.where(F.size("v") == top["n"])
            .where(F.forall("v", lambda x: F.abs(F.lit(float(scale)) * x) < F.lit(most)))
            .select("id", "label", F.transform("v", lambda x: F.floor(F.lit(float(scale)) * x)).alias("v")))


def tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``(ids, labels, matrix)`` of ``TILE`` candidates, one a column."""
    held, size = [], 0

    def put():
        ids = np.concatenate([b.column("id").to_numpy() for b in held])
        v = np.concatenate([b.column("v").flatten().to_numpy(zero_copy_only=False) for b in held])
        labels = np.concatenate([b.column("label").to_numpy() for b in held])
        return ids, labels, np.ascontiguousarray(v.reshape(len(ids), -1).T)

    for b in batches:
        for a in range(0, b.num_rows, TILE):
            part = b.slice(a, TILE)
            if size + part.num_rows > TILE:
                yield put()
                held, size = [], 0
            held.append(part)
            size += part.num_rows
    if size:
        yield put()


def _table(names: list[str], arrays: list[np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], names)


def best_positives(block, batches: Iterator[pa.RecordBatch], k: int, leaf: int) -> Iterator[pa.RecordBatch]:
    """The best ``k`` candidates of each anchor's label that this task reads."""
    ids, labels, vectors = block
    heaps = Heaps(len(ids), k)
    for cand, cand_label, matrix in tiles(batches):
        for a in range(0, len(ids), ANCHORS):
            score = strassen(vectors[a:a + ANCHORS], matrix, leaf)
            for r in range(len(score)):
                g = a + r
                ok = np.flatnonzero((cand_label == labels[g]) & (cand != ids[g]) & (score[r] >= heaps.worst(g)))
                if len(ok):
                    ok = ok[best_of(score[r, ok], cand[ok], k)]
                    heaps.merge(g, score[r, ok], cand[ok])
    g, score, found = heaps.rows()
    if len(g):
        yield _table(["anchor", "score", "id"], [ids[g], score, found])


def best_in_windows(block, batches: Iterator[pa.RecordBatch], k: int, low: int, high: int,
                    leaf: int) -> Iterator[pa.RecordBatch]:
    """For each positive, the best ``k`` candidates of other labels in its window that this task reads."""
    ids, labels, vectors, groups, positive, positive_score, place = block
    heaps = Heaps(len(positive), k)  # a positive each, by anchor
    for cand, cand_label, matrix in tiles(batches):
        for a in range(0, len(ids), ANCHORS):
            score = strassen(vectors[a:a + ANCHORS], matrix, leaf)
            for r in range(len(score)):
                lo, hi = groups[a + r], groups[a + r + 1]
                if lo == hi:
                    continue
                s, pos = score[r], positive_score[lo:hi]
                # the anchor's windows together, then each positive's own
                ok = np.flatnonzero((cand_label != labels[a + r]) & (100 * s >= (low * pos).min()) & (100 * s <= (high * pos).max()))
                if not len(ok):
                    continue
                ok = ok[np.lexsort((cand[ok], -s[ok]))]
                falling = -100 * s[ok]
                begin = np.searchsorted(falling, -high * pos, "left")
                end = np.searchsorted(falling, -low * pos, "right")
                for g, x, y in zip(range(lo, hi), begin, np.minimum(end, begin + k)):
                    if x < y:
                        heaps.merge(g, s[ok[x:y]], cand[ok[x:y]])
    g, score, found = heaps.rows()
    if len(g):
        anchor = np.repeat(ids, np.diff(groups))
        yield _table(["anchor", "place", "positive", "positive_score", "score", "id"],
                     [anchor[g], place[g], positive[g], positive_score[g], score, found])


def _first(df: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The tasks' heaps merged: the best ``k`` of each group."""
    best = Window.partitionBy(*keys).orderBy(F.desc("score"), "id")
    return df.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def mine(vectors: DataFrame, is_anchor: Column, label: Column, positives: int = POSITIVES, negatives: int = NEGATIVES,
         low: int = LOW, high: int = HIGH, scale: int = SCALE, id_col: str = "vec_id", vec_col: str = "embedding",
         leaf: int = LEAF) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score, positive_rank)``:
    for each row where ``is_anchor`` (over the column ``id``) holds, its best ``positives``
    rows of the same ``label`` and for each of them the best ``negatives`` rows of other
    labels with ``low * positive <= 100 * negative <= high * positive``; ties go to the
    smaller id.

    Rows without id, label or a finite vector take no part. A repeated id is one
    anchor (its smallest label and vector) and several candidates, none of them its own;
    as positives of an anchor they have different ``positive_rank``.
    Anchors without positives, and positives with an empty window, have no rows.
    """
    spark = vectors.sparkSession
    prepare_python(spark)
    rows = usable(vectors, label, scale, id_col, vec_col)
    schema = ("anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint, "
              "positive_rank int")
    anchors = cut_lineage(rows.where(is_anchor).groupBy("id").agg(F.min(F.struct("label", "v")).alias("x")).select("id", "x.label", "x.v"))
    found = []
    sample = anchors.first()
    per_block = max(1, BLOCK_BYTES // (8 * len(sample["v"]))) if sample else 1
    for held in _blocks(anchors, per_block):
        ids = np.array([r[0] for r in held], np.int64)
        labels = np.array([r[1] for r in held], np.int64)
        matrix = np.array([r[2] for r in held], np.int64)
        sent = spark.sparkContext.broadcast((ids, labels, matrix))
        near = stored(_first(rows.mapInArrow(lambda batches, b=sent: best_positives(b.value, batches, positives, leaf),
                                             "anchor bigint, score bigint, id bigint"), ["anchor"], positives), "positives")
        # at most `positives` rows an anchor of the block
        got = near.select("anchor", F.col("rank").cast("bigint").alias("rank"), "id", "score").toArrow()
        anchor, place, positive, score = (got[c].to_numpy().astype(np.int64) for c in got.column_names)
        by, order = np.lexsort((place, anchor)), np.argsort(ids)
        groups = np.append(np.searchsorted(anchor[by], ids[order]), len(by))
        windows = spark.sparkContext.broadcast((ids[order], labels[order], matrix[order], groups, positive[by], score[by], place[by]))
        hard = rows.mapInArrow(lambda batches, b=windows: best_in_windows(b.value, batches, negatives, low, high, leaf),
                               "anchor bigint, place bigint, positive bigint, positive_score bigint, score bigint, id bigint")
        found.append(stored(_first(hard, ["anchor", "place"], negatives).select(
            F.col("anchor").alias("anchor_id"), F.col("positive").alias("positive_id"), F.col("rank").cast("int").alias("rank"),
            F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"),
            F.col("place").cast("int").alias("positive_rank")), "negatives"))
        sent.destroy()
        windows.destroy()
    out = spark.createDataFrame([], schema)
    for part in found:
        out = out.unionByName(part)
    return out


def _blocks(rows: DataFrame, size: int) -> Iterator[list]:
    held: list = []
    for r in rows.toLocalIterator():
        held.append(r)
        if len(held) == size:
            yield held
            held = []
    if held:
        yield held
