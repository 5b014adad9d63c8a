"""Maximum inner product search by collision counting.

Vectors are scaled by the largest norm and get one more component that makes all
lengths 1, so the largest inner product is the smallest distance. Each of ``m``
random projections is a sorted array of the vectors' projected values. A query
opens a window of half-width ``WIDTH`` x radius around its own value on every array;
a vector collides where its value is in the window. Vectors with ``threshold``
collisions or more are verified by their exact inner product. The radius grows
by ``GROWTH`` (the windows of the smaller radius are inside the larger: virtual
rehashing) until ``k`` verified vectors lie within it: a nearer vector that is
still missing would have collided as often with probability ``1 - MISS``.

The index is in chunks of ``CHUNK`` rows, each with its own sorted arrays; every
row is in one. Queries are broadcast in blocks of bounded size, one at a time: a block's
results are written before the next is sent, and each chunk returns its best ``k`` of a query. The first radius is the query's distance to the
nearest of ``SAMPLE`` rows of the chunk; this only saves rounds.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut_lineage, prepare_python, work_path

PROJECTIONS = 64
WIDTH = 1.0
GROWTH = 1.15
LEAST_RADIUS = 0.05
MISS = 0.03
CHUNK = 16_384
SAMPLE = 256
QUERY_BYTES = 32 << 20
BATCH = 128
SEED = 3


def collision_threshold(m: int, width: float = WIDTH, miss: float = MISS) -> int:
    """The count that a vector at the radius reaches with probability ``1 - miss``."""
    p = math.erf(width / math.sqrt(2))
    mass, total = (1 - p) ** m, 0.0
    for c in range(m + 1):
        if total + mass > miss:
            return c
        total += mass
        mass *= (m - c) / (c + 1) * p / (1 - p)
    return m


class Index:
    """The sorted arrays of one chunk."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, top_norm: float, m: int = PROJECTIONS):
        self.ids, self.vectors, self.m = ids, vectors, m
        self.scale = top_norm
        square = (vectors * vectors).sum(axis=1) / top_norm ** 2
        self.fill = np.sqrt(np.maximum(0.0, 1 - square))
        axes = np.random.default_rng(SEED).normal(size=(vectors.shape[1] + 1, m))
        self.axes = axes[:-1]
        values = (vectors / top_norm) @ axes[:-1] + self.fill[:, None] * axes[-1]
        order = np.argsort(values, axis=0)
        self.sorted = np.take_along_axis(values, order, axis=0).T.copy()
        self.rank = np.empty((m, len(ids)), np.uint16)
        for j in range(m):
            self.rank[j, order[:, j]] = np.arange(len(ids))
        step = max(1, len(ids) // SAMPLE)
        self.sample = np.arange(0, len(ids), step)

    def collisions(self, at: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """Counts (queries x rows) of windows around projected values ``at``; a
        chunk has fewer than 65,536 rows, so ranks are 16-bit."""
        out = np.zeros((len(at), len(self.ids)), np.uint8 if self.m < 256 else np.uint16)
        half = WIDTH * radius
        for j in range(self.m):
            low = np.searchsorted(self.sorted[j], at[:, j] - half, "left")
            size = np.searchsorted(self.sorted[j], at[:, j] + half, "right") - low
            # ranks from low to before low + size; smaller ones wrap around
            out += (self.rank[j][None, :] - low.astype(np.uint16)[:, None]) < size.astype(np.uint16)[:, None]
        return out

    def _distance(self, score: np.ndarray) -> np.ndarray:
        """In the transformed space, from the inner product with the unit query."""
        return np.sqrt(np.maximum(0.0, 2 - 2 * score / self.scale))

    def _verify(self, new: np.ndarray, live: np.ndarray, unit: np.ndarray, score: np.ndarray) -> None:
        """Fill ``score`` with the inner products of the pairs in ``new``: one by
        one if they are few, else a product of matrices of which the rest is left."""
        if new.mean() < 0.05:
            i, j = np.nonzero(new)
            for a in range(0, len(i), 1 << 16):
                r, c = live[i[a:a + (1 << 16)]], j[a:a + (1 << 16)]
                score[r, c] = np.einsum("ij,ij->i", unit[r], self.vectors[c])
        else:
            score[live] = np.where(new, unit[live] @ self.vectors.T, score[live])

    def search(self, ids: np.ndarray, queries: np.ndarray, k: int):
        """``(query number, row, score)`` of each query's best ``k`` verified rows."""
        norm = np.linalg.norm(queries, axis=1)
        unit = queries / norm[:, None]
        at = unit @ self.axes
        own = self.ids[None, :] == ids[:, None]
        near = self._distance(unit @ self.vectors[self.sample].T)
        first = np.where(own[:, self.sample], np.inf, near).min(axis=1)
        radius = np.where(np.isfinite(first), np.maximum(first, LEAST_RADIUS), 2.0)
        verified = np.zeros(own.shape, bool)
        score = np.full(own.shape, -np.inf)
        wanted = np.minimum(k, (~own).sum(axis=1))
        live, threshold = np.arange(len(queries)), collision_threshold(self.m)
        while len(live):
            new = self.collisions(at[live], radius[live]) >= threshold
            # no distance is larger than 2: beyond it every row is verified
            new[radius[live] > 2] = True
            self._verify(new & ~verified[live] & ~own[live], live, unit, score)
            verified[live] |= new & ~own[live]
            inside = (self._distance(score[live]) <= radius[live, None]).sum(axis=1)
            live = live[(inside < wanted[live]) & (radius[live] <= 2)]
            radius[live] *= GROWTH
        for i in np.flatnonzero(wanted):
            rows = np.flatnonzero(verified[i])
            if len(rows) > k:
                edge = np.partition(score[i, rows], len(rows) - k)[len(rows) - k]
                rows = rows[score[i, rows] >= edge - 1e-9 * self.scale]
            # the exact measure; equal vectors get equal sums
            exact = (self.vectors[rows] * queries[i]).sum(axis=1)
            best = np.lexsort((self.ids[rows], -exact))[:k]
            yield i, rows[best], exact[best]


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``(id, v)`` as bigint and array of double: without null ids, and without
    vectors that are null, zero, or hold null or non-finite components."""
    v = F.col(f"`{vec_col}`").cast("array<double>")
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    return (vectors.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), v.alias("v"))
            .where(F.col("id").isNotNull() & F.col("v").isNotNull())
            .where(F.forall("v", fine) & F.exists("v", lambda x: x != 0)))


def search(vectors: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id",
           vec_col: str = "embedding") -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each row of ``vectors`` where
    ``is_query`` (over the columns ``id`` and ``v``) holds, the ``k`` rows of another
    id with the largest inner product that the search verified, ties by id.
    Vectors of a length other than the most frequent take no part; repeated
    ids are one query (of the smallest vector) and several candidates."""
    spark = vectors.sparkSession
    prepare_python(spark)
    schema = "query_id bigint, vec_id bigint, score double"
    rows = usable(vectors, id_col, vec_col)
    sizes = rows.groupBy(F.size("v").alias("d")).agg(
        F.count("*").alias("n"), F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)).alias("m"))
    found = spark.createDataFrame([], schema)
    top = sizes.orderBy(F.desc("n"), "d").first()
    if top is not None:
        dims, n, norm = top["d"], top["n"], math.sqrt(top["m"]) * (1 + 1e-9)
        rows = rows.where(F.size("v") == dims)
        queries = cut_lineage(rows.where(is_query).groupBy("id").agg(F.min("v").alias("v"))
                              .repartition(max(1, math.ceil(n / 1_000_000)), "id"))
        per_block = max(1, QUERY_BYTES // (8 * dims))
        spread = rows.repartition(max(1, math.ceil(n / CHUNK)), "id")
        several = queries.limit(per_block + 1).count() > per_block
        if several:  # each block reads it
            spread = cut_lineage(spread)
        base, held, blocks = work_path(spark, "ann"), [], 0

        def block(held, number):
            """One block's results, written before the next block is sent out."""
            sent = spark.sparkContext.broadcast((np.array([r[0] for r in held], np.int64),
                                                 np.array([r[1] for r in held], np.float64)))

            def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                qid, q = sent.value
                for ids, data in _chunks(batches, dims):
                    index = Index(ids, data, norm)
                    for a in range(0, len(qid), BATCH):
                        got = list(index.search(qid[a:a + BATCH], q[a:a + BATCH], k))
                        if got:
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(np.repeat(qid[[a + i for i, _, _ in got]], [len(r) for _, r, _ in got])),
                                 pa.array(ids[np.concatenate([r for _, r, _ in got])]),
                                 pa.array(np.concatenate([s for _, _, s in got]))], ["query_id", "vec_id", "score"])

            spread.mapInArrow(run, schema).write.parquet(f"{base}/{number}")
            sent.destroy()

        for r in queries.toLocalIterator():
            held.append(r)
            if len(held) == per_block:
                block(held, blocks)
                held, blocks = [], blocks + 1
        if held:
            block(held, blocks)
            blocks += 1
        if blocks:
            found = spark.read.schema(schema).parquet(f"{base}/*")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))


def _chunks(batches: Iterator[pa.RecordBatch], dims: int):
    """``(ids, matrix)`` of at most ``CHUNK`` rows."""
    ids, data, size = [], [], 0
    for b in batches:
        for a in range(0, b.num_rows, CHUNK):
            s = b.slice(a, CHUNK)
            if size and size + s.num_rows > CHUNK:
                yield np.concatenate(ids), np.concatenate(data)
                ids, data, size = [], [], 0
            ids.append(s.column("id").to_numpy())
            data.append(s.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, dims))
            size += s.num_rows
    if size:
        yield np.concatenate(ids), np.concatenate(data)
