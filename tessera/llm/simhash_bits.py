"""SimHash near-duplicates with bit-sliced comparison.

1. Each document gets a 64-bit fingerprint: the bitwise majority of the XXH64
   values of its word shingles.
2. Equal fingerprints are one node. Nodes within ``max_bits`` differing bits
   agree on two of ``max_bits + 2`` bit blocks (pigeonhole), so each node is
   dealt to one bucket per pair of blocks; nothing is missed.
3. Inside a bucket the fingerprints are stored as bit planes (one row per bit,
   64 fingerprints to a word). A query's distances to all of them are counted
   by carry-save bitwise counters, plane by plane; query rows are abandoned
   once every lane exceeds the radius.
4. A bucket emits a spanning forest of its links, not all pairs. Buckets over
   ``CHUNK`` nodes are split in chunks, and each pair of chunks is a group.
5. Connected components over the links; the class id is the smallest doc_id.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import columns_of, cut_lineage, lookup_spread, prepare_python, stored, text_slices
from .components import connected_components

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
SEED = 42
CHUNK = 4096
BLOCK = 512


def fingerprint_arrays(texts: list[bytes | None], words: int) -> np.ndarray:
    """Fingerprints (uint64) of UTF-8 texts; null or no word: 0."""
    digest = xxhash.xxh64_digest
    hashes, sizes = [], []
    for text in texts:
        w = WORD.findall(text.lower()) if text else []
        if len(w) <= words:
            sizes.append(1 if w else 0)
            if w:
                hashes.append(digest(b" ".join(w), SEED))
            continue
        joined = b" ".join(w)
        ends = np.cumsum(np.fromiter(map(len, w), np.int64, len(w)) + 1)
        starts = [0, *ends[:-words].tolist()]
        hashes += [digest(joined[a:b], SEED) for a, b in zip(starts, (ends[words - 1:] - 1).tolist())]
        sizes.append(len(w) - words + 1)
    n = np.asarray(sizes, np.int64)
    out = np.zeros((len(n), 64), bool)
    if hashes:
        bits = np.unpackbits(np.frombuffer(b"".join(hashes), np.uint8)).reshape(-1, 64)
        at = np.cumsum(n) - n
        for i in np.flatnonzero(n):
            rows = bits[at[i]:at[i] + n[i]]
            # sums of at most 255 rows fit a byte, which numpy adds several times faster
            ones = sum(rows[k:k + 255].sum(axis=0, dtype=np.uint8).astype(np.int64)
                       for k in range(0, n[i], 255))
            out[i] = 2 * ones > n[i]
    return np.packbits(out, axis=1).view(">u8").reshape(-1).astype(np.uint64)


def fingerprints(docs: DataFrame, words: int = 4, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``(id, fp)`` per row; ``fp`` is the unsigned fingerprint's bits in a bigint."""
    prepare_python(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s in text_slices(batches, "text"):
            fp = fingerprint_arrays(s.column("text").cast(pa.binary()).to_pylist(), words)
            yield pa.RecordBatch.from_arrays([s.column("id"), pa.array(fp.view(np.int64))], ["id", "fp"])

    src = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("id"),
                      F.col(f"`{text_col}`").cast("string").alias("text"))
    return src.mapInArrow(run, "id bigint, fp bigint")


def bit_planes(fps: np.ndarray) -> np.ndarray:
    """64 planes x ceil(n / 64) words: bit ``i`` of plane ``b`` is bit ``b`` of ``fps[i]``."""
    n = len(fps)
    wide = np.zeros((-(-n // 64) * 64,), np.uint64)
    wide[:n] = fps
    bits = np.unpackbits(wide.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.ascontiguousarray(np.packbits(bits.T, axis=1, bitorder="little")).view(np.uint64)


def within(planes: np.ndarray, queries: np.ndarray, radius: int, dead: np.ndarray) -> np.ndarray:
    """Lanes (packed, one row per query) at most ``radius`` bits away. ``dead``
    has the lanes to leave out. Carry-save counters hold the distances so far,
    bitwise; a lane that passes the radius is marked in ``over``, and query rows
    whose lanes are all over are abandoned."""
    digits = max(1, int(radius).bit_length())
    rows = np.arange(len(queries))
    over, sums = dead.copy(), [np.zeros_like(dead) for _ in range(digits)]
    out = np.zeros_like(dead)
    for b in range(64):
        flip = (0 - ((queries >> np.uint64(b)) & np.uint64(1))).astype(np.uint64)
        carry = planes[b][None, :] ^ flip[:, None]
        for k in range(digits):
            sums[k], carry = sums[k] ^ carry, sums[k] & carry
        over |= carry
        # count > radius: compare the digits from the top
        if b >= radius:
            more, same = np.zeros_like(over), np.full_like(over, ~np.uint64(0))
            for k in reversed(range(digits)):
                if radius >> k & 1:
                    same &= sums[k]
                else:
                    more |= same & sums[k]
                    same &= ~sums[k]
            over |= more
            if b % 4 == 3:
                keep = ~(over == ~np.uint64(0)).all(axis=1)
                if not keep.all():
                    rows, queries, over = rows[keep], queries[keep], over[keep]
                    sums = [s[keep] for s in sums]
                    if not len(rows):
                        return out
    out[rows] = ~over
    return out


def block_links(fps: np.ndarray, side: np.ndarray | None, radius: int) -> list[tuple[int, int]]:
    """A spanning forest, as index pairs, of the links among ``fps``. With
    ``side``, only links between rows of different sides are looked for."""
    n = len(fps)
    if n < 2:
        return []
    planes = bit_planes(fps)
    lanes = np.arange(planes.shape[1] * 64)
    label, links = np.arange(n), []
    step = max(16, min(BLOCK, (1 << 17) // planes.shape[1]))
    for q in range(0, n, step):
        ids = np.arange(q, min(n, q + step))
        skip = (lanes[None, :] <= ids[:, None]) | (lanes >= n)[None, :]
        if side is not None:
            skip[:, :n] |= side[ids][:, None] == side[None, :]
        dead = np.ascontiguousarray(np.packbits(skip, axis=1, bitorder="little")).view(np.uint64)
        near = within(planes, fps[ids], radius, dead)
        for r in np.flatnonzero(near.any(axis=1)):
            hit = np.flatnonzero(np.unpackbits(near[r:r + 1].view(np.uint8), bitorder="little"))
            i = ids[r]
            roots, first = np.unique(label[hit], return_index=True)
            for root, j in zip(roots, hit[first]):
                if root != label[i]:
                    links.append((int(i), int(j)))
                    label[label == root] = label[i]
    return links


def _blocks(max_bits: int) -> list[tuple[int, int]]:
    """(offset, width) of ``max_bits + 2`` blocks that cover 64 bits."""
    k = max_bits + 2
    edges = [64 * i // k for i in range(k + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def fingerprint_links(nodes: DataFrame, max_bits: int = 4) -> DataFrame:
    """``(u, v)``: links between distinct fingerprints (column ``fp``) at most
    ``max_bits`` apart; a spanning forest for each bucket."""
    keys = []
    for t, ((o1, w1), (o2, w2)) in enumerate(combinations(_blocks(max_bits), 2)):
        part = lambda o, w: F.shiftrightunsigned("fp", o).bitwiseAND(F.lit((1 << w) - 1))
        keys.append(F.struct(F.lit(t).alias("t"),
                             (part(o1, w1) * F.lit(1 << w2) + part(o2, w2)).alias("key")))
    dealt = nodes.select("fp", F.explode(F.array(*keys)).alias("k")).select("fp", "k.t", "k.key")
    hot = cut_lineage(dealt.groupBy("t", "key").count().where(F.col("count") > CHUNK)
                      .select("t", "key", F.ceil(F.col("count") / CHUNK).cast("int").alias("n")))
    n_hot = hot.count()
    rows = dealt.withColumn("n", F.lit(None).cast("int"))
    if n_hot:
        # 20 bytes a row: broadcast up to 100,000 hot buckets, else a join
        rows = dealt.join(F.broadcast(hot) if n_hot <= 100_000 else hot, ["t", "key"], "left")
    chunk = F.pmod(F.xxhash64("fp"), F.col("n")).cast("int")
    groups = F.when(F.col("n").isNull(), F.array(F.struct(F.lit(0).alias("x"), F.lit(0).alias("y"))))
    groups = groups.otherwise(F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda o: F.struct(
        F.least(chunk, o).alias("x"), F.greatest(chunk, o).alias("y"))))
    rows = (rows.withColumn("c", F.coalesce(chunk, F.lit(0))).withColumn("g", F.explode(groups))
            .select("t", "key", "g.x", "g.y", "c", "fp"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def emit(fps, side):
            pairs = block_links(fps, side, max_bits)
            signed = fps.view(np.int64)
            return pa.RecordBatch.from_arrays([
                pa.array(signed[[i for i, _ in pairs]] if pairs else np.zeros(0, np.int64)),
                pa.array(signed[[j for _, j in pairs]] if pairs else np.zeros(0, np.int64))], ["u", "v"])

        held, size = [], 0
        # whole buckets are packed into blocks of about BLOCK rows; links between
        # buckets of a block are true links too
        for fps, side, large in _whole_buckets(batches):
            if large:
                yield emit(fps, side)
                continue
            if size and size + len(fps) > BLOCK:
                yield emit(np.unique(np.concatenate(held)), None)
                held, size = [], 0
            held.append(fps)
            size += len(fps)
        if size:
            yield emit(np.unique(np.concatenate(held)), None)

    return (rows.repartition("t", "key", "x", "y").sortWithinPartitions("t", "key", "x", "y")
            .mapInArrow(run, "u bigint, v bigint").distinct())


def _whole_buckets(batches: Iterator[pa.RecordBatch]):
    """``(fps, side, large)`` per group of rows sorted by (t, key, x, y); groups
    of one row are left out. A group has about 2 x CHUNK rows at most."""
    rest = None
    for batch in batches:
        cols = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("t", "key", "x", "y", "c")]
        cur = [*cols, batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)]
        if rest is not None:
            cur = [np.concatenate(p) for p in zip(rest, cur)]
        n = len(cur[0])
        if not n:
            continue
        new = np.flatnonzero(np.any([c[1:] != c[:-1] for c in cur[:4]], axis=0)) + 1
        cuts = [0, *new.tolist()]
        for a, b in zip(cuts, cuts[1:]):
            if b - a > 1:
                yield _group(cur, a, b)
        rest = [c[cuts[-1]:] for c in cur]
    if rest is not None and len(rest[0]) > 1:
        yield _group(rest, 0, len(rest[0]))


def _group(cur, a: int, b: int):
    cross = cur[2][a] != cur[3][a]
    return cur[5][a:b], cur[4][a:b] if cross else None, bool(cross or b - a > BLOCK)


def simhash_classes(docs: DataFrame, words: int = 4, max_bits: int = 4,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, fp, component_id)``, one row per row of ``docs``.

    Null and empty texts have fingerprint 0 and are linked like any other. A
    null id is a member of its class but never its name; a class without any id
    has a null ``component_id``. Repeated rows come out as often as they go in.
    """
    fps = stored(fingerprints(docs, words, id_col, text_col), "simhash")
    nodes = cut_lineage(fps.groupBy("fp").agg(F.min("id").alias("low")))
    roots = connected_components(fingerprint_links(nodes.select("fp"), max_bits), "u", "v")
    named = cut_lineage(nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
                        .select("fp", "low", F.coalesce("root", "fp").alias("root")))
    names = cut_lineage(named.groupBy("root").agg(F.min("low").alias("component_id")))
    classes = lookup_spread(named.select("fp", "root"), names, "root").select("fp", "component_id")
    return lookup_spread(fps, cut_lineage(classes), "fp").select("id", "fp", "component_id")


def keep_one(docs: DataFrame, words: int = 4, max_bits: int = 4) -> DataFrame:
    """``docs`` with one row of each class: the one with the smallest doc_id
    (null last), of rows with equal doc_id the one with the smallest row hash.
    All columns are kept; rows equal in every column count once."""
    rows = docs.select("*", F.struct(F.col("doc_id").cast("bigint").alias("id"),
                                     F.xxhash64(*[f"`{c}`" for c in docs.columns]).alias("h"))
                       .alias("__row"))
    prepare_python(docs.sparkSession)
    fps = stored(_fingerprint_rows(rows, words), "simhash-rows")
    order = F.struct(F.col("id").isNull().alias("n"), "id", "h")
    nodes = cut_lineage(fps.groupBy("fp").agg(F.min(order).alias("low")))
    roots = connected_components(fingerprint_links(nodes.select("fp"), max_bits), "u", "v")
    named = cut_lineage(nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
                        .select(F.coalesce("root", "fp").alias("root"), "low"))
    kept = named.groupBy("root").agg(F.min("low").alias("low")).select(
        F.col("low.id").alias("__id"), F.col("low.h").alias("__h"))
    kept = cut_lineage(kept)
    same = (F.col("__row.id").eqNullSafe(F.col("__id"))) & (F.col("__row.h") == F.col("__h"))
    out = rows.join(kept, same, "left_semi")
    # rows that are equal in id and hash are equal rows: one of them stays
    again = cut_lineage(fps.groupBy("id", "h").count().where("count > 1").select("id", "h"))
    if not again.isEmpty():
        a = again.select(F.col("id").alias("__id"), F.col("h").alias("__h"))
        out = (out.join(a, same, "left_anti")
               .unionByName(out.join(a, same, "left_semi").dropDuplicates(["__row"])))
    return out.drop("__row")


def _fingerprint_rows(rows: DataFrame, words: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s in text_slices(batches, "text"):
            fp = fingerprint_arrays(s.column("text").cast(pa.binary()).to_pylist(), words)
            yield pa.RecordBatch.from_arrays(
                [s.column("id"), s.column("h"), pa.array(fp.view(np.int64))], ["id", "h", "fp"])

    return rows.select("__row.id", "__row.h", F.col("text").cast("string").alias("text")) \
               .mapInArrow(run, "id bigint, h bigint, fp bigint")


__all__ = ["columns_of", "fingerprint_links", "fingerprints", "keep_one", "simhash_classes"]
