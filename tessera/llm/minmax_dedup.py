"""MinHash near-duplicates with min-max hashing.

1. A text's set is its distinct word shingles, as 64-bit hashes. Texts with equal
   sets are one node.
2. Each of ``BANDS / 2 * ROWS`` hash functions is evaluated once and gives two values,
   the minimum and the maximum of the set; either is equal for two sets with the
   probability of their similarity. ``ROWS`` minima of different functions make a band,
   and so do the maxima of the same functions. Two sets of similarity 0.8 share no
   band with probability ``(1 - 0.8 ** ROWS) ** BANDS``, 4e-9.
3. Nodes that share a band's key are a bucket. Its pivot is the node with the most
   company over all its buckets (the centre of a group of edited copies has). Every
   member is checked against the pivot on full sets.
4. What is left are buckets, without their pivots, whose members lie in different
   components of the links so far; equal ones count once. Their members of different
   components are checked pair by pair, and a link joins two components there and
   then, so a bucket yields a forest, not pairs. Large buckets are split in chunks,
   and each pair of chunks is a group.
5. Connected components over all links; the class id is the smallest doc_id.

Every pair of nodes that shares a bucket is checked, or lies in one component
already. Sets are made again from the texts of nodes that have company; no set of
another text is stored or moved.
"""

from __future__ import annotations

from collections.abc import Iterator
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage, lookup_spread, prepare_python, stored, text_slices
from .components import connected_components

WORDS = 2
SIMILAR = 80
BANDS = 64
ROWS = 6
SEED = 12
HUB = 256
CHUNK = 2048
CHUNK_HASHES = 2_000_000
PIECE = 1 << 20
HELD_WORDS = 200_000
BROADCAST_KEYS = 500_000
SPACE = re.compile(rb"[\x20\x09-\x0D]")
MULTIPLIER, SECOND = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


class WordHashes(dict):
    """XXH64 of words, remembered up to ``HELD_WORDS``."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= HELD_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word, SEED)
        return h


def shingle_set(text: bytes | None, words: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles; one for a text with fewer words, none without."""
    parts, at = [], 0
    while text and at < len(text):
        end = at + PIECE
        cut = SPACE.search(text, end) if end < len(text) else None
        end = cut.start() if cut else len(text)
        found = text[at:end].lower().split()
        parts.append(np.fromiter(map(hashes.__getitem__, found), np.uint64, len(found)))
        at = end
    h = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    n = min(words, len(h))
    if not n:
        return h
    x = h[:len(h) - n + 1] + np.uint64(n)
    for i in range(1, n):
        x = (x ^ (x >> np.uint64(31))) * MULTIPLIER + h[i:len(h) - n + 1 + i]
    x = (x ^ (x >> np.uint64(29))) * SECOND
    return np.unique(x ^ (x >> np.uint64(32)))


def functions(count: int) -> tuple[np.ndarray, np.ndarray]:
    """Odd factors and offsets of ``count`` permutations of 32-bit numbers."""
    r = np.random.default_rng(SEED)
    return r.integers(0, 1 << 31, count).astype(np.uint32) * np.uint32(2) + np.uint32(1), r.integers(0, 1 << 32, count).astype(np.uint32)


def extremes(sets: list[np.ndarray], count: int) -> tuple[np.ndarray, np.ndarray]:
    """Minima and maxima (sets x functions) of non-empty sets, one evaluation each."""
    sizes = np.array([len(s) for s in sets], np.int64)
    flat = np.concatenate(sets)
    flat = (flat ^ (flat >> np.uint64(32))).astype(np.uint32)
    begin = np.cumsum(sizes) - sizes
    low, high = np.empty((count, len(sets)), np.uint32), np.empty((count, len(sets)), np.uint32)
    for i, (a, b) in enumerate(zip(*functions(count))):
        x = flat * a + b
        low[i] = np.minimum.reduceat(x, begin)
        high[i] = np.maximum.reduceat(x, begin)
    return low.T, high.T


def band_keys(sets: list[np.ndarray], bands: int, rows: int) -> np.ndarray:
    """Keys (sets x bands, int64): half the bands of minima, half of maxima."""
    half = bands // 2
    keys = []
    for side, values in enumerate(extremes(sets, half * rows)):
        v = values.astype(np.uint64).reshape(len(sets), half, rows)
        key = np.broadcast_to(np.arange(half, dtype=np.uint64) * np.uint64(2) + np.uint64(side + 1), v.shape[:2]).copy()
        for i in range(rows):
            key = (key ^ (key >> np.uint64(31))) * MULTIPLIER + v[:, :, i]
        keys.append((key ^ (key >> np.uint64(29))) * SECOND)
    return np.concatenate(keys, axis=1).view(np.int64)


def _source(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.col(f"`{text_col}`").cast("string")
    return docs.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), text.alias("text")) \
        .withColumn("row", F.xxhash64("id", "text"))


def signatures(docs: DataFrame, words: int, bands: int, rows: int, id_col: str, text_col: str) -> DataFrame:
    """``(id, row, n, node, bands)`` per row: its set's size and digest, and its keys (null without a set)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for s in text_slices(batches, "text"):
            sets = [shingle_set(t, words, hashes) for t in s.column("text").cast(pa.binary()).to_pylist()]
            some = [x for x in sets if len(x)]
            keys = iter(band_keys(some, bands, rows).tolist()) if some else iter(())
            yield pa.RecordBatch.from_arrays([
                s.column("id"), s.column("row"), pa.array([len(x) for x in sets], pa.int64()),
                pa.array([xxhash.xxh128_digest(x.tobytes()) if len(x) else None for x in sets], pa.binary()),
                pa.array([next(keys) if len(x) else None for x in sets], pa.list_(pa.int64()))], ["id", "row", "n", "node", "bands"])

    return _source(docs, id_col, text_col).mapInArrow(run, "id bigint, row bigint, n bigint, node binary, bands array<bigint>")


def full_sets(docs: DataFrame, nodes: DataFrame, words: int, id_col: str, text_col: str) -> DataFrame:
    """``(nid, set)`` for ``nodes`` ``(nid, row)``, from the texts they were first seen in."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for s in text_slices(batches, "text"):
            sets = [shingle_set(t, words, hashes).tobytes() for t in s.column("text").cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([s.column("row"), pa.array(sets, pa.binary())], ["row", "set"])

    wanted = nodes.select("row")
    small = nodes.count() <= BROADCAST_KEYS  # 8 bytes each; beyond, texts and keys meet in a join
    found = _source(docs, id_col, text_col).join(F.broadcast(wanted) if small else wanted, "row", "left_semi")
    sets = found.mapInArrow(run, "row bigint, set binary").groupBy("row").agg(F.first("set").alias("set"))
    return stored(sets.join(nodes, "row").select("nid", "set"), "minmax-sets")


def common(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    return int((b[np.minimum(at, len(b) - 1)] == a).sum())


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = common(a, b)
    return 100 * both >= percent * (len(a) + len(b) - both)


def _sizes_fit(a: str, b: str, percent: int):
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def star_links(edges: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The edges ``(u, v)`` whose full sets are similar. A hub's set goes to a
    group of ``HUB`` of its edges."""
    hubs = cut_lineage(edges.groupBy("v").agg(F.ceil(F.count("*") / HUB).cast("int").alias("k")))
    members = (edges.join(hubs, "v").withColumn("part", F.pmod(F.xxhash64("u"), F.col("k")).cast("int"))
               .join(sets.withColumnRenamed("nid", "u"), "u").select("v", "part", "u", "set"))
    centres = (hubs.join(sets.withColumnRenamed("nid", "v"), "v")
               .select("v", F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("part"), F.lit(None).cast("bigint").alias("u"), "set"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centre, of = None, None
        for b in batches:
            us, vs = [], []
            for v, u, data in zip(b.column("v").to_pylist(), b.column("u").to_pylist(), b.column("set").to_pylist()):
                x = np.frombuffer(data, np.uint64)
                if u is None:
                    centre, of = x, v
                elif of == v and similar(centre, x, percent):
                    us.append(u)
                    vs.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(us, pa.int64()), pa.array(vs, pa.int64())], ["u", "v"])

    return (centres.unionByName(members).repartition("v", "part").sortWithinPartitions("v", "part", F.asc_nulls_first("u"))
            .select("v", "u", "set").mapInArrow(run, "u bigint, v bigint"))


def forest(nodes: list[int], comps: list[int], sides: list[int] | None, sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links between members of different components; each joins two of them.

    Hashes are numbered once; a member's numbers are marked, and the marks summed
    over every other set, in one step each. The members of the largest component
    are only met from the others' side.
    """
    label = np.unique(comps, return_inverse=True)[1]
    sizes = np.array([len(x) for x in sets], np.int64)
    begin = np.cumsum(sizes) - sizes
    number = np.unique(np.concatenate(sets), return_inverse=True)[1]
    marks = np.zeros(number.max() + 1, bool)
    side = None if sides is None else np.array(sides)
    links = []
    for i in np.flatnonzero(label != np.bincount(label).argmax()):
        if not (label != label[i]).any():
            break
        own = number[begin[i]:begin[i] + sizes[i]]
        marks[own] = True
        both = np.add.reduceat(marks[number], begin, dtype=np.int64)
        marks[own] = False
        near = (100 * both >= percent * (sizes[i] + sizes - both)) & (label != label[i])
        if side is not None:
            near &= side != side[i]
        for j in np.flatnonzero(near):
            if label[j] != label[i]:
                links.append((nodes[i], nodes[j]))
                label[label == label[j]] = label[i]
    return links


def bucket_links(rows: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """A forest of the links within buckets: ``rows`` has ``(key, c, total, nid, comp)``,
    ``c`` the bucket's size and ``total`` that of its sets."""
    k = F.ceil(F.greatest(F.col("c") / CHUNK, F.col("total") / CHUNK_HASHES)).cast("int")
    side = F.pmod(F.xxhash64("nid"), k).cast("int")
    groups = F.when(k == 1, F.array(F.struct(F.lit(0).alias("x"), F.lit(0).alias("y")))).otherwise(
        F.transform(F.sequence(F.lit(0), k - 1), lambda o: F.struct(F.least(side, o).alias("x"), F.greatest(side, o).alias("y"))))
    dealt = (rows.withColumn("side", side).withColumn("g", F.explode(groups))
             .select("key", "g.x", "g.y", "side", "nid", "comp").join(sets, "nid"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def put(held):
            cross = held[0][1] != held[0][2]
            found = forest([h[4] for h in held], [h[5] for h in held], [h[3] for h in held] if cross else None,
                           [np.frombuffer(h[6], np.uint64) for h in held], percent)
            return pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], pa.int64()) for i in (0, 1)], ["u", "v"])

        held: list = []
        for b in batches:
            for row in zip(*(b.column(c).to_pylist() for c in ("key", "x", "y", "side", "nid", "comp", "set"))):
                if held and held[0][:3] != row[:3]:
                    yield put(held)
                    held = []
                held.append(row)
        if held:
            yield put(held)

    return (dealt.repartition("key", "x", "y").sortWithinPartitions("key", "x", "y", "nid")
            .select("key", "x", "y", "side", "nid", "comp", "set").mapInArrow(run, "u bigint, v bigint"))


def minmax_classes(docs: DataFrame, words: int = WORDS, percent: int = SIMILAR, bands: int = BANDS, rows: int = ROWS,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, row, n, component_id)``, one row per row of ``docs``; ``n`` is its set's size.

    A text without words, or a null one, has no set and is a class of its own; one
    with fewer words than a shingle is one shingle. A null id is a member of its class
    but never its name; a class without any id has a null ``component_id``. Repeated
    rows come out as often as they go in; an empty table gives no rows.
    """
    spark = docs.sparkSession
    prepare_python(spark)
    seen = stored(signatures(docs, words, bands, rows, id_col, text_col), "minmax-signatures")
    # numbers of nodes are made once, as they are written
    nodes = stored(seen.where("n > 0").groupBy("node").agg(F.min("row").alias("row"), F.min("id").alias("low"), F.first("n").alias("n"),
                                                          F.first("bands").alias("bands"))
                   .withColumn("nid", F.monotonically_increasing_id()), "minmax-nodes")
    dealt = nodes.select("nid", "n", F.explode("bands").alias("key"))
    shared = cut_lineage(dealt.groupBy("key").agg(F.count("*").alias("c")).where("c > 1"))
    company = stored(dealt.join(shared, "key"), "minmax-buckets")
    degree = cut_lineage(company.groupBy("nid").agg(F.sum("c").alias("d")))
    best = company.join(degree, "nid").groupBy("key").agg(F.max(F.struct("d", (-F.col("nid")).alias("m"), F.col("n").alias("pn"))).alias("p"))
    pivots = cut_lineage(best.select("key", (-F.col("p.m")).alias("pivot"), F.col("p.pn").alias("pn")))
    members = stored(company.join(pivots, "key").where("nid <> pivot"), "minmax-members")
    edges = cut_lineage(members.where(_sizes_fit("n", "pn", percent)).select(F.col("nid").alias("u"), F.col("pivot").alias("v")).distinct())
    links, rooted = None, None
    if not edges.isEmpty():
        ends = edges.select(F.col("u").alias("nid")).unionByName(edges.select(F.col("v").alias("nid"))).distinct()
        sets = full_sets(docs, cut_lineage(ends.join(nodes.select("nid", "row"), "nid")), words, id_col, text_col)
        links = cut_lineage(star_links(edges, sets, percent))
        rooted = cut_lineage(connected_components(links, "u", "v"))
    comp = F.lit(None).cast("bigint")
    labelled = lookup_spread(members, rooted.withColumnRenamed("node", "nid"), "nid") if rooted is not None else members.withColumn("root", comp)
    labelled = labelled.select("key", "nid", "n", F.coalesce("root", "nid").alias("comp"))
    # buckets with members of several components, the same ones once
    mixed = labelled.groupBy("key").agg(
        F.count("*").alias("c"), F.sum("n").alias("total"), F.min("comp").alias("a"), F.max("comp").alias("b"),
        F.sum(F.xxhash64("nid").cast("decimal(38,0)")).alias("h1"), F.bit_xor(F.xxhash64("nid", F.lit(SEED))).alias("h2")).where("a <> b")
    mixed = cut_lineage(mixed.groupBy("c", "total", "h1", "h2").agg(F.min("key").alias("key")).select("key", "c", "total"))
    if not mixed.isEmpty():
        left = stored(labelled.join(mixed, "key").select("key", "c", "total", "nid", "comp"), "minmax-mixed")
        sets = full_sets(docs, cut_lineage(left.select("nid").distinct().join(nodes.select("nid", "row"), "nid")), words, id_col, text_col)
        more = cut_lineage(bucket_links(left, sets, percent).distinct())
        if not more.isEmpty():
            # new links join components, each known by its smallest node
            links = more if links is None else links.unionByName(more)
            rooted = cut_lineage(connected_components(links, "u", "v"))
    named = nodes.select("node", "nid", "low")
    if rooted is not None:
        named = lookup_spread(named, rooted.withColumnRenamed("node", "nid"), "nid").select("node", "low", F.coalesce("root", "nid").alias("root"))
    else:
        named = named.withColumnRenamed("nid", "root")
    named = cut_lineage(named)
    names = cut_lineage(named.groupBy("root").agg(F.min("low").alias("component_id")))
    classes = cut_lineage(lookup_spread(named.select("node", "root"), names, "root").select("node", "component_id"))
    out = lookup_spread(seen.select("id", "row", "n", "node"), classes, "node")
    return out.select("id", "row", "n", F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"))


def keep_one(docs: DataFrame, words: int = WORDS, percent: int = SIMILAR, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each class, that of the smallest id, all columns kept;
    every row without a set stays. Rows without an id stay only where no row of their class has one."""
    named = minmax_classes(docs, words, percent, id_col=id_col, text_col=text_col)
    chosen = cut_lineage(named.where("n > 0").where(F.col("id").eqNullSafe(F.col("component_id")))
                         .groupBy("component_id").agg(F.min("row").alias("__row")).select("__row"))
    bare = cut_lineage(named.where("n = 0").select(F.col("row").alias("__row")).distinct())
    text = F.col(f"`{text_col}`").cast("string")
    rows = docs.withColumn("__row", F.xxhash64(F.col(f"`{id_col}`").cast("bigint"), text))
    return (rows.join(chosen, "__row", "left_semi").dropDuplicates(["__row"])
            .unionByName(rows.join(bare, "__row", "left_semi")).drop("__row"))
