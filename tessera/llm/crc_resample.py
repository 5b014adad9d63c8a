"""Importance resampling towards target texts, with CRC-32 feature buckets.

Words are runs of letters, digits and anything beyond ASCII, A-Z in lower case;
features are runs of one to ``max_n`` words. A feature's bucket is its CRC-32 modulo
``BUCKETS``. CRC-32 is linear over GF(2) once its constants are taken off, so the
CRC of a span is

    xor over its bytes of TABLE[distance from the span's end][byte]
    xor the CRC of as many zero bytes (a constant of the length).

All spans of a slice are done together: contributions are looked up for every byte
and joined by ``bitwise_xor.reduceat``. Spans longer than ``BLOCK`` are reduced block by
block and the blocks folded in pairs, the earlier one moved on by the length of the
later one, which is linear too (four tables of 256 for each power of two).

Two scans of the documents: bucket counts (at most ``BUCKETS`` rows a task), then each
document's sum of gains. A gain is the log ratio of the bucket's smoothed shares in
the target and in the documents. Gumbel noise from a hash of the id makes the
highest scores a draw without replacement by weight.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import cut_lineage, prepare_python, stored, text_slices

BUCKETS = 10_000
PERCENT = 10
LEAST_WORDS = 20
SEED = 2024
BLOCK = 64
SPAN_BYTES = 1 << 20
POLYNOMIAL = 0xEDB88320  # fixed value: CRC-32, reflected
ONES = np.uint32(0xFFFFFFFF)
RANK_SLACK = 0.002


@lru_cache(maxsize=1)
def position_table() -> np.ndarray:
    """``[d, b]``: what byte ``b`` with ``d`` bytes after it adds to a register that began as zero."""
    table = np.zeros((BLOCK, 256), np.uint32)
    first = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        first = np.where(first & 1, (first >> 1) ^ np.uint32(POLYNOMIAL), first >> 1)
    table[0] = first
    for d in range(1, BLOCK):
        table[d] = (table[d - 1] >> 8) ^ first[table[d - 1] & 255]
    return table


@lru_cache(maxsize=1)
def shift_tables() -> np.ndarray:
    """``[k, i, b]``: a register of byte ``b`` at place ``i``, moved on by ``2 ** k`` zero bytes."""
    first = position_table()[0]
    one = np.arange(256, dtype=np.uint32)[None, :] << np.arange(0, 32, 8, dtype=np.uint32)[:, None]
    tables = [(one >> 8) ^ first[one & 255]]
    for _ in range(40):
        tables.append(move(tables[-1], tables[-1]))
    return np.stack(tables)


def move(registers: np.ndarray, table: np.ndarray) -> np.ndarray:
    return (table[0][registers & 255] ^ table[1][registers >> 8 & 255]
            ^ table[2][registers >> 16 & 255] ^ table[3][registers >> 24])


def length_constants(lengths: np.ndarray) -> np.ndarray:
    """The CRC of as many zero bytes."""
    sizes, where = np.unique(lengths, return_inverse=True)
    registers = np.full(len(sizes), ONES, np.uint32)
    for k, table in enumerate(shift_tables()):
        has = (sizes >> k & 1).astype(bool)
        if has.any():
            registers[has] = move(registers[has], table)
    return (registers ^ ONES)[where]


def fold(registers: np.ndarray, block: np.ndarray, span: np.ndarray) -> np.ndarray:
    """One register a span from those of its blocks (``block``: number from the
    end, falling within a span): neighbours are joined in rounds."""
    k = BLOCK.bit_length() - 1
    while block.any():
        odd = (block & 1).astype(bool)
        registers = registers.copy()
        registers[odd] = move(registers[odd], shift_tables()[k])
        block = block >> 1
        new = np.flatnonzero(np.concatenate(([True], (span[1:] != span[:-1]) | (block[1:] != block[:-1]))))
        registers, block, span = np.bitwise_xor.reduceat(registers, new), block[new], span[new]
        k += 1
    return registers


def crc_spans(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """CRC-32 of ``data[starts[i]:starts[i] + lengths[i]]`` (no span is empty)."""
    offsets = np.cumsum(lengths) - lengths
    at = np.arange(int(lengths.sum()))
    place = at + np.repeat(starts - offsets, lengths)
    distance = np.repeat(offsets + lengths - 1, lengths) - at
    parts = position_table()[distance & (BLOCK - 1), data[place]]
    if lengths.max(initial=0) <= BLOCK:
        registers = np.bitwise_xor.reduceat(parts, offsets)
    else:
        first = np.zeros(len(parts), bool)
        first[offsets] = True
        first |= (distance & (BLOCK - 1)) == BLOCK - 1
        begin = np.flatnonzero(first)
        span = np.searchsorted(offsets, begin, "right") - 1
        registers = fold(np.bitwise_xor.reduceat(parts, begin), distance[begin] // BLOCK, span)
    return registers ^ length_constants(lengths)


@lru_cache(maxsize=1)
def byte_tables() -> tuple[np.ndarray, np.ndarray]:
    """Lower case of each byte, and whether it is part of a word."""
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    word = np.zeros(256, bool)
    word[48:58] = word[97:123] = word[128:] = True
    return lower, word


def words_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(bytes, word starts, word lengths, text of each word)`` of a column of texts; null: none."""
    texts = pc.fill_null(column, "").cast(pa.large_binary())
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    if data is None or offsets[0] == offsets[-1]:
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint8), none, none, none
    lower, word = byte_tables()
    data = lower[np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]]]
    offsets = offsets - offsets[0]
    inside = word[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:-1]
    last[:-1] &= ~inside[1:] | edge[1:-1]
    starts = np.flatnonzero(first)
    lengths = np.flatnonzero(last) + 1 - starts
    return data, starts, lengths, np.searchsorted(offsets, starts, "right") - 1


def feature_buckets(column: pa.Array, max_n: int, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(text number, bucket)`` of all features, ``SPAN_BYTES`` of them at a time."""
    data, starts, lengths, text = words_of(column)
    if max_n > 1 and len(starts):
        # words with one space after each, so that a run of words is one span
        wide = lengths + 1
        new = np.cumsum(wide) - wide
        at = np.arange(int(wide.sum())) - np.repeat(new, wide)
        source = np.minimum(np.repeat(starts, wide) + at, len(data) - 1)
        data = np.where(at == np.repeat(lengths, wide), np.uint8(32), data[source])
        starts = new
    ends = starts + lengths
    for n in range(1, max_n + 1):
        if len(starts) < n:
            break
        m = len(starts) - n + 1
        run = np.flatnonzero(text[:m] == text[n - 1:])
        sizes = ends[run + n - 1] - starts[run]
        cut = np.flatnonzero(np.diff(np.cumsum(sizes) // SPAN_BYTES)) + 1
        for a, b in zip([0, *cut.tolist()], [*cut.tolist(), len(run)]):
            if a < b:
                yield text[run[a:b]], crc_spans(data, starts[run[a:b]], sizes[a:b]).astype(np.int64) % buckets


def bucket_counts(texts: DataFrame, max_n: int = 1, buckets: int = BUCKETS, text_col: str = "text") -> np.ndarray:
    """Features by bucket over all rows; the driver gets a row a bucket."""
    prepare_python(texts.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for s in text_slices(batches, "text"):
            for _, bucket in feature_buckets(s.column("text"), max_n, buckets):
                total += np.bincount(bucket, minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    rows = (texts.select(F.col(f"`{text_col}`").cast("string").alias("text"))
            .mapInArrow(count, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")))
    for bucket, n in rows.collect():
        out[bucket] = n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """1000 times the log ratio of the smoothed shares by bucket, rounded down."""
    buckets, s_all, t_all = len(corpus), float(corpus.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1.0) * (s_all + buckets) / ((s + 1.0) * (t_all + buckets))))
                     for s, t in zip(corpus.tolist(), target.tolist())], np.int64)


def noise(doc_id: int | None, seed: int) -> int:
    """Gumbel noise in thousandths, by a hash of the id (null: of no digits)."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scores(docs: DataFrame, gain: np.ndarray, max_n: int = 1, seed: int = SEED, id_col: str = "doc_id",
           text_col: str = "text", keep: Sequence[str] = ()) -> DataFrame:
    """``(doc_id, n_words, n_features, weight, score)`` and, as ``row``, the columns ``keep`` of ``docs``."""
    prepare_python(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(gain)  # a number a bucket

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s in text_slices(batches, "text"):
            n = s.num_rows
            words = np.bincount(words_of(s.column("text"))[3], minlength=n)
            features, weight = np.zeros(n, np.int64), np.zeros(n, np.int64)
            for text, bucket in feature_buckets(s.column("text"), max_n, len(sent.value)):
                features += np.bincount(text, minlength=n)
                new = np.flatnonzero(np.concatenate(([True], text[1:] != text[:-1])))
                weight[text[new]] += np.add.reduceat(sent.value[bucket], new)
            ids = s.column("id")
            drawn = np.fromiter((noise(i, seed) for i in ids.to_pylist()), np.int64, n)
            cols = [ids, pa.array(words.astype(np.int64)), pa.array(features), pa.array(weight), pa.array(weight + drawn)]
            names = ["doc_id", "n_words", "n_features", "weight", "score"]
            if keep:
                cols, names = [*cols, s.column("row")], [*names, "row"]
            yield pa.RecordBatch.from_arrays(cols, names)

    row = [F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row")] if keep else []
    source = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"), *row)
    schema = StructType()
    for c in ("doc_id", "n_words", "n_features", "weight", "score"):
        schema = schema.add(c, "long")
    if keep:
        schema = schema.add(source.schema["row"])
    return source.mapInArrow(run, schema)


def ranked(scored: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """``scored`` with ``rank``: 1, 2, ... for the share of rows of ``least_words`` words
    that is drawn, by score, then smaller doc_id (null last); null for the others.

    Rows well below the cut, by an approximate percentile that is checked by
    counting, are not sorted. The others are sorted by range partitions, whose row
    counts give each its first rank: no task holds all rows.
    """
    # a number of its own for each written row, so that equal rows can be told apart, also by a later attempt
    rows = stored(scored.withColumn("__salt", F.monotonically_increasing_id()), "resample")
    fits = F.col("n_words") >= least_words
    drawn = rows.where(fits).count() * percent // 100
    null = F.lit(None).cast("bigint")
    if not drawn:
        return rows.withColumn("rank", null).drop("__salt")
    share = max(0.0, 1 - percent / 100 - RANK_SLACK)
    cut = rows.where(fits).agg(F.percentile_approx("score", share, 10_000)).first()[0]
    top = fits & (F.col("score") >= cut)
    if rows.where(top).count() < drawn:
        top = fits
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("n_features"), F.asc("weight"), F.asc("__salt")]
    pid = F.spark_partition_id()
    # the rows themselves do not move: ranks go by salt
    at = cut_lineage(rows.where(top).select("score", "doc_id", "n_features", "weight", "__salt")
                     .repartitionByRange(*order).sortWithinPartitions(*order)
                     .select("__salt", pid.alias("pid"), (F.monotonically_increasing_id() - F.shiftleft(pid.cast("bigint"), 33)).alias("at")))
    first, before = [], 0
    for p, n in sorted(at.groupBy("pid").count().collect()):  # a row a partition
        first.append((p, before))
        before += n
    places = at.join(F.broadcast(at.sparkSession.createDataFrame(first, "pid int, before bigint")), "pid") \
        .select("__salt", (F.col("before") + F.col("at") + 1).alias("rank")).where(F.col("rank") <= drawn)
    return rows.join(places, "__salt", "left").drop("__salt")


def resample(docs: DataFrame, target: DataFrame, max_n: int = 1, buckets: int = BUCKETS, percent: int = PERCENT,
             least_words: int = LEAST_WORDS, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text",
             target_text: str = "text") -> DataFrame:
    """``(doc_id, n_features, weight, score, rank, n_words)``, one row per row of ``docs``.

    Null and empty texts have no features, weight 0 and no rank. Repeated rows are
    drawn separately; equal scores go to the smaller id (null last). Without target
    texts every gain compares with even shares. No documents give no rows.
    """
    gain = gains(bucket_counts(docs, max_n, buckets, text_col), bucket_counts(target, max_n, buckets, target_text))
    out = ranked(scores(docs, gain, max_n, seed, id_col, text_col), percent, least_words)
    return out.select("doc_id", "n_features", "weight", "score", "rank", "n_words")


def resampled_documents(docs: DataFrame, target: DataFrame, max_n: int = 1, buckets: int = BUCKETS, percent: int = PERCENT,
                        least_words: int = LEAST_WORDS, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text",
                        target_text: str = "text") -> DataFrame:
    """The drawn rows of ``docs``, with all their columns."""
    gain = gains(bucket_counts(docs, max_n, buckets, text_col), bucket_counts(target, max_n, buckets, target_text))
    out = ranked(scores(docs, gain, max_n, seed, id_col, text_col, keep=docs.columns), percent, least_words)
    return out.where("rank is not null").select("row.*")
