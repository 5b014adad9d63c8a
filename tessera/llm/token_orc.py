"""Token ids in ORC files.

Documents are range-partitioned by id, encoded in tasks, and written as ORC:
integer run-length encoding of the ids, stripes that readers can split, row
indexes every ``stride`` rows and a Bloom filter on ``doc_id``, so a lookup by id
skips stripes and row groups from metadata alone. ``part`` numbers the range
partitions in id order; offsets of documents come from the token counts that are
read back, first by part and then inside each part.

Encoding goes through the tokenizer for each distinct word of a text once (kept
in a bounded cache of the worker). This is exact for byte-level BPE with the
usual pre-tokenizer, which always cuts before a single space or line feed between
words; a text with any other white space is encoded whole.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut_lineage, prepare_python, text_slices, work_path

END = 0
STRIPE_BYTES = 64 << 20
STRIDE = 1000
CACHE_WORDS = 850_000
SLICE = 4 << 20
#: White space other than single spaces and line feeds between words, and NUL (RE2).
ODD = (r"[ \n][ \n]|^[ \n]|[ \n]$|[\x00\t\v\f\r\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}"
       r"\x{202f}\x{205f}\x{3000}]")
#: A letter, marks (ASCII punctuation, no apostrophe) and a space: the pre-tokenizer
#: cuts between the letter and the marks.
TAIL, CUT = r"([A-Za-zÀ-ÖØ-öø-ſ])([!-&(-/:-@\[-`{-~]+) ", "\\1 \0\\2 "
STOP = "\0\0"
SPECIAL = "<|endoftext|>"


@lru_cache(maxsize=4)
def load_tokenizer(path: str, special: bool = False):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.encode_special_tokens = not special  # else their strings in a text are ordinary text
    return t


@lru_cache(maxsize=4)
def _cache(path: str) -> dict[str, bytes]:
    return {}


def _learn(path: str, cache: dict[str, bytes], words: list[str]) -> None:
    """Put the ids (little-endian 32-bit) of ``words`` in the cache, a few hundred to
    a call of the tokenizer, with its end-of-text token between them."""
    split = load_tokenizer(path, special=True)
    end = split.token_to_id(SPECIAL)
    for k in range(0, len(words), 512):
        some = words[k:k + 512]
        forms = [w[1:] if w[0] == "\0" else w if w[0] == "\n" else " " + w for w in some]
        (e,) = split.encode_batch_fast([SPECIAL.join(forms)], add_special_tokens=False)
        ids = np.array(e.ids, "<u4")
        cuts = np.flatnonzero(ids == end).tolist()
        data = ids.tobytes()
        for w, a, b in zip(some, [-1, *cuts], [*cuts, len(ids)]):
            cache[w] = data[4 * a + 4:4 * b]


def _fill(path: str, cache: dict[str, bytes], words: list[str]) -> None:
    """The ids of new ``words`` into the cache. A word stands for itself with a space
    before it; one that begins with a line feed for itself, one with NUL for the
    rest."""
    if len(cache) > CACHE_WORDS:
        cache.clear()
    odd = [w for w in words if SPECIAL in w]
    for w in odd:
        form = w[1:] if w[0] == "\0" else w if w[0] == "\n" else " " + w
        cache[w] = np.array(load_tokenizer(path).encode(form, add_special_tokens=False).ids, "<u4").tobytes()
    _learn(path, cache, [w for w in words if SPECIAL not in w] if odd else words)


def encode(path: str, texts: pa.Array, end_id: int = END) -> tuple[np.ndarray, np.ndarray]:
    """``(number of ids by text, all ids)``; each text (null: empty) ends with ``end_id``."""
    texts = pc.fill_null(texts, "")
    odd = pc.match_substring_regex(texts, ODD)
    plain = pc.if_else(odd, "", texts)
    # the words of a text: it is cut at spaces, and before line feeds
    marked = pc.binary_join_element_wise("\0", pc.replace_substring(plain, "\n", " \n"), " " + STOP, "")
    words = pc.split_pattern(pc.replace_substring_regex(marked, TAIL, CUT), " ")
    coded = words.flatten().dictionary_encode()
    names = coded.dictionary.to_pylist()
    cache = _cache(path)
    ids = list(map(cache.get, names))
    if new := [w for w, x in zip(names, ids) if x is None and w != STOP]:
        _fill(path, cache, new)
        made = iter(new)
        ids = [cache[next(made)] if x is None and w != STOP else x for w, x in zip(names, ids)]
    if STOP in names:
        ids[names.index(STOP)] = np.array([end_id], "<u4").tobytes()
    size = np.fromiter(map(len, ids), np.int32, len(ids)) // 4
    known, at = np.frombuffer(b"".join(ids), "<u4"), np.cumsum(size, dtype=np.int32) - size
    code = coded.indices.to_numpy()
    n = size[code]
    flat = known[np.repeat(at[code] - (np.cumsum(n, dtype=np.int32) - n), n) + np.arange(n.sum(), dtype=np.int32)]
    counts = np.add.reduceat(n, words.offsets.to_numpy()[:-1] - words.offsets[0].as_py()) if len(texts) else n
    if pc.any(odd).as_py():
        t = load_tokenizer(path)
        rows = np.split(flat, np.cumsum(counts)[:-1])
        for i in np.flatnonzero(odd.to_numpy(zero_copy_only=False)):
            rows[i] = np.array([*t.encode(texts[i].as_py(), add_special_tokens=False).ids, end_id], "<u4")
        counts, flat = np.array([len(r) for r in rows]), np.concatenate(rows)
    return counts, flat


def write_tokens(docs: DataFrame, out: str, tokenizer: str, id_col: str = "doc_id",
                 text_col: str = "text", end_id: int = END, stripe_bytes: int = STRIPE_BYTES,
                 stride: int = STRIDE) -> None:
    """Write ``(doc_id, part, ids)`` to ``out``, in order of ``doc_id`` (nulls
    first) by ``part`` and inside each file. ``tokenizer`` is the path of a
    byte-level BPE file that every worker can open; each document ends with
    ``end_id``."""
    prepare_python(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s in text_slices(batches, "text", SLICE):
            counts, flat = encode(tokenizer, s.column("text"), end_id)
            offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.view("<i4")))
            yield pa.RecordBatch.from_arrays([s.column("doc_id"), s.column("part"), ids], ["doc_id", "part", "ids"])
            pa.default_memory_pool().release_unused()

    (docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"),
                 F.col(f"`{text_col}`").cast("string").alias("text"))
     .repartitionByRange("doc_id").sortWithinPartitions("doc_id")
     .withColumn("part", F.spark_partition_id())
     .mapInArrow(run, "doc_id bigint, part int, ids array<int>")
     .write.option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", "0.01")
     .option("orc.create.index", "true").option("orc.row.index.stride", str(stride))
     .option("orc.stripe.size", str(stripe_bytes)).option("orc.compress", "LZ4").orc(out))


def read_tokens(spark: SparkSession, path: str, ids: list[int] | None = None) -> DataFrame:
    """The files' rows; with ``ids``, only those documents (the filter reaches the
    ORC reader, which skips by stripe statistics and Bloom filters)."""
    df = spark.read.schema("doc_id bigint, part int, ids array<int>").orc(path)
    return df if ids is None else df.where(F.col("doc_id").isin(list(ids)))


def token_index(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32, part)`` per document, from the files.
    Documents of equal id follow each other by length and checksum."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column("ids")
            values = ids.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False)
            at = ids.offsets.to_numpy()
            crc = [zlib.crc32(values[x:y].tobytes()) for x, y in zip(at, at[1:])]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("part"), pa.array(np.diff(at).astype(np.int64)),
                 pa.array(crc, pa.int64())], ["doc_id", "part", "n_tokens", "ids_crc32"])

    prepare_python(spark)
    rows = cut_lineage(read_tokens(spark, path).mapInArrow(
        run, "doc_id bigint, part int, n_tokens bigint, ids_crc32 bigint"))
    # one row a part: its ids are below the next part's
    sums = {r[0]: r[1] for r in rows.groupBy("part").agg(F.sum("n_tokens")).collect()}
    before, total = [], 0
    for part in sorted(sums):
        before.append((part, total))
        total += sums[part]
    offsets = spark.createDataFrame(before, "part int, before bigint")
    w = Window.partitionBy("part").orderBy(F.col("doc_id").asc_nulls_first(), "n_tokens", "ids_crc32") \
        .rowsBetween(Window.unboundedPreceding, -1)
    return (rows.withColumn("in_part", F.coalesce(F.sum("n_tokens").over(w), F.lit(0)))
            .join(F.broadcast(offsets), "part")
            .select("doc_id", (F.col("before") + F.col("in_part")).alias("start"), "n_tokens",
                    "ids_crc32", "part"))


def encode_documents(docs: DataFrame, tokenizer: str, out: str | None = None, **options) -> DataFrame:
    """Write the token files (default: to a fresh path in the shared folder) and
    return their index. Null and empty texts hold the end id alone; rows with
    equal ids are kept; an empty table gives no rows."""
    spark = docs.sparkSession
    out = out or work_path(spark, "tokens")
    write_tokens(docs, out, tokenizer, **options)
    return token_index(spark, out).drop("part")
