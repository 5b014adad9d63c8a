"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

Words are lower-cased ``\\w+`` runs; letters of scripts without spaces between words
(Chinese, Japanese, Thai and the like) are words of their own. Test items are taken in blocks of bounded
size (``BLOCK_WORDS``), each broadcast in turn; two scans of the documents a
block, no shuffle of texts:

1. count, over all documents, in how many each five-word n-gram of the items
   occurs;
2. keep the rare n-grams as seeds: those in at most ``rare_share`` of the
   documents, those at most ``FACTOR`` times as frequent as the item's median
   n-gram (an item that leaked often has no rarer ones), and the rarest of every
   ``span`` adjacent ones, so all parts of an item have seeds. A document that holds
   a seed is aligned with the seed's item around each hit by word-level
   Smith-Waterman.

The score is the alignment's, over that of a full copy of the item (1.0). An
item is found in a document if its best score is ``threshold`` or more, or if the
document holds a passage of it: a local alignment with ``PASSAGE`` words more
that match than twice those that do not, however long the item is. Items of fewer
than five words have no seed; they are found where all their words stand in a row.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import prepare_python, text_slices

# fixed values: letters of Thai, Lao, Myanmar, Khmer, kana, bopomofo and Han
UNSPACED = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3005-\u3007\u3040-\u312f\u31a0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff" \
    "\uff66-\uff9f\U0001b000-\U0001b16f\U00020000-\U000323af"
WORD = re.compile(r"\w+")
LETTER_OR_WORD = re.compile(rf"(?=\w)[{UNSPACED}]|[^\W{UNSPACED}]+")
SEED_WORDS = 5
BLOCK_WORDS = 2_000_000
RARE_SHARE = 1e-3
SPAN = 8
FACTOR = 4
THRESHOLD = 0.5
PASSAGE = 30
MATCH, MISMATCH, GAP = 2, -1, -1
PRIME = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str) -> list[str]:
    text = text.lower()
    try:
        text.encode("latin-1")  # a quick look: no such letters
    except UnicodeEncodeError:
        return LETTER_OR_WORD.findall(text)
    return WORD.findall(text)


class ItemBlock:
    """Word numbers and seeds of one block of items (bounded: ``BLOCK_WORDS``)."""

    def __init__(self, items: list[tuple[int, str]], n: int):
        self.n, self.vocabulary = n, {}
        self.items: dict[int, np.ndarray] = {}
        self.short: dict[int, dict[tuple, list[int]]] = {}  # items of fewer than n words, by length
        for key, (item, text) in enumerate(items):
            words = words_of(text or "")
            if words:
                numbers = np.array([self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words], np.int64)
                if len(words) >= n:
                    self.items[key] = numbers
                else:
                    self.short.setdefault(len(words), defaultdict(list))[tuple(numbers.tolist())].append(key)
        self.ids = [i for i, _ in items]
        places = defaultdict(list)
        for key, w in self.items.items():
            for at, h in enumerate(self.hashes(w).tolist()):
                places[h].append((key, at))
        self.keys = np.array(sorted(places), np.uint64)
        self.places = [places[int(k)] for k in self.keys]

    def hashes(self, numbers: np.ndarray) -> np.ndarray:
        """A 64-bit hash of each run of ``n`` word numbers."""
        w = numbers.astype(np.uint64)
        h = np.zeros(max(0, len(w) - self.n + 1), np.uint64)
        for i in range(self.n):
            h = (h ^ w[i:len(w) - self.n + 1 + i]) * PRIME
            h ^= h >> np.uint64(29)
        return h

    def numbers(self, words: list[str]) -> np.ndarray:
        get = self.vocabulary.get
        return np.fromiter((get(w, 0) for w in words), np.int64, len(words))

    def hits(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in ``numbers`` where an n-gram of an item starts, and which one."""
        if len(numbers) < self.n or not len(self.keys):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        known = np.concatenate(([0], np.cumsum(numbers > 0)))
        at = np.flatnonzero(known[self.n:] - known[:-self.n] == self.n)
        if not len(at):
            return at, at
        runs = numbers[at[:, None] + np.arange(self.n)]
        h = np.zeros(len(at), np.uint64)
        for i in range(self.n):
            h = (h ^ runs[:, i].astype(np.uint64)) * PRIME
            h ^= h >> np.uint64(29)
        k = np.minimum(np.searchsorted(self.keys, h), len(self.keys) - 1)
        ok = self.keys[k] == h
        return at[ok], k[ok]

    def whole(self, numbers: np.ndarray) -> list[tuple[int, float, int, int]]:
        """``(item key, 1.0, copies, end word of the first)`` of the items below ``n`` words that ``numbers`` hold."""
        out = []
        for size, items in self.short.items():
            if len(numbers) < size:
                continue
            runs = np.lib.stride_tricks.sliding_window_view(numbers, size)
            at = np.flatnonzero(np.isin(runs[:, 0], [k[0] for k in items]) & (runs > 0).all(axis=1))
            found: dict[tuple, list[int]] = {}
            for p, run in zip(at.tolist(), map(tuple, runs[at].tolist())):
                if run in items:
                    found.setdefault(run, []).append(p)
            out += [(key, 1.0, len(ps), ps[0] + size) for run, ps in found.items() for key in items[run]]
        return out

    def rare(self, df: np.ndarray, limit: float, span: int) -> np.ndarray:
        """Which n-grams are seeds, given their document counts."""
        chosen = df <= limit
        for w in self.items.values():
            ks = np.searchsorted(self.keys, self.hashes(w))
            chosen[ks[df[ks] <= FACTOR * np.median(df[ks])]] = True
            for a in range(0, len(ks), span):
                part = ks[a:a + span]
                chosen[part[np.argmin(df[part])]] = True
        return chosen


def align(item: np.ndarray, passage: np.ndarray, match: int = MATCH, mismatch: int = MISMATCH,
          gap: int = GAP) -> tuple[int, int]:
    """Best local alignment's score and the end of it in ``passage``. Row by
    row; gaps along the row come from a running maximum."""
    step = -gap * np.arange(len(passage) + 1)
    prev, best, end = np.zeros(len(passage) + 1, np.int64), 0, 0
    for w in item:
        row = np.zeros_like(prev)
        row[1:] = np.maximum(prev[:-1] + np.where(passage == w, match, mismatch), prev[1:] + gap)
        row = np.maximum.accumulate(np.maximum(row, 0) + step) - step
        top = int(row.argmax())
        if row[top] > best:
            best, end = int(row[top]), top
        prev = row
    return best, end


def matches(block: ItemBlock, seeds: np.ndarray, numbers: np.ndarray,
            threshold: float) -> list[tuple[int, float, int, int]]:
    """``(item key, best score, seeds hit, end word)`` of the items found."""
    out = block.whole(numbers)
    at, which = block.hits(numbers)
    if not len(at):
        return out
    use = seeds[which]
    windows, count = defaultdict(list), defaultdict(int)
    for p, k in zip(at[use].tolist(), which[use].tolist()):
        for key, offset in block.places[k]:
            m = len(block.items[key])
            # with a gap to spare for each word that the threshold lets go
            slack = int((1 - threshold) * MATCH * m / -GAP) + 1
            windows[key].append((max(0, p - offset - slack), min(len(numbers), p - offset + m + slack)))
            count[key] += 1
    for key, spans in windows.items():
        best, end, full = 0, 0, MATCH * len(block.items[key])
        merged: list[list[int]] = []
        for a, b in sorted(set(spans)):
            if merged and a <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], b)
            else:
                merged.append([a, b])
        for a, b in merged:
            score, stop = align(block.items[key], numbers[a:b])
            if score > best:
                best, end = score, a + stop
            if best == full:
                break
        if best >= threshold * full:
            out.append((key, best / full, count[key], end))
        elif best >= MATCH * PASSAGE:
            # a gap or mismatch costs two matches here, so scattered common words do not add up
            for a, b in merged:
                score, stop = align(block.items[key], numbers[a:b], 1, -2, -2)
                if score >= PASSAGE:
                    out.append((key, best / full, count[key], a + stop))
                    break
    return out


def item_blocks(benchmark: DataFrame, id_col: str, text_col: str) -> Iterator[list[tuple[int, str]]]:
    """Items in blocks of at most ``BLOCK_WORDS`` words (one item at span);
    the driver holds one block and the partition that is being read."""
    held, size = [], 0
    rows = benchmark.select(F.col(f"`{id_col}`").cast("bigint"), F.col(f"`{text_col}`").cast("string"))
    for r in rows.where(F.col(f"`{text_col}`").isNotNull()).toLocalIterator():
        words = len(words_of(r[1]))
        if held and size + words > BLOCK_WORDS:
            yield held
            held, size = [], 0
        held.append((r[0], r[1]))
        size += words
    if held:
        yield held


def _seeded(docs: DataFrame, text_col: str, items: list, n: int, rare_share: float, span: int,
            total: int):
    """The broadcast block of items and its seeds, from a scan of all documents."""
    sc = docs.sparkSession.sparkContext
    block = sc.broadcast(ItemBlock(items, n))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(len(block.value.keys), np.int64)
        for s in text_slices(batches, "text"):
            for text in s.column("text").to_pylist():
                if text:
                    df[np.unique(block.value.hits(block.value.numbers(words_of(text)))[1])] += 1
        k = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(df[k])], ["k", "df"])

    df = np.zeros(len(block.value.keys), np.int64)
    counted = (docs.select(F.col(f"`{text_col}`").cast("string").alias("text"))
               .mapInArrow(count, "k bigint, df bigint").groupBy("k").agg(F.sum("df").alias("df")))
    for k, n_docs in counted.collect():  # a row for each n-gram of the block at most
        df[k] = n_docs
    seeds = sc.broadcast(block.value.rare(df, max(1.0, rare_share * total), span))
    return block, seeds


def contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD,
                 n: int = SEED_WORDS, rare_share: float = RARE_SHARE, span: int = SPAN,
                 id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id",
                 item_text: str = "text") -> DataFrame:
    """One row per row of ``docs`` and item found in it: ``(doc_id, item_id,
    score, n_seeds, end_word)``. Null and empty texts and items hold nothing;
    repeated documents and items each have their rows; an empty table gives no
    rows."""
    spark = docs.sparkSession
    prepare_python(spark)
    schema = "doc_id bigint, item_id bigint, score double, n_seeds int, end_word bigint"
    found, total = spark.createDataFrame([], schema), docs.count()
    src = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("id"),
                      F.col(f"`{text_col}`").cast("string").alias("text"))
    for items in item_blocks(benchmark, item_id, item_text):
        block, seeds = _seeded(docs, text_col, items, n, rare_share, span, total)

        def run(batches: Iterator[pa.RecordBatch], block=block, seeds=seeds) -> Iterator[pa.RecordBatch]:
            for s in text_slices(batches, "text"):
                rows = []
                for doc, text in zip(s.column("id").to_pylist(), s.column("text").to_pylist()):
                    if text:
                        numbers = block.value.numbers(words_of(text))
                        rows += [(doc, block.value.ids[key], score, hits, end) for key, score, hits, end
                                 in matches(block.value, seeds.value, numbers, threshold)]
                yield pa.RecordBatch.from_pylist(
                    [dict(zip(("doc_id", "item_id", "score", "n_seeds", "end_word"), r)) for r in rows],
                    schema=pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()),
                                      ("score", pa.float64()), ("n_seeds", pa.int32()),
                                      ("end_word", pa.int64())]))

        found = found.unionByName(src.mapInArrow(run, schema))
    return found


def clean(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, n: int = SEED_WORDS,
          rare_share: float = RARE_SHARE, span: int = SPAN, text_col: str = "text") -> DataFrame:
    """``docs`` without the rows in which an item is found; all columns are kept."""
    prepare_python(docs.sparkSession)
    total = docs.count()
    for items in item_blocks(benchmark, "item_id", "text"):
        block, seeds = _seeded(docs, text_col, items, n, rare_share, span, total)

        def run(batches: Iterator[pa.RecordBatch], block=block, seeds=seeds) -> Iterator[pa.RecordBatch]:
            for s in text_slices(batches, text_col):
                keep = [not (t and matches(block.value, seeds.value,
                                           block.value.numbers(words_of(t)), threshold))
                        for t in s.column(text_col).to_pylist()]
                yield s.filter(pa.array(keep, pa.bool_()))

        docs = docs.mapInArrow(run, StructType(docs.schema.fields))
    return docs
