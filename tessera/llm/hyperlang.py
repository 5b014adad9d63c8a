"""Language ID with hyperdimensional profiles.

Each letter has a random vector of +1 and -1. A letter n-gram's vector binds
its letters' vectors, each permuted (rotated) by its place in the n-gram, by
multiplication. A text's vector bundles (adds) the vectors of all its n-grams;
a language's prototype bundles all n-grams of its training texts. The
prediction is the prototype with the largest cosine.

Bundling is a sum, so prototypes come from partial sums of partitions, over
all training rows; texts are compared one by one inside tasks. Letters are
Unicode letters of the lower-cased text, every other character is one space,
runs of spaces are one.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import prepare_python, text_slices

DIMS = 1024
ORDER = 3
SEED = 20
PARTS = 64
UND = "und"
SLICE = 512 << 10
SPACE = 32
GRAMS = (20, 100)


@lru_cache(maxsize=1)
def _letter_table() -> np.ndarray:
    """Code point -> itself for letters (lower case as ``str.lower`` has it), else space."""
    table = np.full(0x110000, SPACE, np.uint32)
    for c in range(0x110000):
        if not 0xD800 <= c < 0xE000 and chr(c).isalpha():
            table[c] = c
    return table


@lru_cache(maxsize=20_000)
def letter_vector(code: int, dims: int) -> np.ndarray:
    return np.random.default_rng([SEED, code]).integers(0, 2, dims).astype(np.float32) * 2 - 1


def letters(text: str) -> np.ndarray:
    """Code points with one space at both ends; empty if there is no letter."""
    # surrogates cannot occur in a Spark string
    a = _letter_table()[np.frombuffer(text.lower().encode("utf-32-le"), np.uint32)]
    a = np.concatenate(([SPACE], a, [SPACE])).astype(np.uint32)
    a = a[~((a == SPACE) & (np.concatenate(([0], a[:-1])) == SPACE))]
    return a if len(a) > 2 else a[:0]


def gram_counts(texts: list[str | None], order: int):
    """``(grams, counts)``: the distinct n-grams of all texts as rows of code
    points, and the matrix of counts (texts x grams, float32)."""
    runs = [letters(t) if t else np.zeros(0, np.uint32) for t in texts]
    sizes = np.array([max(0, len(r) - order + 1) for r in runs])
    if not sizes.sum():
        return np.zeros((0, order), np.uint32), np.zeros((len(texts), 0), np.float32)
    flat = np.concatenate(runs)
    # dense letter numbers keep the n-gram codes small
    seen = np.zeros(0x110000, bool)
    seen[flat] = True
    alphabet = np.flatnonzero(seen)
    dense = np.zeros(0x110000, np.int64)
    dense[alphabet] = np.arange(len(alphabet))
    k = len(alphabet)
    codes = np.zeros(len(flat) - order + 1, np.int64)
    num = dense[flat]
    for i in range(order):
        codes = codes * k + num[i:len(flat) - order + 1 + i]
    starts = np.cumsum([0, *map(len, runs)])[:-1]
    inside = np.zeros(len(flat) + 1, np.int64)
    np.add.at(inside, starts[sizes > 0], 1)
    np.add.at(inside, (starts + sizes)[sizes > 0], -1)
    codes = codes[np.cumsum(inside)[:len(codes)] > 0]
    if k ** order <= 1 << 22:
        present = np.flatnonzero(np.bincount(codes, minlength=1))
        place = np.zeros(present[-1] + 1, np.int64)
        place[present] = np.arange(len(present))
        where = place[codes]
    else:
        present, where = np.unique(codes, return_inverse=True)
    text_no = np.repeat(np.arange(len(texts)), sizes)
    m = np.bincount(text_no * len(present) + where, minlength=len(texts) * len(present))
    grams = np.stack([present // k ** (order - 1 - i) % k for i in range(order)], axis=1)
    return alphabet[grams], m.reshape(len(texts), -1).astype(np.float32)


def gram_vectors(grams: np.ndarray, dims: int) -> np.ndarray:
    """Bound vectors of n-grams: the letter at place ``i`` is rotated by ``order - 1 - i``."""
    order = grams.shape[1]
    used, at = np.unique(grams, return_inverse=True)
    at = at.reshape(grams.shape)
    base = np.stack([letter_vector(int(c), dims) for c in used]) if len(used) else np.zeros((0, dims), np.float32)
    out = np.ones((len(grams), dims), np.float32)
    for i in range(order):
        out *= np.roll(base, order - 1 - i, axis=1)[at[:, i]]
    return out


def bundle(grams: np.ndarray, counts: np.ndarray, dims: int, step: int = 1024) -> np.ndarray:
    """Sums of n-gram vectors by rows of ``counts``; vectors are made ``step`` at a time."""
    out = np.zeros((len(counts), dims), counts.dtype)
    for k in range(0, len(grams), step):
        out += counts[:, k:k + step] @ gram_vectors(grams[k:k + step], dims)
    return out


def bundles(texts: list[str | None], order: int, dims: int) -> np.ndarray:
    return bundle(*gram_counts(texts, order), dims)


def chance(grams: np.ndarray, counts: np.ndarray, dims: int) -> np.ndarray:
    """Expected bundles of as many n-grams as the rows of ``counts`` have, of the same letters in random order."""
    order = grams.shape[1]
    size = counts.sum(axis=1, keepdims=True)
    out = np.repeat(size, dims, axis=1)
    for i in range(order):
        by = np.argsort(grams[:, i], kind="stable")
        used, first = np.unique(grams[by, i], return_index=True)
        share = np.add.reduceat(counts[:, by], first, axis=1) / np.maximum(size, 1)
        out *= np.roll(share @ np.stack([letter_vector(int(c), dims) for c in used]), order - 1 - i, axis=1)
    return out


def train(docs: DataFrame, label: Column, rows: Column, text_col: str = "text",
          order: int = ORDER, dims: int = DIMS) -> dict[str, np.ndarray]:
    """Prototypes by label over all ``docs`` where ``rows`` holds and the label
    is not null. Labels whose texts have no letter get no prototype. The driver
    gets at most ``PARTS`` vectors a label."""
    return learn(docs, label, rows, text_col, order, dims)[0]


def learn(docs: DataFrame, label: Column, rows: Column, text_col: str = "text",
          order: int = ORDER, dims: int = DIMS) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """The prototypes of ``train``, and all letters (code points) of their texts."""
    prepare_python(docs.sparkSession)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        seen: dict[str, np.ndarray] = {}
        for s in text_slices(batches, "text", SLICE):
            names = pd.Series(s.column("label").to_pylist())
            grams, counts = gram_counts(s.column("text").to_pylist(), order)
            if not len(grams):
                continue
            by_label = names.groupby(names).indices
            total = np.stack([counts[at].sum(axis=0, dtype=np.float64) for at in by_label.values()])
            for name, n, v in zip(by_label, total, bundle(grams, total, dims)):
                sums[name] = sums.get(name, 0) + v
                seen[name] = np.union1d(seen.get(name, np.zeros(0, np.uint32)), grams[n > 0])
        if sums:
            yield pa.RecordBatch.from_pydict(
                {"label": list(sums), "v": [x.tolist() for x in sums.values()], "letters": [seen[k].tolist() for k in sums]},
                schema=pa.schema([("label", pa.string()), ("v", pa.list_(pa.float64())), ("letters", pa.list_(pa.int32()))]))

    def add(g: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"label": [g["label"].iloc[0]], "v": [np.sum(np.stack(g["v"]), axis=0)],
                             "letters": [np.unique(np.concatenate(list(g["letters"])))]})

    parts = (docs.where(rows & label.isNotNull())
             .select(label.cast("string").alias("label"), F.col(f"`{text_col}`").cast("string").alias("text"))
             .mapInArrow(partial, "label string, v array<double>, letters array<int>")
             .withColumn("part", F.pmod(F.spark_partition_id(), F.lit(PARTS))))
    sums: dict[str, np.ndarray] = {}
    seen = np.zeros(0, np.int64)
    for r in parts.groupBy("label", "part").applyInPandas(add, "label string, v array<double>, letters array<int>").collect():
        sums[r[0]] = sums.get(r[0], 0) + np.array(r[1])
        seen = np.union1d(seen, r[2])
    return ({k: v / np.linalg.norm(v) for k, v in sorted(sums.items()) if np.linalg.norm(v) > 0},
            seen[seen != SPACE].astype(np.uint32))


def scorer(prototypes: dict[str, np.ndarray], order: int = ORDER, dims: int = DIMS):
    """A function from texts to ``(language or None, cosine in 0..1)`` lists;
    ties go to the language that sorts first."""
    names = sorted(prototypes)
    matrix = np.stack([prototypes[k] for k in names]).astype(np.float32) if names else None

    def score(texts: list[str | None]):
        if matrix is None:
            return [UND] * len(texts), [0.0] * len(texts)
        v = bundles(texts, order, dims)
        norm = np.linalg.norm(v, axis=1)
        cos = (v @ matrix.T) / np.where(norm > 0, norm, 1)[:, None]
        best = cos.argmax(axis=1)
        top = np.clip(cos[np.arange(len(best)), best], 0, 1).astype(np.float64)
        ok = norm > 0
        return ([names[b] if k else UND for b, k in zip(best, ok)],
                np.where(ok, top, 0.0).tolist())

    return score


def predict(docs: DataFrame, prototypes: dict[str, np.ndarray], text_col: str = "text",
            order: int = ORDER, dims: int = DIMS, keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns of ``docs`` (default: all) with ``lang_pred`` and
    ``score``. Null text and text without a letter: ``und`` and 0. Columns of
    those names in ``docs`` must not be kept."""
    from pyspark.sql.types import DoubleType, StringType, StructType

    prepare_python(docs.sparkSession)
    keep = docs.columns if keep is None else keep
    score = scorer(prototypes, order, dims)
    src = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text_col}`").cast("string").alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s in text_slices(batches, "__text", SLICE):
            lang, sc = score(s.column("__text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*(s.column(c) for c in keep), pa.array(lang, pa.string()), pa.array(sc, pa.float64())],
                [*keep, "lang_pred", "score"])

    schema = StructType(src.schema.fields[:-1]).add("lang_pred", StringType()).add("score", DoubleType())
    return src.mapInArrow(run, schema)


def held_out(id_col: str = "doc_id") -> Column:
    """Whether crc32 of the id as text leaves 2 modulo 4 (null id: no)."""
    return F.coalesce(F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def known(prototypes: dict[str, np.ndarray], least: float, seen: np.ndarray | None = None,
          order: int = ORDER, dims: int = DIMS):
    """A function from texts to whether there is evidence for a language. With ``GRAMS[1]``
    n-grams or more it is a cosine of ``least`` above that expected by chance, of the same
    letters in random order; with fewer the cosine's noise is as large as itself, and less
    will do, down to one letter (of ``seen``, if given) with ``GRAMS[0]`` n-grams or fewer."""
    names = sorted(prototypes)
    matrix = np.stack([prototypes[k] for k in names]).astype(np.float32) if names else None

    def run(texts: list[str | None]) -> np.ndarray:
        grams, counts = gram_counts(texts, order)
        if matrix is None or not len(grams):
            return np.zeros(len(texts), bool)
        size = counts.sum(axis=1)
        v = bundle(grams, counts, dims)
        norm = np.linalg.norm(v, axis=1)
        above = (((v - chance(grams, counts, dims)) @ matrix.T) / np.where(norm > 0, norm, 1)[:, None]).max(axis=1)
        few = size <= GRAMS[0]
        need = least * np.clip((size - GRAMS[0]) / (GRAMS[1] - GRAMS[0]), 0, 1)
        some = (grams != SPACE if seen is None else np.isin(grams, seen)).any(axis=1)
        return (counts[:, some].sum(axis=1) > 0) & (few | (norm > 0) & (above >= need))

    return run


def keep_known(docs: DataFrame, prototypes: dict[str, np.ndarray], least: float,
               text_col: str = "text", order: int = ORDER, dims: int = DIMS,
               seen: np.ndarray | None = None) -> DataFrame:
    """The rows of ``docs`` (all columns) whose texts are ``known``."""
    from pyspark.sql.types import StructType

    prepare_python(docs.sparkSession)
    test = known(prototypes, least, seen, order, dims)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s in text_slices(batches, text_col, SLICE):
            yield s.filter(pa.array(test(s.column(text_col).to_pylist()), pa.bool_()))

    return docs.mapInArrow(run, StructType(docs.schema.fields))
