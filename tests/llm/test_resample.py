"""Importance resampling, min-max near duplicates and hard negatives."""

import hashlib
import math
import random
import re
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tessera.llm import crc_resample, hard_negatives, minmax_dedup, queries

EN = "the of and to in is that for it was on are with they at be this have from or".split()


def twin(name, **tables):
    con = duckdb.connect()
    for table, df in tables.items():
        con.register(table, df.toArrow())
    got = con.execute(queries.SQL[name])
    names = [c[0] for c in got.description]
    return names, sorted(got.fetchall(), key=str)


def same(df, name, **tables):
    names, want = twin(name, **tables)
    assert sorted(names) == sorted(df.columns)
    assert sorted((tuple(r) for r in df.select(*names).collect()), key=str) == want
    return want


# ------------------------------------------------------------------ CRC

def test_crc_of_spans():
    """Short and long spans, block edges included, overlapping and repeated."""
    r = np.random.default_rng(0)
    data = r.integers(0, 256, 200_000).astype(np.uint8)
    edges = [k * 64 + d for k in (1, 2, 3, 4, 7, 8, 100) for d in (-1, 0, 1)]
    lengths = np.concatenate((r.integers(1, 90, 800), r.integers(1, 9000, 60), edges, [1, 100_000]))
    starts = r.integers(0, 100_000, len(lengths))
    got = crc_resample.crc_spans(data, starts, lengths)
    assert got.tolist() == [zlib.crc32(data[s:s + n].tobytes()) for s, n in zip(starts, lengths)]
    assert crc_resample.crc_spans(data, starts[:5], np.full(5, 3)).tolist() == [zlib.crc32(data[s:s + 3].tobytes()) for s in starts[:5]]
    n = np.array([1, 2, 63, 64, 65, 5000, 1 << 20])
    assert crc_resample.length_constants(n).tolist() == [zlib.crc32(bytes(k)) for k in n.tolist()]


def slow_features(text, max_n):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    return [" ".join(w[i:i + n]) for n in range(1, max_n + 1) for i in range(len(w) - n + 1)]


@pytest.mark.parametrize("max_n", [1, 3])
def test_features(monkeypatch, max_n):
    monkeypatch.setattr(crc_resample, "SPAN_BYTES", 50)
    r = random.Random(1)
    alphabet = [*"aZ09é漢😀\x7f\x80 \n-_{[`@/:", "Word", " the ", "\x00", "İ"]
    texts = [None, "", "   ", "a", "x" * 500, *("".join(r.choice(alphabet) for _ in range(r.randint(0, 40))) for _ in range(400))]
    got = [[] for _ in texts]
    for text, bucket in crc_resample.feature_buckets(pa.array(texts).slice(0), max_n, 10_000):
        for t, b in zip(text, bucket):
            got[t].append(int(b))
    want = [[zlib.crc32(f.encode()) % 10_000 for f in slow_features(t, max_n)] for t in texts]
    assert [sorted(x) for x in got] == [sorted(x) for x in want]
    part = [x for _, b in crc_resample.feature_buckets(pa.array(texts).slice(7, 50), max_n, 10_000) for x in b.tolist()]
    assert sorted(part) == sorted(x for t in want[7:57] for x in t)


def brute_resample(docs, target, percent=10, least=20, seed=2024, max_n=1, buckets=10_000):
    count = lambda texts: np.bincount([zlib.crc32(f.encode()) % buckets for t in texts for f in slow_features(t, max_n)], minlength=buckets)
    s, t = count([d[1] for d in docs]), count(target)
    gain = [math.floor(1000 * math.log(float(b + 1) * float(s.sum() + buckets) / (float(a + 1) * float(t.sum() + buckets)))) for a, b in zip(s, t)]
    rows = []
    for i, text in docs:
        f = slow_features(text, max_n)
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[zlib.crc32(x.encode()) % buckets] for x in f)
        rows.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2 ** 32))), None, len(slow_features(text, 1))])
    fit = sorted((r for r in rows if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1], r[2]))
    for k, row in enumerate(fit[:percent * len(fit) // 100]):
        row[4] = k + 1
    return sorted(map(tuple, rows), key=str)


@pytest.fixture(scope="module")
def corpus(spark):
    """Copies, nulls, empties, repeated ids, a long text, one word only, clashing columns."""
    r = random.Random(4)
    words = EN + [f"w{i}" for i in range(300)] + ["Ünï", "漢字"]
    rows = [(i, " ".join(r.choice(words) for _ in range(r.randint(0, 60)))) for i in range(300)]
    rows += [(400 + i, rows[7][1]) for i in range(60)] + [(None, None), (None, rows[8][1]), (500, ""), (501, "Word"), (502, None),
                                                         (503, " ".join(r.choice(words) for _ in range(9000))), (504, "x" * 90_000), (7, rows[7][1]), (9, "word")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    for c in ("score", "rank", "row", "n", "id", "bands", "node", "__salt"):
        df = df.withColumn(c, F.lit("clash"))
    return df, rows


@pytest.fixture(scope="module")
def bench(spark):
    return spark.createDataFrame([(1, " ".join(EN * 4)), (2, None), (3, "w1 w2 w3"), (4, "")], "item_id bigint, text string")


def test_resample(spark, corpus, bench, monkeypatch):
    df, rows = corpus
    target = [r[1] for r in bench.collect()]
    got = crc_resample.resample(df, bench)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_resample(rows, target)
    same(got, "op11_crc_resample", documents=df.select("doc_id", "text"), benchmark=bench)
    monkeypatch.setattr(crc_resample, "RANK_SLACK", -0.05)  # a cut above the last drawn row: all are sorted
    wide = crc_resample.resample(df, bench, max_n=2, percent=30, least_words=5, seed=1)
    assert sorted((tuple(r) for r in wide.collect()), key=str) == brute_resample(rows, target, 30, 5, 1, 2)
    kept = crc_resample.resampled_documents(df, bench)
    assert kept.columns == df.columns and kept.count() == got.where("rank is not null").count()
    assert {r[0] for r in kept.select("doc_id").collect()} == {r[0] for r in got.where("rank is not null").select("doc_id").collect()}
    none = crc_resample.resample(df.where("false"), bench)
    assert none.count() == 0 and crc_resample.resample(df, bench.where("false")).count() == len(rows)


# -------------------------------------------------------------- min-max

def slow_set(text, n=2):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    return frozenset(" ".join(w[i:i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([" ".join(w)] if w else [])


def brute_classes(rows, percent=80):
    sets = [slow_set(t) for _, t in rows]
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]) and label[i] != label[j]:
                a, b = label[i], label[j]
                label = [a if x == b else x for x in label]
    low = {}
    for (i, _), c in zip(rows, label):
        low[c] = min((x for x in (low.get(c), i) if x is not None), default=None)
    return sorted(((i, len(s), low[c] if s else i) for (i, _), s, c in zip(rows, sets, label)), key=str)


def test_sets_and_extremes(monkeypatch):
    words = minmax_dedup.WordHashes()
    assert len(minmax_dedup.shingle_set(None, 2, words)) == len(minmax_dedup.shingle_set(b" \x0b\t", 2, words)) == 0
    long = (b"Some words in\x0ca text \xc3\xa9 " * 50)
    whole = minmax_dedup.shingle_set(long, 2, words)
    assert len(whole) == len(slow_set(long.decode()))
    monkeypatch.setattr(minmax_dedup, "PIECE", 7)
    monkeypatch.setattr(minmax_dedup, "HELD_WORDS", 2)
    assert np.array_equal(minmax_dedup.shingle_set(long, 2, minmax_dedup.WordHashes()), whole)
    assert len(minmax_dedup.shingle_set(b"one", 2, words)) == 1
    # each side alone is unbiased; together they vary less than as many functions of one side
    r = np.random.default_rng(2)
    pool = r.integers(0, 1 << 63, 150).astype(np.uint64)
    a, b = np.sort(pool[:120]), np.sort(pool[30:])
    low, high = minmax_dedup.extremes([a, b], 4000)
    assert abs((low[0] == low[1]).mean() - 0.6) < 0.03 and abs((high[0] == high[1]).mean() - 0.6) < 0.03


def near_copies(seed=5):
    """Edited copies at all distances around the threshold, a group whose centre alone links it, tiny texts."""
    r = random.Random(seed)
    words = [f"w{i}" for i in range(2000)]
    rows = []
    for g in range(12):
        base = [r.choice(words) for _ in range(r.choice((12, 60, 200)))]
        for e in range(8):
            t = base.copy()
            for _ in range(int(len(base) * e / 60)):
                t[r.randrange(len(t))] = r.choice(words)
            rows.append((1000 + 97 * g + 11 * e, " ".join(t)))
    base = [r.choice(words) for _ in range(300)]
    for i in range(40):  # copies are far from each other, near the centre
        t = base.copy()
        for _ in range(14):
            t[r.randrange(300)] = r.choice(words)
        rows.append((3000 + i, " ".join(t)))
    rows.append((9000, " ".join(base)))
    shared = " ".join(r.choice(words) for _ in range(120))
    rows += [(4000 + i, shared + " " + " ".join(r.choice(words) for _ in range(100))) for i in range(25)]
    return rows


@pytest.mark.parametrize("chunk", [2048, 3])
def test_minmax_classes(spark, corpus, monkeypatch, chunk):
    monkeypatch.setattr(minmax_dedup, "CHUNK", chunk)
    monkeypatch.setattr(minmax_dedup, "HUB", chunk)
    df, rows = corpus
    rows = rows + near_copies()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4).withColumn("key", F.lit("x")).withColumn("n", F.lit(1))
    got = minmax_dedup.minmax_classes(docs)
    assert sorted((tuple(r) for r in got.select("id", "n", "component_id").collect()), key=str) == brute_classes(rows)


def test_minmax_query(spark, corpus, monkeypatch):
    df, rows = corpus
    docs = spark.createDataFrame(rows + near_copies(6), "doc_id bigint, text string")
    monkeypatch.setattr(queries, "_table", lambda *a: docs)
    monkeypatch.setattr(minmax_dedup, "BROADCAST_KEYS", 3)
    out = same(queries.op12_minmax_dedup(spark, ""), "op12_minmax_dedup", documents=docs)
    kept = minmax_dedup.keep_one(docs)
    sets = [r for r in out if r[1] and r[0] is not None]
    assert kept.columns == docs.columns and kept.where("text is null or trim(text) = ''").count() == len([r for r in out if not r[1]])
    assert kept.count() == len([r for r in out if not r[1]]) + len({r[2] for r in sets})
    monkeypatch.setattr(queries, "_table", lambda *a: docs.where("false"))
    assert queries.op12_minmax_dedup(spark, "").count() == 0


def test_pairs_without_the_pivot(spark, monkeypatch):
    """Members that are near each other and not the pivot are found in what is left of the buckets."""
    sets = {0: set(range(100)), 1: set(range(60)) | set(range(200, 245)), 2: set(range(60)) | set(range(200, 240)), 3: {7}}
    frames = spark.createDataFrame([(k, bytearray(np.array(sorted(s), np.uint64).tobytes())) for k, s in sets.items()], "nid bigint, set binary")
    rows = spark.createDataFrame([(5, 4, 286, k, k) for k in sets], "key bigint, c bigint, total bigint, nid bigint, comp bigint")
    for chunk, hashes in ((256, 1000), (1, 1000), (256, 70)):
        monkeypatch.setattr(minmax_dedup, "CHUNK", chunk)
        monkeypatch.setattr(minmax_dedup, "CHUNK_HASHES", hashes)
        assert {tuple(sorted(r)) for r in minmax_dedup.bucket_links(rows, frames, 80).collect()} == {(1, 2)}
    edges = spark.createDataFrame([(1, 0), (2, 1), (3, 1), (0, 1)], "u bigint, v bigint")
    assert [tuple(r) for r in minmax_dedup.star_links(edges, frames, 80).collect()] == [(2, 1)]


def test_forest():
    """As many links as it takes to join what pairwise links join."""
    r = np.random.default_rng(8)
    centre = r.integers(0, 1 << 62, (5, 60)).astype(np.uint64)
    sets = [np.unique(np.concatenate((r.permutation(centre[r.integers(0, 5)])[:r.integers(48, 61)], r.integers(0, 1 << 62, r.integers(0, 8)).astype(np.uint64))))
            for _ in range(80)]
    comps = r.integers(0, 30, 80).tolist()
    got = minmax_dedup.forest(list(range(80)), comps, None, sets, 80)

    def classes(links):
        label = list(comps)
        for i, j in links:
            a, b = label[i], label[j]
            label = [min(a, b) if x in (a, b) else x for x in label]
        return label

    pairs = [(i, j) for i in range(80) for j in range(i) if minmax_dedup.similar(sets[i], sets[j], 80)]
    assert set(got) <= {p for i, j in pairs for p in ((i, j), (j, i))}
    assert classes(got) == classes(pairs) and len(got) == len(set(comps)) - len(set(classes(pairs)))


# ------------------------------------------------------- hard negatives

def test_strassen():
    r = np.random.default_rng(0)
    for n, k, m in ((37, 64, 100), (1, 1, 1), (64, 64, 64), (17, 17, 17), (33, 5, 70), (9, 130, 11)):
        a, b = r.integers(-1 << 27, 1 << 27, (n, k)), r.integers(-1 << 27, 1 << 27, (k, m))
        want = np.array([[sum(x * y for x, y in zip(row, col)) for col in b.T.tolist()] for row in a.tolist()], dtype=object)
        assert (hard_negatives.strassen(a, b, 8) == want).all()


def test_heaps_merge():
    r = np.random.default_rng(1)
    score, ids = r.integers(0, 6, 200), r.permutation(200)
    whole, parts = hard_negatives.Heaps(1, 7), hard_negatives.Heaps(1, 7)
    whole.merge(0, score, ids)
    for a in range(0, 200, 33):
        parts.merge(0, score[a:a + 33], ids[a:a + 33])
    best = sorted(zip((-score).tolist(), ids.tolist()))[:7]
    for h in (whole, parts):
        assert sorted(zip((-h.rows()[1]).tolist(), h.rows()[2].tolist())) == best and h.worst(0) == -best[-1][0]


@pytest.mark.parametrize("block", [None, 3])
def test_hard_negatives(spark, monkeypatch, block):
    """Ties, repeated rows and ids, one hot vector, unusable rows, clashing columns; anchors in one block or several."""
    if block:
        monkeypatch.setattr(hard_negatives, "BLOCK_BYTES", block * 8 * 20)
        monkeypatch.setattr(hard_negatives, "TILE", 50)
        monkeypatch.setattr(hard_negatives, "ANCHORS", 2)
    r = np.random.default_rng(3)
    x = np.round(r.normal(size=(900, 20)), 2)
    x[:, 0] += 2
    x[200:500] = x[7]
    rows = [(i, v.tolist(), int(r.integers(0, 10))) for i, v in enumerate(x)]
    rows += [rows[100], rows[100], rows[205], (300, rows[3][1], 4), (1000, None, 1), (1100, [float("nan")] * 20, 1), (1200, [1.0, None] * 10, 2),
             (1300, [1.0] * 20, None), (1400, [1.0] * 3, 2), (None, [1.0] * 20, 1), (1500, [float("inf")] * 20, 1), (1600, [0.0] * 20, 1)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int").repartition(3)
    wide = df.withColumn("rank", F.lit("x")).withColumn("score", F.lit(1)).withColumn("id", F.lit(5)).withColumn("v", F.lit(5))
    monkeypatch.setattr(queries, "_table", lambda *a: wide)
    got = same(queries.op13_hard_negatives(spark, ""), "op13_hard_negatives", embeddings=df.where("size(embedding) = 20 or embedding is null"))
    assert len(got) > 100
    monkeypatch.setattr(queries, "_table", lambda *a: df.where("false"))
    assert queries.op13_hard_negatives(spark, "").count() == 0
    monkeypatch.setattr(queries, "_table", lambda *a: spark.createDataFrame([(0, [1e300, 1.0], 1), (1, [1.0, 1.0], 1), (100, [1.0, 2.0], 1)], df.schema))
    assert queries.op13_hard_negatives(spark, "").count() == 0
