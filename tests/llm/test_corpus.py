"""Language ID, SimHash, decontamination, mixture, token files and the pipeline."""

import os
import random
import re
import tempfile
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tessera.llm import decontam, hyperlang, mixture, simhash_bits, token_orc

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, fp string, size int"
rng = random.Random(7)
EN = "the of and to in is that for it was on are with they at be this have from or".split()
DE = "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als".split()


def text(words, n, seed):
    r = random.Random(seed)
    return " ".join(r.choice(words) for _ in range(n))


@pytest.fixture(scope="module")
def docs(spark):
    """Copies, near copies, nulls, empties, one hot source, a long text, clashing columns."""
    rows, base = [], text(EN, 300, 1)
    for i in range(60):
        t = text(EN if i % 2 else DE, 40 + i, i)
        rows.append((i, t, "en" if i % 2 else "de", "hot" if i % 3 else f"s{i % 4}", len(t), "x", 1))
    rows += [(100 + i, base, "en", "hot", len(base), "x", 1) for i in range(20)]
    rows += [(200, base + " extra", "en", None, 1, None, None), (201, None, None, None, None, None, None),
             (202, "", "de", "s1", 0, None, 2), (203, "12 34 !", None, "s2", 7, None, 3),
             (204, text(DE, 9000, 5), "de", "s3", 1, None, 1), (None, "they are with the others in it", "en", "s1", 30, None, 1),
             (59, rows[59][1], rows[59][2], rows[59][3], rows[59][4], "x", 1)]
    return spark.createDataFrame(rows, DOCS).repartition(4)


def test_language(spark, docs):
    p = hyperlang.train(docs, F.col("lang"), F.lit(True))
    assert sorted(p) == ["de", "en"]
    got = {(r["doc_id"]): r for r in hyperlang.predict(docs, p, keep=["doc_id", "lang", "text"]).collect()}
    for r in got.values():
        assert 0 <= r["score"] <= 1
        if not r["text"] or not re.search("[a-z]", r["text"]):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
        elif r["lang"]:
            assert r["lang_pred"] == r["lang"]
    kept = hyperlang.keep_known(docs, p, 0.1)
    assert kept.columns == docs.columns and kept.count() == docs.count() - 3
    empty = docs.where("false")
    none = hyperlang.train(empty, F.col("lang"), F.lit(True))
    assert none == {} and hyperlang.predict(empty, none, keep=["doc_id"]).count() == 0
    assert {r[0] for r in hyperlang.predict(docs, none, keep=["doc_id"]).select("lang_pred").collect()} == {"und"}


def test_language_by_length(spark, docs):
    """Clean documents of one to three words stay; letters at random go at any length, scripts that were not learned too."""
    p, seen = hyperlang.learn(docs, F.col("lang"), F.lit(True))
    assert bytes(sorted(seen[seen < 128])).decode().isalpha() and ord("ü") in seen
    r = random.Random(8)
    short = [" ".join(r.choice(words) for _ in range(n)) for words in (EN, DE) for n in (1, 2, 3) for _ in range(40)]
    noise = [" ".join("".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randint(2, 9))) for _ in range(n))
             for n in (500, 500, 500, 500, 4000)]
    noise += ["".join(r.sample(text(EN, 800, 3), 2000)), "слово", "слово и дело " * 50, "12", None]
    test = hyperlang.known(p, corpus_pipeline.MIN_SCORE, seen)
    assert test(short).all() and test([x.upper() + "!" for x in short]).all() and not test(noise).any()
    assert [test([x])[0] for x in short[:5] + noise] == [True] * 5 + [False] * len(noise)
    both = spark.createDataFrame(list(enumerate(short + noise)), "doc_id bigint, text string")
    assert hyperlang.keep_known(both, p, corpus_pipeline.MIN_SCORE, seen=seen).count() == len(short)


def test_bundle_is_sum_of_bound_vectors():
    grams, counts = hyperlang.gram_counts(["Ab, ba", None, "12"], 3)
    v = hyperlang.bundle(grams, counts, 256, step=2)
    slow = np.zeros(256)
    s = " ab ba "
    for i in range(len(s) - 2):
        a, b, c = (hyperlang.letter_vector(ord(x), 256) for x in s[i:i + 3])
        slow += np.roll(a, 2) * np.roll(b, 1) * c
    assert np.array_equal(v[0], slow) and not v[1].any() and not v[2].any()


def test_bit_sliced_distances():
    r = np.random.default_rng(0)
    base = r.integers(0, 1 << 63, 40).astype(np.uint64)
    flips = np.array([np.bitwise_xor.reduce(np.uint64(1) << r.integers(0, 64, k).astype(np.uint64), initial=np.uint64(0))
                      for k in r.integers(0, 9, 300)], np.uint64)
    fps = np.concatenate([base, base[r.integers(0, 40, 300)] ^ flips])
    for radius in (0, 1, 3, 4, 7):
        dead = np.zeros((len(fps), -(-len(fps) // 64)), np.uint64)
        near = simhash_bits.within(simhash_bits.bit_planes(fps), fps, radius, dead)
        got = np.unpackbits(near.view(np.uint8), axis=1, bitorder="little")[:, :len(fps)].astype(bool)
        assert np.array_equal(got, np.bitwise_count(fps[:, None] ^ fps[None, :]) <= radius)


def classes(fps, radius=4):
    label = list(range(len(fps)))
    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(fps ^ fps[i]) <= radius):
            a, b = label[i], label[j]
            if a != b:
                label = [min(a, b) if x in (a, b) else x for x in label]
    return label


@pytest.mark.parametrize("chunk", [4096, 16])
def test_links_of_hot_buckets(spark, monkeypatch, chunk):
    """A dense cluster of different fingerprints, with buckets split in chunks."""
    monkeypatch.setattr(simhash_bits, "CHUNK", chunk)
    r = np.random.default_rng(1)
    centre = r.integers(0, 1 << 63, 6).astype(np.uint64)
    fps = np.unique([centre[r.integers(0, 6)] ^ np.bitwise_xor.reduce(np.uint64(1) << r.integers(0, 64, 3).astype(np.uint64))
                     for _ in range(250)])
    nodes = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp bigint")
    links = simhash_bits.fingerprint_links(nodes).collect()
    index = {int(x): i for i, x in enumerate(fps.view(np.int64))}
    label = list(range(len(fps)))
    for a, b in ((index[u], index[v]) for u, v in links):
        assert np.bitwise_count(fps[a] ^ fps[b]) <= 4
        x, y = label[a], label[b]
        label = [min(x, y) if z in (x, y) else z for z in label]
    assert label == classes(fps)


def test_simhash_classes(spark, docs):
    got = simhash_bits.simhash_classes(docs).collect()
    assert len(got) == docs.count()
    by = {r["id"]: r for r in got}
    assert {by[100 + i]["component_id"] for i in range(20)} == {100}
    assert by[201]["fp"] == by[202]["fp"] == 0 and by[202]["component_id"] == 201
    assert by[200]["component_id"] in (100, 200) and by[None]["component_id"] is None
    kept = simhash_bits.keep_one(docs)
    ids = sorted(-1 if r[0] is None else r[0] for r in kept.select("doc_id").collect())
    firsts = {r["component_id"] for r in got}
    assert kept.columns == docs.columns and len(ids) == len(set(ids)) == len(firsts)
    assert simhash_bits.simhash_classes(docs.where("false")).count() == 0
    assert simhash_bits.keep_one(docs.where("false")).count() == 0


def test_alignment():
    def slow(a, b):
        h = np.zeros((len(a) + 1, len(b) + 1), int)
        for i in range(len(a)):
            for j in range(len(b)):
                h[i + 1, j + 1] = max(0, h[i, j] + (2 if a[i] == b[j] else -1), h[i, j + 1] - 1, h[i + 1, j] - 1)
        return h.max()

    r = np.random.default_rng(2)
    for _ in range(60):
        a, b = r.integers(1, 6, r.integers(1, 20)), r.integers(1, 6, r.integers(1, 30))
        assert decontam.align(a, b)[0] == slow(a, b)


def test_decontamination(spark):
    names = [f"w{i}" for i in range(3000)]
    item = text(names, 40, 11)
    words = item.split()
    edited = words.copy()
    for k in (7, 18, 33):
        edited[k] = "changed"
    del edited[25]
    fill = [text(names, 200, 100 + i) for i in range(20)]
    rows = [(i, t) for i, t in enumerate(fill)] + [
        (100, fill[0] + " " + item.upper() + " " + fill[1]), (101, fill[2] + "\n" + " ".join(edited) + " " + fill[3]),
        (102, fill[4] + " " + " ".join(words[:8]) + " " + fill[5]), (103, None), (104, ""), (100, item)]
    rows += [(1000 + i, item + " " + fill[6]) for i in range(30)]  # a hot passage has no rare n-gram
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    bench = spark.createDataFrame([(1, item), (2, "too short"), (3, None), (4, text(names, 30, 999))], "item_id bigint, text string")
    got = decontam.contaminated(docs, bench).collect()
    assert sorted({r["doc_id"] for r in got}) == [100, 101, *range(1000, 1030)] and {r["item_id"] for r in got} == {1}
    assert {r["score"] for r in got if r["doc_id"] != 101} == {1.0} and len(got) == 33
    left = decontam.clean(docs, bench)
    assert {r[0] for r in left.select("doc_id").collect()} == {*range(20), 102, 103, 104}
    assert decontam.contaminated(docs, bench.where("false")).count() == 0
    assert decontam.contaminated(docs.where("false"), bench).count() == 0
    # items in several blocks give the same
    old, decontam.BLOCK_WORDS = decontam.BLOCK_WORDS, 10
    try:
        assert sorted(decontam.contaminated(docs, bench).collect()) == sorted(got)
    finally:
        decontam.BLOCK_WORDS = old


def test_decontamination_passages(spark):
    """Passages of long items, items in scripts without spaces, items shorter than a seed."""
    names = [f"w{i}" for i in range(3000)]
    words = text(names, 250, 21).split()
    fill = [text(names, 200, 300 + i) for i in range(12)]
    edited = words[100:145]
    for k in (9, 27):
        edited[k] = "changed"
    scattered = " ".join(x for i in range(0, 250, 8) for x in [*words[i:i + 5], *fill[6].split()[i % 150:i % 150 + 9]])
    han, thai = "床前明月光疑是地上霜舉頭望明月低頭思故鄉", "กาลครั้งหนึ่งนานมาแล้วมีชายคนหนึ่ง"
    rows = [(i, t) for i, t in enumerate(fill)] + [
        (100, " ".join([fill[0], *words[60:160], fill[1]])), (101, " ".join([fill[2], *edited, fill[3]])),
        (102, " ".join([fill[4], *words[:25], fill[5]])), (103, scattered), (104, f"詩曰{han}也"), (105, f"ว่า{thai}อยู่"),
        (106, "床前有月光"), (107, "He said: 'Forty-two  DAYS', then left"), (108, "forty days and two"), (109, "這是答案。")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    bench = spark.createDataFrame([(1, " ".join(words)), (2, han), (3, thai), (4, "forty two days"), (5, "答案"), (6, "!?"), (7, "")],
                                  "item_id bigint, text string")
    got = decontam.contaminated(docs, bench).collect()
    assert sorted((r["doc_id"], r["item_id"]) for r in got) == [(100, 1), (101, 1), (104, 2), (105, 3), (107, 4), (109, 5)]
    assert [r["score"] for r in got if r["doc_id"] in (104, 105, 107, 109)] == [1.0] * 4
    assert {r[0] for r in decontam.clean(docs, bench).select("doc_id").collect()} == {*range(12), 102, 103, 106, 108}


def test_splitting_tree():
    tree = mixture.Tree([50, 7, 0, 120], 13, seed=3)
    quotas = np.array([tree.quotas(s) for s in range(13)])
    assert quotas.sum(axis=0).tolist() == [50, 7, 0, 120] and set(quotas.sum(axis=1)) <= {13, 14}
    for source, n in enumerate((50, 7, 0, 120)):
        shard = tree.shards_of(np.full(n, source), np.arange(n))
        assert np.bincount(shard, minlength=13).tolist() == quotas[:, source].tolist()
        assert (np.diff(shard) >= 0).all()  # a shard's quota is a range of the draws


def test_splitting_tree_beyond_numpy(monkeypatch):
    """More draws than numpy takes at once, and small parts, keep the quotas; one part draws as before."""
    draws = [2_000_000_000, 7, 1_500_000_001]
    quotas = np.array([mixture.Tree(draws, 5, seed=3).quotas(s) for s in range(5)])
    assert quotas.sum(axis=0).tolist() == draws and (quotas >= 0).all() and np.ptp(quotas.sum(axis=1)) <= 1
    one = mixture.Tree([50, 7, 0, 120], 13, seed=3)
    assert one.quotas(0) != one.draws and one._split(0, 13, one.draws) == tuple(
        np.random.default_rng([3, 0, 13]).multivariate_hypergeometric(one.draws, 177 * 6 // 13, method="marginals").tolist())
    monkeypatch.setattr(mixture, "PART", 10)
    quotas = np.array([mixture.Tree([50, 7, 0, 120], 13, seed=3).quotas(s) for s in range(13)])
    assert quotas.sum(axis=0).tolist() == [50, 7, 0, 120] and set(quotas.sum(axis=1)) <= {13, 14} and (quotas >= 0).all()


def test_targets():
    sizes = {"a": 10, "b": 100, None: 1000, "c": 50}
    t = mixture.targets(sizes)
    assert sum(t.values()) == pytest.approx(1.5 * 1160) and t["a"] == 20 and t["b"] == 200
    assert all(t[s] <= 2 * sizes[s] for s in sizes) and mixture.targets({}) == {}


def test_mixture(spark, docs):
    got = mixture.taken(docs, block_words=64, shard_words=700).collect()
    assert len(got) == docs.count() and got == mixture.taken(docs, block_words=64, shard_words=700).collect()
    by = {}
    for r, s in zip(got, (x["source"] for x in docs.select("doc_id", "source").collect())):
        assert 0 <= r["taken"] <= 2 * r["size"]
    source = {r[0]: r[1] for r in docs.select("doc_id", "source").collect()}
    for r in got:
        b = by.setdefault(source[r["doc_id"]], [0, r["target"], r["source_size"], 0])
        b[0] += r["taken"]
        b[3] += r["size"]
    for total, target, source_size, size in by.values():
        assert total == int(target) and size == source_size
    out = mixture.mixed_documents(docs, block_words=64, shard_words=700)
    assert out.columns == docs.columns
    n = sum(len(re.findall(mixture.WORD, r["text"])) for r in out.collect())
    assert n == sum(r["taken"] for r in got)
    assert mixture.taken(docs.where("false")).count() == 0
    assert mixture.mixed_documents(docs.where("false")).count() == 0


def test_tokens(spark, docs):
    out = os.path.join(tempfile.mkdtemp(), "tokens")
    got = token_orc.encode_documents(docs, corpus_pipeline.TOKENIZER, out, stride=1000, stripe_bytes=1 << 16).collect()
    t = token_orc.load_tokenizer(corpus_pipeline.TOKENIZER)
    start = 0
    rows = {}
    for r in docs.collect():
        rows.setdefault(r["doc_id"], []).append([*t.encode(r["text"] or "", add_special_tokens=False).ids, 0])
    for r in sorted(got, key=lambda r: r["start"]):
        ids = rows[r["doc_id"]][0]
        assert (r["start"], r["n_tokens"]) == (start, len(ids))
        assert r["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
    assert [r["doc_id"] for r in sorted(got, key=lambda r: r["start"])][0] is None and len(got) == docs.count()
    one = token_orc.read_tokens(spark, out, [204])
    assert one.count() == 1 and "PushedFilters: [In(doc_id, [204])" in one._jdf.queryExecution().toString() \
        or "EqualTo(doc_id,204)" in one._jdf.queryExecution().toString()
    from pyarrow import orc
    files = [os.path.join(out, f) for f in os.listdir(out) if f.endswith(".orc")]
    assert sum(orc.ORCFile(f).nrows for f in files) == docs.count()
    assert token_orc.encode_documents(docs.where("false"), corpus_pipeline.TOKENIZER).count() == 0


def test_encode_is_exact():
    t = token_orc.load_tokenizer(corpus_pipeline.TOKENIZER)
    alphabet = [*"aAéß \n\t'.,!#-09²Ⅷ\xa0　漢я😀\x1c\x85\r\x00", "word", " the", "don't", "<|endoftext|>", "  "]
    texts = [None, "", *("".join(rng.choice(alphabet) for _ in range(rng.randint(0, 12))) for _ in range(3000))]
    counts, flat = token_orc.encode(corpus_pipeline.TOKENIZER, pa.array(texts, pa.string()), 0)
    at = 0
    for s, n in zip(texts, counts):
        assert flat[at:at + n].tolist() == [*t.encode(s or "", add_special_tokens=False).ids, 0], repr(s)
        at += n


def test_pipeline_stages(spark, docs, tmp_path):
    sf = str(tmp_path)
    docs.write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([(1, docs.where("doc_id = 100").first()["text"])], "item_id bigint, text string") \
        .write.parquet(f"{sf}/benchmark.parquet")
    d = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        d = spark.createDataFrame(stage(spark, d, sf).collect(), DOCS)
        assert d.columns == docs.columns, name
    assert not d.where("doc_id between 100 and 119").count()
    got = corpus_pipeline.run(spark, sf)
    assert got.count() == d.count()
    empty = docs.where("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, sf).count() == 0
