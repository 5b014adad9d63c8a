"""One registered query per operator, over whole tables, and their SQL twins."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (blockdist, collision_ann, crc_resample, decontam, hard_negatives, hyperlang, minmax_dedup, mixture,
               pii_vote, simhash_bits, token_orc, url_rules, warc)

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_orc.encode_documents(_table(spark, sf_dir, "documents"), TOKENIZER)


def op2_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    out = url_rules.judge(pages, url_rules.page_edges(pages))
    return out.withColumnRenamed("id", "page_id")


def op3_collision_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collision_ann.search(_table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0, k=20)


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op5_hyperlang(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    profiles = hyperlang.train(docs, F.col("lang"), ~hyperlang.held_out())
    out = hyperlang.predict(docs, profiles, keep=["doc_id"])
    return out.select("doc_id", hyperlang.held_out().alias("held_out"), "lang_pred", "score")


def op6_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture.taken(_table(spark, sf_dir, "documents"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(_table(spark, sf_dir, "pages"))


def op8_blockdist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blockdist.extract(_table(spark, sf_dir, "pages"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash_bits.simhash_classes(_table(spark, sf_dir, "documents"), words=4, max_bits=4)
    return out.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                      "component_id")


def op10_pii_vote(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_vote.find_spans(_table(spark, sf_dir, "documents"))


def op11_crc_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crc_resample.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op12_minmax_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = minmax_dedup.minmax_classes(_table(spark, sf_dir, "documents"), words=2, percent=80)
    return out.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), "component_id",
                      F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(_table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, label)


QUERIES = {f.__name__: f for f in (
    op1_token_orc, op2_url_rules, op3_collision_ann, op4_decontamination, op5_hyperlang, op6_mixture,
    op7_warc, op8_blockdist, op9_simhash, op10_pii_vote, op11_crc_resample, op12_minmax_dedup, op13_hard_negatives)}

_RULE_CASES = " ".join(
    f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{{0}}'".replace("{0}", v)
    for h, p, v in sorted(url_rules.RULES, key=lambda r: (-len(r[0] + r[1]), r)))
_NAME_CASES = " ".join(
    f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{h}{p}'"
    for h, p, _ in sorted(url_rules.RULES, key=lambda r: (-len(r[0] + r[1]), r)))
_SPLIT = r"""CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) END"""
_HOST = (r"""coalesce(translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '')""")

SQL: dict[str, str] = {
    # aliases by a recursive walk over canonical links and refresh redirects
    "op2_url_rules": rf"""
WITH RECURSIVE tag AS (
  SELECT url, unnest(regexp_extract_all(html, '(?is)<link\b[^>]*>')) AS x, true AS is_link FROM pages
  UNION ALL
  SELECT url, unnest(regexp_extract_all(html, '(?is)<meta\b[^>]*>')), false FROM pages),
found AS (SELECT url AS s, replace(CASE WHEN is_link THEN regexp_extract(x, '(?is)\bhref\s*=\s*["'']?\s*([^"''\s>]+)', 1)
          ELSE regexp_extract(x, '(?is)\burl\s*=\s*["'']?\s*([^"''\s>]+)', 1) END, '&amp;', '&') AS t FROM tag
          WHERE CASE WHEN is_link THEN regexp_matches(x, '(?is)\brel\s*=\s*["'']?canonical\b')
                ELSE regexp_matches(x, '(?is)\bhttp-equiv\s*=\s*["'']?refresh\b') END),
base AS (SELECT s, t, regexp_extract(s, '(?s)^([^:]*://[^/?#]*)', 1) AS site, regexp_extract(s, '^([^:]*:)', 1) AS scheme,
         regexp_extract(s, '(?s)^([^:]*://[^/?#]*(?:/[^?#]*/|/)?)', 1) AS folder FROM found WHERE t <> '' AND s IS NOT NULL),
edge AS (SELECT s, CASE WHEN contains(t, '://') THEN t WHEN starts_with(t, '//') THEN scheme || t
         WHEN starts_with(t, '/') THEN site || t WHEN ends_with(folder, '/') THEN folder || t ELSE folder || '/' || t END AS t FROM base),
urls AS (SELECT coalesce(url, '') AS url FROM pages UNION SELECT s FROM edge UNION SELECT t FROM edge),
parts AS (SELECT url, {_SPLIT} AS rest FROM urls),
split AS (SELECT url, {_HOST} AS host, coalesce(regexp_extract(rest, '(?s)^[^/?#]*([^?#]*)', 1), '') AS path,
          regexp_extract(rest, '(?s)^[^?#]*(\?[^#]*)?', 1) AS query FROM parts),
ruled AS (SELECT *, CASE WHEN position('://' IN url) > 0 THEN host || path || query END AS key,
          CASE {_NAME_CASES} END AS rule, CASE {_RULE_CASES} END AS own FROM split),
link AS (SELECT a.key AS u, b.key AS v FROM edge JOIN ruled a ON a.url = s JOIN ruled b ON b.url = t
         UNION SELECT b.key, a.key FROM edge JOIN ruled a ON a.url = s JOIN ruled b ON b.url = t),
reach AS (SELECT u AS node, u AS other FROM link UNION SELECT node, v FROM reach JOIN link ON other = u),
alias AS (SELECT node, min(own) AS alias_verdict FROM reach JOIN ruled ON key = other GROUP BY node)
SELECT page_id, host, path, rule, coalesce(own, alias_verdict, 'allow') AS verdict
FROM (SELECT page_id, coalesce(url, '') AS url FROM pages) p
JOIN ruled USING (url) LEFT JOIN alias ON node = key""",
    "op6_mixture": rf"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^ 	-
]+')) AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS ssize,
      [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS w FROM d GROUP BY source),
r AS (SELECT *, row_number() OVER o AS i, lead(2.0 * ssize / w, 1, 'infinity'::DOUBLE) OVER o AS next,
      sum(2 * ssize) OVER o AS capped, sum(w) OVER (ORDER BY 2.0 * ssize / w DESC, source DESC) - w AS free,
      sum(ssize) OVER () AS total FROM s WINDOW o AS (ORDER BY 2.0 * ssize / w, source)),
level AS (SELECT arg_min(each, i) AS each FROM (
  SELECT 1.5 * max(total) / sum(w) AS each, 0 AS i, min(2.0 * ssize / w) AS next FROM r
  UNION ALL SELECT (1.5 * total - capped) / free, i, next FROM r WHERE free > 0) WHERE each <= next),
t AS (SELECT source, ssize, least(w * each, 2.0 * ssize) AS target FROM s, level),
p AS (SELECT *, floor(target)::BIGINT AS words, (ssize + 4095) // 4096 - 1 AS whole_blocks FROM t),
q AS (SELECT *, words // greatest(ssize, 1) AS passes, words - words // greatest(ssize, 1) * ssize AS rest FROM p),
placed AS (SELECT doc_id, source, size, (sum(size) OVER (PARTITION BY source ORDER BY md5(doc_id::VARCHAR), doc_id, size
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size)::BIGINT AS start FROM d),
piece AS (SELECT doc_id, size, start, ssize, target, passes, rest, whole_blocks,
          unnest(CASE WHEN size > 0 THEN generate_series(start // 4096, (start + size - 1) // 4096) END) AS blk
          FROM placed JOIN q ON placed.source IS NOT DISTINCT FROM q.source),
ranked AS (SELECT *, CASE WHEN blk = whole_blocks THEN blk
         ELSE blk * (2147483647 % greatest(whole_blocks, 1)) % greatest(whole_blocks, 1) END AS k,
         greatest(blk * 4096, start) AS low, least((blk + 1) * 4096, start + size) AS high FROM piece),
got AS (SELECT doc_id, sum(passes * (high - low) + CASE WHEN k < rest // 4096 THEN high - low
        WHEN k = rest // 4096 THEN greatest(0, least(high, blk * 4096 + rest % 4096) - low) ELSE 0 END) AS taken
        FROM ranked GROUP BY doc_id)
SELECT placed.doc_id, placed.size::BIGINT AS size, ssize AS source_size, target, coalesce(taken, 0)::BIGINT AS taken
FROM placed JOIN q ON placed.source IS NOT DISTINCT FROM q.source LEFT JOIN got ON got.doc_id = placed.doc_id""",
    # of rows with equal ids and payloads, those of the first url are the response's capture
    "op7_warc": """
WITH p AS (SELECT page_id, url, coalesce(html, '') AS html FROM pages),
h AS (SELECT page_id, url, octet_length(encode(html))::BIGINT AS payload_bytes, sha256(html) AS payload_digest FROM p),
f AS (SELECT *, first_value(page_id) OVER w AS first, first_value(url) OVER w AS first_url FROM h
      WINDOW w AS (PARTITION BY payload_digest ORDER BY page_id NULLS LAST, url NULLS FIRST)),
r AS (SELECT *, payload_bytes >= 100 AND (page_id IS DISTINCT FROM first OR url IS DISTINCT FROM first_url) AS again FROM f)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN again THEN first END AS refers_to
FROM r""",
    # CRC-32 byte by byte, over a table made in SQL, once a distinct word
    "op11_crc_resample": r"""
WITH crc_table AS (SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)),
       lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS t),
d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
dw AS (SELECT r, unnest(w) AS w FROM d), bw AS (SELECT unnest(w) AS w FROM b),
word AS (SELECT w, list_transform(range(octet_length(encode(w))), lambda i: ('0x' || substr(hex(encode(w)), 2 * i + 1, 2))::BIGINT) AS bytes
         FROM (SELECT w FROM dw UNION SELECT w FROM bw)),
code AS (SELECT w, xor(list_reduce(list_prepend(4294967295, bytes), lambda c, x: xor(c // 256, t[xor(c, x) % 256 + 1])), 4294967295)
         % 10000 AS bucket FROM word, crc_table),
s AS (SELECT bucket, count(*) AS n FROM dw JOIN code USING (w) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM bw JOIN code USING (w) GROUP BY bucket),
gain AS (SELECT s.bucket, floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM s) + 10000)::DOUBLE
         / ((s.n + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM t) + 10000)::DOUBLE)))::BIGINT AS g FROM s LEFT JOIN t USING (bucket)),
weighed AS (SELECT r, sum(g)::BIGINT AS weight FROM dw JOIN code USING (w) JOIN gain USING (bucket) GROUP BY r),
scored AS (SELECT d.r, doc_id, len(w)::BIGINT AS n_features, coalesce(weight, 0) AS weight,
           ('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT AS h FROM d LEFT JOIN weighed USING (r)),
final AS (SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5) / 4294967296)))::BIGINT AS score FROM scored),
placed AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, n_features, weight) AS rank,
           floor(10 * count(*) OVER () / 100) AS k FROM final WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= k THEN rank END::BIGINT AS rank, n_features AS n_words
FROM final LEFT JOIN placed USING (r)""",
    # similarity of all pairs of different sets with a common shingle
    "op12_minmax_dedup": r"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
x AS (SELECT r, doc_id, CASE WHEN len(w) < 2 THEN w ELSE list_sort(list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) END AS s
      FROM d),
node AS (SELECT s, min(r) AS n, len(s) AS size FROM x WHERE len(s) > 0 GROUP BY s),
post AS (SELECT n, size, unnest(s) AS g FROM node),
link AS (SELECT a.n AS u, b.n AS v FROM post a JOIN post b ON a.g = b.g AND a.n <> b.n
         WHERE 100 * least(a.size, b.size) >= 80 * greatest(a.size, b.size)
         GROUP BY a.n, b.n, a.size, b.size HAVING 100 * count(*) >= 80 * (a.size + b.size - count(*))),
reach AS (SELECT n AS u, n AS v FROM node UNION SELECT reach.u, link.v FROM reach JOIN link ON reach.v = link.u),
low AS (SELECT n, min(doc_id) AS low FROM x JOIN node USING (s) GROUP BY n),
comp AS (SELECT u AS n, min(low) AS component_id FROM reach JOIN low ON low.n = reach.v GROUP BY u)
SELECT doc_id, len(x.s)::BIGINT AS n_shingles, CASE WHEN len(x.s) > 0 THEN component_id ELSE doc_id END AS component_id,
       doc_id IS NOT DISTINCT FROM CASE WHEN len(x.s) > 0 THEN component_id ELSE doc_id END AS kept
FROM x LEFT JOIN (SELECT s, component_id FROM node JOIN comp USING (n)) USING (s)""",
    "op13_hard_negatives": """
WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::DOUBLE) AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pair AS (SELECT a.vec_id AS anchor, b.vec_id AS id, a.label = b.label AS same, list_dot_product(a.v, b.v)::BIGINT AS score
         FROM (SELECT vec_id, min(label) AS label, min(v) AS v FROM e WHERE vec_id % 100 = 0 GROUP BY vec_id) a JOIN e b ON a.vec_id <> b.vec_id),
positive AS (SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY score DESC, id) AS p FROM pair WHERE same QUALIFY p <= 5),
found AS (SELECT p.anchor, p.id AS positive, p.score AS ps, p.p, n.id AS negative, n.score AS ns,
          row_number() OVER (PARTITION BY p.anchor, p.p ORDER BY n.score DESC, n.id) AS rank
          FROM positive p JOIN pair n ON n.anchor = p.anchor AND NOT n.same AND 100 * n.score BETWEEN 80 * p.score AND 100 * p.score
          QUALIFY rank <= 5)
SELECT anchor AS anchor_id, positive AS positive_id, rank::INT AS rank, negative AS negative_id, ps AS positive_score,
       ns AS negative_score, p::INT AS positive_rank FROM found""",
}
