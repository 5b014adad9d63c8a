"""WARC archives: writing captures, reading records, assembling transactions.

A capture is three records: a request, a response (or a revisit of an earlier
response with the same payload) and a metadata record; request and metadata name
the response's record in WARC-Concurrent-To. Archives are plain WARC/1.1 files
that Spark's own writer puts in the shared folder: one record a row, and the two
line ends that close a record are the writer's row separator.

Reading takes whole files of bounded size, cuts records by Content-Length inside
tasks, and joins the records of a transaction by their concurrent-to identifiers
into one nested row. Payloads stay out of the joins unless asked for.
"""

from __future__ import annotations

import gzip
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut_lineage, lookup_spread, prepare_python, stored, work_path

END = "\r\n\r\n"
CAPTURES = ("response", "revisit", "resource")
MIN_REVISIT = 100
FILE_BYTES = 64 << 20
COPIES = 10_000
CLASSES = (64 << 10, 1 << 20, 16 << 20)
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
RECORD = ("record_id string, type string, concurrent_to array<string>, refers_to string, target_uri string, "
          "payload_bytes bigint, payload_digest string, stated_digest string, fields map<string,string>")


def _record(kind: str, record_id: Column, headers: list[Column], block: Column) -> Column:
    """The text of a record without its closing line ends."""
    line = lambda name, value: F.when(value.isNotNull(), F.concat(F.lit(name + ": "), value, F.lit("\r\n"))).otherwise("")
    parts = [F.lit(f"WARC/1.1\r\nWARC-Type: {kind}\r\nWARC-Date: {DATE}\r\n"), line("WARC-Record-ID", record_id)]
    parts += [line(n, v) for n, v in headers]
    parts += [F.lit("Content-Length: "), F.octet_length(block).cast("string"), F.lit("\r\n\r\n"), block]
    return F.concat(*parts)


def write_captures(pages: DataFrame, out: str, id_col: str = "page_id", url_col: str = "url",
                   html_col: str = "html", min_revisit: int = MIN_REVISIT,
                   codec: str = "gzip") -> None:
    """Archive the rows of ``pages``. Of equal payloads of ``min_revisit`` bytes or
    more, that with the smallest id (null last) is a response and the others are
    revisits. Null html is an empty payload; a null url has no target line; line
    ends in a url are percent-encoded. A record's id is made of the page's id and
    a hash of its row, so rows equal in id, url and html are one capture, whose
    metadata says how many rows it stands for (copies, if more than one).
    ``codec`` is that of whole files: gzip or none."""
    url = F.regexp_replace(F.regexp_replace(F.col(f"`{url_col}`").cast("string"), "\r", "%0D"), "\n", "%0A")
    rows = pages.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), url.alias("url"),
                        F.coalesce(F.col(f"`{html_col}`").cast("string"), F.lit("")).alias("html"))
    name = F.concat_ws(":", F.coalesce(F.col("id").cast("string"), F.lit("none")), F.hex(F.xxhash64("url", "html")))
    rows = rows.withColumn("n", F.octet_length("html")).withColumn("name", name) \
        .withColumn("digest", F.sha2(F.col("html").cast("binary"), 256))
    keys = stored(rows.select("id", "n", "name", "digest"), "warc-keys")
    order = F.struct(F.col("id").isNull().alias("none"), "id", "name")
    # repeated payloads only; the sum before the shuffle takes a hot payload apart
    first = cut_lineage(keys.where(F.col("n") >= min_revisit).groupBy("digest")
                        .agg(F.min(order).alias("f"), F.count("*").alias("c")).where("c > 1")
                        .select("digest", F.col("f.name").alias("first")))
    repeated = cut_lineage(keys.groupBy("name").agg(F.count("*").alias("copies")).where("copies > 1"))
    marked = rows
    for table, key in ((first, "digest"), (repeated, "name")):
        # about 150 bytes a row
        marked = marked.join(F.broadcast(table), key, "left") if table.count() <= 200_000 else lookup_spread(marked, table, key)
    uri = lambda kind, i: F.concat(F.lit(f"<urn:capture:{kind}:"), i, F.lit(">"))
    main, target = uri("response", F.col("name")), F.col("url")
    host = F.regexp_extract(F.coalesce("url", F.lit("")), r"^[^:]*://([^/?#]*)", 1)
    path = F.regexp_extract(F.coalesce("url", F.lit("")), r"^[^:]*://[^/?#]*([^#]*)", 1)
    is_revisit = F.coalesce(F.col("first") != F.col("name"), F.lit(False))
    stated = F.concat(F.lit("sha256:"), F.col("digest"))
    http = F.lit("application/http; msgtype=response")
    request = _record("request", uri("request", F.col("name")), [
        ("WARC-Target-URI", target), ("WARC-Concurrent-To", main), ("Content-Type", F.lit("application/http; msgtype=request"))],
        F.concat(F.lit("GET "), F.when(path == "", "/").otherwise(path), F.lit(" HTTP/1.1\r\nHost: "), host, F.lit("\r\n\r\n")))
    response = _record("response", main, [("WARC-Target-URI", target), ("WARC-Payload-Digest", stated), ("Content-Type", http)],
                       F.concat(F.lit(HTTP), F.col("html")))
    revisit = _record("revisit", main, [
        ("WARC-Target-URI", target), ("WARC-Payload-Digest", stated), ("WARC-Refers-To", uri("response", F.col("first"))),
        ("WARC-Profile", F.lit(PROFILE)), ("Content-Type", http)], F.lit(HTTP))
    metadata = _record("metadata", uri("metadata", F.col("name")), [
        ("WARC-Target-URI", target), ("WARC-Concurrent-To", main), ("Content-Type", F.lit("application/warc-fields"))],
        F.concat(*[F.coalesce(F.concat(F.lit(f"{k}: "), F.col(c).cast("string"), F.lit("\r\n")), F.lit(""))
                   for k, c in (("page_id", "id"), ("copies", "copies"))]))
    records = marked.select("n", F.explode(F.array(
        request, F.when(is_revisit, revisit).otherwise(response), metadata)).alias("value"))
    # a reader takes a file at a time, so files are bounded: payloads by size class,
    # and so many captures a file that it stays under FILE_BYTES (one larger payload: alone)
    largest = keys.agg(F.max("n")).first()[0]
    low = -1
    for high in (*CLASSES, None):
        if largest is not None and largest > low:
            part = records.where((F.col("n") > low) & (F.col("n") <= high if high else F.lit(True)))
            part.select("value").write.mode("append").option("lineSep", END) \
                .option("maxRecordsPerFile", 3 * max(1, FILE_BYTES // high if high else 1)) \
                .option("compression", codec).text(out)
        low = high
    if largest is None:
        records.select("value").write.text(out)


def parse_records(raw: bytes) -> Iterator[tuple[dict[str, list[str]], memoryview]]:
    """``(headers, block)`` of each record of an archive, plain or gzip; names in lower case."""
    if raw[:2] == b"\x1f\x8b":
        raw = gzip.decompress(raw)
    at, data = 0, memoryview(raw)
    while at < len(raw):
        stop = raw.index(b"\r\n\r\n", at)
        headers: dict[str, list[str]] = {}
        for line in raw[at:stop].decode("utf-8", "replace").split("\r\n")[1:]:
            name, _, value = line.partition(":")
            headers.setdefault(name.strip().lower(), []).append(value.strip())
        begin = stop + 4
        end = begin + int(headers["content-length"][0])
        yield headers, data[begin:end]
        at = end + 4


def read_records(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """One row per record; with ``payloads``, the payload too. The payload of an
    http block is what follows its header; its size is measured, and its SHA-256
    where the record is a capture."""
    prepare_python(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                rows = []
                for h, block in parse_records(b.column("content")[i].as_py()):
                    one = lambda name: h.get(name, [None])[0]
                    kind, body = one("content-type") or "", block
                    if kind.startswith("application/http"):
                        raw = bytes(block)
                        body = block[raw.index(b"\r\n\r\n") + 4:]
                    fields = {}
                    if kind.startswith("application/warc-fields"):
                        fields = dict((x.strip() for x in line.split(":", 1))
                                      for line in bytes(block).decode("utf-8", "replace").split("\r\n") if ":" in line)
                    row = {"record_id": one("warc-record-id"), "type": one("warc-type"),
                           "concurrent_to": h.get("warc-concurrent-to", []), "refers_to": one("warc-refers-to"),
                           "target_uri": one("warc-target-uri"), "payload_bytes": len(body),
                           "payload_digest": hashlib.sha256(body).hexdigest() if one("warc-type") in CAPTURES else None,
                           "stated_digest": one("warc-payload-digest"), "fields": list(fields.items())}
                    rows.append(row | ({"payload": bytes(body)} if payloads else {}))
                for k in range(0, len(rows), 512):
                    yield pa.RecordBatch.from_pylist(rows[k:k + 512], schema=arrow)

    arrow = pa.schema([("record_id", pa.string()), ("type", pa.string()), ("concurrent_to", pa.list_(pa.string())),
                       ("refers_to", pa.string()), ("target_uri", pa.string()), ("payload_bytes", pa.int64()),
                       ("payload_digest", pa.string()), ("stated_digest", pa.string()),
                       ("fields", pa.map_(pa.string(), pa.string())), *([("payload", pa.binary())] if payloads else [])])
    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(run, RECORD + (", payload binary" if payloads else ""))


def transactions(records: DataFrame) -> DataFrame:
    """One nested row per capture: ``(capture_id, target_uri, response, request,
    metadata)``. A capture is a response, revisit or resource record; other
    records belong to it if either names the other in WARC-Concurrent-To, or
    through the request that does. Records that reach no capture are left out;
    of repeated record ids one is kept."""
    r = stored(records.dropDuplicates(["record_id"]), "warc-records")
    main = r.where(F.col("type").isin(*CAPTURES))
    rest = r.where(~F.col("type").isin(*CAPTURES))
    link = r.select(F.col("record_id").alias("a"), F.explode("concurrent_to").alias("b"))
    both = stored(link.unionByName(link.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "warc-links")
    captures = main.select(F.col("record_id").alias("b"), F.col("record_id").alias("capture_id"))
    near = both.join(captures, "b").select("a", "capture_id")
    seen = stored(near.groupBy("a").agg(F.min("capture_id").alias("capture_id")), "warc-members")
    # a metadata record may name the request only
    far = (both.join(seen.select("a"), "a", "left_anti")
           .join(seen.select(F.col("a").alias("b"), "capture_id"), "b").groupBy("a").agg(F.min("capture_id").alias("capture_id")))
    member = seen.unionByName(far)
    struct = F.struct(*[c for c in r.columns])
    parts = rest.select(F.col("record_id").alias("a"), F.col("type").alias("kind"), struct.alias("rec")).join(member, "a")
    grouped = parts.groupBy("capture_id").agg(
        F.min_by(F.when(F.col("kind") == "request", F.col("rec")), F.when(F.col("kind") == "request", F.col("a"))).alias("request"),
        F.sort_array(F.collect_list(F.when(F.col("kind") == "metadata", F.struct("a", F.map_entries("rec.fields").alias("fields"))))).alias("metadata"))
    return (main.select(F.col("record_id").alias("capture_id"), "target_uri", struct.alias("response"))
            .join(grouped, "capture_id", "left"))


def archive_pages(pages: DataFrame, out: str | None = None) -> DataFrame:
    """Write ``pages`` to archives (default: a fresh path in the shared folder),
    read them back, and return per row ``(page_id, payload_bytes, payload_digest,
    record_type, refers_to)``. A revisit's payload is that of the response it
    refers to. Rows equal in id, url and html are one capture, so they have equal
    results, one each."""
    spark = pages.sparkSession
    out = out or work_path(spark, "warc")
    write_captures(pages, out)
    t = transactions(read_records(spark, out))
    field = lambda k: F.get(F.filter(F.flatten(F.transform("metadata", lambda m: m["fields"])), lambda e: e["key"] == k), F.lit(0))["value"].cast("bigint")
    flat = stored(t.select("capture_id", field("page_id").alias("page_id"), field("copies").alias("copies"), F.col("response.type").alias("record_type"),
                                F.col("response.payload_bytes").alias("n"), F.col("response.payload_digest").alias("d"),
                                F.col("response.refers_to").alias("ref")), "warc-captures")
    referred = flat.where("record_type = 'revisit'").select(F.col("ref").alias("used")).distinct()
    heads = cut_lineage(flat.where("record_type = 'response'").join(referred, F.col("capture_id") == F.col("used"), "left_semi")
                        .select(F.col("capture_id").alias("ref"), F.col("page_id").alias("head"), F.col("n").alias("hn"), F.col("d").alias("hd")))
    out = lookup_spread(flat, heads, "ref").select(
        "page_id", F.coalesce("hn", "n").alias("payload_bytes"), F.coalesce("hd", "d").alias("payload_digest"),
        "record_type", F.col("head").alias("refers_to"), "copies")
    once, more = out.where("copies is null").drop("copies"), out.where("copies > 1")
    most = flat.agg(F.max("copies")).first()[0]
    if most is None:
        return once
    # in steps of COPIES rows, dealt out between them, so a row repeated often is no long array and no one task's
    steps = more.withColumn("k", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("copies") - 1, F.lit(COPIES).cast("bigint"))))
    if most > COPIES:
        steps = steps.repartition(spark.sparkContext.defaultParallelism)
    rows = steps.withColumn("k", F.explode(F.sequence(F.lit(1).cast("bigint"), F.least(F.lit(COPIES).cast("bigint"), F.col("copies") - F.col("k")))))
    return once.unionByName(rows.drop("k", "copies"))
