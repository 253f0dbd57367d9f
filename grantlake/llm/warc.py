"""WARC archives of captures, and the assembly of their records into transactions.

Writing: payloads are classed by SHA-1 and length; of a class the capture with the largest id is a ``response``, the
others are ``revisit`` records that refer to it. Each capture's request, response or revisit, and metadata records go
out as gzip-compressed WARC/1.1 text by Spark's own writer, which commits files of finished tasks only.

Reading: a worker parses whole files record by record, following ``Content-Length``. Records are then joined through
``WARC-Concurrent-To`` into one nested row per capture.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from grantlake.llm.common import base32_sha1, discard, materialise, scratch

# Fixed values of the WARC/1.1 format.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"
FILE_BYTES = 32 << 20

RECORD = (
    "record_id string, record_type string, target_uri string, date string, concurrent_to array<string>, refers_to string, "
    "payload_digest string, payload_bytes bigint, payload binary, fields map<string,string>"
)


def _uri(kind: str, page: Column, digest: Column) -> Column:
    h = F.md5(F.concat_ws("|", F.lit(kind), F.coalesce(page.cast("string"), F.lit("null")), digest))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]), F.lit(">"))


def _record(head: list[tuple[str, Column | str | None]], block: Column) -> Column:
    """A record without the blank lines behind it; headers with a null value are left out."""
    lines = [F.lit(VERSION)]
    for name, value in [*head, ("Content-Length", F.octet_length(block).cast("string"))]:
        lines.append(F.concat(F.lit(f"{name}: "), F.lit(value) if isinstance(value, str) else value))
    return F.concat(F.concat_ws("\r\n", *lines), F.lit("\r\n\r\n"), block)


def write_archive(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", *, min_bytes: int = 0, date: str = DATE) -> None:
    """Writes three records for each row. Payloads of ``min_bytes`` or more that occur more than once are stored once.

    Null payloads are empty. An id names a capture: rows that repeat id and payload are one capture. Control characters
    of a URL, which no header can hold, are left out. A null id is smaller than any other.
    """
    spark = pages.sparkSession
    rows = pages.select(
        F.col(id_col).cast("bigint").alias("page"),
        F.regexp_replace(F.coalesce(F.col(url_col).cast("string"), F.lit("")), r"\p{Cntrl}", "").alias("url"),
        F.coalesce(F.col(payload_col).cast("string"), F.lit("")).alias("body"),
    ).withColumns({"digest": base32_sha1("body"), "size": F.octet_length("body").cast("bigint")})
    classes, kept = materialise(rows.groupBy("digest", "size").agg(F.max("page").alias("first"), F.count("*").alias("n")), "payloads")
    mean = classes.agg((F.sum(F.col("n") * F.col("size")) / F.sum("n")).alias("mean")).first().mean or 0
    again = classes.where((F.col("n") > 1) & (F.col("size") >= min_bytes)).select(F.col("digest").alias("d"), F.col("size").alias("s"), "first")
    rows = rows.join(again, (F.col("digest") == F.col("d")) & (F.col("size") == F.col("s")), "left")
    revisit = F.col("first").isNotNull() & ~F.col("page").eqNullSafe(F.col("first"))
    page, digest = F.col("page"), F.col("digest")
    main = _uri("capture", page, digest)
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("size").cast("string"), F.lit("\r\n\r\n"))
    shared = [("WARC-Date", date), ("WARC-Target-URI", F.col("url"))]
    host = F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1)
    path = F.regexp_replace("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*", "")
    asked = F.concat(F.lit("GET "), F.when(path == "", "/").otherwise(path), F.lit(" HTTP/1.1\r\nHost: "), host, F.lit("\r\n\r\n"))
    request = _record([("WARC-Type", "request"), ("WARC-Record-ID", _uri("request", page, digest)), ("WARC-Concurrent-To", main), *shared, ("Content-Type", "application/http; msgtype=request")], asked)
    answer = _record(
        [
            ("WARC-Type", F.when(revisit, "revisit").otherwise("response")), ("WARC-Record-ID", main), *shared, ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), digest)),
            ("WARC-Refers-To", F.when(revisit, _uri("capture", F.col("first"), digest))), ("WARC-Profile", F.when(revisit, PROFILE)), ("Content-Type", "application/http; msgtype=response"),
        ],
        F.when(revisit, http).otherwise(F.concat(http, F.col("body"))),
    )
    about = F.concat(F.coalesce(F.concat(F.lit("page-id: "), page.cast("string"), F.lit("\r\n")), F.lit("")), F.lit("payload-length: "), F.col("size").cast("string"), F.lit("\r\n"))
    metadata = _record([("WARC-Type", "metadata"), ("WARC-Record-ID", _uri("metadata", page, digest)), ("WARC-Concurrent-To", main), *shared, ("Content-Type", "application/warc-fields")], about)
    lines = rows.select(F.concat_ws("\r\n\r\n", request, answer, metadata).alias("value"))
    most = max(1, int(FILE_BYTES / (mean + 1500)))  # a file has about FILE_BYTES before compression
    lines.write.option("lineSep", "\r\n\r\n").option("compression", "gzip").option("maxRecordsPerFile", most).text(folder)
    discard(spark, kept)


def _inflated(data: bytes) -> bytes:
    """A gzip file's members on end; other files as they are."""
    if data[:2] != b"\x1f\x8b":
        return data
    parts = []
    while data:
        one = zlib.decompressobj(31)
        parts.append(one.decompress(data))
        data = one.unused_data
    return b"".join(parts)


def parse(data: bytes) -> Iterator[dict]:
    """Records of an archive; raises ``ValueError`` on a damaged one or on a payload unlike its digest."""
    at = 0
    while True:
        while data[at : at + 2] == b"\r\n":
            at += 2
        if at >= len(data):
            return
        end = data.find(b"\r\n\r\n", at)
        lines = data[at:end].decode("utf-8", "replace").split("\r\n")
        if end < 0 or not lines[0].startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        head: dict[str, list[str]] = {}
        for line in lines[1:]:
            name, _, value = line.partition(":")
            head.setdefault(name.strip().lower(), []).append(value.strip())
        first = lambda name: head.get(name, [None])[0]
        at = end + 4
        size = int(first("content-length"))
        block = data[at : at + size]
        if len(block) < size:
            raise ValueError(f"record cut off at byte {at}")
        at += size
        kind, digest = first("warc-type"), first("warc-payload-digest")
        out = {
            "record_id": first("warc-record-id"), "record_type": kind, "target_uri": first("warc-target-uri"), "date": first("warc-date"), "concurrent_to": head.get("warc-concurrent-to", []),
            "refers_to": first("warc-refers-to"), "payload_digest": digest and digest.removeprefix("sha1:"), "payload_bytes": None, "payload": None, "fields": None,
        }
        if (first("content-type") or "").startswith("application/http") and kind in ("response", "revisit"):
            http, _, payload = block.partition(b"\r\n\r\n")
            named = [x.partition(b":")[2] for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")]
            if kind == "response":
                found = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                if digest and found != out["payload_digest"]:
                    raise ValueError(f"{out['record_id']}: payload {found} is not {digest}")
                out |= {"payload": payload, "payload_bytes": len(payload), "payload_digest": found}
            elif named:
                out["payload_bytes"] = int(named[0])
        elif kind == "metadata" or first("content-type") == "application/warc-fields":
            pairs = [x.partition(":") for x in block.decode("utf-8", "replace").split("\r\n") if ":" in x]
            out["fields"] = [(k.strip(), v.strip()) for k, _, v in pairs]
        yield out


def read_records(spark: SparkSession, folder: str) -> DataFrame:
    """A row for each record of the archives in a folder, see ``RECORD``."""
    schema = pa.schema([
        ("record_id", pa.string()), ("record_type", pa.string()), ("target_uri", pa.string()), ("date", pa.string()), ("concurrent_to", pa.list_(pa.string())), ("refers_to", pa.string()),
        ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("payload", pa.binary()), ("fields", pa.map_(pa.string(), pa.string())),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.column(0):
                rows, held = [], 0
                for record in parse(_inflated(file.as_py())):
                    rows.append(record)
                    held += len(record["payload"] or b"") + 500
                    if held > 4_000_000:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder).select("content")
    return files.mapInArrow(run, RECORD)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: ``record_id, record_type, target_uri, date, refers_to, payload_digest,
    payload_bytes, payload, requests array<struct>, metadata array<struct>``.

    A capture is a ``response``, ``revisit`` or ``resource`` record. Another record belongs to it if either names the
    other in ``WARC-Concurrent-To`` (several may be named). A capture without others has empty arrays; a record that
    names no capture here is not a transaction and is left out; records that repeat an id count once.
    """
    captured = F.col("record_type").isin("response", "revisit", "resource")
    main = records.where(captured).drop("fields")
    others = records.where(F.col("record_type").isin("request", "metadata"))
    slim = others.select("record_id", "record_type", "target_uri", "date", "fields", "concurrent_to")
    forward = slim.select(F.explode(F.array_distinct("concurrent_to")).alias("main"), "record_id", "record_type", "target_uri", "date", "fields")
    named = main.select(F.col("record_id").alias("main"), F.explode(F.array_distinct("concurrent_to")).alias("other"))
    backward = named.join(slim, F.col("other") == F.col("record_id")).select("main", "record_id", "record_type", "target_uri", "date", "fields")
    part = F.struct("record_id", "target_uri", "date", "fields")
    grouped = (
        forward.union(backward).groupBy("main", "record_id").agg(*[F.first(c).alias(c) for c in ("record_type", "target_uri", "date", "fields")])
        .groupBy("main").agg(*[F.array_sort(F.collect_list(F.when(F.col("record_type") == k, part)), lambda a, b: F.when(a["record_id"] < b["record_id"], -1).when(a["record_id"] > b["record_id"], 1).otherwise(0)).alias(v) for k, v in (("request", "requests"), ("metadata", "metadata"))])
    )
    once = main.drop("concurrent_to").join(grouped, F.col("record_id") == F.col("main"), "left").drop("main")
    columns = [c for c in once.columns if c != "record_id"]
    once = once.groupBy("record_id").agg(*[F.first(c).alias(c) for c in columns])
    order = ["record_id", "record_type", "target_uri", "date", "refers_to", "payload_digest", "payload_bytes", "payload"]
    return once.select(*order, *[F.coalesce(c, F.array()).alias(c) for c in ("requests", "metadata")])


def digest_of_pages(pages: DataFrame, *, min_bytes: int = 0, folder: str | None = None) -> DataFrame:
    """Writes an archive, reads it back and returns of each capture ``page_id, payload_bytes, payload_digest,
    record_type, refers_to``, the last being the page id of the response that a revisit refers to."""
    spark = pages.sparkSession
    folder = folder or scratch(spark, "warc")
    write_archive(pages, folder, min_bytes=min_bytes)
    captures = assemble(read_records(spark, folder))
    page = F.try_element_at(F.element_at(F.col("metadata"), 1)["fields"], F.lit("page-id")).cast("bigint")
    found, _ = materialise(captures.select("record_id", "record_type", F.col("refers_to").alias("to"), "payload_digest", "payload_bytes", page.alias("page_id")), "captures")
    first = found.where("record_type = 'response'").select(F.col("record_id").alias("to"), F.col("page_id").alias("refers_to"))
    return found.join(first, "to", "left").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
b AS (SELECT page_id, octet_length(encode(h)) AS payload_bytes, sha1(h) AS x FROM p),
m AS (SELECT *, max(page_id) OVER (PARTITION BY x, payload_bytes) AS last FROM b),
d AS (SELECT *, list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
  1 + list_aggregate(list_transform(range(5), lambda j: ((instr('0123456789abcdef', substr(x, 1 + CAST((5 * i + j) // 4 AS BIGINT), 1)) - 1)
    >> CAST(3 - (5 * i + j) % 4 AS BIGINT) & 1) << CAST(4 - j AS BIGINT)), 'sum')::BIGINT, 1)), 'string_agg', '') AS payload_digest FROM m)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
  CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = last THEN NULL ELSE last END AS refers_to
FROM d
"""
