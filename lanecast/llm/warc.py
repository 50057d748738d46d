"""WARC archives with revisit records.

Headers (page, payload digest, length) are shuffled by digest; the smallest
page of a digest keeps its payload as a response, every other page becomes a
revisit that refers to it.  Only then do payloads move, once, to the writer of
the deduplicated archives, which get fresh headers.  Reading an archive parses
record by record by Content-Length, checks each payload against its digest and
joins revisits to their responses by digest.

Archives are written by Spark's own text writer (record separator CRLF CRLF,
gzip), so a lost executor's attempt leaves nothing behind.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lanecast.llm.common import arrow_schema, as_array, map_batches

# Fixed values of the format.
VERSION = b"WARC/1.1"
PROFILE = "http://netpreservefiles.org/warc/1.1/revisit/identical-payload-digest"
END = "\r\n\r\n"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"

# Records of an archive file: bounds what a reader holds.
FILE_RECORDS = 2000


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def headers(pages: DataFrame) -> DataFrame:
    """page_id, digest (hex SHA-1 of the payload), payload_bytes; null html is empty."""
    html = F.coalesce("html", F.lit(""))
    return pages.select("page_id", F.sha1(F.encode(html, "utf-8")).alias("digest"),
                        F.octet_length(html).cast("long").alias("payload_bytes"))


def revisits(heads: DataFrame, least_bytes: int = 0) -> DataFrame:
    """page_id, digest, refers_to (null: a response), one row per page and digest."""
    first = heads.groupBy("digest").agg(F.min("page_id").alias("first"))
    other = (F.col("payload_bytes") >= least_bytes) & ~F.col("page_id").eqNullSafe(F.col("first"))
    return (heads.distinct().join(first, "digest")
            .select("page_id", "digest", F.when(other, F.col("first")).alias("refers_to"), other.alias("revisit")))


def record(page_id, url: str | None, html: str, refers_to, revisit: bool, date: str) -> str:
    """One record without its end; a revisit has no payload."""
    payload = html.encode()
    digest = base32_sha1(payload)
    head = HTTP.format(len(payload))
    name = hashlib.sha1(f"{page_id}:{digest}".encode()).hexdigest()
    lines = [VERSION.decode(), f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:sha1:{name}>",
             f"WARC-Date: {date}", f"WARC-Payload-Digest: sha1:{digest}",
             "Content-Type: application/http; msgtype=response",
             f"Content-Length: {len(head) + (0 if revisit else len(payload))}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + re.sub(r"[\r\n]", lambda m: f"%{ord(m[0]):02X}", url))
    if page_id is not None:
        lines.append(f"Page-ID: {page_id}")
    if revisit:
        first = hashlib.sha1(f"{refers_to}:{digest}".encode()).hexdigest()
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:sha1:{first}>"]
    return "\r\n".join(lines) + END + head + ("" if revisit else html)


def write_archives(pages: DataFrame, path: str, least_bytes: int = 0, date: str = "2025-01-01T00:00:00Z") -> None:
    """Deduplicated archives of pages (page_id, url, html) below path."""
    known = revisits(headers(pages), least_bytes).withColumnRenamed("page_id", "_page")
    p = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    p = p.withColumn("_digest", F.sha1(F.encode("html", "utf-8")))
    rows = (p.join(known, p["page_id"].eqNullSafe(known["_page"]) & (p["_digest"] == known["digest"]))
            .select("page_id", "url", "html", "refers_to", "revisit"))

    def run(b: pa.RecordBatch) -> dict:
        return {"value": [record(*row, date) for row in zip(*(c.to_pylist() for c in b.columns))]}

    (map_batches(rows, run, "value string").write.mode("overwrite")
     .option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", FILE_RECORDS).text(path))


def records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of an archive."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        first, *lines = data[at:end].split(b"\r\n")
        if first != VERSION:
            raise ValueError("no WARC record where one should begin")
        head = dict(x.decode().split(": ", 1) for x in lines)
        stop = end + 4 + int(head["Content-Length"])
        if data[stop:stop + 4] != b"\r\n\r\n":
            raise ValueError("a record does not end where its length says")
        yield head, data[end + 4:stop]
        at = stop + 4


RECORD_SCHEMA = "page_id bigint, record_type string, payload_digest string, payload_bytes bigint, url string"


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """One row per record; payload_bytes is null for revisits.  A payload that
    does not have its digest fails the read."""
    schema = arrow_schema(RECORD_SCHEMA)

    def rows(data: bytes) -> Iterator[tuple]:
        for head, block in records(zlib.decompress(data, 31)):
            payload = block[block.index(b"\r\n\r\n") + 4:]
            digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
            revisit = head["WARC-Type"] == "revisit"
            if not revisit and base32_sha1(payload) != digest:
                raise ValueError(f"digest of {head['WARC-Record-ID']}")
            page = head.get("Page-ID")
            yield (None if page is None else int(page), head["WARC-Type"], digest, None if revisit else len(payload),
                   head.get("WARC-Target-URI"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for value in b.column(0):
                got = list(zip(*rows(value.as_py())))
                if got:
                    yield pa.record_batch([as_array(list(c), f.type) for c, f in zip(got, schema)], schema=schema)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
    return files.select("content").mapInArrow(run, RECORD_SCHEMA)


def resolve(recs: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to: each
    revisit joined to the response of its digest.

    One row per page and payload: rows that repeat both are one.  A null
    page_id counts as larger than any other; a page with null html has the
    empty payload; an empty archive gives no rows.
    """
    cols = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    response = recs.filter("record_type = 'response'").select("page_id", "payload_digest", "payload_bytes").distinct()
    first = response.groupBy("payload_digest").agg(F.min("page_id").alias("refers_to"),
                                                   F.max("payload_bytes").alias("payload_bytes"))
    again = recs.filter("record_type = 'revisit'").select("page_id", "payload_digest", "record_type").distinct()
    return (again.join(first, "payload_digest").select(*cols)
            .unionByName(response.select("page_id", "payload_bytes", "payload_digest", F.lit("response").alias("record_type"),
                                         F.lit(None).cast("bigint").alias("refers_to")).select(*cols)))
