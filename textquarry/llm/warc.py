"""WARC derivatives: metadata and plain-text conversion records of responses.

Each response gets a ``metadata`` record (application/warc-fields: the
source's status line, HTTP headers, digests and outlinks) and a
``conversion`` record (text/plain). Both refer to the response by its record
id and keep its target, date and digests; each names the other, so that a
reader finds all three from any one. Record ids are derived from what they
name: a job that runs again makes the same records.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textquarry.functions.html import html_to_text, links
from textquarry.plans.texts import html_text_sql

SOFTWARE = "textquarry"
#: Between the records of a file.
BREAK = "\r\n\r\n"


def digest(text: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(text.cast("binary"), 256))


def record_id(*parts: Column) -> Column:
    """<urn:uuid:...> named by the parts (version 8: own scheme)."""
    h = F.sha2(F.concat_ws("\n", *parts), 256)
    return F.concat(F.lit("<urn:uuid:"), F.substring(h, 1, 8), F.lit("-"), F.substring(h, 9, 4), F.lit("-8"), F.substring(h, 14, 3), F.lit("-a"), F.substring(h, 18, 3), F.lit("-"), F.substring(h, 21, 12), F.lit(">"))


def responses(pages: DataFrame, date: str = "2024-01-01T00:00:00Z", id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Crawled pages as responses: page_id, record_id, target_uri, date, http_headers, payload. Null bodies are empty."""
    body = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    url = F.coalesce(F.col(url_col).cast("string"), F.lit(""))
    headers = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.octet_length(body).cast("string"))
    return pages.select(F.col(id_col).alias("page_id"), record_id(F.lit("response"), url, digest(body)).alias("record_id"), url.alias("target_uri"), F.lit(date).alias("date"), headers.alias("http_headers"), body.alias("payload"))


def records_of(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(named fields in lower case, block) of each record of a WARC file, gzipped (in one or many members) or not.

    A block has as many bytes as its Content-Length says, whatever they are.
    What follows the last whole record is left out.
    """
    chunks, held, at = _inflated(data), bytearray(), 0

    def fill(n: int) -> bool:
        """Whether ``n`` bytes from ``at`` on are there."""
        nonlocal at
        while len(held) - at < n:
            if at > 1 << 20:
                del held[:at]
                at = 0
            more = next(chunks, None)
            if more is None:
                return False
            held.extend(more)
        return True

    while True:
        while fill(1) and held[at] in b"\r\n":
            at += 1
        looked = at
        while (end := held.find(b"\r\n\r\n", looked)) < 0:
            have, was = len(held) - at, at
            if not fill(have + 1):
                return
            looked = max(at, looked - (was - at) - 3)
        version, *lines = held[at:end].decode("utf-8", "replace").split("\r\n")
        fields: dict[str, str] = {}
        name = ""
        for line in lines:
            if line[:1] in " \t" and name:  # a folded line
                fields[name] += " " + line.strip()
            elif ":" in line:
                name, value = line.split(":", 1)
                name = name.strip().lower()
                fields[name] = value.strip()
        at = end + 4
        length = fields.get("content-length", "")
        if not version.startswith("WARC/") or not length.isdigit() or not fill(int(length)):
            return
        yield fields, bytes(held[at : at + int(length)])
        at += int(length)


def _inflated(data: bytes, step: int = 1 << 20) -> Iterator[bytes]:
    view = memoryview(data)
    if data[:2] != b"\x1f\x8b":
        yield from (bytes(view[i : i + step]) for i in range(0, len(data), step))
        return
    while data[:2] == b"\x1f\x8b":
        member, rest = zlib.decompressobj(31), data
        while not member.eof and rest:
            out = member.decompress(rest, step)
            rest = member.unconsumed_tail
            if not out and not rest:
                break
            yield out
        data = member.unused_data


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(content) of files -> their responses, in batches of bounded size."""
    names = ["record_id", "target_uri", "date", "http_headers", "payload"]
    types = [pa.string()] * 4 + [pa.binary()]
    for batch in batches:
        for content in batch.column(0):
            out, size = [], 0
            for fields, block in records_of(content.as_py()):
                if fields.get("warc-type", "").lower() == "response":
                    head, _, payload = block.partition(b"\r\n\r\n")
                    out.append((*(fields.get(f"warc-{x}", "").strip() for x in ("record-id", "target-uri", "date")), head.decode("utf-8", "replace"), payload))
                    size += len(block)
                    if size > 8_000_000:
                        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(types)], names)
                        out, size = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(types)], names)


def read_responses(spark: SparkSession, path: str) -> DataFrame:
    """Responses of WARC files, uncompressed or gzipped: record_id, target_uri, date, http_headers, payload (binary).

    Records are read by their Content-Length, so a file is one task's work;
    files of the usual gigabyte are many enough to share out. Spark reads
    files up to 2 GB this way.
    """
    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(_read, "record_id string, target_uri string, date string, http_headers string, payload binary")


def decoded(payload: Column, http_headers: Column) -> Column:
    """The payload as text: UTF-8, bytes that are none replaced, unless the headers name Latin-1."""
    latin = http_headers.rlike(r"(?im)^content-type:[^\r\n]*charset *= *[\"']?(?:iso-8859-1|latin-?1|windows-1252)\b")
    return F.when(latin, F.decode(payload.cast("binary"), "ISO-8859-1")).otherwise(F.make_valid_utf8(payload.cast("string")))


def derive(found: DataFrame) -> DataFrame:
    """Two records for each response: the response's extra columns, and type, record_id, refers_to, target_uri, date, content_type, headers, block.

    Needs record_id, target_uri, date, http_headers and payload (text or
    binary); null ones are taken as empty. Digests are of the payload's bytes.
    Repeated responses give repeated records. One pass, no shuffle.
    """
    own = ("record_id", "target_uri", "date", "http_headers", "payload")
    extra = [c for c in found.columns if c not in (*own, "type", "refers_to", "content_type", "headers", "block", "source_digest", "block_digest", "source_block_digest", "made", "page", "metadata_id", "conversion_id")]
    src = found.select(*extra, *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in own])
    src = src.withColumns({"source_digest": digest(F.col("payload")), "source_block_digest": digest(F.concat("http_headers", F.lit(BREAK), "payload")), "metadata_id": record_id(F.lit("metadata"), F.col("record_id")), "conversion_id": record_id(F.lit("conversion"), F.col("record_id")), "page": decoded(F.col("payload"), F.col("http_headers"))})
    # Header lines are folded into fields of their own; line ends within would end the field.
    fields = F.concat(
        F.lit("source-status: "), F.substring_index("http_headers", "\r\n", 1),
        F.array_join(F.transform(F.slice(F.split("http_headers", "\r\n"), F.lit(2), F.size(F.split("http_headers", "\r\n"))), lambda h: F.concat(F.lit("\r\nsource-header: "), h)), ""),
        F.lit("\r\nsource-payload-digest: "), "source_digest", F.lit("\r\nsource-block-digest: "), "source_block_digest",
        F.lit("\r\nconversion-record: "), "conversion_id",
        F.array_join(F.transform(links(F.col("page")), lambda u: F.concat(F.lit("\r\noutlink: "), F.regexp_replace(u, r"[\r\n]+", " "))), ""), F.lit("\r\n"),
    )

    def record(kind: str, own_id: str, other: str, content: str, block: Column) -> Column:
        return F.struct(F.lit(kind).alias("type"), F.col(own_id).alias("record_id"), F.col(other).alias("concurrent_to"), F.lit(content).alias("content_type"), block.alias("block"))

    made = F.array(record("metadata", "metadata_id", "conversion_id", "application/warc-fields", fields), record("conversion", "conversion_id", "metadata_id", "text/plain; charset=utf-8", html_to_text(F.col("page"))))
    out = src.select(*extra, F.col("record_id").alias("refers_to"), "target_uri", "date", "source_digest", "source_block_digest", F.explode(made).alias("made"))
    out = out.select(*extra, "made.type", "made.record_id", "refers_to", "made.concurrent_to", "target_uri", "date", "made.content_type", "source_digest", "source_block_digest", digest(F.col("made.block")).alias("block_digest"), F.octet_length("made.block").cast("bigint").alias("content_length"), "made.block")
    return out.withColumn("headers", F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), "type", F.lit("\r\nWARC-Record-ID: "), "record_id", F.lit("\r\nWARC-Refers-To: "), "refers_to", F.lit("\r\nWARC-Concurrent-To: "), "concurrent_to",
        F.lit("\r\nWARC-Target-URI: "), "target_uri", F.lit("\r\nWARC-Date: "), "date", F.lit("\r\nWARC-Block-Digest: "), "block_digest",
        F.lit("\r\nContent-Type: "), "content_type", F.lit("\r\nContent-Length: "), F.col("content_length").cast("string"),
    ))


def write_records(records: DataFrame, path: str, compression: str = "gzip") -> None:
    """Records as WARC files, one for each task, by Spark's own writer."""
    records.select(F.concat("headers", F.lit(BREAK), "block", F.lit("\r\n")).alias("value")).write.option("lineSep", "\r\n").option("compression", compression).mode("overwrite").text(path)


_UUID = "concat('<urn:uuid:', h[1:8], '-', h[9:12], '-8', h[14:16], '-a', h[18:20], '-', h[21:32], '>')"
ORACLE = rf"""
WITH p AS (SELECT page_id, coalesce(url, '') AS url, coalesce(html, '') AS html FROM pages),
r AS (SELECT *, 'sha256:' || sha256(html) AS source_digest, 'HTTP/1.1 200 OK' || chr(13) || chr(10) || 'Content-Type: text/html; charset=utf-8' || chr(13) || chr(10) || 'Content-Length: ' || strlen(html) AS head FROM p),
i AS (SELECT *, (SELECT {_UUID} FROM (SELECT sha256('response' || chr(10) || url || chr(10) || source_digest) AS h)) AS refers_to, 'sha256:' || sha256(head || chr(13) || chr(10) || chr(13) || chr(10) || html) AS source_block_digest FROM r),
b AS (SELECT *, (SELECT {_UUID} FROM (SELECT sha256('metadata' || chr(10) || refers_to) AS h)) AS mid, (SELECT {_UUID} FROM (SELECT sha256('conversion' || chr(10) || refers_to) AS h)) AS cid FROM i),
m AS (
SELECT page_id, 'metadata' AS type, mid AS record_id, cid AS concurrent_to, refers_to, url AS target_uri, source_digest, source_block_digest,
'source-status: HTTP/1.1 200 OK' || chr(13) || chr(10) || 'source-header: Content-Type: text/html; charset=utf-8' || chr(13) || chr(10) || 'source-header: Content-Length: ' || strlen(html)
|| chr(13) || chr(10) || 'source-payload-digest: ' || source_digest || chr(13) || chr(10) || 'source-block-digest: ' || source_block_digest || chr(13) || chr(10) || 'conversion-record: ' || cid
|| coalesce(array_to_string(list_transform(regexp_extract_all(html, '(?i)<a\s[^>]*?href="([^"]*)"', 1), lambda u: chr(13) || chr(10) || 'outlink: ' || regexp_replace(u, '[\r\n]+', ' ', 'g')), ''), '') || chr(13) || chr(10) AS block FROM b
UNION ALL
SELECT page_id, 'conversion', cid, mid, refers_to, url, source_digest, source_block_digest, {html_text_sql("html")} FROM b)
SELECT page_id, type, record_id, concurrent_to, refers_to, target_uri, source_digest, source_block_digest, 'sha256:' || sha256(block) AS block_digest, strlen(block) AS content_length, block FROM m
"""
