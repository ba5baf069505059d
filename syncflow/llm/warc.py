"""Web archives: writing pages as records, and reassembling them.

Archives are written and read through Spark's text source, so any file system
that Spark reaches will do. A record ends with two line ends; a reader splits at
record starts and therefore holds one record at a time, never a file. The writer
frames payloads in chunks (as HTTP transfers do) and ends a chunk inside any
text that looks like a record start, so that payloads cannot be mistaken for one.
Blocks longer than ``segment_bytes`` go on in continuation records. Reading puts
them together by origin identifier and segment number, verifies the total
length, and then decodes the chunks.

Pages with the same payload, ``min_revisit_bytes`` long at least, are written
once, as a response under the largest page id; the others become revisits.

Defined results: a null payload is empty. A null page id is smaller than any id;
if no page of a payload has an id, all are responses. Repeated rows of the
largest id are all responses, with equal records; reading gives each of them
back. Payloads that are no UTF-8 are kept byte by byte. Records that are cut off
or lack a segment come back with a null payload, size and digest and ``intact``
false; other sizes and digests are those of the payload that was read.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

START = b"WARC/1.1\r\n"
END = "\r\n\r\n"
HTTP_HEAD = (
    b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    b"Transfer-Encoding: chunked\r\n\r\n"
)
SEGMENT_BYTES = 16 * 1024
CHUNK_BYTES = 4 * 1024

RECORD = (
    "record_id string, page_id long, record_type string, refers_to long, url string, "
    "payload_digest string, payload_bytes long, segment int, total long, copies int, "
    "block binary, payload binary, intact boolean"
)
_RECORD_SCHEMA = pa.schema(
    [
        ("record_id", pa.string()),
        ("page_id", pa.int64()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
        ("url", pa.string()),
        ("payload_digest", pa.string()),
        ("payload_bytes", pa.int64()),
        ("segment", pa.int32()),
        ("total", pa.int64()),
        ("copies", pa.int32()),
        ("block", pa.binary()),
        ("payload", pa.binary()),
        ("intact", pa.bool_()),
    ]
)
#: Rows are handed on in batches of about so many bytes.
BATCH_BYTES = 4 * 1024 * 1024


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload, usedforsecurity=False).digest()).decode()


def chunked(payload: bytes, chunk_bytes: int = CHUNK_BYTES) -> bytes:
    """Chunked transfer framing in which no record start can appear."""
    out, at = [], 0
    while at < len(payload):
        end = min(at + chunk_bytes, len(payload))
        # A chunk ends after the first letters of what looks like a record start.
        start = payload.find(START[:8], at, end + 7)
        if start >= 0 and start + 4 < end:
            end = start + 4
        out += (b"%x\r\n" % (end - at), payload[at:end], b"\r\n")
        at = end
    out.append(b"0\r\n\r\n")
    return b"".join(out)


def unchunked(body: bytes) -> bytes | None:
    """The payload of a framed body, or null if the framing is broken."""
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        if end < 0:
            return None
        try:
            size = int(body[at:end].split(b";")[0], 16)
        except ValueError:
            return None
        at = end + 2
        if size == 0:
            return b"".join(out)
        if body[at + size : at + size + 2] != b"\r\n":
            return None
        out.append(body[at : at + size])
        at += size + 2


def payload_of(block: bytes) -> bytes | None:
    """The payload of a whole response block."""
    head, mark, body = block.partition(b"\r\n\r\n")
    if not mark:
        return None
    if b"transfer-encoding: chunked" in head.lower():
        return unchunked(body)
    return body


def _record(kind: str, record_id: str, date: str, fields: list, block: bytes) -> bytes:
    lines = [("WARC-Type", kind), ("WARC-Record-ID", f"<{record_id}>"), ("WARC-Date", date)]
    lines += [*fields, ("Content-Length", len(block))]
    head = "".join(f"{name}: {value}\r\n" for name, value in lines if value is not None)
    return START + head.encode() + b"\r\n" + block


def page_records(page: dict, segment_bytes: int, chunk_bytes: int, date: str) -> Iterator[bytes]:
    """The records of one page, in order, without the two line ends."""
    payload, page_id = page["payload"], page["page_id"]
    digest = base32_sha1(payload)
    url = page["url"] and "".join(page["url"].split())
    common = [
        ("WARC-Target-URI", url),
        ("WARC-Page-ID", page_id),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Payload-Length", len(payload)),
    ]
    name = f"urn:page:{page_id}:{digest}"
    if page["refers_to"] is not None:
        target = [
            ("WARC-Refers-To", f"<urn:page:{page['refers_to']}:{digest}>"),
            ("WARC-Refers-To-Page", page["refers_to"]),
        ]
        yield _record("revisit", f"{name}:revisit", date, [*common, *target], b"")
        return
    block = HTTP_HEAD + chunked(payload, chunk_bytes)
    if len(block) <= segment_bytes:
        yield _record("response", name, date, common, block)
        return
    parts = range(0, len(block), segment_bytes)
    for number, at in enumerate(parts, 1):
        part = block[at : at + segment_bytes]
        fields = [("WARC-Segment-Number", number)]
        if number == len(parts):
            fields.append(("WARC-Segment-Total-Length", len(block)))
        if number == 1:
            yield _record("response", name, date, [*common, *fields], part)
        else:
            origin = ("WARC-Segment-Origin-ID", f"<{name}>")
            yield _record("continuation", f"{name}:{number}", date, [origin, *fields], part)


def write_archives(
    pages: DataFrame,
    path: str,
    *,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    segment_bytes: int = SEGMENT_BYTES,
    chunk_bytes: int = CHUNK_BYTES,
    min_revisit_bytes: int = 0,
    date: str = "2000-01-01T00:00:00Z",
) -> None:
    """Write a record (or several segments) per page as gzip archives under ``path``."""
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        F.col(url_col).cast("string").alias("url"),
        F.coalesce(F.col(payload_col).cast("binary"), F.lit(b"")).alias("payload"),
    ).withColumn("sha", F.sha1("payload"))
    long_enough = F.octet_length("payload") >= min_revisit_bytes
    first = (
        rows.where(long_enough)
        .groupBy(F.col("sha").alias("first_sha"))
        .agg(F.max("page_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
        .where((F.col("n") > 1) & F.col("first_id").isNotNull())
        .select("first_sha", "first_id")
    )
    marked = rows.join(
        first.hint("shuffle_hash"), (F.col("sha") == F.col("first_sha")) & long_enough, "left"
    ).select(
        "page_id",
        "url",
        "payload",
        F.when(~F.col("page_id").eqNullSafe(F.col("first_id")), F.col("first_id")).alias(
            "refers_to"
        ),
    )

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, held = [], 0
        for batch in batches:
            for at in range(batch.num_rows):
                page = {n: batch.column(n)[at].as_py() for n in batch.schema.names}
                for record in page_records(page, segment_bytes, chunk_bytes, date):
                    out.append(record)
                    held += len(record)
                if held >= BATCH_BYTES:
                    yield pa.record_batch([pa.array(out, pa.binary())], ["record"])
                    out, held = [], 0
        if out:
            yield pa.record_batch([pa.array(out, pa.binary())], ["record"])

    marked.mapInArrow(emit, "record binary").select(F.col("record").cast("string")).write.option(
        "lineSep", END
    ).option("compression", "gzip").text(path)


def _parse(record: bytes) -> dict:
    """Fields of one record; ``record`` begins after the version line."""
    head, mark, rest = record.partition(b"\r\n\r\n")
    fields = {}
    for line in head.split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if colon:
            fields[name.strip().lower().decode("utf-8", "replace")] = value.strip().decode(
                "utf-8", "replace"
            )

    def number(name: str) -> int | None:
        value = fields.get(name, "")
        return int(value) if value.lstrip("-").isdigit() else None

    length = number("content-length")
    intact = bool(mark) and length is not None and len(rest) >= length
    block = rest[:length] if intact else None
    digest = fields.get("warc-payload-digest", "")
    row = {
        "record_id": fields.get("warc-segment-origin-id", fields.get("warc-record-id")),
        "page_id": number("warc-page-id"),
        "record_type": fields.get("warc-type"),
        "refers_to": number("warc-refers-to-page"),
        "url": fields.get("warc-target-uri"),
        "payload_digest": digest.removeprefix("sha1:") or None,
        "payload_bytes": number("warc-payload-length"),
        "segment": number("warc-segment-number"),
        "total": number("warc-segment-total-length"),
        "copies": 1,
        "block": block,
        "payload": None,
        "intact": intact,
    }
    return row


def _finish(row: dict) -> dict:
    """Decode the payload of a whole record; its size and digest are taken from it.

    They must be those of the header. A revisit has no payload and keeps the header's.
    """
    if row["record_type"] == "response":
        payload = payload_of(row["block"]) if row["intact"] else None
        size, digest = (None, None) if payload is None else (len(payload), base32_sha1(payload))
        row["intact"] = payload is not None and (size, digest) == (
            row["payload_bytes"],
            row["payload_digest"],
        )
        if not row["intact"]:
            payload = size = digest = None
        row["payload"], row["payload_bytes"], row["payload_digest"] = payload, size, digest
    row["block"] = None
    return row


def _emit(rows: Iterator[dict]) -> Iterator[pa.RecordBatch]:
    out, held = [], 0
    for row in rows:
        out.append(row)
        held += len(row["block"] or b"") + len(row["payload"] or b"") + 200
        if held >= BATCH_BYTES:
            yield pa.RecordBatch.from_pylist(out, _RECORD_SCHEMA)
            out, held = [], 0
    if out:
        yield pa.RecordBatch.from_pylist(out, _RECORD_SCHEMA)


def _records(batches: Iterator[pa.RecordBatch], segments: bool) -> Iterator[dict]:
    for batch in batches:
        for value in batch.column(0):
            record = value.as_py().removeprefix(START)
            if not record.strip():
                continue
            row = _parse(record)
            if (row["segment"] is not None) == segments:
                yield row if segments else _finish(row)


def _joined(parts: list[dict]) -> Iterator[dict]:
    """One record from its sorted segments; equal copies of a segment count as copies."""
    first, blocks, last = parts[0], [], 0
    intact, copies, total = first["segment"] == 1, 0, None
    for part in parts:
        copies += part["segment"] == 1
        if part["segment"] == last:
            continue
        intact &= part["segment"] == last + 1 and part["intact"]
        blocks.append(part["block"] or b"")
        last, total = part["segment"], part["total"] if part["total"] is not None else total
    block = b"".join(blocks)
    row = _finish(
        {
            **first,
            "record_type": "response",
            "segment": None,
            "total": total,
            "copies": max(copies, 1),
            "intact": bool(intact and total == len(block)),
            "block": block,
        }
    )
    for _ in range(row["copies"]):
        yield {**row, "copies": 1}


def _reassemble(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Sorted segments to whole records; holds the segments of one record."""
    parts: list[dict] = []
    for batch in batches:
        for at in range(batch.num_rows):
            part = {n: batch.column(n)[at].as_py() for n in batch.schema.names}
            if parts and parts[0]["record_id"] != part["record_id"]:
                yield from _joined(parts)
                parts = []
            parts.append(part)
    if parts:
        yield from _joined(parts)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """A row per response or revisit record, with verified payloads.

    Columns: ``record_id, page_id, record_type, refers_to, url, payload_digest,
    payload_bytes, payload, intact``. Only segmented records are shuffled.
    """
    raw = (
        spark.read.schema(T.StructType([T.StructField("value", T.StringType())]))
        .option("lineSep", END + START.decode())
        .text(path)
        .select(F.col("value").cast("binary"))
    )
    whole = raw.mapInArrow(lambda b: _emit(_records(b, False)), RECORD)
    segments = (
        raw.mapInArrow(lambda b: _emit(_records(b, True)), RECORD)
        .repartition("record_id")
        .sortWithinPartitions("record_id", "segment")
        .mapInArrow(lambda b: _emit(_reassemble(b)), RECORD)
    )
    return whole.unionByName(segments).select(
        "record_id",
        "page_id",
        "record_type",
        "refers_to",
        "url",
        "payload_digest",
        "payload_bytes",
        "payload",
        "intact",
    )
