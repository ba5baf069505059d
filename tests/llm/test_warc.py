from __future__ import annotations

import glob
import gzip

import pytest

from syncflow.llm import warc

SCHEMA = "page_id long, url string, html string, block string, segment int"
TRICKY = "a\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\nWARC/1.1" * 40


@pytest.mark.parametrize("chunk", [1, 3, 7, 4096])
@pytest.mark.parametrize("payload", [b"", b"x", TRICKY.encode(), "é".encode() * 5000])
def test_chunks(payload, chunk):
    framed = warc.chunked(payload, chunk)
    assert warc.unchunked(framed) == payload
    assert warc.START not in framed
    assert warc.unchunked(framed[:-6]) is None or not payload


def pages_of(spark, rows):
    return spark.createDataFrame([(*r, "b", 1) for r in rows], SCHEMA)


ROWS = [
    (1, "http://a/", "same"),
    (2, "http://b/ x", "same"),
    (2, "http://b/ x", "same"),
    (3, None, None),
    (4, "http://d/", ""),
    (5, "http://e/", TRICKY),
    (6, "http://f/", "é" * 40_000),
    (None, "http://g/", "é" * 40_000),
    (None, "http://h/", "alone"),
    (None, None, "alone"),
    (7, "http://i/", "long and repeated " * 500),
    (7, "http://i/", "long and repeated " * 500),
]


def expected(rows, least=0):
    first = {}
    for i, _, html in rows:
        first.setdefault(html or "", []).append(i)
    out = []
    for i, _, html in rows:
        ids = [x for x in first[html or ""] if x is not None]
        data = (html or "").encode()
        revisit = ids and i != max(ids) and len(data) >= least
        out.append((i, len(data), warc.base32_sha1(data), "revisit" if revisit else "response",
                    max(ids) if revisit else None, None if revisit else data))
    return sorted(out, key=repr)


@pytest.mark.parametrize("segment,chunk,least", [(16384, 4096, 0), (50, 7, 0), (300, 100, 5)])
def test_round_trip(spark, folder, segment, chunk, least):
    path = folder("archives")
    warc.write_archives(
        pages_of(spark, ROWS), path, segment_bytes=segment, chunk_bytes=chunk, min_revisit_bytes=least
    )
    got = warc.read_archives(spark, path).collect()
    assert all(r["intact"] for r in got)
    rows = [
        (r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"],
         None if r["payload"] is None else bytes(r["payload"]))
        for r in got
    ]
    assert sorted(rows, key=repr) == expected(ROWS, least)


def test_bytes_that_are_no_text(spark, folder):
    pages = spark.range(3).selectExpr("id as page_id", "'u' as url", "unhex('fffe00c3') as html")
    warc.write_archives(pages, folder("a"), segment_bytes=10)
    got = warc.read_archives(spark, folder("a")).where("record_type = 'response'").collect()
    assert [bytes(r["payload"]) for r in got] == [bytes.fromhex("fffe00c3")]


def test_missing_segment_is_reported(spark, folder):
    warc.write_archives(pages_of(spark, [(1, "u", "z" * 900)]), folder("a"), segment_bytes=200)
    text = "".join(gzip.open(f, "rt", newline="").read() for f in glob.glob(folder("a") + "/*.gz"))
    at = text.index("WARC-Segment-Number: 3")
    start, end = text.rindex("WARC/1.1", 0, at), text.index("WARC/1.1", at)
    spark.createDataFrame([(text[:start] + text[end:],)], "value string").coalesce(1).write.text(
        folder("b")
    )
    (row,) = warc.read_archives(spark, folder("b")).collect()
    assert not row["intact"] and row["payload"] is None and row["page_id"] == 1


def test_empty_table(spark, folder):
    warc.write_archives(pages_of(spark, []), folder("a"))
    assert warc.read_archives(spark, folder("a")).collect() == []


def test_size_and_digest_are_those_of_the_payload_read():
    page = {
        "record_id": "r", "record_type": "response", "payload_bytes": 2, "intact": True,
        "payload_digest": warc.base32_sha1(b"ab"), "payload": None,
    }
    whole = warc._finish({**page, "block": warc.HTTP_HEAD + warc.chunked(b"ab")})
    assert (whole["payload"], whole["payload_bytes"], whole["intact"]) == (b"ab", 2, True)
    assert whole["payload_digest"] == warc.base32_sha1(b"ab")
    blocks = [warc.HTTP_HEAD + warc.chunked(b"xy"), warc.HTTP_HEAD + b"no chunks", None]
    for block in blocks:
        lost = warc._finish({**page, "block": block, "intact": block is not None})
        assert not lost["intact"]
        assert lost["payload"] is lost["payload_bytes"] is lost["payload_digest"] is None
    revisit = warc._finish({**page, "record_type": "revisit", "block": b""})
    assert revisit["payload_bytes"] == 2 and revisit["payload_digest"] == page["payload_digest"]
