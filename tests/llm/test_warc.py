"""WARC archives: exact round trips, chunks, revisits and damaged records."""

import base64
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from clearshelf.llm import warc

SCHEMA = "page_id long, url string, html string"
BOUNDARY = warc.BOUNDARY


def pages_of(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def expected(rows):
    largest = {}
    for i, _, h in rows:
        if i is not None:
            largest[h or ""] = max(i, largest.get(h or "", i))
    out = []
    for i, _, h in rows:
        first = largest.get(h or "")
        kind = "response" if first == i else "revisit"
        out.append((i, len((h or "").encode()), digest(h), kind, first if kind == "revisit" else None))
    return sorted(out, key=str)


def found(df):
    rows = df.collect()
    assert all(r.digest_ok for r in rows)
    return sorted((tuple(r)[:5][:1] + (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows), key=str)


AWKWARD = [
    (1, "http://a/x", "plain"),
    (2, None, None),
    (3, "http://a/\r\nX: y", ""),
    (4, "u", "plain"),
    (5, "u", "a" + BOUNDARY + "b"),
    (6, "u", BOUNDARY * 3),
    (7, "u", "WARC/1.1\r\nWARC-Type: response\r\n\r\n"),
    (8, "u", "\r\n\r\n"),
    (9, "u", "é" * 100 + "\U0001f600" * 50),
    (10, "u", "\r\n" * 40 + "x"),
    (11, "u", ("WARC/1.1\r\n" * 30)),
    (12, "u", "x" * 300_000),
    (13, "u", "\x00\x01\r"),
]


@pytest.mark.parametrize("chunk_bytes", [7, 64, 1000, warc.CHUNK_BYTES])
def test_round_trip(spark, chunk_bytes):
    rows = AWKWARD if chunk_bytes > 7 else [r for r in AWKWARD if len(r[2] or "") < 1000]
    assert found(warc.round_trip(pages_of(spark, rows), chunk_bytes=chunk_bytes)) == expected(rows)


def test_chunks_are_small_and_carry_running_digests(spark, tmp_path):
    text = "".join(random.Random(1).choices("abcé", k=5000))
    path = str(tmp_path / "archives")
    warc.write_archives(pages_of(spark, [(1, "u", text)]), path, chunk_bytes=512)
    chunks = warc.read_chunks(spark, path).orderBy("chunk").collect()
    assert [r.chunk for r in chunks] == list(range(1, len(chunks) + 1)) and len(chunks) > 10
    sha = hashlib.sha1()
    for r in chunks:
        assert len(r.content) <= 514
        sha.update(r.content)
        assert r.digest == base64.b32encode(sha.digest()).decode()
    assert b"".join(r.content for r in chunks).decode() == text


@pytest.mark.parametrize("chunk_bytes", [5, 16, 64])
def test_no_chunk_holds_or_begins_with_the_boundary(chunk_bytes):
    rng = random.Random(chunk_bytes)
    parts = ["WARC/1.1\r\n", "\r\n", "\r\n\r\n", "W", "é", BOUNDARY]
    for _ in range(300):
        block = "".join(rng.choices(parts, k=30)).encode()
        whole = [(b"HTTP" + block)[a:b] for a, b in warc.cuts(b"HTTP" + block, chunk_bytes)]
        assert b"".join(whole) == b"HTTP" + block
        assert not any(BOUNDARY.encode() in p or p.startswith(b"WARC/1.1\r\n") for p in whole)


def test_repeated_rows_null_ids_and_extra_columns(spark):
    rows = [(1, "u", "long" * 400), (1, "u", "long" * 400), (None, "u", "only null"), (None, "u", "x"), (2, "u", "x")]
    pages = pages_of(spark, rows).withColumn("sha1", F.lit("clash")).withColumn("first", F.lit(1))
    assert found(warc.round_trip(pages, chunk_bytes=300)) == expected(rows)


def test_empty_table(spark):
    assert warc.round_trip(pages_of(spark, [])).count() == 0


def test_a_lost_chunk_is_noticed(spark):
    record = list(warc.records(1, "u", b"x" * 1000, 1, "0-1", 300))
    rows = [warc.parse_segment(r) for r in record]
    assert [r["chunk"] for r in rows] == list(range(1, len(record) + 1))
    with pytest.raises(ValueError, match="cut short"):
        warc.parse_segment(record[0][:-5])


def test_blocks_that_end_in_line_ends_across_read_buffers(spark, tmp_path):
    """The edge of a 64 KiB buffer falls on every byte around the end of a record."""
    ends = ["\r\n\r\n", "\r\n", "\r", "W", "x"]
    n = 0
    for k, end in enumerate(ends):
        for shift in range(24):
            for total in (4096, 65536):
                bare = len(next(warc.records(1, "u", end.encode(), 1, "0-1", 10**6)))
                text = "x" * (total - bare - shift) + end
                parts = [*warc.records(1, "u", text.encode(), 1, "0-1", 10**6)]
                parts += [*warc.records(2, "u", b"", 3, "0-2", 10**6), *warc.records(3, "u", b"", 3, "0-3", 10**6)]
                whole = b"".join(p + warc.RECORD_END.encode() for p in parts)
                (tmp_path / f"{k}-{shift}-{total}.warc").write_bytes(whole)
                n += 1
    rows = warc.read_chunks(spark, str(tmp_path)).collect()
    assert len(rows) == 3 * n
    assert all(sum(r.page_id == i for r in rows) == n for i in (1, 2, 3))


def test_the_mark_of_a_record_in_a_url_and_at_the_end_of_a_page(spark):
    rows = [(1, "http://a/WARC/1.1", "x WARC/1.1"), (2, "WARC/1.1", "WARC/1.1\r\n"), (3, "u", "WWARC/1.1\r\n\r\n"),
            (4, "u", "WARC/1.1" * 9), (5, "u", "")]
    for chunk_bytes in (8, 64, warc.CHUNK_BYTES):
        assert found(warc.round_trip(pages_of(spark, rows), chunk_bytes=chunk_bytes)) == expected(rows)


def test_bytes_after_a_block_are_noticed():
    one, two = (next(warc.records(i, "u", b"a\r\n", i, "0-1", 300)) for i in (1, 2))
    assert warc.parse_segment(one + b"\r\n\r\n")["page_id"] == 1
    with pytest.raises(ValueError, match="bytes follow"):
        warc.parse_segment(one + b"\r\n\r\n" + two)
