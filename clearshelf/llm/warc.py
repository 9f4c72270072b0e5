"""WARC archives of pages, written and read as a table of chunks.

A record block longer than a chunk is written as WARC segments: the first record and its
continuations, each a row of (record, chunk number) with the SHA-1 of the payload so far. Writer
and reader hold one chunk beside the row they are at.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clearshelf.llm.common import arrow_map, utf8
from clearshelf.sources.tables import fresh_path, stage

CHUNK_BYTES = 64 * 1024
# Fixed values of the format.
VERSION = b"WARC/1.1\r\n"
RECORD_END = "\r\n\r\n"
BOUNDARY = RECORD_END + VERSION.decode()
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: The reader splits at ``VERSION``. Its first byte stands in it once: a line reader that does not
#: back up over the edge of its buffer cannot miss it, whatever bytes a block ends in.
MARK = "WARC/1.1"
_MARKS = re.compile(re.escape(MARK.encode()))


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def cuts(block: bytes, chunk_bytes: int, head: int = 0) -> Iterator[tuple[int, int]]:
    """(start, end) of the chunks of a block; the first one has ``head`` bytes more.

    Chunks end between UTF-8 characters. No chunk holds ``MARK``, with which the line that begins a
    record begins, so that a reader may split at that line: a cut falls inside the mark wherever
    the block has it.
    """
    forced = iter([m.start() + 2 for m in _MARKS.finditer(block)])
    start, size, inside = 0, len(block), next(forced, None)
    while True:
        end = min(start + chunk_bytes + (head if start == 0 else 0), size)
        while start + 1 < end < size and block[end] & 0xC0 == 0x80:
            end -= 1
        while inside is not None and inside <= start:
            inside = next(forced, None)
        if inside is not None and inside < end:
            end = inside
        yield start, end
        if end >= size:
            return
        start = end


def _header(fields: list[tuple[str, object]]) -> bytes:
    return VERSION + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n"


def _record_id(page_id: object, digest: str) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.md5(f'{page_id}|{digest}'.encode()).digest())}>"


def _one_line(url: str | None) -> str:
    escaped = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "")
    return escaped.replace(MARK, f"%{ord(MARK[0]):02X}{MARK[1:]}")


def records(
    page_id: int | None, url: str | None, payload: bytes, first: int | None, row: str, chunk_bytes: int
) -> Iterator[bytes]:
    """The segments of one page's record, each header and block.

    ``first`` is the id of the page that holds the payload; any other page becomes a revisit
    without a payload.
    """
    whole = hashlib.sha1()
    view = memoryview(payload)
    for at in range(0, len(view), chunk_bytes):
        whole.update(view[at : at + chunk_bytes])
    digest = base32(whole.digest())
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    own = _record_id(page_id, digest)
    common = [
        ("WARC-Target-URI", _one_line(url)),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("X-Page-ID", "" if page_id is None else page_id),
        ("X-Row", row),
    ]
    if first != page_id:
        fields = [
            ("WARC-Type", "revisit"),
            ("WARC-Record-ID", own),
            ("WARC-Profile", REVISIT_PROFILE),
            ("WARC-Refers-To", _record_id(first, digest)),
            ("X-Refers-To-Page", first),
        ]
        yield _header([*fields, *common, ("Content-Length", len(http))]) + http
        return
    block = http + payload
    pieces = list(cuts(block, chunk_bytes, len(http)))
    running = hashlib.sha1()
    for k, (start, end) in enumerate(pieces, 1):
        body = memoryview(block)[max(start, len(http)) : max(end, len(http))]
        running.update(body)
        kind = [("WARC-Type", "response"), ("WARC-Record-ID", own)]
        if k > 1:
            kind = [
                ("WARC-Type", "continuation"),
                ("WARC-Record-ID", _record_id(f"{page_id}#{k}", digest)),
                ("WARC-Segment-Origin-ID", own),
            ]
        if len(pieces) > 1:
            kind += [("WARC-Segment-Number", k), ("X-Running-Digest", base32(running.digest()))]
            if k == len(pieces):
                kind.append(("WARC-Segment-Total-Length", len(block)))
        yield _header([*kind, *common, ("Content-Length", end - start)]) + block[start:end]


def write_archives(
    pages: DataFrame,
    path: str,
    *,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    chunk_bytes: int = CHUNK_BYTES,
) -> None:
    """Write a record per row of ``pages`` to gzip WARC files under ``path``.

    Of equal payloads, by SHA-1, the row of the largest id is the response, the others revisit it.
    A null html is an empty payload. A null id never refers to itself unless all ids of its payload
    are null; rows that repeat the largest id are responses too. A null url is written empty.
    """
    html = F.coalesce(F.col(html_col), F.lit(""))
    rows = pages.select(
        F.col(id_col).alias("page_id"),
        F.col(url_col).cast("string").alias("url"),
        html.alias("html"),
        F.sha1(html.cast("binary")).alias("sha1"),
    )
    first = rows.groupBy("sha1").agg(F.max("page_id").alias("first"))
    named = rows.join(first, "sha1").select("page_id", "url", "first", "html")

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, n = TaskContext.get().partitionId(), 0
        for batch in batches:
            ids, urls, firsts = (batch.column(i).to_pylist() for i in range(3))
            out, held = [], 0
            for page_id, url, first_id, payload in zip(ids, urls, firsts, utf8(batch, "html")):
                n += 1
                for segment in records(page_id, url, payload, first_id, f"{task}-{n}", chunk_bytes):
                    out.append(segment)
                    held += len(segment)
                    if held > 64 * chunk_bytes:
                        yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], ["value"])
                        out, held = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], ["value"])

    lines = arrow_map(named, segments, "value string")
    lines.write.option("compression", "gzip").option("lineSep", RECORD_END).text(path)


CHUNKS = T.StructType(
    [
        T.StructField("page_id", T.LongType()),
        T.StructField("record_type", T.StringType()),
        T.StructField("refers_to", T.LongType()),
        T.StructField("record", T.StringType()),
        T.StructField("chunk", T.IntegerType()),
        T.StructField("payload_bytes", T.LongType()),
        T.StructField("stated", T.StringType()),
        T.StructField("digest", T.StringType()),
        T.StructField("content", T.BinaryType()),
    ]
)


def parse_segment(value: bytes) -> dict | None:
    """A segment as a row of ``CHUNKS``; ``content`` only for a part of a longer record.

    None for the nothing before the first record of a file. After the block only the record's end
    may follow.
    """
    if value.startswith(VERSION):
        value = value[len(VERSION) :]
    if not value:
        return None
    head, mark, rest = value.partition(b"\r\n\r\n")
    if not mark:
        raise ValueError("a record has no end of its header")
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n"))
    length = int(fields["Content-Length"])
    block = memoryview(rest)[:length]
    if len(block) != length:
        raise ValueError(f"record {fields['WARC-Record-ID']} is cut short")
    if rest[length:] not in (b"", RECORD_END.encode()):
        raise ValueError(f"bytes follow the block of record {fields['WARC-Record-ID']}")
    chunk = int(fields.get("WARC-Segment-Number", 0))
    row = {
        "page_id": int(fields["X-Page-ID"]) if fields["X-Page-ID"] else None,
        "record_type": fields["WARC-Type"],
        "refers_to": int(fields["X-Refers-To-Page"]) if "X-Refers-To-Page" in fields else None,
        "record": fields["X-Row"],
        "chunk": chunk,
        "stated": fields["WARC-Payload-Digest"].removeprefix("sha1:"),
    }
    if chunk <= 1:
        at = rest.index(b"\r\n\r\n") + 4
        row["payload_bytes"] = int(re.search(rb"Content-Length: (\d+)", rest[:at])[1])
        block = block[at:]
    if fields["WARC-Type"] == "revisit":
        row["digest"] = row["stated"]
    elif chunk == 0:
        row["digest"] = base32(hashlib.sha1(block).digest())
    else:
        row["digest"], row["content"] = fields["X-Running-Digest"], bytes(block)
    return row


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    """The segments of the archives under ``path`` as a table of chunks."""

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        schema = to_arrow_schema(CHUNKS)
        for batch in batches:
            rows = [r for v in utf8(batch, "value") if (r := parse_segment(v))]
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    lines = spark.read.option("lineSep", VERSION.decode()).schema("value string").text(path)
    return arrow_map(lines, parsed, CHUNKS)


def _folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks in the order of record and number to one row per record, one chunk at a time."""
    record, sha, size, first, due = None, None, 0, None, 0

    def ended() -> list[dict]:
        if record is None:
            return []
        if size != first["payload_bytes"]:
            raise ValueError(f"record {record} has {size} of {first['payload_bytes']} bytes")
        return [{**first, "digest": base32(sha.digest())}]

    names = ("page_id", "record_type", "refers_to", "payload_bytes", "stated", "digest")
    fields = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
    schema = pa.schema(list(zip(names, fields)))
    for batch in batches:
        done: list[dict] = []
        columns = [batch.column(i) for i in range(batch.num_columns)]
        for i in range(batch.num_rows):
            row = {f.name: c[i].as_py() for f, c in zip(batch.schema, columns)}
            if row["record"] != record:
                done += ended()
                record, sha, size, due = row["record"], hashlib.sha1(), 0, 1
                first = {k: row[k] for k in names}
            if row["chunk"] != due:
                raise ValueError(f"record {record} lacks chunk {due}")
            due += 1
            sha.update(row["content"])
            size += len(row["content"])
            if base32(sha.digest()) != row["digest"]:
                raise ValueError(f"record {record}, chunk {row['chunk']}: digest differs")
        yield pa.RecordBatch.from_pylist(done, schema=schema)
    yield pa.RecordBatch.from_pylist(ended(), schema=schema)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per record: ``page_id``, ``payload_bytes``, ``payload_digest``, ``record_type``,
    ``refers_to``, ``digest_ok``.

    The digest is that of the payload as read; a record in chunks is folded chunk by chunk, and its
    running digests must agree. A revisit has the size and digest its record states.
    """
    chunks = stage(read_chunks(spark, path), "chunks")
    names = ["page_id", "record_type", "refers_to", "payload_bytes", "stated", "digest"]
    whole = chunks.where(F.col("chunk") == 0).select(*names)
    parts = chunks.where(F.col("chunk") > 0).repartition("record")
    folded = arrow_map(parts.sortWithinPartitions("record", "chunk"), 
        _folded,
        "page_id long, record_type string, refers_to long, payload_bytes long, stated string, "
        "digest string",
    )
    return whole.union(folded).select(
        "page_id",
        "payload_bytes",
        F.col("digest").alias("payload_digest"),
        "record_type",
        "refers_to",
        (F.col("digest") == F.col("stated")).alias("digest_ok"),
    )


def round_trip(pages: DataFrame, *, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Write ``pages`` to archives in the shared folder and read them back."""
    path = fresh_path(pages.sparkSession, "archives")
    write_archives(pages, path, chunk_bytes=chunk_bytes)
    return read_archives(pages.sparkSession, path)
