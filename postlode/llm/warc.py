"""WARC archives as a chunked record table.

A record's bytes (header, HTTP header, payload, end) are rows of (record_id,
chunk_no, last, data), so a payload of any size passes through tasks a chunk at
a time: the reader carries an incremental digest from chunk to chunk. Records
of one chunk are read where they lie; longer ones are brought together by
record and in order of chunk. Which record others revisit is found from digests
and ids alone; only digests that repeat are joined to the payloads.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlode.shared import arrow_schema, stored


CHUNKS = "record_id string, chunk_no int, last boolean, data binary"
RECORDS = "id string, payload_bytes long, payload_digest string, record_type string, refers_to string"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
#: A record's headers lie in its first chunk up to so many bytes; longer ones run over chunks of that size.
HEADER_BYTES = 1 << 20


def base32(sha1: bytes) -> str:
    return base64.b32encode(sha1).decode()


def _quoted(url: str | None) -> str:
    return quote(url or "", safe=":/?#[]@!$&()*+,;=%~")


def record_uuid(page: str, digest: str) -> str:
    """The id of the record of a page and payload; rows that repeat both are one record, captured again."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{digest}/{page}')}>"


def header(page: str, url: str | None, digest: str, payload_bytes: int, refers_to: str | None, refers_url: str | None = None, date: str = "1970-01-01T00:00:00Z") -> bytes:
    """The lines before a record's block. Urls and page ids are quoted."""
    kind = "response" if refers_to is None else "revisit"
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Date: {date}", f"WARC-Record-ID: {record_uuid(page, digest)}", f"WARC-Target-URI: {_quoted(url)}", f"WARC-Payload-Digest: sha1:{digest}", f"X-Page-Id: {quote(page, safe='')}", f"X-Payload-Bytes: {payload_bytes}", "Content-Type: application/http; msgtype=response"]
    if refers_to is not None:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {record_uuid(refers_to, digest)}", f"WARC-Refers-To-Target-URI: {_quoted(refers_url)}", f"X-Refers-To-Page-Id: {quote(refers_to, safe='')}"]
    lines.append(f"Content-Length: {len(HTTP) + (payload_bytes if refers_to is None else 0)}")
    return "\r\n".join([*lines, "", ""]).encode()


def repeated_payloads(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_bytes: int = 0) -> DataFrame:
    """(digest, first, first_url): of payloads of min_bytes at least that several rows hold, the smallest id, and the smallest url of that."""
    payload = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    rows = pages.select(F.unhex(F.sha1(payload)).alias("digest"), F.octet_length(payload).alias("n"), F.col(id_col).alias("id"), F.col(url_col).alias("url"))
    # null ids come first in a least struct, so they are told apart
    least = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "url"))
    found = rows.where(F.col("n") >= min_bytes).groupBy("digest").agg(F.count("*").alias("times"), least.alias("least"))
    return found.where("times > 1 and least.id is not null").select("digest", F.col("least.id").alias("first"), F.col("least.url").alias("first_url"))


def write_records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_bytes: int = 0, chunk_bytes: int = 1 << 20, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """The chunk table of one record for each row of pages, written to the shared folder.

    Of records with equal payloads of at least min_bytes, that with the
    smallest id is a response and the others revisit it; rows that repeat an id
    and its payload are alike. A null id never is a response to others; null
    payloads are empty ones. date is that of the capture. The table of repeated
    digests is written first: Spark knows its size, broadcasts it if it is
    small, and else splits the rows of a hot digest.
    """
    repeated = stored(repeated_payloads(pages, id_col, url_col, html_col, min_bytes), "repeated").withColumnRenamed("digest", "_digest")
    payload = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), payload.alias("payload"), F.unhex(F.sha1(payload)).alias("digest"))
    joined = rows.join(repeated, F.col("digest") == F.col("_digest"), "left")
    refers = F.when(F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("id")), F.col("first"))
    rows = joined.select(F.coalesce(F.col("id").cast("string"), F.lit("")).alias("id"), "url", "payload", "digest", refers.cast("string").alias("refers_to"), "first_url")
    out = arrow_schema(CHUNKS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), 0
        ready: list[tuple] = []
        held = 0
        for batch in batches:
            ids, urls, digests, refers, first_urls = (batch.column(c).to_pylist() for c in ("id", "url", "digest", "refers_to", "first_url"))
            payloads = batch.column("payload")
            for i, page in enumerate(ids):
                body = memoryview(payloads[i].as_buffer())
                record, at = str(uuid.uuid5(uuid.NAMESPACE_OID, f"{part}/{at}/{page}")), at + 1
                head = header(page, urls[i], base32(digests[i]), len(body), refers[i], first_urls[i], date) + HTTP
                body = body if refers[i] is None else body[:0]
                places = range(0, max(1, len(body)), chunk_bytes)
                # of a long header all but the last piece are chunks without payload
                heads = [head[i : i + HEADER_BYTES] for i in range(0, len(head), HEADER_BYTES)]
                pieces = [(h, None) for h in heads[:-1]] + [(heads[-1] if start == 0 else b"", start) for start in places]
                for k, (before, start) in enumerate(pieces):
                    data, last = b"" if start is None else bytes(body[start : start + chunk_bytes]), k == len(pieces) - 1
                    data = before + data + (b"\r\n\r\n" if last else b"")
                    ready.append((record, k, last, data))
                    held += len(data)
                    if held >= 4 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*ready, strict=True), out, strict=True)], schema=out)
                        ready, held = [], 0
        if ready:
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*ready, strict=True), out, strict=True)], schema=out)

    return stored(rows.mapInArrow(run, CHUNKS), "warc")


class Reader:
    """One record, fed with its chunks in order. It keeps the headers, a digest and counts, never the payload."""

    def __init__(self) -> None:
        self.fields: dict[str, str] | None = None
        self.head, self.seen = bytearray(), 0

    def feed(self, data: bytes) -> None:
        if self.fields is None:
            self.head += data
            # the blank lines that end the WARC header and the HTTP header
            first = self.head.find(b"\r\n\r\n", self.seen)
            end = first + 4
            second = self.head.find(b"\r\n\r\n", end) if first >= 0 else -1
            if second < 0:
                self.seen = first if first >= 0 else max(0, len(self.head) - 3)
                return
            start, data, self.head = second + 4, bytes(self.head), bytearray()
            self.fields = dict(line.split(": ", 1) for line in data[:end].decode().split("\r\n")[1:-2])
            self.left = int(self.fields["Content-Length"]) - (start - end)
            self.payload_bytes, self.digest = self.left, hashlib.sha1()
            data = memoryview(data)[start:]
        own = memoryview(data)[: self.left]
        self.digest.update(own)
        self.left -= len(own)

    def result(self) -> tuple:
        if (f := self.fields) is None:
            raise ValueError("damaged record without the end of its header")
        revisit = f["WARC-Type"] == "revisit"
        digest, stated = base32(self.digest.digest()), f["WARC-Payload-Digest"].removeprefix("sha1:")
        if self.left or not revisit and digest != stated:
            raise ValueError(f"damaged record {f['WARC-Record-ID']}")
        refers = f.get("X-Refers-To-Page-Id")
        return unquote(f["X-Page-Id"]), int(f["X-Payload-Bytes"]) if revisit else self.payload_bytes, stated if revisit else digest, f["WARC-Type"], refers and unquote(refers)


def read_records(chunks: DataFrame) -> DataFrame:
    """(id, payload_bytes, payload_digest, record_type, refers_to) of each record of a chunk table.

    Sizes and digests of responses come from the bytes that were read; a record
    whose bytes are missing or differ from its digest fails the job.
    """
    out = arrow_schema(RECORDS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, record, expected = None, None, 0
        for batch in batches:
            rows = []
            data = batch.column("data")
            for i, (name, k, last) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("record_id", "chunk_no", "last")), strict=True)):
                if k == 0:
                    reader, record, expected = Reader(), name, 0
                if reader is None or record != name or k != expected:
                    raise ValueError(f"chunk {k} of record {name} is out of order")
                reader.feed(data[i].as_py())
                expected += 1
                if last:
                    rows.append(reader.result())
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True) if rows else [()] * len(out), out, strict=True)], schema=out)

    single = F.col("last") & (F.col("chunk_no") == 0)
    longer = chunks.where(~single).repartition("record_id").sortWithinPartitions("record_id", "chunk_no")
    return chunks.where(single).mapInArrow(run, RECORDS).unionByName(longer.mapInArrow(run, RECORDS))
