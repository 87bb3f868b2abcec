"""WARC archives: one gzip member per record, written and read back by a sequential reader.

An archive is a run of members; each holds a header block and a payload block framed by
Content-Length. The reader feeds compressed bytes to zlib piece by piece, cuts a record where its
member ends, and verifies block and payload digests. It stops at the first damage and reports it.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pacewright.llm.scratch import Scratch

#: Payload bytes after which an archive is closed; compressed bytes fed to zlib at a time.
ARCHIVE_BYTES, FEED = 8 << 20, 1 << 16
#: Payloads of at least so many bytes are stored once.
LEAST_BYTES = 0
_CRLF = b"\r\n"
_DATE = "2024-01-01T00:00:00Z"


def _digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(kind: str, page_id: int | None, uri: str | None, payload: bytes, refers_to: int | None = None) -> bytes:
    """One record as a gzip member: an HTTP response, or a revisit with the HTTP header alone."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http + payload if kind == "response" else http
    head = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:page:{'none' if page_id is None else page_id}>",
        f"WARC-Date: {_DATE}",
        f"WARC-Payload-Digest: sha1:{_digest(payload)}",
        f"WARC-Block-Digest: sha1:{_digest(block)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if uri:
        head.insert(3, "WARC-Target-URI: " + uri.replace("\r", "%0D").replace("\n", "%0A"))
    if kind == "revisit":
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(head).encode() + 2 * _CRLF + block + 2 * _CRLF) + packer.flush()


@dataclass
class Record:
    headers: dict[str, str]
    block: bytes
    error: str | None = None


def _members(pieces: Iterable[bytes]) -> Iterator[bytes]:
    """The contents of each gzip member, decompressed as bytes arrive."""
    unpack, out = zlib.decompressobj(31), []
    fed = False
    for piece in pieces:
        while piece:
            out.append(unpack.decompress(piece))
            fed = True
            piece = unpack.unused_data
            if unpack.eof:
                yield b"".join(out)
                unpack, out, fed = zlib.decompressobj(31), [], False
    if fed:
        raise ValueError("the last member is cut off")


def read(pieces: Iterable[bytes]) -> Iterator[Record]:
    """The records of an archive in order; a last one with an error where it is damaged."""
    try:
        for data in _members(pieces):
            head, gap, rest = data.partition(2 * _CRLF)
            first, *lines = head.decode("utf-8", "replace").split("\r\n")
            headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
            length = int(headers.get("content-length", -1))
            if not first.startswith("WARC/1.") or not gap or length < 0 or len(rest) != length + 4:
                raise ValueError("a record isn't framed by its length")
            block = rest[:length]
            if (want := headers.get("warc-block-digest")) and want != "sha1:" + _digest(block):
                raise ValueError("a block digest differs")
            payload = block.partition(2 * _CRLF)[2]
            if headers.get("warc-type") == "response" and (want := headers.get("warc-payload-digest")) and want != "sha1:" + _digest(payload):
                raise ValueError("a payload digest differs")
            yield Record(headers, block)
    except (ValueError, zlib.error) as e:
        yield Record({}, b"", str(e))


def archives(pages: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """content: archives of all pages, one record each, of about ``ARCHIVE_BYTES`` of payload.

    Of equal payloads of at least ``least_bytes`` the one with the largest page_id is the response; the
    others revisit it. Rows that repeat a page_id each have a record, and revisit by their own payload; those
    that repeat the response whole are responses too. A null html is an empty payload. A row without a
    page_id has a record without one, which is never what others revisit. An empty table gives no archive.
    A payload of any size is one record, which a task holds a few times.
    """
    payload = F.coalesce(F.encode("html", "UTF-8"), F.lit(b""))
    pages = pages.select("page_id", "url", payload.alias("payload")).withColumn("sha1", F.sha1("payload"))
    keyed = pages.select("page_id", "sha1", F.octet_length("payload").alias("n")).where(F.col("n") >= least_bytes)
    # only payloads that occur twice or more are joined back; AQE cuts a hot one's partition
    twice = keyed.groupBy("sha1").agg(F.max("page_id").alias("to"), F.count("*").alias("times")).where("times > 1").drop("times")
    own = keyed.join(twice, "sha1").where(~F.col("to").eqNullSafe(F.col("page_id")))
    own = own.select(F.col("page_id").alias("of"), F.col("sha1").alias("with"), "to").distinct()
    placed = pages.join(own, F.col("page_id").eqNullSafe(F.col("of")) & (F.col("sha1") == F.col("with")), "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0
        for batch in batches:
            for page_id, uri, data, to in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                parts.append(record("response" if to is None else "revisit", page_id, uri, data, to))
                size += len(data)
                if size >= ARCHIVE_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array([b"".join(parts)], pa.binary())], ["content"])
                    parts, size = [], 0
        if parts:
            yield pa.RecordBatch.from_arrays([pa.array([b"".join(parts)], pa.binary())], ["content"])

    return placed.select("page_id", "url", "payload", "to").mapInArrow(run, "content binary")


_SCHEMA = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary, error string"


def records(contents: DataFrame, keep_payload: bool = True) -> DataFrame:
    """Every record of a table of archives (content binary).

    page_id, url, record_type, refers_to, payload_bytes and payload_digest of the full payload, the
    payload (null for revisits), error (null, or what stopped an archive's reader). A null content has no record.
    """

    def page(value: str | None) -> int | None:
        digits = (value or "").rpartition(":")[2].rstrip(">")
        return int(digits) if digits.lstrip("-").isdigit() else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in _SCHEMA.split(", ")]
        types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.string()]
        for batch in batches:
            for content in batch.column(0):
                rows, view = [], memoryview(content.as_buffer() or b"")
                for r in read(view[i : i + FEED] for i in range(0, len(view), FEED)):
                    http, _, payload = r.block.partition(2 * _CRLF)
                    length = next((int(x.split(b":")[1]) for x in http.split(_CRLF) if x.lower().startswith(b"content-length:")), None)
                    kind = r.headers.get("warc-type")
                    rows.append((
                        page(r.headers.get("warc-record-id")), r.headers.get("warc-target-uri"), kind, page(r.headers.get("warc-refers-to")), length,
                        r.headers.get("warc-payload-digest", "").removeprefix("sha1:") or None, payload if keep_payload and kind == "response" else None, r.error,
                    ))
                yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in rows], t) for i, t in enumerate(types)], names)

    return contents.select("content").mapInArrow(run, _SCHEMA)


def read_archives(spark: SparkSession, path: str, keep_payload: bool = True) -> DataFrame:
    """The records of .warc.gz files under a path that Spark can read; a file is read in one task."""
    return records(spark.read.format("binaryFile").load(path), keep_payload)


def round_trip(pages: DataFrame) -> DataFrame:
    """Write all pages to archives in the shared folder and read the records back; a damaged archive is an error."""
    written = Scratch(pages.sparkSession).save(archives(pages))
    found = records(written, keep_payload=False)
    damaged: Column = F.raise_error(F.concat(F.lit("damaged archive: "), "error"))
    return found.select("page_id", "payload_bytes", "payload_digest", F.when(F.col("error").isNotNull(), damaged.cast("string")).otherwise(F.col("record_type")).alias("record_type"), "refers_to")
