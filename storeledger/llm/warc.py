"""Operator 10: WARC archives, one gzip member per record, written and read sequentially.

Writing is per partition: a task writes its records to archive files of its own, rolled at
ARCHIVE_BYTES, and reports them; only reported files are archives, so what a lost or repeated
task leaves behind is never read. Reading streams each archive: members are inflated piece
by piece, framed by Content-Length, and held against the digests in their headers. Memory is
one record and one piece of the file.
"""

from __future__ import annotations

import base64
import hashlib
import urllib.parse
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storeledger.llm import support
from storeledger.llm.support import Scratch

ARCHIVE_BYTES = 64 << 20
PIECE_BYTES = 1 << 18
LEVEL = 6
# Equal payloads of so many bytes at least are stored once.
REVISIT_BYTES = 0
# The table has no time of capture.
NO_DATE = "1970-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_PREFIX = "urn:page:"


class BadRecord(ValueError):
    """A record that is cut short, wrongly framed or does not match its digests."""


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _file_system(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One record: a response with its payload, or a revisit that has the HTTP header only."""
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (b"" if revisit else payload)
    target = urllib.parse.quote(url, safe="%/:=&?~#+!$,;'@()*[]") if url else f"{_PREFIX}{page_id}"
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", f"<{_PREFIX}{page_id}>"),
        ("WARC-Date", NO_DATE),
        ("WARC-Target-URI", target),
        ("WARC-Payload-Digest", f"sha1:{digest(payload)}"),
        ("WARC-Block-Digest", f"sha1:{digest(block)}"),
        *([("WARC-Refers-To", f"<{_PREFIX}{refers_to}>"), ("WARC-Profile", _PROFILE)] if revisit else []),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


class _Member:
    """One gzip member of a stream, inflated piece by piece."""

    def __init__(self, stream, left: bytes):
        self.stream, self.pending = stream, left
        self.inflater = zlib.decompressobj(31)
        self.buffer = bytearray()

    def _more(self) -> bool:
        if self.inflater.eof:
            return False
        self.pending = self.pending or self.stream.read(PIECE_BYTES)
        if not self.pending:
            raise BadRecord("the archive ends inside a record")
        try:
            self.buffer += self.inflater.decompress(self.pending, PIECE_BYTES)
        except zlib.error as error:
            raise BadRecord(f"not a gzip member: {error}") from error
        self.pending = self.inflater.unconsumed_tail
        return True

    def until(self, mark: bytes) -> bytes:
        at = 0
        while (found := self.buffer.find(mark, at)) < 0:
            at = max(0, len(self.buffer) - len(mark))
            if not self._more():
                raise BadRecord("a record without a whole header")
        head = bytes(self.buffer[: found + len(mark)])
        del self.buffer[: found + len(mark)]
        return head

    def exactly(self, size: int) -> bytes:
        while len(self.buffer) < size:
            if not self._more():
                raise BadRecord("a record shorter than its Content-Length")
        data = bytes(self.buffer[:size])
        del self.buffer[:size]
        return data

    def end(self) -> bytes:
        """The bytes after this member; nothing of it may be left."""
        while self._more():
            pass
        if self.buffer:
            raise BadRecord("a record longer than its Content-Length")
        return self.inflater.unused_data


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode().split("\r\n")[1:]
    pairs = (line.partition(":") for line in lines if line)
    return {name.strip().lower(): value.strip() for name, _, value in pairs}


def records(stream) -> Iterator[tuple[dict[str, str], dict[str, str], bytes]]:
    """Header, HTTP header and payload of each record, every digest of what is there verified."""
    left = stream.read(PIECE_BYTES)
    while left:
        own = _Member(stream, left)
        head = own.until(b"\r\n\r\n")
        if not head.startswith(b"WARC/1."):
            raise BadRecord("not a WARC record")
        fields = _fields(head)
        block = own.exactly(int(fields["content-length"]))
        if own.exactly(4) != b"\r\n\r\n":
            raise BadRecord("a record that does not end with two line ends")
        left = own.end() or stream.read(PIECE_BYTES)
        if fields.get("warc-block-digest", "").removeprefix("sha1:") != digest(block):
            raise BadRecord("a block that does not match its digest")
        http, _, payload = block.partition(b"\r\n\r\n")
        if fields["warc-type"] == "response":
            if fields.get("warc-payload-digest", "").removeprefix("sha1:") != digest(payload):
                raise BadRecord("a payload that does not match its digest")
        elif payload:
            raise BadRecord("a revisit with a payload")
        yield fields, _fields(http + b"\r\n"), payload


def write_archives(pages: DataFrame, folder: str, scratch: Scratch, revisit_bytes: int = REVISIT_BYTES) -> DataFrame:
    """A record for each row of `page_id` (long), `url`, `html`; the archives: `path`, `records`, `bytes`.

    Other columns are ignored. The payload is the html in UTF-8 (null: empty). Of rows with
    equal payloads of revisit_bytes or more, those with the least page_id are responses and
    the others revisits of it; rows that repeat the least page_id are responses too. A null
    page_id is never the least. A null url is replaced by the page's own name. No rows give no
    archive. folder: where all executors can write, a path or a URI that pyarrow opens.
    """
    support.prepare(pages.sparkSession)
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).cast("binary").alias("payload"))
    key = F.when(F.octet_length("payload") >= revisit_bytes, F.sha2("payload", 256))
    rows = rows.withColumn("content", key)
    # Only contents that occur again are joined; the others are most.
    firsts = rows.filter("content is not null").groupBy("content")
    firsts = firsts.agg(F.min("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n")
    rows = rows.join(firsts, "content", "left")
    refers = F.when(F.col("page_id").isNull() | (F.col("page_id") != F.col("first")), F.col("first"))
    rows = rows.select("page_id", "url", "payload", refers.alias("refers_to"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, place = _file_system(folder)
        system.create_dir(place, recursive=True)
        out, path, done = None, "", [0, 0]

        def closed() -> pa.RecordBatch:
            out.close()
            columns = [pa.array([path]), pa.array([done[0]]), pa.array([done[1]])]
            return pa.RecordBatch.from_arrays(columns, ["path", "records", "bytes"])

        for batch in batches:
            for page_id, url, payload, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    name = f"{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.gz"
                    path, done = f"{folder}/{name}", [0, 0]
                    out = system.open_output_stream(f"{place}/{name}", compression=None)
                data = member(record(page_id, url, payload, refers_to))
                out.write(data)
                done = [done[0] + 1, done[1] + len(data)]
                if done[1] >= ARCHIVE_BYTES:
                    yield closed()
                    out = None
        if out is not None:
            yield closed()

    return scratch.write(rows.mapInArrow(write, "path string, records long, bytes long"), "archives")


def _page(value: str | None) -> int | None:
    number = (value or "").strip("<>").removeprefix(_PREFIX)
    return int(number) if number.lstrip("-").isdigit() else None


def read_archives(archives: DataFrame, payloads: bool = True) -> DataFrame:
    """A row for each record of the archives in `path`.

    `page_id`, `url`, `payload` (of responses, if asked for), `payload_bytes` and
    `payload_digest` (bare upper-case base32 SHA-1) of the full payload, `record_type`,
    `refers_to`. A damaged archive fails the job. Archives are dealt out one by one.
    """
    support.prepare(archives.sparkSession)
    names = ["page_id", "url", "payload", "payload_bytes", "payload_digest", "record_type", "refers_to"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                system, place = _file_system(path)
                with system.open_input_stream(place, compression=None) as stream:
                    held, size = [], 0
                    for fields, http, payload in records(stream):
                        kind = fields["warc-type"]
                        held.append(
                            (
                                _page(fields["warc-record-id"]),
                                fields["warc-target-uri"],
                                payload if payloads and kind == "response" else None,
                                int(http["content-length"]),
                                fields["warc-payload-digest"].removeprefix("sha1:"),
                                kind,
                                _page(fields.get("warc-refers-to")),
                            )
                        )
                        size += len(payload) if payloads else 0
                        if len(held) >= 2000 or size >= 4 << 20:
                            yield _rows(held)
                            held, size = [], 0
                    if held:
                        yield _rows(held)

    def _rows(held: list[tuple]) -> pa.RecordBatch:
        types = [pa.int64(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.string(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names)

    schema = (
        "page_id long, url string, payload binary, payload_bytes long, payload_digest string, "
        "record_type string, refers_to long"
    )
    tasks = max(1, min(archives.count(), 10_000))
    return archives.select("path").repartition(tasks).mapInArrow(read, schema)
