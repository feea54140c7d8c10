"""WARC archives as tables of chunks.

Payloads are cut into rows of (record, chunk number, bytes) and travel as such in both directions: the writer
appends a record chunk by chunk, the reader returns chunks with the running length and digest. No
task holds more of a record than a chunk (the cell a payload is read from aside).

Archives are gzip files of one member per record under a folder that all executors share. A task writes
files of its own name and returns their paths; only files of finished tasks are read.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import urlsplit

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glossa.llm.common import lean
from glossa.session import scratch_path, write_scratch

NAMESPACE = "urn:page:"
# Digits of base 32 as counted and as RFC 4648 writes them.
_HEX32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


@dataclass(frozen=True)
class WarcSettings:
    """``chunk``: bytes of a chunk row. ``file_bytes``: payload after which a task starts a new archive."""

    chunk: int = 1 << 20
    file_bytes: int = 1 << 29
    date: str = "2024-01-01T00:00:00Z"
    level: int = 1


def sha1_base32(data: Column) -> Column:
    """Upper-case base32 of the SHA-1 of a binary column: five hex digits are four base-32 digits."""
    digits = [
        F.lpad(F.conv(F.substring(F.sha1(data), 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)
    ]
    return F.translate(F.concat(*digits), _HEX32, _BASE32)


def chunk_rows(rows: DataFrame, payload: str, settings: WarcSettings) -> DataFrame:
    """Each row once per chunk of its binary ``payload``, with chunk_no (from 0), chunks and data.

    An empty payload has one empty chunk. The chunks of a row are neighbours, in order.
    """
    count = F.greatest(F.ceil(F.octet_length(payload) / F.lit(settings.chunk)), F.lit(1)).cast("int")
    return (
        rows.withColumn("chunks", count)
        .withColumn("chunk_no", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .withColumn("data", F.substring(F.col(payload), F.col("chunk_no") * settings.chunk + 1, F.lit(settings.chunk)))
        .drop(payload)
    )


def _storage(folder: str):
    """pyarrow file system and path of a folder given as a path or URI."""
    from pyarrow import fs

    if "://" not in folder and not folder.startswith("file:"):
        return fs.LocalFileSystem(), folder
    parts = urlsplit(folder)
    if parts.scheme == "file":
        return fs.LocalFileSystem(), parts.path
    return fs.FileSystem.from_uri(folder.replace("s3a://", "s3://", 1))


def _record_head(page_id, url, kind, refers_to, digest, length: int, settings: WarcSettings) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()
    head = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <{NAMESPACE}{'' if page_id is None else page_id}>",
        f"WARC-Date: {settings.date}",
        # One line whatever the URL holds.
        f"WARC-Target-URI: {' '.join((url or '').split())}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
    ]
    if kind == "revisit":
        head += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: <{NAMESPACE}{refers_to}>",
        ]
    head.append(f"Content-Length: {len(http) + (0 if kind == 'revisit' else length)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + http


def write_archives(chunks: DataFrame, folder: str, settings: WarcSettings = WarcSettings()) -> DataFrame:
    """Write records given as neighbouring chunk rows; returns (path, records, payload_bytes) per file.

    ``chunks``: page_id, url, record_type, refers_to, payload_digest, payload_bytes, chunk_no, chunks,
    data. A row of a revisit has no data. Rows that repeat the record before them are skipped.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        storage, base = _storage(folder)
        storage.create_dir(base, recursive=True)
        made, out, name, records, size, packer, last = [], None, None, 0, 0, None, None

        def end_file():
            nonlocal out
            if out is not None:
                out.close()
                made.append((name, records, size))
                out = None

        for batch in batches:
            cols = {c: batch.column(c) for c in batch.schema.names}
            small = {c: cols[c].to_pylist() for c in cols if c != "data"}
            for i in range(batch.num_rows):
                row = {c: small[c][i] for c in small}
                if row["chunk_no"] == 0:
                    key = (row["page_id"], row["payload_digest"])
                    skip = last == key
                    last = key
                    if skip:
                        packer = None
                        continue
                    if out is not None and size >= settings.file_bytes:
                        end_file()
                    if out is None:
                        file = f"part-{uuid.uuid4().hex}.warc.gz"
                        name = f"{folder.rstrip('/')}/{file}"
                        out, records, size = storage.open_output_stream(f"{base.rstrip('/')}/{file}", compression=None), 0, 0
                    packer = zlib.compressobj(settings.level, zlib.DEFLATED, 31)
                    out.write(packer.compress(_record_head(
                        row["page_id"], row["url"], row["record_type"], row["refers_to"], row["payload_digest"], row["payload_bytes"], settings,
                    )))
                    records += 1
                if packer is None:
                    continue
                if row["record_type"] == "response":
                    data = cols["data"][i].as_buffer()
                    if data is not None:
                        size += len(data)
                        out.write(packer.compress(data))
                if row["chunk_no"] == row["chunks"] - 1:
                    out.write(packer.compress(b"\r\n\r\n") + packer.flush())
        end_file()
        yield pa.RecordBatch.from_pydict(
            {"path": [m[0] for m in made], "records": [m[1] for m in made], "payload_bytes": [m[2] for m in made]},
            schema=pa.schema([("path", pa.string()), ("records", pa.int64()), ("payload_bytes", pa.int64())]),
        )

    files = chunks.mapInArrow(lean(run), "path string, records long, payload_bytes long")
    return write_scratch(files, "archives")


def _number(text: str) -> int | None:
    text = text.strip().strip("<>").removeprefix(NAMESPACE)
    return int(text) if text.lstrip("-").isdigit() else None


class _Reader:
    """Unpacks a file of gzip members piece by piece."""

    def __init__(self, stream, chunk: int):
        self.stream, self.chunk, self.buffer, self.raw, self.unpack, self.over = stream, chunk, b"", b"", None, False

    def _more(self) -> bool:
        while True:
            if not self.raw:
                self.raw = self.stream.read(1 << 18)
                if not self.raw:
                    return False
            if self.unpack is None or self.unpack.eof:
                self.unpack = zlib.decompressobj(31)
            piece = self.unpack.decompress(self.raw, self.chunk)
            self.raw = self.unpack.unused_data if self.unpack.eof else self.unpack.unconsumed_tail
            if piece:
                self.buffer += piece
                return True

    def line(self) -> bytes | None:
        while (at := self.buffer.find(b"\r\n")) < 0:
            if not self._more():
                return None
        line, self.buffer = self.buffer[:at], self.buffer[at + 2 :]
        return line

    def headers(self) -> dict[str, str] | None:
        """Fields up to a blank line, names in lower case; the first line as ''. None at the end."""
        first = self.line()
        if first is None:
            return None
        fields = {"": first.decode("utf-8", "replace")}
        while line := self.line():
            name, _, value = line.decode("utf-8", "replace").partition(":")
            fields[name.strip().lower()] = value.strip()
        return fields

    def take(self, n: int) -> bytes:
        """Up to ``n`` bytes, and up to a chunk."""
        n = min(n, self.chunk)
        while len(self.buffer) < n and self._more():
            pass
        piece, self.buffer = self.buffer[:n], self.buffer[n:]
        return piece


_CHUNK_FIELDS = [
    ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
    ("stated_digest", pa.string()), ("chunk_no", pa.int32()), ("last", pa.bool_()), ("data", pa.binary()),
    ("bytes_so_far", pa.int64()), ("digest_so_far", pa.string()),
]


def _records(storage, path: str, settings: WarcSettings, with_data: bool) -> Iterator[tuple]:
    with storage.open_input_stream(path, compression=None) as stream:
        reader = _Reader(stream, settings.chunk)
        while (head := reader.headers()) is not None:
            if not head[""].startswith("WARC/"):
                raise ValueError(f"{path}: not a WARC record: {head[''][:80]!r}")
            http = reader.headers() or {}
            stated = int(http.get("content-length", 0))
            same = (
                _number(head["warc-record-id"]), head.get("warc-target-uri"), head["warc-type"],
                _number(head["warc-refers-to"]) if "warc-refers-to" in head else None,
                head["warc-payload-digest"].removeprefix("sha1:"),
            )
            if head["warc-type"] == "revisit":
                yield (*same, 0, True, None, stated, same[4])
            else:
                digest, done, number = hashlib.sha1(), 0, 0
                while True:
                    data = reader.take(stated - done)
                    if not data and done < stated:
                        raise ValueError(f"{path}: a record ends early")
                    digest.update(data)
                    done += len(data)
                    yield (*same, number, done == stated, data if with_data else None, done, base64.b32encode(digest.digest()).decode())
                    number += 1
                    if done == stated:
                        break
            reader.line(), reader.line()  # the two line ends after a record


def read_archives(files: DataFrame, settings: WarcSettings = WarcSettings(), with_data: bool = True) -> DataFrame:
    """Chunk rows of the archives in ``files`` (path): the record's fields, chunk_no, last, data, and
    the length and base32 SHA-1 of the payload up to and with this chunk.

    A revisit is one row without data; its length is the one its HTTP header states and its digest that of
    the payload it repeats. Files are read one to a task, in pieces.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(_CHUNK_FIELDS)
        for batch in batches:
            for path in batch.column(0).to_pylist():
                storage, place = _storage(path)
                rows, held = [], 0
                for row in _records(storage, place, settings, with_data):
                    rows.append(row)
                    held += len(row[7] or b"") + 200
                    if held > 4 * settings.chunk:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows), _CHUNK_FIELDS)], schema=schema)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows), _CHUNK_FIELDS)], schema=schema)

    # A number of its own keeps adaptive planning from putting many small rows, and so many files, in one task.
    return files.select("path").repartition(max(1, files.count())).mapInArrow(lean(run),
        "page_id long, url string, record_type string, refers_to long, stated_digest string, chunk_no int, last boolean,"
        " data binary, bytes_so_far long, digest_so_far string",
    )


def payload_digests(chunks: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest) of records given as neighbouring chunk rows, by incremental digests."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest, size = None, 0
        for batch in batches:
            data, ids = batch.column("data"), batch.column("page_id").to_pylist()
            numbers, counts = batch.column("chunk_no").to_pylist(), batch.column("chunks").to_pylist()
            out = []
            for i, number in enumerate(numbers):
                if number == 0:
                    digest, size = hashlib.sha1(), 0
                piece = data[i].as_buffer()
                digest.update(piece)
                size += len(piece)
                if number == counts[i] - 1:
                    out.append((ids[i], size, base64.b32encode(digest.digest()).decode()))
            yield pa.RecordBatch.from_pydict(
                {"page_id": [o[0] for o in out], "payload_bytes": [o[1] for o in out], "payload_digest": [o[2] for o in out]},
                schema=pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string())]),
            )

    return chunks.select("page_id", "chunk_no", "chunks", "data").mapInArrow(lean(run), "page_id long, payload_bytes long, payload_digest string"
    )


def archive_pages(
    pages: DataFrame, folder: str | None = None, least_bytes: int = 0, settings: WarcSettings = WarcSettings()
) -> DataFrame:
    """Write a record per page (page_id, url, html); returns (path, records, payload_bytes) of the archives.

    Of pages with equal payloads of at least ``least_bytes`` bytes the one with the largest page_id is a response and
    the others revisit it; pages with smaller payloads are all responses. The payload is the html in UTF-8.

    * null html: empty payload; null url: empty target; null page_id: a record without a number
    * rows that repeat a page_id are one page: the payload of the smallest digest is written, once
    * empty table: no archive; other columns are not read

    ``folder`` must be shared by all executors; a fresh folder under ``spark.checkpoint.dir`` by default.
    """
    body = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", body.alias("payload"))
    digests = payload_digests(chunk_rows(rows.select("page_id", "payload"), "payload", settings))
    digests = write_scratch(
        digests.groupBy("page_id").agg(F.min(F.struct("payload_digest", "payload_bytes")).alias("d")).select("page_id", "d.*"), "digests"
    )
    groups = write_scratch(
        digests.filter(F.col("payload_bytes") >= least_bytes).groupBy("payload_digest")
        .agg(F.max("page_id").alias("response"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"),
        "equal",
    )
    revisit = F.col("response").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("response"))
    plan = digests.join(groups, "payload_digest", "left").select(
        F.col("page_id").alias("_id"), "payload_digest", "payload_bytes",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("response")).alias("refers_to"),
    )
    keyed = rows.withColumn("_digest", sha1_base32(F.col("payload")))
    full = keyed.join(
        plan.hint("merge"),
        keyed["page_id"].eqNullSafe(plan["_id"]) & (keyed["_digest"] == plan["payload_digest"]),
    )
    full = full.drop("_id", "_digest").sortWithinPartitions("page_id").withColumn(
        "payload", F.when(F.col("record_type") == "response", F.col("payload")).otherwise(F.lit(b""))
    )
    return write_archives(chunk_rows(full, "payload", settings), folder or scratch_path(pages.sparkSession, "warc"), settings)
