"""Web archive files written from and read to a chunked record table.

A payload is never one value on the way: it is rows of record number, chunk number and bytes, in
order inside their partition. A writing task streams the chunks of its records into archive files
of bounded size, one gzip member for each record, feeding the digest as it goes. A reading
task streams an archive through a parser that holds one chunk and a line of headers, checks every
payload against its length and digest, and gives chunk rows again.

Files are written under another name and renamed when complete; only the names that finished tasks
return are read, so what a lost task leaves is never read. Paths may be of any file system that
pyarrow can open, the shared folder's included.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import shared_folder
from ..sources.staging import stage
from .common import column_lists, map_batches

#: Bytes of a payload in one row.
CHUNK = 256 << 10
#: Payload bytes after which an archive is closed.
ARCHIVE = 256 << 20
#: Payloads under this many bytes never become revisits.
LEAST = 100

# The record format's version line and its profile for equal payloads.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: All records carry this date, since the input has none; a run gives the same bytes each time.
DATE = "2000-01-01T00:00:00Z"

CHUNKS = "record long, chunk int, last boolean, data binary"


def chunked(records: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Rows ``record``, ..., ``chunk``, ``last``, ``data`` of rows with a binary ``payload``; one at least each."""
    count = F.greatest(F.lit(1), F.ceil(F.octet_length("payload") / chunk)).cast("int")
    rest = [c for c in records.columns if c != "payload"]
    rows = records.withColumn("chunk", F.explode(F.sequence(F.lit(0), count - 1)))
    data = F.expr(f"substring(payload, chunk * {chunk} + 1, {chunk})")
    return rows.select(*rest, "chunk", (F.col("chunk") == count - 1).alias("last"), data.alias("data"))


def header(fields: dict[str, str]) -> bytes:
    lines = [VERSION, *(f"{k}: {v}" for k, v in fields.items()), "", ""]
    return "\r\n".join(lines).encode("utf-8")


def _name(page: int | None, record: int | None = None) -> str:
    """Record identifier: a response is named by its page, so that revisits can refer to it."""
    return f"<urn:page:{'' if page is None else page}{'' if record is None else f':{record}'}>"


def _page_of(name: str) -> int | None:
    page = name.strip("<>").split(":")[2]
    return int(page) if page else None


class ArchiveWriter:
    """Archives of bounded size in one folder; each record is a gzip member of its own."""

    def __init__(self, folder: str, limit: int):
        self.system, self.folder = pafs.FileSystem.from_uri(folder)
        self.limit = limit
        self.file = None
        self.names: list[str] = []

    def begin(self, fields: dict[str, str]) -> None:
        if self.file is None:
            self.path = f"{self.folder}/{uuid.uuid4().hex}.warc.gz"
            self.file = self.system.open_output_stream(self.path + ".part", compression=None)
            self.size = 0
        self.member = zlib.compressobj(6, zlib.DEFLATED, 31)
        self._put(header(fields))

    def _put(self, data: bytes) -> None:
        self.file.write(self.member.compress(data))

    def data(self, data: bytes) -> None:
        self.size += len(data)
        self._put(data)

    def end(self) -> None:
        self._put(b"\r\n\r\n")
        self.file.write(self.member.flush())
        if self.size >= self.limit:
            self.close()

    def close(self) -> None:
        if self.file is not None:
            self.file.close()
            self.system.move(self.path + ".part", self.path)
            self.names.append(self.path.rsplit("/", 1)[1])
            self.file = None


def _write(folder: str, limit: int) -> Callable:
    """Chunk rows of whole records, in order, to names of archives."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = ArchiveWriter(folder, limit)
        digest, seen = None, 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                record, page, url, size, expected, kind, refers, chunk, last, data = row
                if chunk == 0:
                    fields = {
                        "WARC-Type": kind,
                        "WARC-Record-ID": _name(page, None if kind == "response" and page is not None else record),
                        "WARC-Date": DATE,
                        "WARC-Target-URI": " ".join((url or "").split()),
                        "WARC-Payload-Digest": f"sha256:{expected}",
                        "Content-Type": "text/html",
                        "Content-Length": str(size if kind == "response" else 0),
                    }
                    if kind == "revisit":
                        fields |= {"WARC-Profile": PROFILE, "WARC-Refers-To": _name(refers), "X-Payload-Length": str(size)}
                    writer.begin(fields)
                    digest, seen = hashlib.sha256(), 0
                digest.update(data)
                seen += len(data)
                if kind == "response":
                    writer.data(data)
                if last:
                    if seen != size or digest.hexdigest() != expected:
                        raise ValueError(f"Record {record}: the chunks don't make up the payload.")
                    writer.end()
        writer.close()
        yield pa.RecordBatch.from_arrays([pa.array(writer.names, pa.string())], ["archive"])

    return run


def parsed(stream: Iterator[bytes], chunk: int) -> Iterator[tuple[dict[str, str] | None, bytes | None]]:
    """Headers of each record, then its payload in pieces: ``(fields, None)``, ``(None, piece)``, ...

    Holds the unread part of one piece. A record that breaks off raises ``ValueError``.
    """
    held, ended = bytearray(), False

    def more() -> bool:
        nonlocal ended
        piece = next(stream, None)
        ended = piece is None
        held.extend(piece or b"")
        return not ended

    while True:
        while held[:2] == b"\r\n":
            del held[:2]
        while len(held) < 2 and more():
            pass
        if held[:2] == b"\r\n":
            continue
        if not held:
            return
        end = held.find(b"\r\n\r\n")
        while end < 0:
            if not more():
                raise ValueError("An archive ends inside a header.")
            end = held.find(b"\r\n\r\n")
        lines = bytes(held[:end]).decode("utf-8").split("\r\n")
        del held[: end + 4]
        fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(": "), "") for line in lines[1:])
        yield fields, None
        left = int(fields["Content-Length"])
        while left:
            if not held and not more():
                raise ValueError("An archive ends inside a payload.")
            piece = bytes(held[: min(left, chunk)])
            del held[: len(piece)]
            left -= len(piece)
            if piece:
                yield None, piece


def unzipped(file: object, size: int) -> Iterator[bytes]:
    """Bytes of a file of gzip members, in pieces of at most ``size``."""
    machine = zlib.decompressobj(31)
    while data := file.read(size):
        full = False  # more may come out without more going in
        while data or full:
            out = machine.decompress(data, size)
            if out:
                yield out
            data, full = machine.unconsumed_tail, len(out) == size
            if machine.eof:
                data, machine, full = machine.unused_data, zlib.decompressobj(31), False


RECORDS = "archive string, at long, page long, kind string, url string, size long, digest string, refers long"


def _read(folder: str, chunk: int, payloads: bool) -> Callable:
    """Names of archives to their records, or to the chunk rows of their payloads."""

    def records(name: str) -> Iterator[tuple]:
        system, base = pafs.FileSystem.from_uri(folder)
        with system.open_input_stream(f"{base}/{name}", compression=None) as file:
            fields, number, at, digest, seen = None, -1, 0, None, 0

            def closed() -> tuple:
                revisit = fields["WARC-Type"] == "revisit"
                stated = fields["WARC-Payload-Digest"].split(":", 1)[1]
                if not revisit and (digest.hexdigest() != stated or seen != int(fields["Content-Length"])):
                    raise ValueError(f"{name}: record {number} doesn't match its digest.")
                size = int(fields["X-Payload-Length"]) if revisit else seen
                refers = _page_of(fields["WARC-Refers-To"]) if revisit else None
                url = fields["WARC-Target-URI"]
                return name, number, _page_of(fields["WARC-Record-ID"]), fields["WARC-Type"], url, size, stated, refers

            for new, piece in parsed(unzipped(file, chunk), chunk):
                if new is not None:
                    if fields is not None and not payloads:
                        yield closed()
                    fields, number, at, digest, seen = new, number + 1, 0, hashlib.sha256(), 0
                    continue
                digest.update(piece)
                seen += len(piece)
                if payloads:
                    yield name, number, at, piece
                    at += 1
            if fields is not None and not payloads:
                yield closed()

    kinds = {"archive": pa.string(), "at": pa.int64()}
    if payloads:
        kinds |= {"chunk": pa.int32(), "data": pa.binary()}
    else:
        kinds |= {
            "page": pa.int64(), "kind": pa.string(), "url": pa.string(), "size": pa.int64(), "digest": pa.string(), "refers": pa.int64(),
        }
    most = 16 if payloads else 2000

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for (names,) in column_lists(batches):
            for name in names:
                for row in records(name):
                    rows.append(row)
                    if len(rows) >= most:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds.values())], [*kinds])
                        rows = []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds.values())], [*kinds])

    return run


def described(pages: DataFrame, id_column: str = "page_id", payload_column: str = "html", url_column: str = "url", least: int = LEAST) -> DataFrame:
    """What to write of each row: ``record``, ``page``, ``url``, ``size``, ``digest``, ``kind``, ``refers``, ``payload``.

    Of equal payloads of at least ``least`` bytes the row of the smallest id is a response and the
    others revisit it. Rows that share the smallest id are all responses, since none can refer to
    another. Null ids rank last; where all ids are null, all rows are responses.
    """
    payload = F.encode(F.coalesce(F.col(payload_column).cast("string"), F.lit("")), "utf-8")
    rows = pages.select(
        F.monotonically_increasing_id().alias("record"),
        F.col(id_column).cast("long").alias("page"),
        F.col(url_column).cast("string").alias("url"),
        payload.alias("payload"),
    )
    rows = rows.withColumn("size", F.octet_length("payload").cast("long")).withColumn("digest", F.sha2("payload", 256))
    slim = rows.select("page", "size", "digest").filter(F.col("size") >= least)
    # Only payloads that come again are looked up; the counting combines before its shuffle.
    again = slim.groupBy("digest").agg(F.min("page").alias("refers"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    found = rows.join(again.select(F.col("digest").alias("same"), "refers"), F.col("digest") == F.col("same"), "left")
    revisit = F.col("refers").isNotNull() & ((F.col("page") != F.col("refers")) | F.col("page").isNull())
    return found.select(
        "record",
        "page",
        "url",
        "size",
        "digest",
        F.when(revisit, "revisit").otherwise("response").alias("kind"),
        F.when(revisit, F.col("refers")).alias("refers"),
        "payload",
    )


def write_archives(
    pages: DataFrame,
    folder: str,
    id_column: str = "page_id",
    payload_column: str = "html",
    url_column: str = "url",
    least: int = LEAST,
    chunk: int = CHUNK,
    archive: int = ARCHIVE,
) -> DataFrame:
    """Write the rows of ``pages`` as records into archives in ``folder``; the archives' names, written down.

    Null payloads count as empty, null URLs as blank. Without rows there are no archives.
    """
    system, base = pafs.FileSystem.from_uri(folder)
    system.create_dir(base, recursive=True)
    rows = chunked(described(pages, id_column, payload_column, url_column, least), chunk)
    return stage(map_batches(rows, _write(folder, archive), "archive string"), "archives")


def read_records(names: DataFrame, folder: str, chunk: int = CHUNK) -> DataFrame:
    """One row per record of the named archives, in whatever order; payloads are checked, not kept."""
    return map_batches(_dealt(names), _read(folder, chunk, False), RECORDS)


def read_chunks(names: DataFrame, folder: str, chunk: int = CHUNK) -> DataFrame:
    """The payloads of the named archives as rows ``archive``, ``at``, ``chunk``, ``data``."""
    return map_batches(_dealt(names), _read(folder, chunk, True), "archive string, at long, chunk int, data binary")


def _dealt(names: DataFrame) -> DataFrame:
    """One archive to a task, as far as there are tasks."""
    spark = names.sparkSession
    count = max(1, min(names.count(), 16 * spark.sparkContext.defaultParallelism))
    return names.select("archive").repartition(count)


def archived(pages: DataFrame, id_column: str = "page_id", payload_column: str = "html", url_column: str = "url") -> DataFrame:
    """Write ``pages`` to archives in the shared folder and read them back, one row per input row.

    id, ``payload_bytes``, ``payload_digest``, ``record_type``, ``refers_to`` and ``url``. Cases as in
    ``described`` and ``write_archives``; other columns are not read.
    """
    root = shared_folder(pages.sparkSession).rstrip("/")
    folder = f"{root if ':/' in root else 'file://' + root}/warc/{uuid.uuid4().hex}"
    names = write_archives(pages, folder, id_column, payload_column, url_column)
    return read_records(names, folder).select(
        F.col("page").alias(id_column),
        F.col("size").alias("payload_bytes"),
        F.col("digest").alias("payload_digest"),
        F.col("kind").alias("record_type"),
        F.col("refers").alias("refers_to"),
        "url",
    )
