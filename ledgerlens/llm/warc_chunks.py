"""WARC archives written and read as tables of payload chunks.

A payload travels as rows (record, chunk number, bytes) of at most ``CHUNK``
bytes. The writer streams the chunks of a record into a gzip member of its own,
the reader streams members back into chunk rows, and both carry a SHA-1 that
grows chunk by chunk, so no Python process ever holds a whole payload. Each
chunk row shows the digest of all bytes up to its end; the last one's is the
payload's, and it must equal the one in the record's header.

Of records with equal payloads one is a response and the others are revisits
that name it and carry no payload. Equal payloads meet by digest and size,
counted per task before the shuffle; groups of one never meet anything.

Archives lie in the shared folder. A file's name holds the attempt that wrote
it and only files listed in the returned index are read, so files of lost
attempts stand aside.
"""

from __future__ import annotations

import base64
import hashlib
import urllib.parse
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if_small, scratch_path, written

#: Bytes in a chunk row at most.
CHUNK = 64 * 1024
#: An archive is closed when it has this many bytes.
ARCHIVE_BYTES = 256 * 1024 * 1024
LEVEL = 3

INDEX = "archive string, offset long, page_id long, record_type string"
CHUNKS = ("archive string, offset long, chunk_no long, n_bytes long, digest string, page_id long, "
          "record_type string, refers_to long, payload_bytes long, payload_digest string")


def base32(sha1: bytes) -> str:
    return base64.b32encode(sha1).decode("ascii")


def typed(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, record_type, refers_to, sha1.

    The largest page_id of equal payloads is the response; null ids rank below
    all others. Rows repeated with the response's page_id are that capture
    written again and responses too. Digests and sizes alone meet; the groups of
    several, counted, go back to the payloads, which are not dealt anew while
    the groups fit a broadcast.
    """
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).cast("binary").alias("payload"))
    keyed = rows.withColumn("sha1", F.sha1("payload")).withColumn("_bytes", F.length("payload"))
    copied = (keyed.groupBy("sha1", "_bytes").agg(F.max("page_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
              .where("_n > 1").drop("_n"))
    revisit = F.col("_first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_first"))
    return keyed.join(broadcast_if_small(copied), ["sha1", "_bytes"], "left").select(
        "page_id", "url", "payload", F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("_first")).alias("refers_to"), "sha1")


def chunked(records: DataFrame) -> DataFrame:
    """A row for each chunk, the chunks of a record in order and together; a
    record without bytes has one empty chunk. A row is made for each number and
    takes its bytes then, so that the chunks of a record are never held beside it."""
    n_bytes = F.length("payload")
    numbers = F.sequence(F.lit(0), F.floor(F.greatest(n_bytes - 1, F.lit(0)) / CHUNK).cast("int"))
    return records.select("*", n_bytes.alias("n_bytes"), F.explode(numbers).alias("chunk_no")).select(
        "page_id", "url", "record_type", "refers_to", "sha1", "n_bytes", "chunk_no",
        F.substring("payload", F.col("chunk_no") * CHUNK + 1, F.lit(CHUNK)).alias("data"))


def _http(n_bytes: int) -> bytes:
    return (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n_bytes}\r\n\r\n").encode()


def _header(row: dict) -> bytes:
    """Header of a record and the HTTP lines of its block."""
    http = _http(row["n_bytes"])
    kept = row["n_bytes"] if row["record_type"] == "response" else 0
    lines = ["WARC/1.1", f"WARC-Type: {row['record_type']}", f"WARC-Record-ID: <urn:page:{_id(row['page_id'])}>",
             "WARC-Date: 1970-01-01T00:00:00Z"]
    if row["url"] is not None:
        lines.append("WARC-Target-URI: " + urllib.parse.quote(row["url"], safe="!#$%&'()*+,/:;=?@[]~-._"))
    if row["record_type"] == "revisit":
        lines += [f"WARC-Refers-To: <urn:page:{_id(row['refers_to'])}>",
                  "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    lines += [f"WARC-Payload-Digest: sha1:{base32(bytes.fromhex(row['sha1']))}",
              "Content-Type: application/http;msgtype=response", f"Content-Length: {len(http) + kept}"]
    return "\r\n".join(lines).encode("utf-8") + b"\r\n\r\n" + http


def _id(page_id: int | None) -> str:
    return "null" if page_id is None else str(page_id)


class Archive:
    """Archives of one task, rolled over by size, one gzip member a record."""

    def __init__(self, folder: str):
        self.fs, self.base = pafs.FileSystem.from_uri(folder)
        self.fs.create_dir(self.base, recursive=True)
        context, self.folder = TaskContext.get(), folder
        self.prefix = f"archive-{context.partitionId():06d}-{context.taskAttemptId()}"
        self.files, self.out, self.offset, self.sha = 0, None, 0, None

    def begin(self, row: dict) -> tuple[str, int]:
        if self.out is not None and self.offset >= ARCHIVE_BYTES:
            self.out.close()
            self.out = None
        if self.out is None:
            self.name = f"{self.prefix}-{self.files}.warc.gz"
            self.out = self.fs.open_output_stream(f"{self.base}/{self.name}", compression=None)
            self.offset, self.files = 0, self.files + 1
        at = (f"{self.folder}/{self.name}", self.offset)
        self.gzip, self.sha, self.row = zlib.compressobj(LEVEL, zlib.DEFLATED, 31), hashlib.sha1(), row
        self._put(self.gzip.compress(_header(row)))
        return at

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.offset += len(data)

    def chunk(self, data: bytes) -> None:
        self.sha.update(data)
        if self.row["record_type"] == "response":
            self._put(self.gzip.compress(data))

    def end(self) -> None:
        if self.sha is None:
            return
        if self.sha.hexdigest() != self.row["sha1"]:
            raise ValueError(f"payload of page {self.row['page_id']} changed while it was written")
        self._put(self.gzip.compress(b"\r\n\r\n") + self.gzip.flush())
        self.sha = None

    def close(self) -> None:
        self.end()
        if self.out is not None:
            self.out.close()


def write(pages: DataFrame, folder: str) -> DataFrame:
    """Write the archives; returns their index, (archive, offset, page_id,
    record_type), as a written table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive = None
        for batch in batches:
            archive = archive or Archive(folder)
            numbers, data = batch.column(batch.schema.get_field_index("chunk_no")), batch.column(
                batch.schema.get_field_index("data"))
            heads = batch.drop_columns(["data"])
            found = []
            for i in range(len(numbers)):
                if numbers[i].as_py() == 0:
                    archive.end()
                    row = heads.slice(i, 1).to_pylist()[0]
                    found.append((*archive.begin(row), row["page_id"], row["record_type"]))
                archive.chunk(data[i].as_py())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(list(zip(*found)) or [()] * 4,
                                                [pa.string(), pa.int64(), pa.int64(), pa.string()])],
                ["archive", "offset", "page_id", "record_type"])
        if archive:
            archive.close()

    return written(chunked(typed(pages)).mapInArrow(run, INDEX), "warc-index")


class Members:
    """Streams the records of an archive: header fields, then payload chunks."""

    def __init__(self, filesystem, name: str):
        self.file = filesystem.open_input_stream(name, compression=None, buffer_size=1 << 20)
        self.raw, self.offset, self.eof = b"", 0, False

    def _more(self) -> bytes:
        """Some decompressed bytes of the member; b'' at its end."""
        while not self.gzip.eof:
            given = len(self.raw)
            # at most a chunk comes out; what was not used of the input comes next
            got = self.gzip.decompress(self.raw, CHUNK)
            self.raw = self.gzip.unused_data if self.gzip.eof else self.gzip.unconsumed_tail
            self.offset += given - len(self.raw)
            if got:
                return got
            if not self.raw and not self.gzip.eof:
                self.raw = self.file.read(CHUNK)
                if not self.raw:
                    raise ValueError("archive ends inside a record")
        return b""

    def records(self) -> Iterator[tuple[int, dict, Iterator[bytes]]]:
        while True:
            if not self.raw:
                self.raw = self.file.read(CHUNK)
                if not self.raw:
                    self.file.close()
                    return
            at, self.gzip, head = self.offset, zlib.decompressobj(31), b""
            while head.count(b"\r\n\r\n") < 2:  # the record's header and that of its block
                head += self._more()
            warc, http, rest = head.split(b"\r\n\r\n", 2)
            fields = {k.lower(): v for k, v in (x.split(": ", 1) for x in warc.decode("utf-8").split("\r\n")[1:])}
            fields |= {f"http-{k.lower()}": v for k, v in (
                x.split(": ", 1) for x in http.decode("utf-8").split("\r\n")[1:])}
            size = int(fields["content-length"]) - len(http) - 4
            yield at, fields, self._payload(rest, size)

    def _payload(self, rest: bytes, size: int) -> Iterator[bytes]:
        while size > 0:
            part = rest[:min(CHUNK, size)]
            size, rest = size - len(part), rest[len(part):]
            if part:
                yield part
            rest = rest or self._more()
        while more := rest or self._more():
            if more.strip(b"\r\n"):
                raise ValueError("bytes after the payload")
            rest = b""


def _page(urn: str | None) -> int | None:
    name = urn[len("<urn:page:"):-1] if urn else "null"
    return None if name == "null" else int(name)


def read(index: DataFrame, with_data: bool = False) -> DataFrame:
    """The chunk table of the archives in ``index``; header fields stand in
    every row of a record, ``digest`` covers the chunks up to the row's."""
    names = [x.split()[0] for x in CHUNKS.split(", ")] + ["data"] * with_data

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive in batch.column(0).to_pylist():
                rows, held = [], 0
                for at, h, payload in Members(*pafs.FileSystem.from_uri(archive)).records():
                    sha, head = hashlib.sha1(), (
                        _page(h["warc-record-id"]), h["warc-type"], _page(h.get("warc-refers-to")),
                        int(h["http-content-length"]), h["warc-payload-digest"].removeprefix("sha1:"))
                    number = -1
                    for number, data in enumerate(payload):
                        sha.update(data)
                        held += len(data) if with_data else 100
                        rows.append((archive, at, number, len(data), base32(sha.digest()), *head, *[data] * with_data))
                        if held > 16 * CHUNK:
                            yield _batch(rows, names)
                            rows, held = [], 0
                    if number < 0:
                        rows.append((archive, at, 0, 0, base32(sha.digest()), *head, *[b""] * with_data))
                yield _batch(rows, names)

    archives = index.select("archive").distinct()
    # rows are few but stand for much work, so they are spread by number, not by size
    spread = archives.repartitionByRange(max(1, archives.count()), "archive")
    return spread.mapInArrow(run, CHUNKS + ", data binary" * with_data)


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    longs = {"offset", "chunk_no", "n_bytes", "page_id", "refers_to", "payload_bytes"}
    columns = list(zip(*rows)) or [()] * len(names)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, pa.int64() if n in longs else pa.binary() if n == "data" else pa.string())
         for n, c in zip(names, columns)], names)


def records(chunks: DataFrame) -> DataFrame:
    """One row a record: page_id, payload_bytes, payload_digest, record_type,
    refers_to, once the streamed digest and size of a response agree with its header."""
    whole = chunks.groupBy("archive", "offset").agg(
        F.sum("n_bytes").alias("_bytes"), F.max_by("digest", "chunk_no").alias("_digest"),
        *[F.first(c).alias(c) for c in ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")])
    sound = (F.col("record_type") == "revisit") | (
        (F.col("_digest") == F.col("payload_digest")) & (F.col("_bytes") == F.col("payload_bytes")))
    return whole.select(
        "page_id", "payload_bytes",
        F.when(sound, F.col("payload_digest")).otherwise(
            F.raise_error(F.concat(F.lit("damaged record in "), "archive"))).alias("payload_digest"),
        "record_type", "refers_to")


def round_trip(pages: DataFrame) -> DataFrame:
    """Write a record for every page, read the archives back: one row a page.

    Null and empty pages are records without payload. Null ids and urls are
    left out of the header; an empty table gives no archive and no rows; other
    columns are not read.
    """
    folder = scratch_path(pages.sparkSession, "warc")
    return records(read(write(pages, folder)))
