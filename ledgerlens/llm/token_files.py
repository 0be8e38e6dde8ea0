"""Token ids in binary files, each document compressed with a shared dictionary.

A file holds the documents of a range of doc_ids: their ids as little-endian
numbers, each document a zstandard frame of its own. Short documents compress
badly alone, so all frames refer to one dictionary, trained on the serialized
ids of a bounded sample and kept once beside the files. A file's head names the
dictionary's SHA-256 and its tail has an index of offsets, so one document is
read with three small reads and without its neighbours:

    head    magic, SHA-256 of the dictionary, bytes of an id
    frames  one a document, in ascending doc_id order
    index   doc_ids, flags of those that are not null, begins of frames, token counts
    foot    offset of the index, documents, magic

Files are written by tasks, named with the attempt that wrote them; only those
in the returned index are read, so files of lost attempts stand aside.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import scratch_path, written
from .token_pieces import Flat, PieceTable, bpe_ids, byte_bpe, cut, entries, slabs

#: Bounds of the dictionary's training sample: documents, characters of each.
SAMPLE_DOCS, SAMPLE_CHARS = 2_000, 20_000
DICTIONARY_BYTES = 64 * 1024
#: Bytes of frames in a file, about.
FILE_BYTES = 64 * 1024 * 1024
LEVEL = 3
#: Bytes of frames that a reader fetches at once, about.
READ_BYTES = 8 * 1024 * 1024
#: Files whose token counts are summed up together.
FILES_AT_ONCE = 64

MAGIC = b"TOKIDS01"
HEAD, FOOT = "<8s32sB7x", "<QQ8s"

FRAMES = "doc_id long, n_tokens long, frame binary"
INDEX = "file string, number int, n_docs long, n_tokens long"
DOCUMENTS = "doc_id long, start long, n_tokens long, ids_crc32 long"


class Ids(PieceTable):
    """Distinct pieces with their ids."""

    def __init__(self, bpe_json: str, end: int):
        self.bpe, self.end = byte_bpe(bpe_json, plain_specials=False), end
        top = max(self.bpe.get_vocab_size(), end + 1)
        self.dtype = np.dtype("<u2") if top <= 1 << 16 else np.dtype("<u4")
        self.sizes = np.fromiter(map(len, entries(self.bpe)), np.int64)
        super().__init__()

    def clear(self) -> None:
        super().clear()
        self.ids = Flat(self.dtype)

    def add(self, pieces: list[str]) -> None:
        for begin in range(0, len(pieces), self.AT_ONCE):
            counts, ids = bpe_ids(self.bpe, self.sizes, pieces[begin:begin + self.AT_ONCE])
            self.ids.extend(counts, ids.astype(self.dtype))

    def documents(self, texts: list[str | None]) -> list[np.ndarray]:
        """The ids of each text and the end id."""
        found: list[list[np.ndarray]] = [[] for _ in texts]
        for owners, parts in slabs([t or "" for t in texts]):
            distinct, numbers, sizes = cut(parts)
            at = self.find(distinct)[numbers]
            ids, lengths = self.ids.take(at), self.ids.lengths(at)
            # ends of the parts among the ids
            ends = np.append(0, np.cumsum(lengths))[np.cumsum(sizes)]
            for owner, part in zip(owners, np.split(ids, ends[:-1])):
                found[owner].append(part)
        last = np.array([self.end], self.dtype)
        return [np.concatenate([*parts, last]) for parts in found]


def vocabulary(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def _key(doc_id: str):
    return F.md5(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary"))


def trained(docs: DataFrame, bpe_json: str, end: int, text: str = "text", doc_id: str = "doc_id") -> bytes:
    """A zstandard dictionary from the ids of ``SAMPLE_DOCS`` documents, drawn by
    a hash of doc_id, their first ``SAMPLE_CHARS`` characters each; the sampled
    ids themselves where there are too few to train on."""
    import zstandard

    n = docs.count()
    share = F.conv(F.substring("_key", 1, 8), 16, 10).cast("double")
    sample = (docs.select(_key(doc_id).alias("_key"), F.substring(text, 1, SAMPLE_CHARS).alias("text"))
              .where(share * n <= 2 * SAMPLE_DOCS * float(2 ** 32)).orderBy("_key", "text").limit(SAMPLE_DOCS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Ids(bpe_json, end)
        for batch in batches:
            ids = table.documents(batch.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array([x.tobytes() for x in ids], pa.binary())], ["ids"])

    samples = [bytes(r.ids) for r in sample.select("text").mapInArrow(run, "ids binary").collect()]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(samples)[:DICTIONARY_BYTES]


def _dictionary(data: bytes):
    import zstandard

    return zstandard.ZstdCompressionDict(data)


def compressed(docs: DataFrame, bpe_json: str, end: int, dictionary: bytes, text: str = "text",
               doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, n_tokens, frame) of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        table = Ids(bpe_json, end)
        # a document's size stands in its frame; the dictionary is named by the file
        squeeze = zstandard.ZstdCompressor(level=LEVEL, dict_data=_dictionary(dictionary), write_dict_id=False)
        for batch in batches:
            for begin in range(0, batch.num_rows, 1024):
                part = batch.slice(begin, 1024)
                rows = table.documents(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(r) for r in rows], pa.int64()),
                     pa.array([squeeze.compress(r.tobytes()) for r in rows], pa.binary())], ["doc_id", "n_tokens", "frame"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, FRAMES)


class Writer:
    """A file that grows by frames."""

    def __init__(self, folder: str, digest: bytes, width: int):
        filesystem, base = pafs.FileSystem.from_uri(folder)
        filesystem.create_dir(base, recursive=True)
        context = TaskContext.get()
        self.number = context.partitionId()
        name = f"ids-{self.number:06d}-{context.taskAttemptId()}.bin"
        self.name, self.out = f"{folder}/{name}", filesystem.open_output_stream(f"{base}/{name}", compression=None)
        self.out.write(struct.pack(HEAD, MAGIC, digest, width))
        self.at, self.n_docs, self.n_tokens = struct.calcsize(HEAD), 0, 0
        self.index: list[tuple[np.ndarray, ...]] = []

    def put(self, doc_ids: pa.Array, n_tokens: pa.Array, frames: pa.Array) -> None:
        known = np.asarray(doc_ids.is_valid(), np.uint8)
        ids = doc_ids.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8")
        counts = n_tokens.to_numpy(zero_copy_only=False).astype("<u8")
        data = [f.as_buffer() for f in frames]
        sizes = np.fromiter((d.size for d in data), np.uint64, len(data))
        self.index.append((ids, known, (self.at + np.cumsum(sizes) - sizes).astype("<u8"), counts))
        for d in data:
            self.out.write(d)
        self.at, self.n_docs, self.n_tokens = self.at + int(sizes.sum()), self.n_docs + len(data), self.n_tokens + int(counts.sum())

    def close(self) -> tuple[str, int, int, int]:
        for column in zip(*self.index):
            self.out.write(np.concatenate(column).tobytes())
        self.out.write(struct.pack(FOOT, self.at, self.n_docs, MAGIC))
        self.out.close()
        return self.name, self.number, self.n_docs, self.n_tokens


def write(docs: DataFrame, folder: str, bpe_json: str, end: int, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Write the files and ``dictionary.bin`` into ``folder``; returns their
    index (file, number, n_docs, n_tokens), numbers ascending with doc_id, as a
    written table. Null doc_ids come first; rows repeated with a doc_id stand in
    the order of their counts and frames."""
    spark = docs.sparkSession
    dictionary = trained(docs, bpe_json, end, text, doc_id)
    filesystem, base = pafs.FileSystem.from_uri(folder)
    filesystem.create_dir(base, recursive=True)
    with filesystem.open_output_stream(f"{base}/dictionary.bin", compression=None) as out:
        out.write(dictionary)
    digest = hashlib.sha256(dictionary).digest()
    frames = written(compressed(docs, bpe_json, end, dictionary, text, doc_id), "frames", compression="none")
    n_bytes = frames.agg(F.coalesce(F.sum(F.length("frame")), F.lit(0)).alias("n")).first().n
    n_files = max(spark.sparkContext.defaultParallelism, -(-n_bytes // FILE_BYTES))
    # rows that tie in everything but their place differ by it, so that no doc_id is a range of its own
    order = [F.col("doc_id").asc_nulls_first(), F.col("n_tokens").asc(), F.col("_tie").asc(), F.col("_place").asc()]
    ranged = (frames.withColumn("_tie", F.xxhash64("frame")).withColumn("_place", F.monotonically_increasing_id())
              .repartitionByRange(n_files, *order).sortWithinPartitions(*order).select("doc_id", "n_tokens", "frame"))
    width = Ids(bpe_json, end).dtype.itemsize

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = None
        for batch in batches:
            if batch.num_rows:
                writer = writer or Writer(folder, digest, width)
                writer.put(*batch.columns)
        if writer:
            yield pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in zip(writer.close(), (pa.string(), pa.int32(), pa.int64(), pa.int64()))],
                [c.split()[0] for c in INDEX.split(", ")])

    index = written(ranged.mapInArrow(run, INDEX), "token-index")
    return index


class Reader:
    """A file of frames: its documents one after another, or one by its place."""

    def __init__(self, name: str, dictionary: bytes | None = None):
        import zstandard

        filesystem, path = pafs.FileSystem.from_uri(name)
        self.file = filesystem.open_input_file(path)
        magic, digest, width = struct.unpack(HEAD, self._bytes(0, struct.calcsize(HEAD)))
        foot = struct.calcsize(FOOT)
        at, self.n_docs, end = struct.unpack(FOOT, self._bytes(self.file.size() - foot, foot))
        if magic != MAGIC or end != MAGIC:
            raise ValueError(f"{name} is not a file of token ids")
        if dictionary is None:
            with filesystem.open_input_stream(f"{path.rpartition('/')[0]}/dictionary.bin", compression=None) as f:
                dictionary = f.read()
        if hashlib.sha256(dictionary).digest() != digest:
            raise ValueError(f"{name} was written with another dictionary")
        self.index_at, self.dtype = at, np.dtype(f"<u{width}")
        self.expand = zstandard.ZstdDecompressor(dict_data=_dictionary(dictionary))

    def _bytes(self, at: int, size: int) -> bytes:
        self.file.seek(at)
        return self.file.read(size)

    def _column(self, k: int, first: int, n: int) -> np.ndarray:
        """Rows of a column of the index: doc_ids, flags, begins, counts."""
        before, kind = ((0, "<i8"), (8, "u1"), (9, "<u8"), (17, "<u8"))[k]
        kind = np.dtype(kind)
        return np.frombuffer(self._bytes(self.index_at + before * self.n_docs + first * kind.itemsize,
                                         n * kind.itemsize), kind)

    def _ids(self, frame: bytes, n: int) -> np.ndarray:
        ids = np.frombuffer(self.expand.decompress(frame, max_output_size=n * self.dtype.itemsize), self.dtype)
        if len(ids) != n:
            raise ValueError(f"a document of {n} tokens has {len(ids)}")
        return ids

    def document(self, place: int) -> np.ndarray:
        """The ids of the document at ``place``, read alone."""
        begin = int(self._column(2, place, 1)[0])
        end = int(self._column(2, place + 1, 1)[0]) if place + 1 < self.n_docs else self.index_at
        return self._ids(self._bytes(begin, end - begin), int(self._column(3, place, 1)[0]))

    def places(self, doc_id: int) -> range:
        """Places of the documents with ``doc_id``; ids ascend."""
        n_null = self.n_docs - int(self._column(1, 0, self.n_docs).sum())
        ids = self._column(0, n_null, self.n_docs - n_null)
        return range(n_null + int(np.searchsorted(ids, doc_id, "left")), n_null + int(np.searchsorted(ids, doc_id, "right")))

    def documents(self, at_once: int = 1000) -> Iterator[tuple[int | None, np.ndarray]]:
        for first in range(0, self.n_docs, at_once):
            n = min(at_once, self.n_docs - first)
            ids, known, begins, counts = (self._column(k, first, n) for k in range(4))
            ends = np.append(begins[1:], self._column(2, first + n, 1)[0] if first + n < self.n_docs else self.index_at)
            i = 0
            while i < n:  # frames are read together up to ``READ_BYTES``, a longer one alone
                stop = max(i + 1, int(np.searchsorted(ends, int(begins[i]) + READ_BYTES, "right")))
                block = memoryview(self._bytes(int(begins[i]), int(ends[stop - 1]) - int(begins[i])))
                for k in range(i, stop):
                    frame = block[int(begins[k]) - int(begins[i]):int(ends[k]) - int(begins[i])]
                    yield (int(ids[k]) if known[k] else None), self._ids(frame, int(counts[k]))
                i = stop
        self.file.close()


def read(index: DataFrame, with_ids: bool = False) -> DataFrame:
    """One row per document of the files in ``index``: doc_id, start (ids of all
    documents before it), n_tokens, ids_crc32 (of 32-bit ids), and with
    ``with_ids`` the ids."""
    # one row a file: sums over files of a block, and over the blocks before
    block = F.floor(F.col("number") / FILES_AT_ONCE)
    inside = Window.partitionBy(block).orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    blocks = index.groupBy(block.alias("_block")).agg(F.sum("n_tokens").alias("_n")).withColumn(
        "_before", F.sum("_n").over(Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1))).drop("_n")
    files = index.join(blocks, block == F.col("_block")).select("file", (
        F.coalesce("_before", F.lit(0)) + F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).alias("start"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows, held = [], 0
                for doc_id, ids in Reader(name).documents():
                    rows.append((doc_id, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()),
                                 *[ids.astype(np.int32)] * with_ids))
                    start, held = start + len(ids), held + len(ids) * with_ids + 10
                    if held > 1_000_000:
                        yield _batch(rows, with_ids)
                        rows, held = [], 0
                if rows:
                    yield _batch(rows, with_ids)

    # rows are few but stand for much work, so they are spread by number, not by size
    return files.repartitionByRange(max(1, index.count()), "file").mapInArrow(
        run, DOCUMENTS + ", ids array<int>" * with_ids)


def _batch(rows: list[tuple], with_ids: bool) -> pa.RecordBatch:
    columns = list(zip(*rows))
    arrays = [pa.array(c, pa.int64()) for c in columns[:4]]
    if with_ids:
        arrays.append(pa.array(columns[4], pa.list_(pa.int32())))
    return pa.RecordBatch.from_arrays(arrays, ["doc_id", "start", "n_tokens", "ids_crc32", "ids"][:len(arrays)])


def round_trip(docs: DataFrame, bpe_json: str, end: int = 2) -> DataFrame:
    """Write all documents, read the files back: one row a document, see ``read``.

    Null and empty texts have the end id alone; null doc_ids come first; rows
    repeated with a doc_id are documents of their own; an empty table gives no
    file and no rows; other columns are not read.
    """
    return read(write(docs, scratch_path(docs.sparkSession, "token-files"), bpe_json, end))
