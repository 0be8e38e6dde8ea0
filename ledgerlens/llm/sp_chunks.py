"""SentencePiece encoding and decoding through a table of distinct chunks.

In a model whose pieces never hold a white-space marker after another
character, no merge can cross from one marked word into the next. A text is
therefore the sequence of its chunks (markers, then the characters up to the
next marker), each segmented on its own. ``mapInArrow`` keeps, while a task
reads its rows, a table of the distinct chunks it has met: a new chunk is
encoded and decoded once by the library, and the ids and the decoded text of a
document come from the table by position.

The table is of the task, not of the corpus: a global one would need every
occurrence (document, position, chunk) to be shuffled, several times the input.
It is emptied when it reaches ``TABLE_CHUNKS`` or ``TABLE_CHARS``, and a long
text passes through it in slabs, so memory does not grow with texts or rows.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
#: Bounds of a task's table.
TABLE_CHUNKS, TABLE_CHARS = 400_000, 16_000_000
#: Characters of a text that are split into chunks at a time, about.
SLAB = 500_000

DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def model_bytes(path: str) -> bytes:
    """The model file, for shipping it to the executors (half a megabyte).

    Raises if a piece holds a marker inside, since chunks would then not be
    independent.
    """
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    for i in range(sp.get_piece_size()):
        if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i)) and MARK in sp.id_to_piece(i).lstrip(MARK):
            raise ValueError(f"piece {sp.id_to_piece(i)!r} crosses a white-space marker")
    if sp.encode("  a", add_bos=False) == sp.encode("a", add_bos=False):
        raise ValueError("the model drops white space; chunks need a model that keeps it")
    with open(path, "rb") as f:
        return f.read()


class Document:
    """What is kept of a document while its parts come in: the count, both
    digests and, if wanted, the ids."""

    def __init__(self, sp, with_ids: bool):
        self.sp, self.with_ids = sp, with_ids
        self.n, self.ids, self.fresh = 0, [], True
        self.ids_sha, self.text_sha = hashlib.sha256(), hashlib.sha256()
        self._ids(np.array([sp.bos_id()], np.int32))

    def _ids(self, ids: np.ndarray) -> None:
        self.n += len(ids)
        self.ids_sha.update(ids.astype("<u4").tobytes())
        if self.with_ids:
            self.ids.append(ids)

    def put(self, ids: np.ndarray, decoded: str) -> None:
        self._ids(ids)
        # the marker that the library puts before a text is not decoded
        self.text_sha.update(decoded[self.fresh:].encode("utf-8"))
        self.fresh = False

    def end(self) -> None:
        self._ids(np.array([self.sp.eos_id()], np.int32))


class ChunkTable:
    """Distinct chunks with their ids and decoded text."""

    CHUNK = re.compile(" *[^ ]+| +")
    WORD_END = re.compile("(?<=[^ ]) ")

    def __init__(self, model: bytes):
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.alone = self.sp.piece_to_id(MARK)
        self.clear()

    def clear(self) -> None:
        self.at: dict[str, int] = {}
        self.decoded: list[str] = []
        self.chars = 0
        self.starts = np.zeros(1024, np.int64)
        self.ids = np.zeros(4096, np.int32)
        self.n_ids = 0

    def add(self, chunks: list[str]) -> None:
        # the library puts the marker before what it encodes, so the chunk goes without it
        encoded = [ids or [self.alone] for ids in self.sp.encode([c[1:] for c in chunks], num_threads=1)]
        n = len(self.decoded)
        for k, c in enumerate(chunks):
            self.at[c] = n + k
        self.decoded += [" " + x for x in self.sp.decode(encoded, num_threads=1)]
        self.chars += sum(map(len, chunks))
        lengths = np.fromiter(map(len, encoded), np.int64, len(encoded))
        flat = np.fromiter((i for ids in encoded for i in ids), np.int32, int(lengths.sum()))
        if n + len(chunks) + 1 > len(self.starts):
            self.starts = np.concatenate([self.starts, np.zeros(n + len(chunks) + 1, np.int64)])
        self.starts[n + 1:n + 1 + len(chunks)] = self.n_ids + np.cumsum(lengths)
        if self.n_ids + len(flat) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(self.n_ids + len(flat), np.int32)])
        self.ids[self.n_ids:self.n_ids + len(flat)] = flat
        self.n_ids += len(flat)

    def slabs(self, text: str) -> Iterator[list[str]]:
        """The chunks of a text in lists of about ``SLAB`` characters."""
        marked, begin = " " + text.replace(MARK, " "), 0
        while begin < len(marked):
            cut = self.WORD_END.search(marked, begin + SLAB) if len(marked) - begin > SLAB else None
            end = cut.start() if cut else len(marked)
            yield self.CHUNK.findall(marked, begin, end)
            begin = end

    def block(self, parts: list[tuple[Document, list[str]]]) -> None:
        """Look up the chunks of some documents at once and hand each its ids and text."""
        if new := [c for c in dict.fromkeys(itertools.chain.from_iterable(p for _, p in parts)) if c not in self.at]:
            self.add(new)
        for doc, chunks in parts:
            at = np.fromiter(map(self.at.__getitem__, chunks), np.int64, len(chunks))
            starts, lengths = self.starts[at], self.starts[at + 1] - self.starts[at]
            skip = starts - (np.cumsum(lengths) - lengths)
            doc.put(self.ids[np.repeat(skip, lengths) + np.arange(lengths.sum())],
                    "".join(map(self.decoded.__getitem__, at.tolist())))
        if len(self.decoded) > TABLE_CHUNKS or self.chars > TABLE_CHARS:
            self.clear()

    def documents(self, texts: list[str | None], with_ids: bool) -> list[Document]:
        docs, parts, size = [Document(self.sp, with_ids) for _ in texts], [], 0
        for doc, text in zip(docs, texts):
            for chunks in self.slabs(text) if text else ():
                parts.append((doc, chunks))
                size += min(len(text), SLAB)
                if size >= SLAB:
                    self.block(parts)
                    parts, size = [], 0
        self.block(parts)
        for doc in docs:
            doc.end()
        return docs


def encoded(docs: DataFrame, model: bytes, text: str = "text", doc_id: str = "doc_id",
            with_ids: bool = False) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256, decoded_sha256, and
    with ``with_ids`` the ids.

    Null and empty texts have the begin and the end id alone. Rows stand for
    themselves, so repeats and ties need no rule; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = ChunkTable(model)
        for batch in batches:
            ids_of, texts = batch.column(0), batch.column(1)
            for begin in range(0, len(texts), 256):
                rows = table.documents(texts[begin:begin + 256].to_pylist(), with_ids)
                out = {"doc_id": ids_of[begin:begin + 256], "n_tokens": pa.array([r.n for r in rows], pa.int64()),
                       "ids_sha256": pa.array([r.ids_sha.hexdigest() for r in rows], pa.string()),
                       "decoded_sha256": pa.array([r.text_sha.hexdigest() for r in rows], pa.string())}
                if with_ids:
                    ends = np.cumsum([0, *(r.n for r in rows)]).astype(np.int32)
                    out["ids"] = pa.ListArray.from_arrays(ends, np.concatenate([p for r in rows for p in r.ids]))
                yield pa.RecordBatch.from_arrays(list(out.values()), list(out))

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        run, DIGESTS + (", ids array<int>" if with_ids else ""))
