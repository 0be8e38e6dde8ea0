"""Alignment of the tokens of two tokenizers over the bytes of each text.

Both tokenizers cover the same bytes, so a token is the range of bytes up to
its cumulative end. A dictionary for each side leads from an end to the index
after its token; the intersection of their keys, sorted, are the places where
both sides end a token, and these slice both id lists into groups. Inside a
group, a token of one side is linked with each of the other whose range
overlaps its own.

Byte-level BPE and SentencePiece both end a token at certain places
(``token_pieces``, ``check_cuts``), so a text is a sequence of pieces, and each
distinct piece of a task is encoded and aligned once, many in one pass. The links of a document go on as
counted id pairs. How many links of the corpus hold a pair is a sum over all
documents, combined per task; the counts come back to the documents by a join:
pairs with at least a 100,000th of all rows by a broadcast, of which there can
be no more than 100,000, and all others, none of them frequent, by a shuffle.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import chain, groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written
from .sp_chunks import MARK
from .token_pieces import Flat, PieceTable, bpe_ids, byte_bpe, cut, entries, slabs

#: Pairs whose counts are broadcast at most.
FREQUENT = 100_000
#: Bits of an id of B in a pair's code.
B_BITS = 24

ALIGNED = ("_row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
           "codes array<long>, times array<int>")


def sliced(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Groups: the index after the last token of each, in A and in B.

    A hash set of each side's ends, with the index after each, and their
    intersection in order.
    """
    after_a, after_b = (dict(zip(ends.tolist(), range(1, len(ends) + 1))) for ends in (ends_a, ends_b))
    common = sorted(after_a.keys() & after_b.keys())
    return tuple(np.fromiter(map(after.__getitem__, common), np.int64, len(common)) for after in (after_a, after_b))


def linked(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of the tokens whose ranges overlap: between two ends that
    follow each other, of whichever side, lie one token of A and one of B."""
    ends = np.union1d(ends_a, ends_b)
    return np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends)


def check_cuts(model: bytes) -> None:
    """Raise if a piece of the model reaches over a place where ``token_pieces`` cuts."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_proto=model)
    for i in range(sp.get_piece_size()):
        if not sp.is_byte(i) and re.search(r"\n|[A-Za-z][.,;:!?)]", sp.id_to_piece(i)):
            raise ValueError(f"piece {sp.id_to_piece(i)!r} reaches over a cut")


class Alignments(PieceTable):
    """Distinct pieces with their groups, links and counts."""

    def __init__(self, bpe_json: str, model: bytes):
        import sentencepiece

        self.bpe = byte_bpe(bpe_json, plain_specials=True)
        self.sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.alone, self.feed = self.sp.encode("\n")  # the marker that the library puts before a text, and the feed
        self.bytes_a = entries(self.bpe)
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.sp.is_byte(i) else p.replace(MARK, " ").encode()
                        for i, p in ((i, self.sp.id_to_piece(i)) for i in range(self.sp.get_piece_size()))]
        self.sizes_a, self.sizes_b = (np.fromiter(map(len, x), np.int64, len(x)) for x in (self.bytes_a, self.bytes_b))
        # an id as it stands in a group: before another of its side, and at its side's end
        self.said_a, self.said_b = (np.array([[f"{i},", f"{i}{end}"] for i in range(len(x))], object)
                                    for x, end in ((self.bytes_a, "|"), (self.bytes_b, ";")))
        super().__init__()

    def clear(self) -> None:
        super().clear()
        self.groups: list[str | None] = []
        self.counts, self.codes = Flat(np.int64), Flat(np.int64)

    def _ids_b(self, pieces: list[str]) -> list[list[int]]:
        """The library puts a marker before what it encodes: a piece goes without
        its space, and one without a space goes after a line feed."""
        ids = self.sp.encode([p[1:] if p[0] == " " else "\n" + p for p in pieces], num_threads=1)
        return [(x or [self.alone]) if p[0] == " " else x[2:] for p, x in zip(pieces, ids)]

    def add(self, pieces: list[str]) -> None:
        full = [p or " " for p in pieces]  # the empty piece, if any, is in no text
        for begin in range(0, len(pieces), self.AT_ONCE):
            part = full[begin:begin + self.AT_ONCE]
            ids_b = self._ids_b(part)
            self._add(part, *bpe_ids(self.bpe, self.sizes_a, part), np.fromiter(map(len, ids_b), np.int64, len(ids_b)),
                      np.fromiter(chain.from_iterable(ids_b), np.int64))

    def _add(self, pieces: list[str], n_a: np.ndarray, flat_a: np.ndarray, n_b: np.ndarray, flat_b: np.ndarray) -> None:
        n, bodies = len(pieces), [p.encode() for p in pieces]
        sizes = np.fromiter(map(len, bodies), np.int64, n)
        ends_a, ends_b = np.cumsum(self.sizes_a[flat_a]), np.cumsum(self.sizes_b[flat_b])
        ends, body = np.cumsum(sizes), b"".join(bodies)
        if not (all(len(e) and np.array_equal(e[np.cumsum(k) - 1], ends) for e, k in ((ends_a, n_a), (ends_b, n_b)))
                and body == b"".join(map(self.bytes_a.__getitem__, flat_a.tolist()))
                and body == b"".join(map(self.bytes_b.__getitem__, flat_b.tolist()))):
            # some piece does not come back byte for byte: those are set apart
            ids_a, ids_b = ([x.tolist() for x in np.split(flat, np.cumsum(k)[:-1])] for k, flat in ((n_a, flat_a), (n_b, flat_b)))
            sound = [b"".join(map(self.bytes_a.__getitem__, a)) == p == b"".join(map(self.bytes_b.__getitem__, b))
                     for p, a, b in zip(bodies, ids_a, ids_b)]
            for good, run in groupby(range(n), sound.__getitem__):
                run = list(run)
                if good:
                    self._add([pieces[i] for i in run], *(y for ids in (ids_a, ids_b) for y in (
                        np.array([len(ids[i]) for i in run]), np.array([k for i in run for k in ids[i]]))))
                else:
                    self.groups += [None] * len(run)
                    self.counts.extend(np.full(len(run), 3), np.zeros(3 * len(run), np.int64))
                    self.codes.extend(np.zeros(len(run), np.int64), np.zeros(0, np.int64))
            return
        # all pieces of the block lie one after another, and each ends a token of both sides
        stop_a, stop_b = sliced(ends_a, ends_b)
        last_a, last_b = np.zeros(len(flat_a), np.int64), np.zeros(len(flat_b), np.int64)
        last_a[stop_a - 1], last_b[stop_b - 1] = 1, 1
        # group by group, first A's ids, then B's
        order = np.argsort(np.concatenate([2 * (np.cumsum(last_a) - last_a), 2 * (np.cumsum(last_b) - last_b) + 1]), kind="stable")
        said = np.concatenate([self.said_a[flat_a, last_a], self.said_b[flat_b, last_b]])[order].tolist()
        upto = np.cumsum(n_a + n_b).tolist()
        self.groups += ["".join(said[a:b]) for a, b in zip([0, *upto], upto)]
        of_piece = np.searchsorted(ends, ends_a[stop_a - 1])
        n_groups = np.bincount(of_piece, minlength=n)
        self.counts.extend(np.full(n, 3), np.stack([n_a, n_b, n_groups], axis=1).ravel())
        a, b = linked(ends_a, ends_b)
        self.codes.extend(np.bincount(np.searchsorted(ends, ends_a[a] - self.sizes_a[flat_a[a]], "right"), minlength=n),
                          flat_a[a] << B_BITS | flat_b[b])

    def documents(self, texts: list[str | None]) -> list["Document"]:
        docs = [Document() for _ in texts]
        for owners, parts in slabs([" " + t if t else "" for t in texts]):
            distinct, numbers, sizes = cut(parts)
            at, end = self.find(distinct)[numbers], np.cumsum(sizes)
            for owner, stop, size in zip(owners, end, sizes):
                docs[owner].put(self, at[stop - size:stop])
        for doc in docs:
            doc.end()
        return docs


class Document:
    """Counts, digest and counted pairs of a document while its parts come in."""

    def __init__(self):
        self.counts, self.sha, self.sound = np.zeros(3, np.int64), hashlib.sha256(), True
        self.codes, self.times = [], []

    def put(self, table: Alignments, at: np.ndarray) -> None:
        said = list(map(table.groups.__getitem__, at.tolist()))
        if not self.sound or None in said:
            self.sound = False
            return
        self.sha.update(((";" if self.counts[2] else "") + "".join(said)[:-1]).encode())
        self.counts += table.counts.take(at).reshape(-1, 3).sum(axis=0)
        codes, times = np.unique(table.codes.take(at), return_counts=True)
        self.codes.append(codes)
        self.times.append(times.astype(np.int32))

    def end(self) -> None:
        self.n_a, self.n_b, self.n_groups = self.counts.tolist() if self.sound else (0, 0, 0)
        self.digest = self.sha.hexdigest() if self.n_groups else ""
        self.codes = np.concatenate(self.codes) if self.n_groups else np.zeros(0, np.int64)
        self.times = np.concatenate(self.times) if self.n_groups else np.zeros(0, np.int32)


def alignments(docs: DataFrame, bpe_json: str, model: bytes, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """A row per document: its number, doc_id, counts and digest of its groups,
    and its linked id pairs (A's id in the high bits) with how often they occur."""

    check_cuts(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Alignments(bpe_json, model)
        for batch in batches:
            for begin in range(0, batch.num_rows, 512):
                part = batch.slice(begin, 512)
                rows = table.documents(part.column(2).to_pylist())
                ends = np.cumsum([0, *(len(r.codes) for r in rows)]).astype(np.int32)
                codes, times = (np.concatenate([getattr(r, c) for r in rows]) for c in ("codes", "times"))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1),
                     *[pa.array([getattr(r, c) for r in rows], pa.int64()) for c in ("n_a", "n_b", "n_groups")],
                     pa.array([int(r.times.sum()) for r in rows], pa.int64()), pa.array([r.digest for r in rows], pa.string()),
                     pa.ListArray.from_arrays(ends, codes), pa.ListArray.from_arrays(ends, times)],
                    [c.split()[0] for c in ALIGNED.split(", ")])

    return docs.select(F.monotonically_increasing_id().alias("_row"), F.col(doc_id).cast("long").alias("doc_id"),
                       F.col(text).alias("text")).mapInArrow(run, ALIGNED)


def pair_counts(rows: DataFrame) -> DataFrame:
    """(code, links, in_docs, best): links of the corpus that hold an id pair,
    rows of ``alignments`` that do, and whether no other pair of its B id has more."""
    pairs = rows.select(F.explode(F.arrays_zip("codes", "times")).alias("_p")).groupBy(F.col("_p.codes").alias("code")).agg(
        F.sum("_p.times").alias("links"), F.count(F.lit(1)).alias("in_docs"))
    pairs = written(pairs, "pairs")
    b = F.col("code").bitwiseAND(F.lit((1 << B_BITS) - 1))
    most = pairs.groupBy(b.alias("_b")).agg(F.max("links").alias("_most"))
    return pairs.join(most, b == F.col("_b")).select("code", "links", "in_docs", (F.col("links") == F.col("_most")).alias("best"))


def aligned(docs: DataFrame, bpe_json: str, model: bytes, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best,
    count_sum, groups_sha256.

    ``n_best`` counts the links whose pair has the most links of all pairs with
    its B id, ties included; ``count_sum`` adds up the pairs' counts over the
    links. Null and empty texts, and those that a tokenizer does not give back
    byte for byte, have zeros and ''. Rows stand for themselves, so repeats and
    ties need no rule; an empty table gives no rows; other columns are not read.
    """
    rows = written(alignments(docs, bpe_json, model, text, doc_id), "aligned", compression="zstd")
    counts = written(pair_counts(rows), "pair-counts")
    total = counts.agg(F.coalesce(F.sum("in_docs"), F.lit(0)).alias("n")).first().n
    often = F.col("in_docs") * FREQUENT >= total  # true of at most FREQUENT pairs
    links = rows.select("_row", F.explode(F.arrays_zip("codes", "times")).alias("_p")).select(
        "_row", F.col("_p.codes").alias("code"), F.col("_p.times").alias("times"))
    frequent, rare = F.broadcast(counts.where(often)), counts.where(~often)
    seldom = links.join(F.broadcast(counts.where(often).select("code")), "code", "left_anti")
    best, sums = F.when(F.col("best"), F.col("times")).otherwise(0), F.col("times") * F.col("links")
    known = links.join(frequent, "code").unionByName(seldom.join(rare, "code"))
    known = known.groupBy("_row").agg(F.sum(best).alias("n_best"), F.sum(sums).alias("count_sum"))
    return rows.drop("codes", "times").join(known, "_row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", *[F.coalesce(c, F.lit(0)).cast("long").alias(c)
                                                         for c in ("n_best", "count_sum")], "groups_sha256")
