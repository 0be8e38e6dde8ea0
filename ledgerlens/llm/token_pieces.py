"""Texts cut where no token of a byte-level BPE or SentencePiece model crosses,
so that each distinct piece is encoded once while a task reads its rows.

A cut before a space is safe after a character that is no white space: the
byte-level BPE begins a word there (the space goes with the word) and a
SentencePiece model without markers inside its pieces does too. For the
byte-level BPE, a single line feed stands for itself, and a letter and the sign
after it (not an apostrophe) never share a word; a SentencePiece model may be
cut there if no piece of its holds such a pair. Texts with white space in a
row, or with characters on whose being white space libraries differ, are cut
before spaces alone, by a pattern.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CUT = "\x01"
# fixed values: white space, and characters that are white space to some
WHITE, DOUBTFUL = " \t\n\x0b\x0c\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000", "\u180e\u200b\ufeff"
#: White space in a row, or a sign that is doubtful or means a cut.
UNEVEN = f"[{WHITE}][{WHITE}]|[{CUT}{DOUBTFUL}]"
BEFORE_SPACE = re.compile(f"(?<=[^{WHITE}{DOUBTFUL}])(?= )")
LETTER_SIGN = r"([A-Za-z])([.,;:!?)])"
#: Characters of a text that are cut at a time, and of the texts that are looked up at once, about.
SLAB = 4_000_000


def slabs(texts: list[str]) -> Iterator[tuple[list[int], list[str]]]:
    """(numbers of texts, their parts) in lists of about ``SLAB`` characters; a
    long text comes in several parts, cut where a piece ends."""
    owners, parts, size = [], [], 0
    for i, text in enumerate(texts):
        begin = 0
        while begin < len(text):
            found = BEFORE_SPACE.search(text, begin + SLAB) if len(text) - begin > SLAB else None
            end = found.start() if found else len(text)
            owners.append(i)
            parts.append(text[begin:end])
            size, begin = size + end - begin, end
            if size >= SLAB:
                yield owners, parts
                owners, parts, size = [], [], 0
    if parts:
        yield owners, parts


def cut(parts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct pieces of some parts, the pieces' numbers part after part, and
    how many each part has."""
    whole = pa.array(parts, pa.large_string())
    found = pc.match_substring_regex(whole, UNEVEN)
    uneven, even = found.to_numpy(zero_copy_only=False), whole.filter(pc.invert(found))
    marked = pc.replace_substring(even, " ", CUT + " ")
    marked = pc.replace_substring(marked, "\n", CUT + "\n" + CUT)
    marked = pc.replace_substring_regex(marked, LETTER_SIGN, "\\1" + CUT + "\\2")
    lists = pc.split_pattern(marked, CUT)
    odd = [BEFORE_SPACE.split(p) for p, u in zip(parts, uneven) if u]
    codes = pa.chunked_array([lists.flatten(), pa.array([x for p in odd for x in p], pa.large_string())]
                             ).combine_chunks().dictionary_encode()
    counts = np.zeros(len(parts), np.int64)
    counts[~uneven], counts[uneven] = pc.list_value_length(lists).to_numpy(zero_copy_only=False), [len(p) for p in odd]
    numbers, distinct = codes.indices.to_numpy(zero_copy_only=False), codes.dictionary.to_numpy(zero_copy_only=False).tolist()
    if odd and len(even):  # back into the order of the parts
        starts = np.empty(len(parts), np.int64)
        order = np.concatenate([np.flatnonzero(~uneven), np.flatnonzero(uneven)])
        starts[order] = np.cumsum(counts[order]) - counts[order]
        numbers = numbers[spread(starts, counts)]
    if "" in distinct:  # before a cut at the begin, between two cuts
        full = numbers != distinct.index("")
        counts = np.bincount(np.repeat(np.arange(len(parts)), counts)[full], minlength=len(parts))
        numbers = numbers[full]
    return distinct, numbers, counts


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places start, start + 1, ... of each stretch, one after another."""
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(int(lengths.sum()))


class Flat:
    """Number arrays of different lengths one after another, that grow."""

    def __init__(self, dtype):
        self.starts, self.values = np.zeros(1024, np.int64), np.zeros(4096, dtype)
        self.n, self.used = 0, 0

    def extend(self, lengths: np.ndarray, values: np.ndarray) -> None:
        if self.n + len(lengths) + 1 > len(self.starts):
            self.starts = np.concatenate([self.starts, np.zeros(self.n + len(lengths) + 1, np.int64)])
        self.starts[self.n + 1:self.n + 1 + len(lengths)] = self.used + np.cumsum(lengths)
        if self.used + len(values) > len(self.values):
            self.values = np.concatenate([self.values, np.zeros(self.used + len(values), self.values.dtype)])
        self.values[self.used:self.used + len(values)] = values
        self.n, self.used = self.n + len(lengths), self.used + len(values)

    def lengths(self, at: np.ndarray) -> np.ndarray:
        return self.starts[at + 1] - self.starts[at]

    def take(self, at: np.ndarray) -> np.ndarray:
        return self.values[spread(self.starts[at], self.lengths(at))]


class PieceTable:
    """Numbers of the distinct pieces that a task has met; ``add`` of a subclass
    stores what belongs to new ones. Emptied when it is full."""

    #: Bounds of the table.
    PIECES, CHARS = 250_000, 10_000_000
    #: New pieces that are encoded together.
    AT_ONCE = 20_000

    def __init__(self):
        self.clear()

    def clear(self) -> None:
        self.at: dict[str, int] = {}
        self.chars = 0

    def add(self, pieces: list[str]) -> None:
        raise NotImplementedError

    def find(self, distinct: list[str]) -> np.ndarray:
        """Numbers of the pieces in the table, new ones added. What is asked for
        at once stays valid until the next call."""
        if len(self.at) > self.PIECES or self.chars > self.CHARS:
            self.clear()
        if new := [p for p in distinct if p not in self.at]:
            n = len(self.at)
            self.add(new)
            self.at.update(zip(new, range(n, n + len(new))))
            self.chars += sum(map(len, new))
        return np.fromiter(map(self.at.__getitem__, distinct), np.int64, len(distinct))


def byte_bpe(json_text: str, plain_specials: bool):
    """The tokenizers library's encoder; with ``plain_specials`` the strings of
    special tokens are ordinary text."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(json_text)
    tokenizer.encode_special_tokens = plain_specials
    return tokenizer


def byte_level() -> dict[str, int]:
    """Byte of each character in the entries of a byte-level vocabulary: bytes
    that print stand for themselves, the others for characters from 256 on."""
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in prints]
    return {chr(b): b for b in prints} | {chr(256 + i): b for i, b in enumerate(others)}


def entries(tokenizer) -> list[bytes]:
    """The bytes of each id of a byte-level vocabulary."""
    of = byte_level()
    latin, known = {ord(c): b for c, b in of.items()}, frozenset(of)
    return [p.translate(latin).encode("latin-1") if known.issuperset(p) else p.encode()
            for p in map(tokenizer.id_to_token, range(tokenizer.get_vocab_size()))]


def bpe_ids(tokenizer, sizes: np.ndarray, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """How many ids each piece has, and the ids piece after piece. ``sizes`` has
    the bytes of each id.

    Pieces that begin with a space and end with no white space may stand one
    after another: they are encoded as one string, and told apart by where ids
    end among the bytes. The others are encoded one by one.
    """
    white = {c for c in map(chr, range(0x3001)) if c.isspace()} | set(DOUBTFUL)
    joinable = np.fromiter((len(p) > 1 and p[0] == " " and p[-1] not in white for p in pieces), bool, len(pieces))
    counts, parts = np.zeros(len(pieces), np.int64), []
    joined = [p for p, j in zip(pieces, joinable) if j]
    if joined:
        ids = np.array(tokenizer.encode_batch_fast(["".join(joined)], add_special_tokens=False)[0].ids, np.int64)
        ends, stops = np.cumsum(sizes[ids]), np.cumsum(pc.binary_length(pa.array(joined, pa.large_string())).to_numpy())
        upto = np.searchsorted(ends, stops) + 1
        if upto[-1] == len(ids) and np.array_equal(ends[upto - 1], stops):
            counts[joinable] = np.diff(upto, prepend=0)
            parts.append(ids)
        else:  # an id reaches over a piece's end, or bytes are missing
            joinable[:] = False
    alone = [e.ids for e in tokenizer.encode_batch_fast([p for p, j in zip(pieces, joinable) if not j], add_special_tokens=False)]
    counts[~joinable] = np.fromiter(map(len, alone), np.int64, len(alone))
    parts.append(np.fromiter(chain.from_iterable(alone), np.int64))
    flat = np.concatenate(parts)
    if joinable.any() and not joinable.all():
        starts = np.empty(len(pieces), np.int64)
        order = np.concatenate([np.flatnonzero(joinable), np.flatnonzero(~joinable)])
        starts[order] = np.cumsum(counts[order]) - counts[order]
        flat = flat[spread(starts, counts)]
    return counts, flat
