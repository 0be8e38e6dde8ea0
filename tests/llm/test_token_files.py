import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerlens.llm import common, token_files as t, token_pieces as pieces

JSON = t.vocabulary(P.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(P.path("byte_bpe_50k.json"))


def plain(library, rows):
    """(doc_id, start, n_tokens, crc32) in ascending doc_id order, ties by counts."""
    out, start = [], 0
    sized = [(r.doc_id is not None, r.doc_id or 0, [*library.encode(r.text or "", add_special_tokens=False).ids, 2], r) for r in rows]
    for known, doc_id, ids, _ in sorted(sized, key=lambda x: (x[0], x[1], len(x[2]))):
        out.append((doc_id if known else None, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def got(df):
    return sorted((tuple(r) for r in t.round_trip(df, JSON).collect()), key=lambda r: r[1])


def test_documents_as_the_library(documents, library):
    assert got(documents) == plain(library, documents.collect())


def test_odd_rows(odd, empty, library):
    have, want = got(odd), plain(library, odd.collect())
    assert [r[:3] for r in have] == [r[:3] for r in want] and sorted(have, key=str) == sorted(want, key=str)
    assert t.round_trip(empty, JSON).count() == 0


def test_odd_texts(spark, library):
    rng = random.Random(5)
    texts = ["", None, " ", "  ", "a\n\nb", "a\n\n", "\n", "a.\n b", "x<|endoftext|> y", "don't. he'll?'s", "a.b.c", "a\x1c\nb", "a᠎\nb",
             "x　y", "\x01", "a\x01 b", "x" * 5000, " " * 3000, "\n" * 999, "a\r\nb", "1,000.5 e.g. (x)", "é. è\n"]
    for alphabet in ("ab c.'\n\té\U0001F600\x1c　\x01s1.,漢", "ab c.'\n é1.,!?)sS", "a \n"):
        texts += ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 50))) for _ in range(700)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    assert got(df) == plain(library, df.collect())


def test_one_document_is_read_alone(spark, documents, library):
    folder = common.scratch_path(spark, "token-files")
    index = t.write(documents, folder, JSON, end=2)
    text = {r.doc_id: r.text for r in documents.collect()}
    assert index.agg(F.sum("n_docs")).first()[0] == len(text)
    for row in index.orderBy("number").collect()[:2]:
        reader = t.Reader(row.file)
        ids = reader._column(0, 0, reader.n_docs).tolist()
        assert ids == sorted(ids) and reader.n_docs == row.n_docs
        for doc_id in random.Random(1).sample(ids, min(5, len(ids))):
            (place,) = reader.places(doc_id)
            assert reader.document(place).tolist() == [*library.encode(text[doc_id], add_special_tokens=False).ids, 2]
        with pytest.raises(ValueError):
            t.Reader(row.file, b"another dictionary")


def test_files_are_small_and_ids_come_back(spark, documents, library, monkeypatch):
    monkeypatch.setattr(t, "FILE_BYTES", 20_000)
    monkeypatch.setattr(t, "FILES_AT_ONCE", 3)
    monkeypatch.setattr(t, "READ_BYTES", 700)
    index = t.write(documents, common.scratch_path(spark, "token-files"), JSON, end=2)
    assert index.count() > 8
    rows = sorted(t.read(index, with_ids=True).collect(), key=lambda r: r.start)
    assert [tuple(r)[:4] for r in rows] == plain(library, documents.collect())
    text = {r.doc_id: r.text for r in documents.collect()}
    assert all(r.ids == [*library.encode(text[r.doc_id] or "", add_special_tokens=False).ids, 2] for r in rows[:50])


def test_slabs(library, monkeypatch):
    monkeypatch.setattr(pieces, "SLAB", 100)
    monkeypatch.setattr(pieces.PieceTable, "PIECES", 30)
    rng = random.Random(6)
    texts = ["".join(rng.choice("abc de.\n") for _ in range(n)) for n in (0, 5, 2000, 50, 700)]
    found = t.Ids(JSON, 2).documents(texts)
    assert [x.tolist() for x in found] == [[*library.encode(x, add_special_tokens=False).ids, 2] for x in texts]


def test_too_few_documents_to_train_on(spark, library):
    df = spark.createDataFrame([(2, "b"), (1, "a b"), (None, None)], "doc_id long, text string")
    assert got(df) == plain(library, df.collect())
