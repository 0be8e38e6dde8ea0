import hashlib
import random
import struct

import public_tokenizers as P
import pytest
import sentencepiece
from .conftest import by_id

from ledgerlens.llm import sp_chunks as s

MODEL = P.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def expected(library, text):
    ids = library.encode(text or "", add_bos=True, add_eos=True)
    return (len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(),
            hashlib.sha256(library.decode(ids).encode()).hexdigest())


def test_odd_texts_as_the_library(library, monkeypatch):
    monkeypatch.setattr(s, "SLAB", 300)
    monkeypatch.setattr(s, "TABLE_CHUNKS", 50)
    rng = random.Random(1)
    texts = ["", None, " ", "  ", "a", "▁▁ x", "a ", "a  ", " a  b\n c ", "\x00a", "é́ \U0001F600 ▁", "<s> hi </s>",
             "\n\n a\t\tb  ", "x" * 5000 + " " + "y " * 3000, " " * 3000, "�", "　 a", " \xa0 b"]
    texts += ["".join(rng.choice("ab c ▁\n\té\U0001F600\x00<s>1.,漢") for _ in range(rng.randint(0, 60))) for _ in range(1500)]
    table = s.ChunkTable(s.model_bytes(MODEL))
    for begin in range(0, len(texts), 37):
        part = texts[begin:begin + 37]
        for text, d in zip(part, table.documents(part, True)):
            assert (d.n, d.ids_sha.hexdigest(), d.text_sha.hexdigest()) == expected(library, text), repr(text)
            assert sum(map(len, d.ids)) == d.n


def test_documents_as_the_library(spark, documents, odd, empty, library):
    model = s.model_bytes(MODEL)
    for df in (documents, odd):
        got = by_id(s.encoded(df, model), "n_tokens", "ids_sha256", "decoded_sha256")
        for r in df.collect():
            assert expected(library, r.text) in got[r.doc_id]
    ids = {r.doc_id: r.ids for r in s.encoded(documents, model, with_ids=True).collect()}
    assert all(ids[r.doc_id] == library.encode(r.text, add_bos=True, add_eos=True) for r in documents.collect())
    assert s.encoded(empty, model).count() == 0


def test_each_chunk_is_encoded_once(library):
    table = s.ChunkTable(s.model_bytes(MODEL))
    calls = []
    add = table.add
    table.add = lambda chunks: (calls.extend(chunks), add(chunks))
    table.documents(["the cat and the dog"] * 50 + ["the dog"], False)
    table.documents(["and the cat"], False)
    assert sorted(calls) == sorted([" the", " cat", " and", " dog"])
