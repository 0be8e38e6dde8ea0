import hashlib
import random
from bisect import bisect_left
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
from tokenizers import Tokenizer

from ledgerlens.llm import sp_chunks, token_alignment as t, token_files, token_pieces as pieces

JSON, MODEL = token_files.vocabulary(P.path("byte_bpe_50k.json")), P.path("piece_bpe_32k.model")
COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.fixture(scope="module")
def libraries():
    bpe = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    bpe.encode_special_tokens = True
    return bpe, sentencepiece.SentencePieceProcessor(model_file=MODEL)


def plain(libraries, texts):
    """The contract word for word: whole texts, ranges compared pairwise."""
    bpe, sp = libraries
    byte = {c: bytes([b]) for c, b in pieces.byte_level().items()}
    docs, counts = [], Counter()
    for text in texts:
        docs.append(None)
        if not text:
            continue
        a, b = bpe.encode(" " + text, add_special_tokens=False).ids, sp.encode(text)
        of_a = [b"".join(byte[c] for c in bpe.id_to_token(i)) for i in a]
        of_b = [bytes([int(sp.id_to_piece(i)[1:-1], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if not b"".join(of_a) == b"".join(of_b) == (" " + text).encode():
            continue
        spans = []
        for tokens in (of_a, of_b):
            at, span = 0, []
            for x in tokens:
                span.append((at, at + len(x)))
                at += len(x)
            spans.append(span)
        ends = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
        groups, links = [], []
        inside = [[[] for _ in ends], [[] for _ in ends]]
        for k, span in enumerate(spans):
            for i, (_, e) in enumerate(span):
                inside[k][bisect_left(ends, e)].append(i)
        for ia, ib in zip(*inside):
            groups.append((",".join(str(a[i]) for i in ia), ",".join(str(b[i]) for i in ib)))
            links += [(a[i], b[j]) for i in ia for j in ib
                      if max(spans[0][i][0], spans[1][j][0]) < min(spans[0][i][1], spans[1][j][1])]
        counts.update(links)
        docs[-1] = (a, b, groups, links)
    best = defaultdict(int)
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    for d in docs:
        if d is None:
            yield (0, 0, 0, 0, 0, 0, "")
            continue
        a, b, groups, links = d
        yield (len(a), len(b), len(groups), len(links), sum(counts[x] == best[x[1]] for x in links),
               sum(counts[x] for x in links), hashlib.sha256(";".join(map("|".join, groups)).encode()).hexdigest())


def check(spark, libraries, df):
    rows = df.select("doc_id", "text").collect()
    want = defaultdict(list)
    for r, w in zip(rows, plain(libraries, [r.text for r in rows])):
        want[r.doc_id].append(w)
    got = defaultdict(list)
    for r in t.aligned(df, JSON, sp_chunks.model_bytes(MODEL)).collect():
        got[r.doc_id].append(tuple(r[c] for c in COLUMNS))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}


def test_documents_against_plain_reading(spark, libraries, documents):
    check(spark, libraries, documents)


def test_odd_rows(spark, libraries, odd, empty):
    check(spark, libraries, odd)
    assert t.aligned(empty, JSON, sp_chunks.model_bytes(MODEL)).count() == 0


def test_odd_texts(spark, libraries, monkeypatch):
    rng = random.Random(3)
    texts = ["", None, " ", "  ", "a ", " a", "▁", "a▁b", "<|endoftext|>", "x <|endoftext|> y", "<s>", "<0x41>", "\x00", "\x01 a", "\n", "a\n",
             "a\x1c b", "a \x85 b", "a᠎ b", "naïve café 漢字 \U0001F600", "x" * 3000, " " * 500, "don't we'll ' s"]
    texts += ["".join(rng.choice("ab c.'\n\té\U0001F600\x1c　\x01<s>1.,漢▁") for _ in range(rng.randint(0, 40))) for _ in range(600)]
    texts += ["".join(rng.choice("ab c.'\n é1.,漢") for _ in range(rng.randint(0, 60))) for _ in range(600)]
    check(spark, libraries, spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3))


def test_rare_pairs_come_back_by_a_join_and_the_result_is_the_same(spark, libraries, documents, monkeypatch):
    monkeypatch.setattr(t, "FREQUENT", 5)
    check(spark, libraries, documents.limit(60))


def test_long_texts_in_slabs_and_a_small_table(libraries, monkeypatch):
    monkeypatch.setattr(pieces, "SLAB", 200)
    monkeypatch.setattr(pieces.PieceTable, "PIECES", 40)
    rng = random.Random(4)
    texts = [" ".join("".join(rng.choice("abcdé.") for _ in range(rng.randint(1, 7))) for _ in range(n)) for n in (1, 50, 900, 3)]
    table = t.Alignments(JSON, sp_chunks.model_bytes(MODEL))
    for got, want in zip(table.documents(texts), plain(libraries, texts)):
        assert (got.n_a, got.n_b, got.n_groups, int(got.times.sum()), got.digest) == (*want[:4], want[6])


def test_slices_and_links_by_hand():
    a, b = np.array([1, 3, 6]), np.array([2, 3, 4, 6])
    assert [x.tolist() for x in t.sliced(a, b)] == [[2, 3], [2, 4]]
    assert list(zip(*map(np.ndarray.tolist, t.linked(a, b)))) == [(0, 0), (1, 0), (1, 1), (2, 2), (2, 3)]


def test_a_model_whose_pieces_reach_over_cuts_is_refused():
    class Model:
        get_piece_size = staticmethod(lambda: 2)
        is_byte = staticmethod(lambda i: False)
        id_to_piece = staticmethod(["ab", "e.g"].__getitem__)

    import unittest.mock

    with unittest.mock.patch("sentencepiece.SentencePieceProcessor", lambda **_: Model), pytest.raises(ValueError, match="e.g"):
        t.check_cuts(b"")
