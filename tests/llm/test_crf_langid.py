import random
import zlib

import numpy as np
import pytest
from .conftest import DOCS, by_id

from ledgerlens.llm import crf_langid as c


def test_blocked_recursions_equal_word_after_word():
    rng = np.random.default_rng(0)
    sizes = np.array([1, 5, 32, 33, 64, 200, 2])
    scores, transitions = rng.normal(size=(sizes.sum(), 3)) * 3, rng.normal(size=(3, 3))
    got, o = c.marginals(scores, sizes, transitions), 0
    for n in sizes:
        e, a = np.exp(scores[o:o + n]), np.exp(transitions)
        forward, back = [e[0] / e[0].sum()], [np.ones(3)]
        for t in range(1, n):
            f = (forward[-1] @ a) * e[t]
            forward.append(f / f.sum())
        for t in range(n - 1, 0, -1):
            b = a @ (e[t] * back[-1])
            back.append(b / b.sum())
        p = np.array(forward) * np.array(back[::-1])
        assert np.abs(p / p.sum(axis=1, keepdims=True) - got[o:o + n]).max() < 1e-12
        o += n


@pytest.fixture(scope="module")
def two_languages(spark):
    rng = random.Random(2)
    heads = {"xx": ["bra", "tro", "kle", "sto"], "yy": ["lami", "noru", "sevi", "dapo"]}
    rows = []
    for i in range(400):
        lang = rng.choice(["xx", "yy"])
        words = ["".join(rng.choice(heads[lang]) for _ in range(rng.randint(1, 3))) for _ in range(rng.randint(5, 60))]
        rows.append((i, " ".join(words).capitalize() + ".", lang if i % 7 else None, "s", 0))
    return spark.createDataFrame(rows, DOCS)


def test_held_out_accuracy_and_columns(two_languages):
    model = c.learned(two_languages)
    assert model.labels == ["xx", "yy"]
    truth = {r.doc_id: r.lang for r in two_languages.collect()}
    for r in c.identified(two_languages, model).collect():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1
        assert r.lang_pred == truth[r.doc_id] or truth[r.doc_id] is None


def test_code_switched_text_is_labelled_word_by_word(two_languages):
    labeller = c.Labeller(c.learned(two_languages))
    text = "brakle stotro klebra " * 5 + "lamidapo norusevi lami " * 5
    (_, p), = labeller.words([text])
    assert [labeller.model.labels[k] for k in p.argmax(axis=1)] == ["xx"] * 15 + ["yy"] * 15


def test_a_text_in_parts_gives_the_same(two_languages, monkeypatch):
    labeller = c.Labeller(c.learned(two_languages))
    text = "brakle stotro, klebra " * 200
    (_, whole), = labeller.words([text])
    monkeypatch.setattr(c, "CHARS", 97)
    (_, parts), = labeller.words([text])
    assert np.abs(whole - parts).max() < 1e-12


def test_held_out_rows_and_nulls_are_not_learned_from(two_languages, spark):
    out = two_languages.where(c.remainder(two_languages["doc_id"]) == 1)
    assert c.learned(out) is None
    assert c.learned(two_languages.withColumn("lang", two_languages["lang"].substr(9, 1)).where("lang is null")) is None


def test_given_documents(documents):
    truth = {r.doc_id: r.lang for r in documents.collect()}
    got = c.identified(documents, c.learned(documents)).where("held_out").collect()
    assert sum(r.lang_pred == truth[r.doc_id] for r in got) >= 0.9 * len(got)


def test_odd_rows(odd, empty):
    got = by_id(c.identified(odd, c.learned(odd)), "lang_pred", "score")
    assert got[1] == [("und", 0.0)] and got[2] == [("und", 0.0)] and got[3] == [("und", 0.0)]
    assert {x[0] for x in got[6]} <= {"en", "fr", "de"} and len(got[6]) == 2 and len(got[None]) == 2
    assert c.identified(empty, c.learned(empty)).count() == 0
    assert {r.lang_pred for r in c.identified(odd, None).collect()} == {"und"}


def test_few_words_train_too(spark):
    """Twelve short documents in two languages, under 64 words in all."""
    en, fr = ["the cat and the dog", "the house of the man", "and then the day"], ["le chat et le chien", "la maison de la femme", "et puis le jour"]
    rows = [(i, text, lang, "s", 0) for i, (text, lang) in enumerate(2 * ([(x, "en") for x in en] + [(x, "fr") for x in fr]))]
    df = spark.createDataFrame(rows, DOCS)
    model = c.train([r[1] for r in rows], [r[2] for r in rows], c.Features())
    got = {r.doc_id: (r.lang_pred, r.score) for r in c.identified(df, model).collect()}
    assert all(got[r[0]][0] == r[2] and got[r[0]][1] > 0.6 for r in rows)


def test_a_language_of_long_documents_alone_is_learned(spark):
    rows = [(i, "der hund und die katze " * 3, "de", "s", 0) for i in range(12)]
    rows += [(100 + i, "o gato e o cachorro " * 2_000, "pt", "s", 0) for i in range(12)]
    df = spark.createDataFrame(rows, DOCS)
    model = c.learned(df)
    assert model.labels == ["de", "pt"]
    assert {r.lang_pred for r in c.identified(df, model).where("doc_id >= 100").collect()} == {"pt"}


def test_the_sample_is_bounded_in_all(spark, monkeypatch):
    monkeypatch.setattr(c, "SAMPLE_ALL", 40)
    taken = []
    monkeypatch.setattr(c, "train", lambda texts, languages, features: taken.append(len(texts)))
    rows = [(i, f"word{i}", f"l{i % 10}", "s", 0) for i in range(900)]
    c.learned(spark.createDataFrame(rows, DOCS))
    assert 0 < taken[0] <= 10 * max(c.SAMPLE_LEAST, 4)
