import base64
import random
import re

import public_tokenizers as P
import pytest
import tiktoken
from .conftest import DOCS, SF

from ledgerlens.llm import common, token_rollup as t
from ledgerlens.llm.queries import QUERIES

RANKS = P.path("byte_bpe_50k.tiktoken")


def changes(spark, *rows):
    """Rows of ``CHANGES`` without their copy, which is null and counts as 0."""
    return spark.createDataFrame([(r[0], None, *r[1:]) for r in rows], t.CHANGES)


def totals(ledger):
    return {(r.source, r.lang, r.tokenizer): (r.n_docs, r.n_tokens) for r in ledger.totals().collect()}


@pytest.fixture(scope="module")
def coder():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def plain(coder, rows):
    """Every row counted once, as a plain loop does."""
    out = {}
    for r in rows:
        words = len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
        for version, n in ((t.WORDS, words), (t.BPE, len(coder.encode_ordinary(r.text or "")))):
            a, b = out.get((r.source, r.lang, version), (0, 0))
            out[r.source, r.lang, version] = (a + 1, b + n)
    return out


def test_signed_changes_and_idempotent_commits(spark):
    ledger = t.Ledger(spark, common.scratch_path(spark, "ledger-test"))
    assert totals(ledger) == {}
    load = changes(spark, (1, "v1", "insert", "a", "en", 10, 0), (2, "v1", "insert", "a", "en", 5, 0),
                   (3, "v1", "insert", "b", None, 7, 0), (3, "v2", "insert", "b", None, 9, 0))
    assert ledger.apply("b1", load)
    first = {("a", "en", "v1"): (2, 15), ("b", None, "v1"): (1, 7), ("b", None, "v2"): (1, 9)}
    assert totals(ledger) == first
    assert not ledger.apply("b1", load) and totals(ledger) == first  # delivered again
    second = changes(spark, (1, "v1", "revise", "a", "en", 12, 0), (2, "v1", "delete", None, None, None, 0),
                     (3, "v1", "revise", "c", "fr", 8, 0), (9, "v1", "delete", "a", "en", 1, 0),
                     (4, "v1", "revise", "a", "en", 1, 1), (4, "v1", "insert", "a", "en", 99, 0))
    assert ledger.apply("b2", second)
    assert totals(ledger) == {("a", "en", "v1"): (2, 13), ("c", "fr", "v1"): (1, 8), ("b", None, "v2"): (1, 9)}
    assert ledger.apply("b3", changes(spark, (2, "v1", "insert", "a", "de", 3, 0)))  # back after a delete
    assert totals(ledger)[("a", "de", "v1")] == (1, 3)


def test_a_batch_that_broke_off_is_written_anew(spark):
    ledger = t.Ledger(spark, common.scratch_path(spark, "ledger-test"))
    batch = changes(spark, (1, "v1", "insert", "a", "en", 10, 0))
    batch.withColumnRenamed("op", "x").write.parquet(f"{ledger.folder}/entries/batch=b1")  # left by a lost driver
    assert totals(ledger) == {} and ledger.apply("b1", batch)
    assert totals(ledger) == {("a", "en", "v1"): (1, 10)}


def test_copies_of_a_doc_id_are_documents_of_their_own(spark):
    ledger = t.Ledger(spark, common.scratch_path(spark, "ledger-test"))
    rows = [(None, 4, "v", "insert", "a", "en", 3, 0), (None, 9, "v", "insert", "a", "en", 5, 0), (7, 1, "v", "insert", "a", "en", 1, 0),
            (7, 2, "v", "insert", "b", "en", 1, 0), (None, 4, "v", "insert", "a", "en", 3, 0)]
    assert ledger.apply("b1", spark.createDataFrame(rows, t.CHANGES))
    assert totals(ledger) == {("a", "en", "v"): (3, 9), ("b", "en", "v"): (1, 1)}
    assert ledger.apply("b2", spark.createDataFrame([(None, 9, "v", "delete", None, None, None, 0)], t.CHANGES))
    assert totals(ledger) == {("a", "en", "v"): (2, 4), ("b", "en", "v"): (1, 1)}


def test_batches_read_the_buckets_they_change_and_compaction_changes_nothing(spark, monkeypatch):
    monkeypatch.setattr(t, "COMPACT_EVERY", 3)
    rng, ledger, state = random.Random(3), t.Ledger(spark, common.scratch_path(spark, "ledger-test")), {}
    for b in range(8):
        batch = []
        for doc in rng.sample(range(12), 4):
            op = rng.choice(["insert", "revise", "delete"])
            n = rng.randint(1, 9)
            batch.append((doc, "v", op, "ab"[doc % 2], "en", n, 0))
            state[doc] = n
            if op == "delete":
                del state[doc]
        assert ledger.apply(f"b{b}", changes(spark, *batch))
        want = {}
        for doc, n in state.items():
            a, s = want.get(("ab"[doc % 2], "en", "v"), (0, 0))
            want["ab"[doc % 2], "en", "v"] = (a + 1, s + n)
        assert totals(ledger) == want
    assert ledger._compacted() == 6
    files = ledger.state([t_.bucket for t_ in spark.createDataFrame([(3, 0)], "doc_id long, copy long").select(t.bucket()).collect()]).inputFiles()
    assert files and all("/batch=b6/" in f or "/batch=b7/" in f or "/states/6/" in f for f in files)


def test_query_against_counting_anew(spark, documents, coder):
    got = {(r.source, r.lang, r.tokenizer): (r.n_docs, r.n_tokens) for r in QUERIES["op4_token_rollup"](spark, SF).collect()}
    assert got == plain(coder, documents.collect())


def test_every_row_counts(spark, odd, empty, coder):
    """Null and repeated doc_ids, null texts, sources and languages."""
    more = spark.createDataFrame([(None, "null id one", "en", "a", 0), (None, "null id two", "en", "a", 0),
                                  (7, "seven", "en", "a", 0), (7, "seven again", "en", "a", 0)], DOCS)
    for df in (odd, more):
        got = {(r.source, r.lang, r.tokenizer): (r.n_docs, r.n_tokens) for r in t.whole_totals(df, RANKS, P.PATTERN).collect()}
        assert got == plain(coder, df.collect())
    assert t.whole_totals(empty, RANKS, P.PATTERN).count() == 0


def test_long_runs_of_white_space_count_as_in_the_library(coder):
    rng = random.Random(8)
    for n in (1, 499, 500, 501, 1200, 4000):
        for run in (" " * n, "\n" * n, "\t" * n, "".join(rng.choice(" \n\t\u3000") for _ in range(n))):
            for text in (run, "a" + run, run + "b", "a" + run + "b", f"x.{run}{run} y {run}'s", f"\x1c{run}\x1c{run}é"):
                assert t.n_ids(coder, text) == len(coder.encode_ordinary(text)), (n, text[:20])


@pytest.mark.parametrize("kind", [" ", "\t", "\n", " \n"])
def test_a_million_characters_of_white_space_do_not_end_the_query(spark, coder, kind):
    text = (kind * 1_000_000)[:1_000_000]
    df = spark.createDataFrame([(1, text, "en", "a", 0), (2, f"a{text}b", "en", "a", 0)], DOCS)
    (row,) = t.counted(df.where("doc_id = 1"), RANKS, P.PATTERN).collect()
    assert row.n_words == 0 and row.n_ids == len(coder._core_bpe.encode_single_piece(text.encode()))
    got = {r.tokenizer: (r.n_docs, r.n_tokens) for r in t.whole_totals(df, RANKS, P.PATTERN).collect()}
    assert got[t.WORDS] == (2, 2) and got[t.BPE][0] == 2 and got[t.BPE][1] > 2 * row.n_ids - 10


def test_schema_of_changes(spark):
    rows = spark.createDataFrame([(1, 0, "s", "en", 3)], "doc_id long, copy long, source string, lang string, n_tokens int")
    assert t.changes(rows, "v", t.INSERT).schema.simpleString() == spark.createDataFrame([], t.CHANGES).schema.simpleString()
