import duckdb
import public_tokenizers as P
import sentencepiece
from .conftest import SF
from .test_curriculum_mix import brute as brute_mix
from .test_trie_join import brute as brute_near

import corpus_pipeline
from ledgerlens.llm import curriculum_mix, trie_join
from ledgerlens.llm.oracle import quality_ctes


def brute(rows, path):
    """doc_id -> list of ids, one for each copy that the pipeline should give."""
    con = duckdb.connect()
    sql = quality_ctes(f"read_parquet('{path}')")
    good = {r[0] for r in con.execute(f"WITH {sql} SELECT doc_id FROM judged WHERE kept").fetchall()}
    rows = {d: (text, source) for d, text, source in rows if d in good}
    last = {}
    for d, (text, _) in rows.items():
        last[text] = max(last.get(text, d), d)
    rows = {d: v for d, v in rows.items() if last[v[0]] == d}
    near = brute_near([(d, v[0]) for d, v in rows.items()], trie_join.SHINGLE, trie_join.PERCENT)
    rows = {d: v for d, v in rows.items() if near[d][1] == d}
    mixed = brute_mix([(d, text, source) for d, (text, source) in rows.items()], curriculum_mix.Mix())
    library = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    out = {}
    for d, ((size, _, _, taken),) in mixed.items():
        if copies := (taken + size // 2) // size:
            out[d] = [library.encode(rows[d][0], add_bos=True, add_eos=True)] * copies
    return out


def test_run_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    expected = brute([(r.doc_id, r.text, r.source) for r in docs], f"{SF}/documents.parquet")
    got = {}
    for r in corpus_pipeline.run(spark, SF).collect():
        assert r.n_tokens == len(r.ids)
        got.setdefault(r.doc_id, []).append(r.ids)
    assert got == expected and len(got) > 100


def test_stages_keep_the_columns_and_odd_rows_pass(spark, odd, tmp_path):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "exact", "near", "mix", "encode"]
    docs = odd
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path / name)
        stage(spark, docs, str(tmp_path)).write.parquet(path)
        docs = spark.read.parquet(path)
        if k < 4:
            assert docs.columns == odd.columns
    assert {r.doc_id for r in docs.collect()} <= {6, 7, 8} and docs.count() > 0


def test_empty_documents(spark, empty, tmp_path):
    empty.write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_oracles_cover_what_sql_can_express():
    from ledgerlens.llm.oracle import ORACLE_SQL
    from ledgerlens.llm.queries import QUERIES

    assert {q.split("_")[0] for q in QUERIES} == {f"op{n}" for n in range(1, 14)} and set(ORACLE_SQL) < set(QUERIES)
