import hashlib
from collections import defaultdict

import numpy as np
import pandas as pd
from .conftest import DOCS, by_id
from pyspark.sql import functions as F

from ledgerlens.llm import mph_dedup as m


def brute(rows):
    groups = defaultdict(list)
    for d, text in rows:
        groups[text or ""].append(d)
    out = defaultdict(list)
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        first = True
        for d in ids:
            kept = d == keep and first
            first = first and not kept
            out[d].append((keep, len(ids), kept, hashlib.sha256(text.encode()).hexdigest()))
    return out


def same(got, expected):
    return {k: sorted(v, key=str) for k, v in got.items()} == {k: sorted(v, key=str) for k, v in expected.items()}


def test_against_brute_force(documents, odd, empty):
    for df in (documents, odd):
        expected = brute([(r.doc_id, r.text) for r in df.collect()])
        for history in (None, F.lit(True), F.lit(False), F.col("doc_id") < 50):
            kwargs = {} if history is None else {"in_history": F.coalesce(history, F.lit(True))}
            assert same(by_id(m.dedup(df, **kwargs), "keep_id", "group_size", "kept", "text_sha256"), expected)
    assert m.dedup(empty).count() == 0


def test_the_hash_is_minimal_and_perfect():
    rng = np.random.default_rng(1)
    for n in (1, 2, 63, 1000, 20_000):
        digests = rng.integers(0, 2 ** 63, (n, 4)).astype(np.uint64)
        row = m._build(0, digests, np.arange(n), np.ones(n, np.int64))
        slots = m._slots(digests, row["level_bits"], np.frombuffer(row["ranks"], np.int32))
        assert sorted(slots) == list(range(n))
        held = np.frombuffer(row["digests"], np.uint64).reshape(-1, 4)
        assert (held[slots] == digests).all() and (np.frombuffer(row["winners"], np.int64)[slots] == np.arange(n)).all()


def test_nonmembers_with_a_slot_are_told_by_their_bytes(spark):
    def rows(texts):
        return spark.createDataFrame(pd.DataFrame({"t": texts})).select(
            F.unhex(F.sha2("t", 256)).alias("sha256"), F.length("t").cast("long").alias("winner"), F.lit(2).cast("long").alias("copies"))

    history, asked = rows([f"old{i}" for i in range(500)]), rows([f"old{i}" for i in range(0, 500, 5)] + [f"new{i}" for i in range(500)])
    found = m.lookup(m.build_index(history, 3), asked, 3)
    assert found.count() == 100 and found.join(history, "sha256", "left_anti").count() == 0


def test_one_text_in_a_third_of_the_rows(spark):
    df = spark.range(9000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(
        F.concat(F.lit("t"), F.col("id"))).alias("text"))
    got = m.dedup(df)
    assert got.where("kept").count() == 6001
    assert got.where("group_size = 3000 and keep_id = 8997").count() == 3000


def test_deduplicated_rows_keep_their_columns(spark, odd, empty):
    kept = m.deduplicated(odd)
    assert kept.columns == odd.columns
    assert sorted((str(r.doc_id), r.text or "") for r in kept.collect()) == sorted(
        {(str(d), t or "") for d, t in [(3, " \n\t "), (2, ""), (4, "a b c"), (5, "A b C"), (7, odd.where("doc_id = 7").first().text),
                                        (8, odd.where("doc_id = 8").first().text), (9, "x"), (10, "long " * 20_000 + "end"),
                                        (11, odd.where("doc_id = 11").first().text)]})
    assert m.deduplicated(empty).count() == 0 and DOCS
