import hashlib
import math
import zlib
from collections import Counter, defaultdict

from .conftest import by_id
from pyspark.sql import functions as F

from ledgerlens.llm import hash_tree as h


def brute(doc_id, node):
    while node.children:
        def draw(c):
            bits = int(hashlib.md5(f"{c.name}:{doc_id}".encode()).hexdigest()[:13], 16)
            return -math.log((bits + 0.5) / 2 ** 52) / c.weight

        node = min((c for c in node.children if c.weight > 0), key=draw)
    return node.shard


def test_descent_against_brute_force(spark, documents):
    grown = h.grown(h.TREE, 24)
    got = by_id(h.sharded(documents), "shard", "grown_shard", "size", "text_crc32")
    for r in documents.collect():
        body = r.text.encode()
        assert got[r.doc_id] == [(brute(r.doc_id, h.TREE.root), brute(r.doc_id, grown.root), len(body) + 8, zlib.crc32(body))]


def test_slots_have_no_gaps(documents, odd):
    for df in (documents, odd):
        slots = defaultdict(list)
        for r in h.sharded(df).collect():
            slots[r.shard].append(r.slot)
        assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and all(0 <= k < 24 for k in slots)


def test_weights_hold_and_growth_moves_into_the_new_shard_alone(spark):
    ids = spark.range(60_000).select(F.col("id").cast("string").alias("id"))
    heavy = h.Tree((h.region("r0", 3, 4, 0), h.region("r1", 3, 4, 12, weight=2.0)))
    rows = ids.select(h.leaf(F.col("id"), h.TREE).alias("a"), h.leaf(F.col("id"), h.grown(h.TREE, 24)).alias("b"),
                      h.leaf(F.col("id"), heavy).alias("c")).collect()
    counts = Counter(r.a for r in rows)
    assert len(counts) == 24 and all(abs(n - 2500) < 250 for n in counts.values())
    moved = [r for r in rows if r.a != r.b]
    assert {r.b for r in moved} == {24} and abs(len(moved) - 2400) < 250
    # a heavier region takes rows and gives none; inside a region nothing moves
    assert all(r.a == r.c or r.a < 12 <= r.c for r in rows)
    assert abs(sum(r.c >= 12 for r in rows) / len(rows) - 2 / 3) < 0.02


def test_odd_rows(odd, empty):
    got = by_id(h.sharded(odd), "size", "text_crc32", "shard")
    assert got[1][0][:2] == (8, 0) and got[2][0][:2] == (8, 0) and len(set(got[6])) == 1
    assert len({r[2] for r in got[None]}) == 1 and h.sharded(empty).count() == 0
