import random
import re
from collections import defaultdict

import numpy as np
import pytest
from .conftest import DOCS, by_id

from ledgerlens.llm import trie_join as t

LOWER = {i: i + 32 for i in range(65, 91)}


def brute(rows, shingle, percent):
    """doc_id -> (n_shingles, component) by comparing all pairs that share a shingle."""
    sets = []
    for _, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
        n = min(shingle, len(w))
        sets.append({tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if n else set())
    up = list(range(len(rows)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    holders = defaultdict(list)
    for i, s in enumerate(sets):
        shared = defaultdict(int)
        for g in s:
            for j in holders[g]:
                shared[j] += 1
            holders[g].append(i)
        for j, o in shared.items():
            if 100 * o >= percent * (len(s) + len(sets[j]) - o):
                up[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    return {d: (len(s), least[find(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets))}


def families(seed, n_families, size, length):
    """Families of texts with a few words changed: similarities on both sides of the threshold."""
    rng = random.Random(seed)
    rows = []
    for f in range(n_families):
        base = [f"f{f}w{rng.randint(0, 9999)}" for _ in range(rng.randint(*length))]
        passage = [f"p{f % 3}x{k}" for k in range(12)]
        for _ in range(rng.randint(1, size)):
            words = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 5, 8])):
                words[rng.randrange(len(words))] = f"e{rng.randint(0, 10 ** 6)}"
            if rng.random() < 0.3:
                at = rng.randrange(len(words))
                words[at:at] = passage
            rows.append(" ".join(words))
    rng.shuffle(rows)
    return [(i * 3 + 1, x) for i, x in enumerate(rows)]


@pytest.mark.parametrize("shingle,percent", [(4, 85), (5, 80)])
def test_against_brute_force(spark, shingle, percent):
    rows = families(11, 25, 30, (6, 40)) + [(10 ** 6 + i, x) for i, (_, x) in enumerate(families(12, 12, 40, (80, 300)))]
    df = spark.createDataFrame([(d, x, "en", "s", 0) for d, x in rows], DOCS)
    got = by_id(t.similar(df, t.TrieJoin(shingle, t.Similarity(percent))), "n_shingles", "component_id")
    expected = brute(rows, shingle, percent)
    assert {k: v[0] for k, v in got.items()} == expected
    assert len({c for _, c in expected.values()}) < len(rows) - 100


def test_large_groups_in_blocks_and_single_buckets(spark, monkeypatch):
    """Blocks of 5 sets and no clusters: block meets block, bucket by bucket."""
    monkeypatch.setattr(t, "BLOCK", 5)
    monkeypatch.setattr(t, "CLUSTER", 4)
    rows = families(21, 3, 70, (40, 60))
    df = spark.createDataFrame([(d, x, "en", "s", 0) for d, x in rows], DOCS)
    got = by_id(t.similar(df, t.TrieJoin(4, t.Similarity(85))), "n_shingles", "component_id")
    assert {k: v[0] for k, v in got.items()} == brute(rows, 4, 85)


def test_tree_finds_what_comparing_finds():
    rng = np.random.default_rng(4)
    for percent in (50, 80, 95):
        sim = t.Similarity(percent)
        for _ in range(60):
            base = np.unique(rng.integers(0, 2 ** 63, rng.integers(1, 90)).astype(np.uint64))
            sets = {}
            for _ in range(30):
                s = base[rng.random(len(base)) > rng.choice([0, 0.02, 0.1, 0.3])]
                s = np.unique(np.concatenate([s, rng.integers(0, 2 ** 63, rng.integers(0, 6)).astype(np.uint64)]))
                if len(s):
                    sets[s.tobytes()] = s
            sets = list(sets.values())
            tree = t.Tree(sets, list(range(len(sets))))
            for x in sets:
                found = {tree.order[k] for k in tree.probe(x, np.ones(len(sets), bool), sim)}
                assert found == {i for i, y in enumerate(sets) if 100 * (o := len(np.intersect1d(x, y)))
                                 >= percent * (len(x) + len(y) - o)}


def test_tree_finds_sets_that_go_on_from_one_that_ends_with_a_level():
    rng = np.random.default_rng(8)
    base = np.unique(rng.integers(0, 2 ** 63, 60).astype(np.uint64))
    sets = [base[:n] for n in (15, 16, 17, 20, 31, 32, 33, 36, 48, 49)]
    sets += [np.append(base[:n], base[n + 1]) for n in (16, 17, 32, 33, 48)]  # two that go on from one
    tree = t.Tree(sets, list(range(len(sets))))
    for percent in (50, 80, 95):
        sim = t.Similarity(percent)
        for x in sets:
            found = sorted(tree.order[k] for k in tree.probe(x, np.ones(len(sets), bool), sim))
            assert found == [i for i, y in enumerate(sets) if 100 * (o := len(np.intersect1d(x, y)))
                             >= percent * (len(x) + len(y) - o)]


def test_similar_sets_share_the_buckets_they_owe():
    rng = np.random.default_rng(6)
    for percent in (80, 85):
        sim, checked = t.Similarity(percent), 0
        for _ in range(1500):
            n = int(rng.integers(4, 400))
            x = np.unique(rng.integers(0, 2 ** 63, n).astype(np.uint64))
            d = int(rng.integers(0, max(1, n // 8) + 1))
            y = np.unique(np.concatenate([x[rng.permutation(len(x))[:len(x) - d // 2]],
                                          rng.integers(0, 2 ** 63, d - d // 2).astype(np.uint64)]))
            o = len(np.intersect1d(x, y))
            if not len(y) or 100 * o < percent * (len(x) + len(y) - o) or o == len(x) == len(y):
                continue
            common = np.sort(rng.permutation(x)[:len(x) // int(rng.integers(2, 9))])
            checked += 1
            groups = [{int(b[0]) & t.TAG: (set(b.tolist()), need) for b, need in t.buckets(s, common, sim)} for s in (x, y)]
            shared = {k: len(groups[0][k][0] & groups[1][k][0]) for k in groups[0].keys() & groups[1].keys()}
            assert any(shared[k] >= max(groups[0][k][1], groups[1][k][1]) for k in shared)
        assert checked > 200


def test_odd_rows(odd, empty):
    got = by_id(t.similar(odd, t.TrieJoin(4, t.Similarity(85))), "n_shingles", "component_id")
    assert got[1] == [(0, 1)] and got[2] == [(0, 2)] and got[3] == [(0, 3)]
    assert got[4] == [(1, 4)] and got[5] == [(1, 4)] and sorted(got[None], key=str) == [(0, None), (1, 4)]
    assert got[6] == [(57, 6)] * 2 and got[7] == [(57, 6)] and got[8] == [(57, 6)] and got[10] == [(2, 10)]
    assert t.similar(empty).count() == 0 and t.deduplicated(empty).count() == 0
    kept = t.deduplicated(odd, t.TrieJoin(4, t.Similarity(85)))
    assert kept.columns == odd.columns
    assert sorted((str(r.doc_id) for r in kept.collect())) == sorted(map(str, [1, 2, 3, 4, 6, 6, 9, 10, 11, None]))


def test_packed_buckets_come_back_as_lists():
    rng = np.random.default_rng(4)
    pool = rng.integers(0, 2 ** 63, 300).astype(np.uint64) << np.uint64(1)
    found = [np.unique(rng.choice(pool, 20)) for _ in range(60)] + [pool[:30]] * 3
    expected = defaultdict(int)
    for key in pool:
        ids = tuple(i for i, f in enumerate(found) if key in f)
        if len(ids) > 1:
            expected[ids] += 1
    parts = defaultdict(list)
    for first, some in ((0, found[:40]), (40, found[40:])):
        for part, keys, places in t._packed(some, 5):
            parts[part].append(t._unpacked(first, keys, places))
    got = defaultdict(int)
    for held in parts.values():
        columns, begins, ids = t._lists(*map(np.concatenate, zip(*held)))
        for times, b, e in zip(columns[3], begins, begins[1:]):
            got[tuple(ids[b:e].tolist())] += int(times)
    assert len(parts) == 5 and got == expected


def test_near_copies_keep_few_rows(spark, monkeypatch):
    """Sets that share most of their buckets go on as lists, not as a row for each set and bucket."""
    rng, rows, held = random.Random(3), [], {}
    for group in range(30):
        words = [f"w{rng.randrange(10 ** 6)}" for _ in range(400)]
        rows += [(group * 4 + k, " ".join([f"a{k}", *words, f"z{k}"])) for k in range(4)]

    def counted(df, tag, written=t.written, **options):
        out = written(df, tag, **options)
        held[tag] = max(held.get(tag, 0), out.count())
        return out

    monkeypatch.setattr(t, "written", counted)
    kept = t.deduplicated(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(r.doc_id for r in kept.collect()) == [group * 4 for group in range(30)]
    assert held["buckets"] < 20 * len(rows)  # a set of 400 words has over 100 buckets


def test_chance_buckets_make_no_company(spark):
    """Pairs that share fewer buckets than they must are no company, unless a bucket has many sets."""
    columns = "bucket long, node long, tag long, need long, times long, hub long"
    rows = [(1, 1, 0, 3, 2, 1), (1, 2, 0, 3, 2, 1), (2, 1, 0, 3, 1, 1), (2, 2, 0, 3, 1, 1), (2, 3, 0, 3, 1, 1),
            *((9, node, 0, 3, 1, 10) for node in range(10, 10 + t.FEW + 1))]
    got = {(r.a, r.b) for r in t._company(spark.createDataFrame(rows, columns)).collect()}
    assert got == {(1, 2)} | {(10, node) for node in range(11, 10 + t.FEW + 1)}


def test_shuffles_go_when_a_table_is_written(spark):
    held = spark._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker().shuffleStatuses()
    before = held.size()
    rows = t.written(spark.range(1000).groupBy((t.F.col("id") % 7).alias("k")).count(), "test-groups")
    assert rows.count() == 7 and held.size() <= before + 1  # that of this last count may be there
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false") == "false"
