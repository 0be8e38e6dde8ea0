import hashlib
import random
import zlib

import pytest

from ledgerlens.llm import merkle_manifest as m


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row, text):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}"
                       for v in (row.doc_id, row.source, row.lang, row.n_chars, text)))


def tree(digests):
    """Root, and for each leaf the siblings' runs: (others on the left, others on the right) level by level."""
    paths, level, owners = [[] for _ in digests], list(digests), [[i] for i in range(len(digests))]
    while len(level) > 1:
        above, held = [], []
        for b in range(0, len(level), 16):
            run = level[b:b + 16]
            for k, node in enumerate(owners[b:b + 16]):
                for i in node:
                    paths[i].append((run[:k], run[k + 1:]))
            above.append(sha("".join(run)))
            held.append([i for node in owners[b:b + 16] for i in node])
        level, owners = above, held
    return level[0], paths


def plain(rows):
    sources = {}
    for r in rows:
        sources.setdefault(r.source, []).append((r.doc_id is not None, r.doc_id or 0, leaf_of(r, r.text), r))
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    for s in names:
        sources[s].sort(key=lambda x: x[:3])
    built = {s: tree([x[2] for x in sources[s]]) for s in names}
    root, tops = tree([built[s][0] for s in names])
    for s, top in zip(names, tops):
        for (_, _, digest, r), path in zip(sources[s], built[s][1]):
            siblings, now, text = path + top, digest, r.text
            if r.doc_id is not None and text is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
                now = leaf_of(r, text)
            for left, right in siblings:
                now = sha("".join([*left, now, *right]))
            proof = sha("".join(x for left, right in siblings for x in [*left, *right]))
            yield (r.doc_id, digest, built[s][0], root, proof, now, now == root)


def check(df):
    want = sorted(plain(df.collect()), key=str)
    got = sorted((tuple(r) for r in m.manifest(df).collect()), key=str)
    assert got == want
    return got


def test_documents_against_plain_reading(documents):
    rows = check(documents)
    assert {r[6] for r in rows} == {True, False}


def test_many_levels(spark, monkeypatch):
    """Blocks of 16 leaves, so that all kinds of levels meet: trees of 1, 16, 17, 257 and 4,300 leaves."""
    monkeypatch.setattr(m, "BLOCK_LEVELS", 1)
    monkeypatch.setattr(m, "BLOCK", 16)
    rng, rows = random.Random(2), []
    for name, n in (("one", 1), (None, 16), ("Ä", 17), ("b", 257), ("hot", 4300), *((f"s{i}", 2) for i in range(20))):
        rows += [(len(rows) + i, f"Text {rng.random()}" if rng.random() < 0.9 else "low", "en", name, i) for i in range(n)]
    rng.shuffle(rows)
    check(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(7))


def test_odd_rows(odd, empty):
    check(odd)
    assert m.manifest(empty).count() == 0


@pytest.mark.parametrize("n", [1, 2, 16])
def test_folding_resumes_the_state_before_the_slot(n):
    digests = [sha(str(i)) for i in range(n)]
    parent = m.Parent(digests)
    assert parent.digest == sha("".join(digests)) and len(parent.before) == n
    for k in range(n):
        assert parent.folded(k, digests[k]) == parent.digest
        assert parent.folded(k, sha("x")) == sha("".join([*digests[:k], sha("x"), *digests[k + 1:]]))


def test_height():
    assert [m.height(n) for n in (0, 1, 2, 16, 17, 256, 257, 4096, 4097)] == [0, 0, 1, 1, 2, 2, 3, 3, 4]
