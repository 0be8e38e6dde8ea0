import random
import re
from collections import Counter

from .conftest import DOCS, by_id
from pyspark.sql import functions as F

from ledgerlens.llm import quality_rules as q


def brute(text):
    text = text or ""
    ws = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(ws[i:i + 5]) for i in range(len(ws) - 4)]
    twice = Counter(windows)
    covered = {p for i, w in enumerate(windows) if twice[w] > 1 for p in range(i, i + 5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(ws), sum(map(len, ws)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def test_measures_against_brute_force(spark):
    rng = random.Random(5)
    texts = ["", " ", None, "a", "a b c d e", "a b c d e a b c d e", "x " * 50]
    texts += ["".join(rng.choice(["a", "b", " ", " ", "\n", "#", "é", "\x0b"]) for _ in range(rng.randint(0, 120)))
              for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").select("doc_id", q.measures(F.col("text")).alias("m"))
    for r in df.collect():
        m = r.m
        assert (m.n_words, m.word_chars, m.n_symbols, m.n_dup_lines, m.n_repeat_words) == brute(texts[r.doc_id]), texts[r.doc_id]


def test_buckets_are_in_order_and_close(spark):
    df = spark.range(0, 300_000, 37).select("id", q.bucket(F.col("id")).alias("b"))
    rows = df.select("id", "b", q.bucket_top(F.col("b")).alias("top")).collect()
    assert all(a.b <= b.b for a, b in zip(rows, rows[1:]))
    assert all(r.id <= r.top <= r.id * (1 + 1 / 64) for r in rows)


def test_sketches_merge_in_any_order(spark, documents):
    m = documents.select("lang", "source", q.measures(F.col("text")).alias("_m"))
    whole = q.sketches(m)
    halves = q.sketches(m.where("hash(source) % 2 = 0")).unionByName(q.sketches(m.where("hash(source) % 2 <> 0")))
    a, b = (sorted(map(tuple, q.merged(x, ["lang"]).collect())) for x in (whole, halves))
    assert a == b and a


def test_thresholds_follow_the_group(spark):
    """The same share of symbols is normal in one source and not in the other."""

    def text(i, symbols):
        ws = [f"w{i}x{k}" for k in range(100)]
        return " ".join(w + "##" if k < symbols else w for k, w in enumerate(ws))

    rows = [(i, text(i, 20 + i % 5), "en", "code", 0) for i in range(300)]
    rows += [(1000 + i, text(i, 0), "en", "prose", 0) for i in range(300)] + [(5000, text(7, 22), "en", "prose", 0)]
    got = by_id(q.quality(spark.createDataFrame(rows, DOCS)), "kept")
    assert all(got[i] == [True] for i in range(300)) and all(got[1000 + i] == [True] for i in range(300))
    assert got[5000] == [False]


def plain_texts(n, words, lang="en", source="s", first=0, rng=random.Random(1)):
    """``n`` documents of ``words`` words in lines of ten, none of them odd."""
    rows = []
    for i in range(n):
        ws = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(3, 7))) for _ in range(words)]
        rows.append((first + i, "\n".join(" ".join(ws[k:k + 10]) for k in range(0, words, 10)), lang, source, 0))
    return rows


def test_each_rule_rejects_its_outlier_and_no_plain_document(spark):
    rng = random.Random(2)
    rows = plain_texts(400, 200)
    ws = ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(400)]
    lines = [" ".join(ws[k:k + 4]) for k in range(0, 200, 4)]
    outliers = {
        9001: " ".join(w + "#" * (k % 3 == 0) for k, w in enumerate(ws[:200])),       # symbols
        9002: "\n".join(lines[:40] + lines[9::-1]),                                   # lines of four words: no window repeats
        9003: " ".join(ws[:360] + ws[:36]),                                           # words, less than the base rule's fifth
        9004: " ".join(w * 4 for w in ws[:200])}                                      # long words
    rows += [(k, text, "en", "s", 0) for k, text in outliers.items()]
    got = by_id(q.quality(spark.createDataFrame(rows, DOCS)), "base_failed", "kept")
    assert all(got[k] == [(False, False)] for k in outliers), {k: got[k] for k in outliers}
    assert all(got[r[0]] == [(False, True)] for r in rows[:400])


def test_a_bad_third_of_a_source_does_not_lift_its_fence(spark):
    rows = plain_texts(700, 60)
    rows += [(5000 + r[0], r[1].replace("a", "#").replace("b", "$").replace("c", "%"), "en", "s", 0) for r in plain_texts(300, 60)]
    got = by_id(q.quality(spark.createDataFrame(rows, DOCS)), "kept")
    assert all(got[i] == [True] for i in range(700)) and not any(got[5000 + i][0] for i in range(300))


def test_fences_differ_between_sources_and_short_documents_are_not_judged_by_chance(spark):
    rng = random.Random(4)
    rows = plain_texts(300, 100, source="prose")
    rows += [(1000 + i, " ".join("".join(rng.choice("abcd") for _ in range(rng.randint(6, 14))) + "#" * (rng.random() < 0.3)
                                 for _ in range(100)), "en", "code", 0) for i in range(300)]
    df = spark.createDataFrame(rows, DOCS).select("lang", "source", q.measures(F.col("text")).alias("_m"))
    fence = {r.source: r.asDict() for r in q.thresholds(df).collect()}
    assert fence["code"]["_fence_symbol_share"] > fence["prose"]["_fence_symbol_share"]
    assert fence["code"]["_fence_letters_a_word"] > fence["prose"]["_fence_letters_a_word"]
    # one line of three is there twice, and ten words are long: few lines, few letters
    short = [(7001, "one two three four\nfive six seven eight nine\none two three four", "en", "prose", 0),
             (7002, "extraordinary words alone cannot condemn so short a document here", "en", "prose", 0)]
    got = by_id(q.quality(spark.createDataFrame(rows + short, DOCS)), "base_failed", "kept")
    assert got[7001] == [(False, True)] and got[7002] == [(False, True)]


def test_odd_rows(odd, empty):
    got = by_id(q.quality(odd), "n_words", "base_failed", "kept")
    assert got[1] == [(0, True, False)] and got[2] == [(0, True, False)] and got[3] == [(0, True, False)]
    assert got[6] == [(60, False, True)] * 2 and got[10] == [(20_001, True, False)] and len(got[None]) == 2
    assert q.quality(empty).count() == 0
    kept = q.accepted(odd)
    assert kept.columns == odd.columns and sorted(r.doc_id for r in kept.collect()) == [6, 6, 7, 8]
    assert {r.component_id for r in kept.collect()} == {"x"} and q.accepted(empty).count() == 0


def test_main_path_runs_no_python(documents):
    plan = q.quality(documents)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
