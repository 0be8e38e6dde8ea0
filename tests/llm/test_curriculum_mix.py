import hashlib
import re
from fractions import Fraction

from .conftest import DOCS, by_id
from pyspark.sql import functions as F

from ledgerlens.llm import common, curriculum_mix as c


def brute_targets(sizes, mix):
    """Share the total by weight, cap, share the excess again until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: mix.weights[i % len(mix.weights)] for i, s in enumerate(names)}
    target = {s: Fraction(0) for s in names}
    left, open_ = Fraction(mix.total_percent, 100) * sum(sizes.values()), set(names)
    while left and open_:
        share = {s: left * weight[s] / sum(weight[o] for o in open_) for s in open_}
        left = Fraction(0)
        for s in list(open_):
            target[s] += share[s]
            cap = mix.max_epochs * sizes[s]
            if target[s] >= cap:
                left += target[s] - cap
                target[s] = Fraction(cap)
                open_.discard(s)
    return target


def brute(rows, mix):
    """(doc_id -> size, source size, target, taken) by walking through each source."""
    sized = [(d, s, len(re.findall(r"[^\x20\x09-\x0D]+", x or ""))) for d, x, s in rows]
    sizes = {s: sum(n for _, o, n in sized if o == s) for _, s, _ in sized}
    targets, out = brute_targets(sizes, mix), {}
    for s in sizes:
        stream = sorted((r for r in sized if r[1] == s), key=lambda r: (
            hashlib.md5(str("" if r[0] is None else r[0]).encode()).hexdigest(), r[0] is not None, r[0] or 0, r[2]))
        goal, taken, at = int(targets[s] + Fraction(1, 2)), [0] * len(stream), 0
        for _ in range(mix.max_epochs):
            for i, (_, _, n) in enumerate(stream):
                taken[i] += max(0, min(n, goal - at))
                at += n
        for (d, _, n), k in zip(stream, taken):
            out.setdefault(d, []).append((n, sizes[s], float(targets[s]), k))
    return out


def test_against_brute_force(documents, odd):
    for df in (documents, odd, documents.withColumn("source", F.when(F.col("doc_id") % 3 > 0, "src").otherwise(F.col("source")))):
        got = by_id(c.mixed(df), "size", "source_size", "target", "taken")
        expected = brute([(r.doc_id, r.text, r.source) for r in df.collect()], c.Mix())
        assert set(got) == set(expected)
        for d, rows in expected.items():
            for a, b in zip(sorted(got[d], key=str), sorted(rows, key=str)):
                assert a[:2] == b[:2] and abs(a[2] - b[2]) < 1e-6 * max(1, b[2]) and a[3] == b[3]


def test_targets_are_met_and_reruns_agree(documents):
    rows = [tuple(r) for r in c.mixed(documents).collect()]
    assert rows == [tuple(r) for r in c.mixed(documents).collect()]
    by_source = c.mixed(documents).join(documents.select("doc_id", "source"), "doc_id").groupBy("source").agg(
        F.sum("taken").alias("n"), F.first("target").alias("target")).collect()
    assert all(abs(r.n - r.target) <= 1 for r in by_source) and all(r[4] <= 2 * r[1] for r in rows)


def test_positions_invert_the_cumulative_demand(spark):
    mix = c.Mix()
    shares = spark.range(0, 1001).select((F.col("id") / 1000).alias("u"))
    for rank, shape in enumerate(mix.schedules):
        step, area = 1 / (len(shape) - 1), sum((a + b) / 2 for a, b in zip(shape, shape[1:])) / (len(shape) - 1)

        def demand(t):
            done, k = 0.0, min(int(t / step), len(shape) - 2)
            for j in range(k):
                done += (shape[j] + shape[j + 1]) / 2 * step
            x = t - k * step
            return (done + shape[k] * x + (shape[k + 1] - shape[k]) / step * x * x / 2) / area

        rows = shares.select("u", c.time_of(F.col("u"), F.lit(rank), mix).alias("t")).collect()
        assert all(abs(demand(r.t) - r.u) < 1e-9 for r in rows) and rows[0].t == 0 and abs(rows[-1].t - 1) < 1e-12


def test_prefix_sums_are_the_same_in_buckets(spark):
    df = spark.range(5000).select(F.when(F.col("id") % 3 > 0, "hot").otherwise("cold").alias("g"), (F.col("id") % 7).alias("n"),
                                  F.md5(F.col("id").cast("string")).alias("k"), "id")
    one, many = (common.prefix_sums(df, df, "g", "k", "n", ["id"], "s", rows_per_bucket=b).select("id", "s").orderBy("id").collect()
                 for b in (10 ** 6, 50))
    assert one == many


def test_odd_rows(odd, empty):
    got = by_id(c.mixed(odd), "size", "taken")
    assert got[1] == [(0, 0)] and got[2] == [(0, 0)] and len(got[None]) == 2 and c.mixed(empty).count() == 0
    mixed = c.mixture(odd)
    assert mixed.columns == odd.columns and c.mixture(empty).count() == 0
    copies = by_id(mixed, "text")
    for d, rows in by_id(c.mixed(odd), "size", "taken").items():
        if d is not None:
            assert len(copies.get(d, [])) == sum((t + n // 2) // n for n, t in rows if n)


def test_mixture_is_in_training_order(documents):
    first = {r.doc_id: r.position_1 for r in c.mixed(documents).collect()}
    seen, last = set(), -1.0
    for r in c.mixture(documents).collect():
        if r.doc_id not in seen:
            assert first[r.doc_id] >= last
            last = first[r.doc_id]
            seen.add(r.doc_id)
    assert DOCS and len(seen) > 100
