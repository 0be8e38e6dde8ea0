"""Quality rules with adaptive thresholds, in DataFrame functions only.

A document has fixed base rules and, beyond them, shares (symbols, repeated
lines, repeated words, letters a word). What is normal for a share differs by
language and source, so the cutoffs are not constants: each (lang, source)
keeps a quantile sketch of each share, and a document is rejected when it lies
beyond the fence of its own group: the median and a multiple of the spread below
it (median less lower decile). Both come from the group's lower half, so bad
documents, even if they are nearly half of a group, do not lift its fence. Where
most documents have the same value the spread is nothing, and a margin of a few
percent takes its place. A share of few words or lines says little, so what lies
beyond the fence must also be a number of words, lines or characters.

The sketch is a log-linear histogram of integers: exact below 128, above it 64
buckets for each power of two (relative error under 1/64). It is a table of
bucket counts, so sketches merge by adding counts, give the same quantiles in
whatever order they merge, and leave no draw to chance. Groups with few
documents take the merged sketch of their language, and failing that of all.

Everything about a document is computed within its row: window hashes are
sorted inside the row, so that long texts cost n log n and nothing is exploded.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import broadcast_if_small, let, null_safe, rows_as, unpacked, words, written

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
SYMBOLS = "#*$%&|<>"
WINDOW = 5



class Share(NamedTuple):
    """A share: ``of`` parts in ``scale`` of ``per``; the least margin between
    median and fence, in the same unit; how many of ``of`` must lie beyond."""

    of: str
    per: str
    scale: int
    margin: int
    units: int


SHARES = {
    "symbol_share": Share("n_symbols", "word_chars", 10_000, 200, 10),
    "dup_line_share": Share("n_dup_lines", "n_lines", 10_000, 1_000, 3),
    "repeat_share": Share("n_repeat_words", "n_words", 10_000, 500, 30),
    "letters_a_word": Share("word_chars", "n_words", 100, 50, 30),
}
#: Spreads (median less lower decile) between the median and the fence.
SPREADS = 8
#: Documents that a group must have to be judged by its own sketch.
MIN_GROUP = 200


def _repeated_words(ws: Column) -> Column:
    """Words within a window of ``WINDOW`` words that occurs twice or more."""

    def windows(hashes: Column) -> Column:
        return F.transform(
            F.slice(hashes, F.lit(1), F.greatest(F.size(hashes) - (WINDOW - 1), F.lit(0))),
            lambda x, i: F.xxhash64(x, *[F.get(hashes, i + k) for k in range(1, WINDOW)]))

    def among(hashed: Column) -> Column:
        ordered = F.sort_array(F.transform(hashed, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return let(ordered, lambda o: let(F.sort_array(F.transform(F.filter(
            o, lambda e, i: F.coalesce(F.get(o, i - 1)["h"] == e["h"], F.lit(False))
            | F.coalesce(F.get(o, i + 1)["h"] == e["h"], F.lit(False))), lambda e: e["i"])), covered))

    def covered(at: Column) -> Column:
        return F.aggregate(F.transform(at, lambda p, i: F.least(
            F.lit(WINDOW), F.coalesce(F.get(at, i + 1) - p, F.lit(WINDOW)))), F.lit(0), lambda a, x: a + x)

    return F.when(F.size(ws) <= WINDOW, F.lit(0)).otherwise(
        let(F.transform(ws, lambda w: F.xxhash64(w)), lambda hs: let(windows(hs), lambda h: F.when(
            F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(among(h)))))


def measures(text: Column) -> Column:
    """Struct of n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words (long)."""
    body = F.coalesce(text, F.lit(""))
    without = body
    for c in SYMBOLS:
        without = F.replace(without, F.lit(c))
    lines = F.filter(F.split(body, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return let(words(body), lambda ws: let(lines, lambda ls: F.struct(
        F.size(ws).cast("long").alias("n_words"),
        F.length(F.array_join(ws, "")).cast("long").alias("word_chars"),
        (F.length(body) - F.length(without)).cast("long").alias("n_symbols"),
        F.size(ls).cast("long").alias("n_lines"),
        (F.size(ls) - F.size(F.array_distinct(ls))).cast("long").alias("n_dup_lines"),
        _repeated_words(ws).cast("long").alias("n_repeat_words"))))


def base_failed(m: Column) -> Column:
    return (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > MAX_REPEAT_PERCENT * m["n_words"])


def shares(m: Column) -> Column:
    """The shares as whole numbers; 0 where there is nothing to divide by."""

    return F.struct(*[
        F.when(m[x.per] > 0, F.floor(x.scale * m[x.of] / m[x.per])).otherwise(F.lit(0)).cast("long").alias(k)
        for k, x in SHARES.items()])


def beyond(m: Column, fence: Column, share: Share) -> Column:
    """Whether at least ``units`` lie beyond the fence."""
    return share.scale * m[share.of] - fence * m[share.per] >= share.scale * share.units


def _shift(v: Column) -> Column:
    return F.greatest(F.length(F.bin(v)) - 7, F.lit(0))


def bucket(v: Column) -> Column:
    """Bucket of a whole number from 0."""
    return (_shift(v) * 64 + F.floor(v / F.pow(F.lit(2.0), _shift(v)))).cast("int")


def bucket_top(b: Column) -> Column:
    """The largest number of a bucket."""
    shift = F.greatest(F.floor(b / 64) - 1, F.lit(0))
    return ((b - shift * 64 + 1) * F.pow(F.lit(2.0), shift) - 1).cast("long")


def sketches(measured: DataFrame) -> DataFrame:
    """(lang, source, share, bucket, n) from rows with lang, source and _m."""
    s = shares(F.col("_m"))
    return (measured.where(~base_failed(F.col("_m")))
            .select("lang", "source", F.explode(F.array(*[
                F.struct(F.lit(k).alias("share"), bucket(s[k]).alias("bucket")) for k in SHARES])).alias("_s"))
            .groupBy("lang", "source", F.col("_s.share").alias("share"), F.col("_s.bucket").alias("bucket"))
            .agg(F.count(F.lit(1)).alias("n")))


def merged(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """Sketches added up over all but ``keys``."""
    return sketch.groupBy(*keys, "share", "bucket").agg(F.sum("n").alias("n"))


def fences(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, share, total, fence): the fence from the median and the lower decile of each sketch."""
    w = Window.partitionBy(*keys, "share")
    ranked = sketch.withColumn("_total", F.sum("n").over(w)).withColumn("_upto", F.sum("n").over(
        w.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)))
    top = bucket_top(F.col("bucket"))
    least = F.create_map(*[F.lit(x) for k, share in SHARES.items() for x in (k, share.margin)])
    return (ranked.groupBy(*keys, "share").agg(
        F.first("_total").alias("total"),
        F.min(F.when(2 * F.col("_upto") >= F.col("_total"), top)).alias("_median"),
        F.min(F.when(10 * F.col("_upto") >= F.col("_total"), top)).alias("_tenth"))
        .select(*keys, "share", "total", (F.col("_median") + F.greatest(
            least[F.col("share")], SPREADS * (F.col("_median") - F.col("_tenth")))).cast("long").alias("fence")))


def thresholds(measured: DataFrame) -> DataFrame:
    """(lang, source, fence per share): of the group itself, its language or all,
    the first with ``MIN_GROUP`` documents; of all if none has."""
    own = written(sketches(measured), "sketches")
    by_lang, everything = merged(own, ["lang"]), merged(own, [])
    out = null_safe(fences(own, ["lang", "source"]),
                    fences(by_lang, ["lang"]).withColumnsRenamed({"total": "_lt", "fence": "_lf"}), ["lang", "share"])
    out = null_safe(out, fences(everything, []).select("share", F.col("fence").alias("_af")), ["share"])
    chosen = (F.when(F.col("total") >= MIN_GROUP, F.col("fence"))
              .when(F.col("_lt") >= MIN_GROUP, F.col("_lf")).otherwise(F.col("_af")))
    return out.groupBy("lang", "source").agg(
        *[F.max(F.when(F.col("share") == k, chosen)).alias(f"_fence_{k}") for k in SHARES])


def judged(measured: DataFrame) -> DataFrame:
    """``measured`` with _base_failed and _kept."""
    within = F.lit(True)
    for k, share in SHARES.items():
        # a group whose documents all fail the base rules has no sketch
        within = within & ~F.coalesce(beyond(F.col("_m"), F.col(f"_fence_{k}"), share), F.lit(False))
    out = null_safe(measured, broadcast_if_small(thresholds(measured)), ["lang", "source"], "left")
    return out.withColumn("_base_failed", base_failed(F.col("_m"))).withColumn("_kept", ~F.col("_base_failed") & within)


def quality(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words, base_failed, kept.

    A null or empty text has no words and fails the base rules. Null languages
    and sources are groups of their own; repeated rows are judged each; other
    columns are not read; an empty table gives no rows.
    """
    measured = written(docs.select("doc_id", "lang", "source", measures(F.col("text")).alias("_m")), "measures")
    return judged(measured).select(
        "doc_id", *[f"_m.{k}" for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        F.col("_base_failed").alias("base_failed"), F.col("_kept").alias("kept"))


def accepted(docs: DataFrame) -> DataFrame:
    """The documents that pass, with all their columns. Measures are written
    beside the rows once; the thresholds read the measures alone."""
    measured = written(rows_as(docs).select(
        "_row", F.col("_row.lang").alias("lang"), F.col("_row.source").alias("source"),
        measures(F.col("_row.text")).alias("_m")), "measured-rows")
    return unpacked(judged(measured).where("_kept"), docs.columns)
