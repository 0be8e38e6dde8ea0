"""Mixing sources to target weights along a curriculum.

Every source has a share of the tokens of a training run and a schedule: how
its weight changes from the run's start (0) to its end (1). Integrating the
schedule gives the source's cumulative token demand; the documents of a source
form a stream of tokens in an order drawn by hash, passed through as often as
the share asks for. A document's training position is the time at which the
source's demand reaches the tokens before it, i.e. the inverse of the
cumulative demand; sorting all documents by position, range by range, gives the
training order.

Targets are exact: shares by weight, capped at ``MAX_EPOCHS`` times the source,
the excess shared again by weight. That is the level at which the sum of
min(cap, weight x level) meets the total, found by one sort of the sources by
cap over weight.

Running totals inside a source come from hash ranges of bounded size, so a
source with a third of all rows is not one task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import broadcast_if_small, n_words, prefix_sums, rows_as, unpacked, written

#: Weights of the sources in the order of their names, repeating.
WEIGHTS = (3, 1, 2)
#: Tokens to take, as a percentage of all.
TOTAL_PERCENT = 150
#: No source is passed through more often than this.
MAX_EPOCHS = 2
#: Schedules in the order of the names, repeating: a source's weight at evenly
#: spaced times from start to end, linear in between. Only the shape counts.
SCHEDULES = ((3.0, 2.0, 1.0), (1.0, 1.0, 1.0), (1.0, 2.0, 3.0))


@dataclass(frozen=True)
class Mix:
    weights: tuple[int, ...] = WEIGHTS
    total_percent: int = TOTAL_PERCENT
    max_epochs: int = MAX_EPOCHS
    schedules: tuple[tuple[float, ...], ...] = SCHEDULES


def stream(docs: DataFrame, *more: Column) -> DataFrame:
    """doc_id, size, the key of the source (not null, in the order of the names,
    null last) and the hash that orders a source's documents."""
    doc_id, source = F.col("doc_id"), F.col("source")
    return docs.select(
        doc_id, n_words(F.col("text")).alias("size"),
        F.when(source.isNull(), "1").otherwise(F.concat(F.lit("0"), source.cast("string"))).alias("_source"),
        F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")).alias("_key"), *more)


def targets(sized: DataFrame, mix: Mix) -> DataFrame:
    """(_source, source_size, target, rank) of each source in (_source, size).

    One row a source: these windows see sources, not documents.
    """
    sources = sized.groupBy("_source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy("_source")
    weights = F.array(*[F.lit(w) for w in mix.weights])
    ranked = (sources.withColumn("rank", F.row_number().over(by_name) - 1)
              .withColumn("_w", F.get(weights, F.col("rank") % len(mix.weights)).cast("long"))
              .withColumn("_cap", mix.max_epochs * F.col("source_size")))
    all_rows = Window.partitionBy()
    fill = all_rows.orderBy(F.col("_cap") / F.col("_w"), "rank")
    upto = fill.rowsBetween(Window.unboundedPreceding, -1)
    # level at which the sources from this one on share what the capped ones before it leave
    level = ranked.withColumn(
        "_level", (F.sum("source_size").over(all_rows) * mix.total_percent / 100
                   - F.coalesce(F.sum("_cap").over(upto), F.lit(0)))
        / (F.sum("_w").over(all_rows) - F.coalesce(F.sum("_w").over(upto), F.lit(0))))
    # the first source that the level does not fill sets it for all after it
    found = level.withColumn("_set", F.first(
        F.when(F.col("_level") * F.col("_w") <= F.col("_cap"), F.col("_level")), ignorenulls=True).over(
            fill.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    return found.select("_source", "source_size", F.least(
        F.col("_cap").cast("double"), F.coalesce(F.col("_set") * F.col("_w"), F.col("_cap").cast("double"))
    ).alias("target"), "rank")


def _segments(shape: tuple[float, ...]) -> list[tuple[float, float, float, float, float]]:
    """(time, demand before, weight, slope, length) of each linear piece; the demand of all is 1."""
    step = 1.0 / (len(shape) - 1)
    area = sum((a + b) / 2 * step for a, b in zip(shape, shape[1:]))
    out, done = [], 0.0
    for k, (a, b) in enumerate(zip(shape, shape[1:])):
        out.append((k * step, done, a / area, (b - a) / area / step, step))
        done += (a + b) / 2 * step / area
    return out


def time_of(share: Column, rank: Column, mix: Mix) -> Column:
    """The time at which a source's cumulative demand reaches ``share`` (0 to 1) of its target."""
    whole = None
    for k, shape in enumerate(mix.schedules):
        time = None
        for t, done, w, slope, _ in _segments(shape):
            left = F.greatest(share - done, F.lit(0.0))
            # root of slope/2 x^2 + w x = left in the form that has no division by a zero slope
            x = 2 * left / (w + F.sqrt(F.greatest(F.lit(w * w) + 2 * slope * left, F.lit(0.0))))
            here = F.lit(t) + F.when(left > 0, x).otherwise(F.lit(0.0))
            time = here if time is None else F.when(share >= done, here).otherwise(time)
        hit = F.when(rank % len(mix.schedules) == k, F.least(time, F.lit(1.0)))
        whole = hit if whole is None else F.coalesce(whole, hit)
    return whole


def placed(rows: DataFrame, sized: DataFrame, mix: Mix, rows_per_bucket: int = 5_000) -> DataFrame:
    """``rows`` (a ``stream``) with source_size, target, rank, taken and _start,
    the tokens of the source before the document. ``sized`` is the same stream,
    written, without what else rows carry.

    Passes through a source run through its documents in the order of
    md5(doc_id), then doc_id and size; the last pass ends inside the document
    at which the target, rounded, is reached.
    """
    out = prefix_sums(rows, sized, "_source", "_key", "size", ["doc_id", "size"], "_start",
                      rows_per_bucket).join(broadcast_if_small(targets(sized, mix)), "_source")
    goal = F.round("target").cast("long")
    taken = F.lit(0)
    for epoch in range(mix.max_epochs):
        begin = F.col("_start") + epoch * F.col("source_size")
        taken = taken + F.greatest(F.lit(0), F.least(F.col("size"), goal - begin))
    return out.withColumn("taken", taken.cast("long"))


def position(epoch: Column, mix: Mix) -> Column:
    """Training position of a document's copy in a pass."""
    return time_of((F.col("_start") + epoch * F.col("source_size")) / F.greatest(F.col("target"), F.lit(1.0)),
                   F.col("rank"), mix)


def mixed(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken and the
    positions of its copies, in the order of the first.

    Size counts words; null and empty texts have none and take none. Null
    sources are one source, last in order. Rows with equal doc_id and size in a
    source are interchangeable; other columns are not read; an empty table
    gives no rows.
    """
    sized = written(stream(docs), "sized")
    out = placed(sized, sized, mix)
    copies = [F.when((F.col("taken") > 0) & (F.col("_start") + e * F.col("source_size") < F.round("target")),
                     position(F.lit(e), mix)).alias(f"position_{e + 1}") for e in range(mix.max_epochs)]
    return (out.select("doc_id", "size", "source_size", "target", "taken", *copies)
            .orderBy(F.col("position_1").asc_nulls_last(), "doc_id"))


def mixture(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """The documents in training order with all their columns, each as often as
    the mix takes it: texts stay whole, so a copy of which half or more is
    taken is there and another is not."""
    rows = rows_as(docs).select("_row", *[F.col(f"_row.{c}").alias(c) for c in ("doc_id", "source", "text")])
    sized = written(stream(docs), "sized")
    # texts travel along, so a bucket holds fewer rows
    out = placed(stream(rows, F.col("_row")), sized, mix, 2_000)
    copies = F.floor((F.col("taken") + F.floor(F.col("size") / 2)) / F.greatest(F.col("size"), F.lit(1))).cast("int")
    each = out.where(copies > 0).withColumn("_copy", F.explode(F.sequence(F.lit(0), copies - 1)))
    ordered = each.select("_row", position(F.col("_copy"), mix).alias("_position"), "_key")
    return unpacked(ordered.repartitionByRange("_position", "_key").sortWithinPartitions("_position", "_key"),
                    docs.columns)
