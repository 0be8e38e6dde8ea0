"""Exact dedup against history by a minimal perfect hash.

``build_index`` turns the distinct digests of a historical corpus into a
minimal perfect hash: every digest has a slot of its own, slots are as many as
digests, and a slot holds the full digest, the locator of the winner (its
doc_id) and the number of copies. The hash is sharded by digest prefix; a shard
is one row of the index table, built in one task from a bounded number of
digests. Inside a shard each level is a bit array; digests that fall alone on a
bit stay there, the others go on to the next level, and the rank of the bit is
the slot.

``lookup`` sends the distinct digests of new rows to the shards. The hash gives
any digest some slot, so the 32 bytes stored there are compared with those
looked up: equal bytes are a repeat of the history, others are nonmembers,
which form groups among themselves.

Copies are counted before any shuffle, so a text that makes up a third of the
rows is one row per task when digests meet.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if_small, rows_as, unpacked, written

#: Distinct digests in one shard of the index, about.
SHARD_DIGESTS = 50_000
#: Bits of a level for each digest that reaches it.
BITS_PER_DIGEST = 2
INDEX = "shard int, level_bits array<int>, ranks binary, digests binary, winners binary, copies binary"


def digests_of(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, sha256, n): how often each doc_id holds each text. A null text
    counts as empty."""
    return (docs.select(F.col(doc_id).cast("long").alias("doc_id"),
                        F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")), 256)).alias("sha256"))
            .groupBy("doc_id", "sha256").agg(F.count(F.lit(1)).alias("n")))


def distinct(rows: DataFrame) -> DataFrame:
    """(sha256, winner, copies): one row for each digest; the largest doc_id wins."""
    return rows.groupBy("sha256").agg(F.max("doc_id").alias("winner"), F.sum("n").alias("copies"))


def shard_of(sha256: Column, shards: int) -> Column:
    return (F.conv(F.hex(F.substring(sha256, 1, 4)), 16, 10).cast("long") % shards).cast("int")


def _hash(digests: np.ndarray, level: int, size: int) -> np.ndarray:
    """Bits of a level for digests given as rows of four 64-bit words."""
    x = digests[:, 1] ^ (digests[:, 2] * np.uint64(2 * level + 1)) ^ np.uint64(level)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return ((x ^ (x >> np.uint64(29))) % np.uint64(size)).astype(np.int64)


def _slots(digests: np.ndarray, level_bits: list[int], ranks: np.ndarray) -> np.ndarray:
    """Slot of each digest, -1 where no level has its bit."""
    slots = np.full(len(digests), -1, np.int64)
    left, base = np.arange(len(digests)), 0
    for level, size in enumerate(level_bits):
        at = ranks[base + _hash(digests[left], level, size)]
        slots[left[at >= 0]] = at[at >= 0]
        left, base = left[at < 0], base + size
    return slots


def _build(shard: int, digests: np.ndarray, winners: np.ndarray, copies: np.ndarray) -> dict:
    """One shard. ``ranks`` holds the slot of each bit, -1 for bits not set."""
    left, level_bits, bits = np.arange(len(digests)), [], []
    while len(left):
        size = max(64, BITS_PER_DIGEST * len(left))
        at = _hash(digests[left], len(level_bits), size)
        alone = np.bincount(at, minlength=size) == 1
        level_bits.append(size)
        bits.append(alone)
        left = left[~alone[at]]
    on = np.concatenate(bits) if bits else np.zeros(0, bool)
    ranks = np.where(on, np.cumsum(on) - 1, -1).astype(np.int32)
    order = np.empty(len(digests), np.int64)
    order[_slots(digests, level_bits, ranks)] = np.arange(len(digests))
    return {"shard": shard, "level_bits": level_bits, "ranks": ranks.tobytes(),
            "digests": digests[order].tobytes(), "winners": winners[order].tobytes(),
            "copies": copies[order].tobytes()}


def _matrix(sha256: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(sha256), np.uint64).reshape(-1, 4)


#: Stands for a null doc_id inside the index; the smallest long, so it never wins.
NO_ID = -(2 ** 63)


def build_index(history: DataFrame, shards: int) -> DataFrame:
    """The index over the ``distinct`` rows of a history, one row a shard."""

    def build(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([_build(int(key[0]), _matrix(pdf["sha256"]),
                                    pdf["winner"].to_numpy(np.int64), pdf["copies"].to_numpy(np.int64))])

    return (history.withColumn("winner", F.coalesce("winner", F.lit(NO_ID)))
            .withColumn("shard", shard_of(F.col("sha256"), shards))
            .groupBy("shard").applyInPandas(build, INDEX))


def lookup(index: DataFrame, queries: DataFrame, shards: int) -> DataFrame:
    """(sha256, winner, copies) of those distinct digests in ``queries`` that the
    index holds: winner and copies are those of the history."""

    def probe(slots: pd.DataFrame, pdf: pd.DataFrame) -> pd.DataFrame:
        out = pd.DataFrame({"sha256": [], "winner": [], "copies": []})
        if not len(slots) or not len(pdf):
            return out
        row = slots.iloc[0]
        asked = _matrix(pdf["sha256"])
        held = np.frombuffer(row["digests"], np.uint64).reshape(-1, 4)
        at = _slots(asked, list(row["level_bits"]), np.frombuffer(row["ranks"], np.int32))
        hit = at >= 0
        hit[hit] = (held[at[hit]] == asked[hit]).all(axis=1)
        return pd.DataFrame({"sha256": pdf["sha256"].to_numpy()[hit],
                             "winner": np.frombuffer(row["winners"], np.int64)[at[hit]],
                             "copies": np.frombuffer(row["copies"], np.int64)[at[hit]]})

    asked = queries.select("sha256").withColumn("shard", shard_of(F.col("sha256"), shards))
    return (index.groupBy("shard").cogroup(asked.groupBy("shard"))
            .applyInPandas(probe, "sha256 binary, winner long, copies long")
            .withColumn("winner", F.when(F.col("winner") != NO_ID, F.col("winner"))))


def shards_for(n_digests: int) -> int:
    return max(1, -(-n_digests // SHARD_DIGESTS))


def groups(rows: DataFrame, in_history: Column) -> DataFrame:
    """(sha256, keep_id, group_size) of every text in ``rows`` (doc_id, sha256, n).

    Rows for which ``in_history`` holds are the history that is indexed; the
    others are looked up. A member's group joins the history's, a nonmember's
    group is its own.
    """
    history = distinct(rows.where(in_history))
    fresh = written(distinct(rows.where(~in_history)), "fresh-digests")
    history = written(history, "history-digests")
    shards = shards_for(max(history.count(), fresh.count()))
    index = written(build_index(history, shards), "digest-index")
    repeats = lookup(index, fresh, shards)
    added = fresh.join(repeats.withColumnsRenamed({"winner": "old_winner", "copies": "old_copies"}), "sha256", "left")
    added = added.select("sha256", F.greatest("winner", "old_winner").alias("keep_id"),
                         (F.col("copies") + F.coalesce("old_copies", F.lit(0))).alias("group_size"),
                         F.col("old_copies").isNotNull().alias("member"))
    untouched = history.join(added.where("member").select("sha256"), "sha256", "left_anti")
    return added.drop("member").unionByName(
        untouched.select("sha256", F.col("winner").alias("keep_id"), F.col("copies").alias("group_size")))


def half(doc_id: Column) -> Column:
    """The split into history and new rows where a corpus comes without one:
    by a hash of the doc_id, null ids being history."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(2)) == 0


def dedup(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", in_history: Column | None = None) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the largest doc_id stays; null ids rank below
    all others. Of rows repeated with one doc_id and one text, one stays. Null
    and empty texts are one group. An empty table gives no rows; other columns
    are not read.
    """
    rows = written(digests_of(docs, text, doc_id), "digests")
    # written, so that both sides of the join below are dealt anew and a hot text can be split
    found = written(groups(rows, half(F.col("doc_id")) if in_history is None else in_history), "digest-groups")
    return (rows.join(found, "sha256")
            .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "n")))
            .select("doc_id", "keep_id", "group_size",
                    (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"),
                    F.lower(F.hex("sha256")).alias("text_sha256")))


def deduplicated(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The documents that stay, with all their columns."""
    packed = rows_as(docs)
    body = F.coalesce(F.col(f"_row.`{text}`"), F.lit(""))
    keyed = packed.select("_row", F.coalesce(F.col(f"_row.`{doc_id}`").cast("long"), F.lit(NO_ID)).alias("_id"),
                          F.sha2(body, 256).alias("_sha"))
    own = [F.coalesce("doc_id", F.lit(NO_ID)).alias("_id"), F.col("text_sha256").alias("_sha")]
    counted = written(dedup(docs, text, doc_id).groupBy("doc_id", "text_sha256").agg(
        F.count(F.lit(1)).alias("n"), F.max("kept").alias("stays")).where("n > 1 OR NOT stays"), "dropped-or-repeated")
    once = keyed.join(broadcast_if_small(counted.select(*own)), ["_id", "_sha"], "left_anti")
    # rows repeated with one id and text are few; of these one stays
    repeated = keyed.join(broadcast_if_small(counted.where("stays").select(*own)), ["_id", "_sha"], "left_semi")
    return unpacked(once.unionByName(repeated.dropDuplicates(["_id", "_sha"])), docs.columns)
