"""N-gram Jaccard join by prefix trees.

Documents are sets of distinct shingles in one global order (that of their
hashes). Sets that meet are stored in a prefix tree; a probe goes down level by
level, counts its overlap with a path once for all the sets below, and leaves a
subtree as soon as the overlap so far and the lengths that remain (of the probe
and of the longest path) cannot reach what the similarity asks of the smallest
set below.

Which sets meet. Two sets of similarity t or more differ in a bounded number d
of shingles. Where d is up to ``SMALL``, sets meet in each of their first
shingles, as many as a set can lose and stay similar, plus one. Else cut the global order into d + 1 + s ranges: the two agree on all
shingles of at least 1 + s ranges. A set's subset in a range, hashed, is a
bucket, and sets meet in buckets; ranges without shingles name a bucket only in
combinations of 1 + s. A set that shares fewer buckets with any others than
1 + s less its empty ranges has no partner and leaves, and so do sets that have
lost their company by that. d depends on sizes, so sizes are cut into bands, and a
set takes part in the band below when a partner can lie there. Shingles that
are common (found in ``COMMON_SHARE`` of the documents of some task or more)
are left out of the buckets where enough others remain, so that a passage that
many documents share makes no bucket. Nothing that reaches the threshold is
lost by any of this; a candidate's similarity is always counted in full.

Buckets are dealt as packed hashes, sorted, and each group of sets that agree
in many buckets goes on as one list with their number. Two sets that meet only in
buckets of up to ``FEW`` sets are company if they share as many as they must; in a
larger bucket the least node, its hub, is company of the others. What company
connects is a cluster, and a cluster of up to ``BLOCK`` sets is joined in one tree.

No group is expanded into pairs. Equal sets are one node. In larger clusters the
tree of a hub's others, in blocks of ``BLOCK``, is probed
with the hub alone. Then components are formed, and only where buckets still
hold more than one component are sets joined in full, block against block, and
subtrees of the probe's own component are skipped.
"""

from __future__ import annotations

import hashlib
import itertools
import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import broadcast_if_small, forget, recorded, rows_as, unpacked, written
from .components import components

#: Words in a shingle; similarity in percent.
SHINGLE, PERCENT = 5, 80
#: Sets in a tree, about, and shingles in all of them.
BLOCK, BLOCK_SHINGLES = 256, 500_000
#: Sets that meet as one cluster.
CLUSTER = 16 * BLOCK
#: A shingle in this share of a task's documents (of 1000 or more) is common.
COMMON_SHARE = 0.002
#: Bytes of text handled at a time, about.
BYTES = 2_000_000
#: Shingles a range at least, for buckets without common shingles.
LEAST_RANGE = 2.5
#: Rounds in which sets with too few shared buckets leave.
ROUNDS = 2
#: Up to this many differences sets meet in single shingles.
SMALL = 4
#: Buckets that are sorted at a time, about: those packed by a task, and those of a part that meet.
CHUNK_ROWS, PART_ROWS = 300_000, 500_000
#: In buckets of up to so many sets, the buckets that two sets share are counted.
FEW = 16
#: Sets in a row of a list at most; what packed ids number within a chunk.
PIECE, CHUNK_SLOTS = 4096, 65_536

U = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(33))) * U(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> U(33))) * U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U(33))


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash and begin of each word; A-Z count as a-z."""
    b = np.frombuffer(data, np.uint8)
    space = _SPACE[b]
    begin = ~space
    begin[1:] &= space[:-1]
    begins = np.flatnonzero(begin)
    if not len(begins):
        return np.zeros(0, U), begins
    at = np.flatnonzero(~space)
    word = np.cumsum(begin)[at] - 1
    each = _mix(_LOWER[b[at]].astype(U) + (at - begins[word] + 1).astype(U) * U(256))
    return _mix(np.add.reduceat(each, np.searchsorted(at, begins))), begins


def _shingles(words: np.ndarray, length: int) -> np.ndarray:
    """The set of a text as sorted distinct hashes."""
    n = min(length, len(words))
    if not n:
        return np.zeros(0, U)
    h = np.full(len(words) - n + 1, n, U)
    for k in range(n):
        h = _mix(h * U(0x9E3779B97F4A7C15) + words[k:len(words) - n + 1 + k])
    return np.unique(h)


def sets_of(texts: list[str | None], length: int) -> Iterator[np.ndarray]:
    """Set after set; short texts are hashed together, long ones in parts."""
    group: list[bytes] = []
    size = 0

    def flush() -> Iterator[np.ndarray]:
        hashes, begins = _word_hashes(b"\n".join(group))
        cuts = np.searchsorted(begins, np.cumsum([len(g) + 1 for g in group]))
        for b, e in zip([0, *cuts], cuts):
            yield _shingles(hashes[b:e], length)

    for text in texts:
        data = (text or "").encode("utf-8")
        if len(data) > BYTES:
            yield from flush() if group else ()
            group, size = [], 0
            yield _shingles(_long(data), length)
            continue
        group.append(data)
        size += len(data)
        if size > BYTES:
            yield from flush()
            group, size = [], 0
    if group:
        yield from flush()


def _long(data: bytes) -> np.ndarray:
    parts, begin = [], 0
    while begin < len(data):
        end = min(len(data), begin + BYTES)
        while end < len(data) and not _SPACE[data[end]]:
            end += 1
        parts.append(_word_hashes(data[begin:end])[0])
        begin = end
    return np.concatenate(parts)


def node_of(shingles: np.ndarray, seed: int) -> tuple[int, int]:
    """Two 64-bit halves of a set's digest: the node and a check of it."""
    digest = hashlib.blake2b(shingles.tobytes(), digest_size=16, salt=seed.to_bytes(16, "little")).digest()
    return int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True)


@dataclass(frozen=True)
class Similarity:
    """Links sets with 100 |x & y| >= percent |x | y|."""

    percent: int = PERCENT

    def needed(self, x, y):
        """The least overlap that links sets of these sizes."""
        return -(-self.percent * (x + y) // (100 + self.percent))

    def least_partner(self, x: int) -> int:
        return -(-self.percent * x // 100)

    def most_partner(self, x: int) -> int:
        return 100 * x // self.percent

    def bands(self, size: int) -> list[tuple[int, int]]:
        """(number of a band, shingles that may differ in it) in which a set takes part."""
        begins = [1]
        while (end := self.most_partner(self.most_partner(begins[-1])) + 1) <= size:
            begins.append(end)
        bands = [len(begins) - 1]
        if len(begins) > 1 and self.least_partner(size) < begins[-1]:
            bands.append(len(begins) - 2)
        found = []
        for b in bands:
            s = self.most_partner(self.most_partner(begins[b]))  # the largest smaller set of the band
            found.append((b, (100 - self.percent) * (s + self.most_partner(s)) // (100 + self.percent)))
        return found


def _slack(d: int) -> int:
    """Ranges on which similar sets agree beyond the one that pigeonholes give;
    as many may be empty without being named."""
    return 2 + d // 6


#: Low bits of a bucket, equal for the buckets of one band and way.
TAG = 127


def _tagged(x: np.ndarray, tag: int) -> np.ndarray:
    return (_mix(x + _mix(np.array([tag + 1], U))) & ~U(TAG)) | U(tag % (TAG + 1))


def _buckets(x: np.ndarray, d: int, tag: int) -> tuple[np.ndarray, int]:
    """Buckets of a set in a band, a hash of its subset in each range, and how
    many of them it shares with a similar set at least."""
    slack = _slack(d)
    ranges = d + 1 + slack
    r = ((x >> U(32)) * U(ranges)) >> U(32)
    begins = np.flatnonzero(np.append(True, r[1:] != r[:-1])) if len(x) else np.zeros(0, np.int64)
    named = np.add.reduceat(_mix(x), begins) + r[begins] * U(0x9E3779B97F4A7C15) if len(x) else np.zeros(0, U)
    empty = sorted(set(range(ranges)) - set(r[begins].tolist()))
    if len(empty) > slack:
        if math.comb(len(empty), slack + 1) <= 64:
            more = [sum((i + 1) * 65_537 ** k for k, i in enumerate(c)) for c in itertools.combinations(empty, slack + 1)]
        else:
            more = [i + 1 for i in empty]
        named = np.concatenate([named, _mix(np.array([x % 2 ** 64 for x in more], U))])
    return _tagged(named, tag), max(1, 1 + slack - len(empty))


def buckets(shingles: np.ndarray, common: np.ndarray, similarity: Similarity) -> list[tuple[np.ndarray, int]]:
    """All buckets of a set, by band and way, each with the number that it
    shares with a similar set. Sets that can only be linked to equal ones have
    none."""
    n, out = len(shingles), []
    often = np.isin(shingles, common) if len(common) else np.zeros(n, bool)
    rare = shingles[~often]
    for band, d in similarity.bands(n):
        if not d:
            continue
        if d <= SMALL:  # in the order of the hashes, common ones last
            first = np.concatenate([rare, shingles[often]])[:n - similarity.least_partner(n) + 1]
            out.append((_tagged(first, 2 * band), 1))
            continue
        least = LEAST_RANGE * (d + 1 + _slack(d))
        if len(rare) >= least:
            out.append(_buckets(rare, d, 2 * band))
        # a partner's rare part differs in d shingles at most, so one of the two ways has both
        if len(rare) < least + d:
            out.append(_buckets(shingles, d, 2 * band + 1))
    return out


@dataclass
class Level:
    """The nodes of a tree between two depths. A node holds the sets ``low`` to
    ``high`` of the tree's order, which are equal down to here."""

    low: np.ndarray
    high: np.ndarray
    #: node of the level above
    up: np.ndarray
    #: shingles between the depths, begin and length of each node's
    shingles: np.ndarray
    begin: np.ndarray
    length: np.ndarray
    #: sizes of the sets below: the least, the most, and what the longest has after this level
    least: np.ndarray
    most: np.ndarray
    rest: np.ndarray
    #: nodes of one set that ends here
    ends: np.ndarray


class Tree:
    """Prefix tree of some sets, in ``LEVELS`` levels of equal depth."""

    LEVELS = 8

    def __init__(self, sets: list[np.ndarray], members: list[int]):
        self.order = sorted(members, key=lambda i: sets[i].astype(">u8").tobytes())
        held = [sets[i] for i in self.order]
        self.sizes = np.array([len(s) for s in held])
        shared = np.zeros(len(held), np.int64)
        for k in range(1, len(held)):
            n = min(len(held[k - 1]), len(held[k]))
            differ = held[k - 1][:n] != held[k][:n]
            shared[k] = differ.argmax() if differ.any() else n
        flat, offsets = np.concatenate(held), np.cumsum(self.sizes) - self.sizes
        deepest = int(self.sizes.max())
        step = max(16, -(-deepest // self.LEVELS))
        self.levels: list[Level] = []
        for depth in range(0, deepest, step):
            # a set that ends here is a node of its own, also where the next ones go on from it
            first = np.flatnonzero(np.append(True, (shared[1:] < depth + step) | (self.sizes[:-1] <= depth + step)))
            high = np.append(first[1:], len(held))
            live = self.sizes[first] > depth
            low, high = first[live], high[live]
            length = np.minimum(step, self.sizes[low] - depth)
            pairs = np.stack([low, high], 1).ravel()
            ext = np.append(self.sizes, self.sizes[-1])
            least, most = np.minimum.reduceat(ext, pairs)[::2], np.maximum.reduceat(ext, pairs)[::2]
            up = np.searchsorted(self.levels[-1].low, low, side="right") - 1 if depth else np.zeros(len(low), np.int64)
            self.levels.append(Level(
                low, high, up, flat[_ranges(offsets[low] + depth, length)], np.cumsum(length) - length, length,
                least, most, np.maximum(most - depth - step, 0), self.sizes[low] <= depth + step))

    def probe(self, own: np.ndarray, wanted: np.ndarray, similarity: Similarity) -> list[int]:
        """Places in ``order`` of the sets linked to ``own``, among those that
        ``wanted`` marks."""
        size, found = len(own), []
        least, most = similarity.least_partner(size), similarity.most_partner(size)
        count = np.append(0, np.cumsum(wanted))
        overlap, alive = np.zeros(1, np.int64), np.ones(1, bool)
        for v in self.levels:
            at = np.flatnonzero(alive[v.up] & (count[v.high] > count[v.low]) & (v.most >= least) & (v.least <= most))
            if not len(at):
                break
            length = v.length[at]
            mine = v.shingles if len(at) == len(v.low) else v.shingles[_ranges(v.begin[at], length)]
            place = np.searchsorted(own, mine)
            hit = own[np.minimum(place, size - 1)] == mine
            ends = np.cumsum(length)
            seen = overlap[v.up[at]] + np.add.reduceat(hit.astype(np.int64), ends - length)
            past = place[ends - 1] + hit[ends - 1]  # of the probe, what is not after the level's last shingle
            reach = seen + np.minimum(size - past, v.rest[at])
            keep = reach >= similarity.needed(size, np.maximum(v.least[at], least))
            done = at[keep & v.ends[at]]
            o, n = seen[keep & v.ends[at]], self.sizes[v.low[done]]
            found += v.low[done][100 * o >= similarity.percent * (size + n - o)].tolist()
            overlap, alive = np.zeros(len(v.low), np.int64), np.zeros(len(v.low), bool)
            overlap[at], alive[at] = seen, keep & ~v.ends[at]
        return found


def _ranges(begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The indices of ranges, one after another."""
    return np.repeat(begin - (np.cumsum(length) - length), length) + np.arange(length.sum())


STORED, PROBE = 1, 2


def linked(sets: list[np.ndarray], component: np.ndarray, role: np.ndarray,
           similarity: Similarity) -> list[tuple[int, int]]:
    """Links between components of the sets at hand, found by probing the tree
    of the stored ones; each link makes its two components one."""
    stored, probes = np.flatnonzero(role & STORED), np.flatnonzero(role & PROBE)
    if not len(stored) or not len(probes):
        return []
    tree, out = Tree(sets, stored.tolist()), []
    order = np.array(tree.order)
    of, probing = component[order], (role[order] & PROBE) > 0
    component, place = component.copy(), {i: k for k, i in enumerate(tree.order)}
    for x in probes.tolist():
        wanted = of != component[x]
        if x in place:  # of two probes in the tree the earlier has met the later
            wanted[:place[x]] &= ~probing[:place[x]]
        for k in tree.probe(sets[x], wanted, similarity) if wanted.any() else ():
            if of[k] != component[x]:
                out.append((x, int(order[k])))
                old = of[k]
                of[of == old] = component[x]
                component[component == old] = component[x]
    return out


def joined(meetings: DataFrame, sets: DataFrame, similarity: Similarity) -> DataFrame:
    """Links (a, b) inside each meeting of (meeting, block, node, component,
    role): the tree of its stored nodes is probed with its probes. Sets with
    equal components are not compared."""
    rows = meetings.join(sets, "node").repartition("meeting", "block").sortWithinPartitions("meeting", "block")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        key = None

        def close() -> list[tuple[int, int]]:
            node, component, role = (np.array([h[k] for h in held], np.int64) for k in range(3))
            found = linked([h[3] for h in held], component, role, similarity)
            return [(int(node[x]), int(node[y])) for x, y in found]

        def batch_of(links: list[tuple[int, int]]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)], ["a", "b"])

        for batch in batches:
            meeting, block, node, component, role = (batch.column(i).to_pylist() for i in range(5))
            lists, links = batch.column(5), []
            for i in range(batch.num_rows):
                if key != (meeting[i], block[i]):
                    links += close()
                    held, key = [], (meeting[i], block[i])
                # copied, so that a batch is not kept for one of its rows
                held.append((node[i], component[i], role[i], lists[i].values.to_numpy().view(U).copy()))
            yield batch_of(links)
        yield batch_of(close())

    return rows.select("meeting", "block", "node", "component", "role", "shingles").mapInArrow(run, "a long, b long")


def _packed(found: list[np.ndarray], parts: int) -> Iterator[tuple[int, bytes, bytes]]:
    """(part, keys, places) of each part that buckets fall into: their first 46
    bits, sorted, as differences of 32 bits where these suffice, and their
    places in ``found``. Buckets that differ in other bits alone meet as well,
    which costs a comparison."""
    keys = np.concatenate(found) >> U(18)
    order = np.argsort(keys)
    keys, place = keys[order], np.repeat(np.arange(len(found), dtype=np.uint16), [len(f) for f in found])[order]
    part = ((keys >> U(14)) * U(parts)) >> U(32)
    begins = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
    for b, e in zip(begins.tolist(), [*begins[1:].tolist(), len(keys)]):
        steps = np.diff(keys[b:e])
        rest = steps.astype(np.uint32) if not len(steps) or steps.max() < 2 ** 32 else steps
        yield int(part[b]), keys[b:b + 1].tobytes() + rest.tobytes(), place[b:e].tobytes()


def _unpacked(first: int, keys: bytes, places: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The keys and ids of a packed row."""
    place = np.frombuffer(places, np.uint16)
    steps = np.frombuffer(keys, U if len(keys) == 8 * len(place) else np.uint32, offset=8)
    return np.cumsum(np.append(np.frombuffer(keys, U, 1), steps.astype(U)), dtype=U), place.astype(np.int64) + first


def _lists(keys: np.ndarray, ids: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Lists of the ids that share a key with others, each list once: two
    hashes, the number of the piece and the number of keys of each piece of up
    to ``PIECE`` ids; where pieces begin; the ids."""
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    order = order[np.append(False, same) | np.append(same, False)] if len(keys) else order
    order = order[np.lexsort((ids[order], keys[order]))]
    keys, ids = keys[order], ids[order]
    if not len(ids):
        return [np.zeros(0, np.int64)] * 4, np.zeros(1, np.int32), ids
    begins = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    size = np.diff(np.append(begins, len(ids)))
    who, who2 = (np.add.reduceat(_mix(ids.view(U) + U(k)), begins) for k in (1, 1 << 62))
    order = np.lexsort((who2, who))
    first = np.flatnonzero(np.append(True, (np.diff(who[order]) != 0) | (np.diff(who2[order]) != 0)))
    times, once = np.diff(np.append(first, len(order))), order[first]
    size = size[once]
    ids = ids[_ranges(begins[once], size)]
    pieces = -(-size // PIECE)
    piece = _ranges(np.zeros(len(pieces), np.int64), pieces)
    at = np.repeat(np.cumsum(size) - size, pieces) + piece * PIECE
    columns = [who.view(np.int64)[once], who2.view(np.int64)[once], times]
    who, who2, times = (np.repeat(c, pieces) for c in columns)
    return [who, who2, piece, times], np.append(at, len(ids)).astype(np.int32), ids


def _shared(rows: DataFrame) -> DataFrame:
    """Rows of the buckets with two nodes or more, with the least as hub."""
    w = Window.partitionBy("bucket")
    return (rows.withColumn("hub", F.min("node").over(w)).withColumn("_top", F.max("node").over(w))
            .where("hub <> _top").select("bucket", "node", "tag", "need", "times", "hub"))


def _enough(rows: DataFrame) -> DataFrame:
    """Rows of the nodes that have as many buckets of a band and way as they
    share with a similar set."""
    nodes = (rows.groupBy(F.col("node").alias("_node"), F.col("tag").alias("_tag"))
             .agg(F.sum("times").alias("_n"), F.max("need").alias("_need"))
             .where("_n >= _need").select("_node", "_tag"))
    return rows.join(nodes, (F.col("node") == F.col("_node")) & (F.col("tag") == F.col("_tag")), "left_semi")


def _company(rows: DataFrame) -> DataFrame:
    """Links (a, b) that connect all sets that may be similar."""
    sized = rows.join(rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("_size")), "bucket")
    few = sized.where(F.col("_size") <= FEW).select("bucket", "node", "tag", "need", "times")
    other = few.select("bucket", F.col("node").alias("b"), F.col("tag").alias("_tag"), F.col("need").alias("_need"))
    counted = (few.withColumnRenamed("node", "a").join(other, "bucket").where("a < b AND tag = _tag")
               .groupBy("a", "b", "tag").agg(F.sum("times").alias("_n"), F.max(F.least("need", "_need")).alias("_least"))
               .where("_n >= _least").select("a", "b"))
    return counted.unionByName(sized.where((F.col("_size") > FEW) & (F.col("node") != F.col("hub"))).select(
        F.col("hub").alias("a"), F.col("node").alias("b")))


@dataclass(frozen=True)
class TrieJoin:
    """The join with its parameters. ``seed`` changes which 64 bits name a set."""

    shingle: int = SHINGLE
    similarity: Similarity = Similarity()
    seed: int = 0

    def measured(self, docs: DataFrame) -> DataFrame:
        """One row per document (doc_id, key, n_shingles, node, check) and, with
        a null ``check``, rows (node = shingle, n_shingles = count) of the
        shingles that are common in a task."""
        shingle, seed = self.shingle, self.seed

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            seen, many, n_docs = np.zeros(0, U), np.zeros(0, np.int64), 0

            def out(doc_id, key, n, node, check) -> pa.RecordBatch:
                return pa.RecordBatch.from_arrays(
                    [doc_id, key, pa.array(n, pa.int64()), pa.array(node, pa.int64()), pa.array(check, pa.int64())],
                    ["doc_id", "key", "n_shingles", "node", "check"])

            for batch in batches:
                for begin in range(0, batch.num_rows, 1000):
                    part = batch.slice(begin, 1000)
                    sets = list(sets_of(part.column(2).to_pylist(), shingle))
                    named = [node_of(s, seed) for s in sets]
                    yield out(part.column(0), part.column(1), [len(s) for s in sets],
                              [x[0] for x in named], [x[1] for x in named])
                    # copies count once; what falls below the share of all is dropped as the task goes on
                    own = list({x: s for x, s in zip(named, sets)}.values())
                    n_docs += len(own)
                    values, counts = np.unique(np.concatenate([seen, *own]), return_counts=True)
                    counts[np.searchsorted(values, seen)] += many - 1
                    keep = counts >= max(2, COMMON_SHARE * min(n_docs, 1000) / 2)
                    seen, many = values[keep], counts[keep]
            seen, many = seen[many >= max(10, COMMON_SHARE * n_docs)], many[many >= max(10, COMMON_SHARE * n_docs)]
            none = pa.nulls(len(seen), pa.int64())
            yield out(none, none, many, seen.view(np.int64), none)

        return docs.select("doc_id", "key", "text").mapInArrow(
            run, "doc_id long, key long, n_shingles long, node long, check long")

    def members(self, docs: DataFrame, common: np.ndarray, parts: int) -> DataFrame:
        """(bucket, node, tag, need, times, hub) of the buckets with two nodes
        or more. Buckets of the same sets, ``times`` of them, are one."""
        shingle, seed, similarity = self.shingle, self.seed, self.similarity
        shipped = docs.sparkSession.sparkContext.broadcast(common)

        def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            """Packed buckets by part and, in parts of their own, the sets' nodes, tags and needs."""
            done: set[int] = set()
            found, slots, held, first = [], [], 0, TaskContext.get().partitionId() << 40

            def flush() -> pa.RecordBatch:
                rows = list(_packed(found, parts))
                nodes, needs = (np.array([s[k] for s in slots], np.int64).tobytes() for k in (0, 1))
                rows.append((parts + (first >> 40) % parts, nodes, needs))
                part, keys, places = zip(*rows)
                return pa.RecordBatch.from_arrays(
                    [pa.array(part, pa.int64()), pa.array([first] * len(part), pa.int64()),
                     pa.array(keys, pa.binary()), pa.array(places, pa.binary())], ["part", "first", "keys", "places"])

            for batch in batches:
                for begin in range(0, batch.num_rows, 1000):
                    for s in sets_of(batch.column(0).slice(begin, 1000).to_pylist(), shingle):
                        node = node_of(s, seed)[0]
                        if not len(s) or node in done:
                            continue
                        done.add(node)
                        for b, n in buckets(s, shipped.value, similarity):
                            found.append(b)
                            slots.append((node, (int(b[0]) & TAG) << 32 | n))
                            held += len(b)
                            if held >= CHUNK_ROWS or len(found) == CHUNK_SLOTS:
                                yield flush()
                                found, slots, held, first = [], [], 0, first + len(slots)
                    if len(done) > 1_000_000:
                        done.clear()
            if found:
                yield flush()

        def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held, now = [], None

            def batch_of(columns, begins, ids) -> pa.RecordBatch:
                return pa.RecordBatch.from_arrays(
                    [*(pa.array(c, pa.int64()) for c in columns), pa.ListArray.from_arrays(begins, ids)],
                    ["who", "who2", "piece", "times", "ids"])

            for batch in batches:
                for part, first, keys, places in zip(*(c.to_pylist() for c in batch.columns)):
                    if part >= parts:
                        nodes, needs = np.frombuffer(keys, np.int64), np.frombuffer(places, np.int64)
                        yield batch_of([np.arange(len(nodes)) + first, needs, np.full(len(nodes), -1), np.ones(len(nodes))],
                                       np.arange(len(nodes) + 1, dtype=np.int32), nodes)
                        continue
                    if part != now and held:
                        yield batch_of(*_lists(*map(np.concatenate, zip(*held))))
                        held = []
                    now = part
                    held.append(_unpacked(first, keys, places))
            if held:
                yield batch_of(*_lists(*map(np.concatenate, zip(*held))))

        dealt = (docs.select("text").mapInArrow(deal, "part long, first long, keys binary, places binary")
                 .repartition("part").sortWithinPartitions("part"))
        lists = written(dealt.mapInArrow(meet, "who long, who2 long, piece long, times long, ids array<long>")
                        .groupBy("who", "who2", "piece").agg(F.sum("times").alias("times"), F.first("ids").alias("ids")), "lists")
        slots = lists.where("piece < 0").select(
            F.col("who").alias("id"), F.col("ids")[0].alias("node"), F.shiftright("who2", 32).alias("tag"),
            F.col("who2").bitwiseAND(F.lit(2 ** 32 - 1)).alias("need"))
        rows = lists.where("piece >= 0").select(F.col("who").alias("bucket"), "times", F.explode("ids").alias("id"))
        # equal sets of several tasks are one node
        rows = (rows.join(slots, "id").groupBy("bucket", "node", "tag")
                .agg(F.max("need").alias("need"), F.max("times").alias("times")))
        rows = written(_shared(rows), "buckets")
        for _ in range(ROUNDS):
            rows = written(_shared(_enough(rows).select("bucket", "node", "tag", "need", "times")), "buckets")
        return rows

    def clustered(self, docs: DataFrame, wanted: DataFrame) -> DataFrame:
        """Links (a, b) inside each meeting of ``wanted`` (_id, key, meeting),
        of a tree's sets at most."""
        shingle, seed, similarity = self.shingle, self.seed, self.similarity
        rows = (docs.select("_id", "key", "text").join(broadcast_if_small(wanted), ["_id", "key"])
                .select("meeting", "text").repartition("meeting").sortWithinPartitions("meeting"))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: dict[int, np.ndarray] = {}
            now = None

            def close() -> pa.RecordBatch:
                node, n = np.array(list(held), np.int64), len(held)
                found = linked(list(held.values()), np.arange(n), np.full(n, STORED + PROBE), similarity)
                return pa.RecordBatch.from_arrays(
                    [pa.array([node[x[k]] for x in found], pa.int64()) for k in (0, 1)], ["a", "b"])

            for batch in batches:
                for begin in range(0, batch.num_rows, 500):
                    part = batch.slice(begin, 500)
                    for meeting, s in zip(part.column(0).to_pylist(), sets_of(part.column(1).to_pylist(), shingle)):
                        if meeting != now:
                            yield close()
                            held, now = {}, meeting
                        held[node_of(s, seed)[0]] = s
            yield close()

        return rows.mapInArrow(run, "a long, b long")

    def shingle_sets(self, docs: DataFrame, wanted: DataFrame) -> DataFrame:
        """(node, shingles) of the nodes in ``wanted`` (_id, key)."""
        shingle, seed = self.shingle, self.seed

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for begin in range(0, batch.num_rows, 500):
                    part = batch.slice(begin, 500)
                    sets = list(sets_of(part.column(0).to_pylist(), shingle))
                    ends = np.cumsum([0, *map(len, sets)]).astype(np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([node_of(s, seed)[0] for s in sets], pa.int64()),
                         pa.ListArray.from_arrays(ends, np.concatenate(sets).view(np.int64))], ["node", "shingles"])

        rows = docs.select("_id", "key", "text").join(broadcast_if_small(wanted), ["_id", "key"]).select("text")
        return rows.mapInArrow(run, "node long, shingles array<long>").dropDuplicates(["node"])

    def grouped(self, docs: DataFrame) -> DataFrame:
        """(doc_id, key, n_shingles, node, component) of ``docs`` (doc_id, key,
        text): nodes that are linked share a component, another node's is its own."""
        base = written(self.measured(docs), "sets")
        rows, marks = base.where(F.col("check").isNotNull()), base.where(F.col("check").isNull())
        ident = [F.coalesce("doc_id", F.lit(2 ** 63 - 1)).alias("_id"), "key"]
        nodes = rows.where("n_shingles > 0").groupBy("node").agg(
            F.min(F.struct(*ident)).alias("_first"), F.max("n_shingles").alias("n"),
            F.min("check").alias("_low"), F.max("check").alias("_high"))
        nodes = written(nodes, "nodes")
        if not nodes.where("_low <> _high").isEmpty():  # two sets share 64 bits: name them by others
            return TrieJoin(self.shingle, self.similarity, self.seed + 1).grouped(docs)
        # by the count that is asked for, at most 10 / COMMON_SHARE times the shingles of a document
        least = COMMON_SHARE / 10 * rows.count()
        often = marks.groupBy("node").agg(F.sum("n_shingles").alias("n")).where(F.col("n") >= least)
        common = np.sort(np.array([r.node for r in often.select("node").collect()], np.int64).view(U))
        total = nodes.agg(F.sum("n")).first()[0] or 0
        members = self.members(docs, common, max(1, -(-total // PART_ROWS)))
        near = written(components(_company(members)).join(nodes, "node").select(
            F.col("component").alias("meeting"), "node", "n", "_first._id", "_first.key"), "near")
        small = near.groupBy("meeting").agg(
            ((F.count(F.lit(1)) <= BLOCK) & (F.sum("n") <= BLOCK_SHINGLES)).alias("_small"))
        near = written(near.join(small, "meeting"), "near")
        members = written(members.drop("hub").join(near.select("node", "meeting", "_small"), "node"), "labelled")
        keyed = docs.withColumn("_id", F.coalesce("doc_id", F.lit(2 ** 63 - 1)))
        if not rows.groupBy(*ident).count().where("count > 1").isEmpty():  # a text once, or copies of a row meet in a task
            keyed = keyed.dropDuplicates(["_id", "key"])
        links = written(self.clustered(keyed, near.where("_small").select("_id", "key", "meeting")), "cluster-links")
        large = near.where("NOT _small")
        if not large.isEmpty():
            links = links.unionByName(self._large(keyed, members.where("NOT _small"), large))
        of = written(components(links), "components")
        return (rows.join(of, "node", "left")
                .select("doc_id", "key", "n_shingles", "node", F.coalesce("component", "node").alias("component")))

    def _large(self, keyed: DataFrame, members: DataFrame, large: DataFrame) -> DataFrame:
        """Links inside the clusters that are more than a tree."""
        members = written(_shared(members.withColumn("bucket", F.xxhash64("bucket", "meeting"))), "large")
        pairs = written(members.where("node <> hub").select("hub", "node").distinct(), "hub-pairs")
        sets = written(self.shingle_sets(keyed, large.select("_id", "key")), "shingles")
        sizes = sets.select("node", F.size("shingles").alias("n"))
        links = written(joined(self._stars(pairs, sizes), sets, self.similarity), "star-links")
        return links.unionByName(joined(self._mixed(members, components(links), sizes), sets, self.similarity))

    @staticmethod
    def _blocks() -> Column:
        """Blocks for a group's sets: by their number, and by their shingles where they are long."""
        return F.ceil(F.greatest(F.count(F.lit(1)) / BLOCK, F.sum("n") / BLOCK_SHINGLES)).cast("int")

    def _stars(self, pairs: DataFrame, sizes: DataFrame) -> DataFrame:
        """Meetings of each hub with the nodes of its buckets, in blocks. Only
        the hubs of several blocks, each of many nodes, are sent to all tasks;
        nodes are not dealt by their hub."""
        hubs = written(pairs.join(sizes, "node").groupBy("hub").agg(self._blocks().alias("_n")), "hubs")
        large = broadcast_if_small(hubs.where("_n > 1"))
        stored = pairs.join(large, "hub", "left").select(
            F.col("hub").alias("meeting"), F.pmod(F.xxhash64("node"), F.coalesce("_n", F.lit(1))).alias("block"), "node",
            F.lit(STORED).alias("role"))
        probes = hubs.select(F.col("hub").alias("meeting"), F.explode(
            F.sequence(F.lit(0).cast("long"), F.col("_n").cast("long") - 1)).alias("block"), F.col("hub").alias("node"), F.lit(PROBE).alias("role"))
        return stored.unionByName(probes).select("meeting", "block", "node", F.col("node").alias("component"), "role")

    def _mixed(self, members: DataFrame, of: DataFrame, sizes: DataFrame) -> DataFrame:
        """Meetings in which sets of different components meet that share a
        bucket: of all that buckets connect, where these are up to ``CLUSTER``,
        else of single buckets.

        The component with the most sets in a meeting is only stored, the other
        sets probe as well. Block i meets block j: its probes for i <= j, and for
        i > j what does not probe itself.
        """
        of = sizes.select("node").join(of, "node", "left").select("node", F.coalesce("component", "node").alias("component"))
        held = members.join(of, "node").select("bucket", "node", "tag", "need", "times", "hub", "component")
        for again in range(ROUNDS + 1):  # only buckets in which sets of two components meet count now
            held = _enough(held) if again else held
            several = held.groupBy("bucket").agg(F.min("component").alias("_low"), F.max("component").alias("_high"))
            held = written(held.join(several.where("_low <> _high").select("bucket"), "bucket"), "mixed-buckets")
        cluster = components(held.select(F.col("hub").alias("a"), F.col("node").alias("b"))).withColumnRenamed(
            "component", "cluster")
        held = written(held.join(cluster, "node"), "clusters")
        nodes = held.select("cluster", "node", "component").distinct()
        small = nodes.groupBy("cluster").agg((F.count(F.lit(1)) <= CLUSTER).alias("_small"))
        meet = nodes.join(small.where("_small"), "cluster").select(F.col("cluster").alias("meeting"), "node", "component")
        apart = held.join(small.where("NOT _small"), "cluster").select("bucket", "node", "component")
        # of buckets with the same nodes one is enough
        once = (apart.groupBy("bucket").agg(F.count(F.lit(1)).alias("_m"), F.sum(
            F.xxhash64("node").cast("decimal(38,0)")).alias("_who"))
            .groupBy("_m", "_who").agg(F.min("bucket").alias("bucket")).select("bucket"))
        meet = written(meet.unionByName(apart.join(once, "bucket").withColumnRenamed("bucket", "meeting")).join(
            sizes, "node"), "meetings")
        main = (meet.groupBy("meeting", "component").agg(F.count(F.lit(1)).alias("_c"))
                .groupBy("meeting").agg(F.max(F.struct("_c", "component")).alias("_main")))
        blocks = written(meet.groupBy("meeting").agg(self._blocks().alias("_n")).join(main, "meeting"), "blocks")
        # meetings of several blocks are sent to the tasks; the others have a block's sets at most
        cut = (meet.join(broadcast_if_small(blocks.where("_n > 1")), "meeting")
               .unionByName(meet.join(blocks.where("_n = 1"), "meeting")))
        cut = (cut.withColumn("_at", F.pmod(F.xxhash64("node"), F.col("_n")).cast("int"))
               .withColumn("_probes", F.col("component") != F.col("_main.component"))
               .withColumn("_k", F.explode(F.sequence(F.lit(0), F.col("_n") - 1))))
        here, there, n = F.col("_at"), F.col("_k"), F.col("_n").cast("long")
        cell = ["meeting", "node", "component"]
        same = cut.where(here == there).select(
            *cell, (here * n + here).alias("block"), F.when(F.col("_probes"), STORED + PROBE).otherwise(STORED).alias("role"))
        stored = cut.where((here < there) | (here > there) & ~F.col("_probes")).select(
            *cell, (here * n + there).alias("block"), F.lit(STORED).alias("role"))
        probes = cut.where((here != there) & F.col("_probes")).select(
            *cell, (there * n + here).alias("block"), F.lit(PROBE).alias("role"))
        return same.unionByName(stored).unionByName(probes).select("meeting", "block", "node", "component", "role")


def _grouped(join: TrieJoin, docs: DataFrame) -> DataFrame:
    """``grouped``, written; the tables that led to it are deleted."""
    own: list[str] = []
    with recorded(own):
        rows = join.grouped(docs)
    rows = written(rows, "grouped")
    for path in own:
        forget(docs.sparkSession, path)
    return rows


def _keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(F.col(text)).alias("key"),
                       F.col(text).alias("text"))


def similar(docs: DataFrame, join: TrieJoin = TrieJoin(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id.

    The component is the smallest doc_id that links lead to, null if all of
    its ids are. Null, empty and blank texts have no shingles and are linked
    with nothing; texts of fewer words than a shingle are one shingle. Repeated
    rows are linked like any equal texts; an empty table gives no rows; other
    columns are not read.
    """
    rows = _grouped(join, _keyed(docs, doc_id, text))
    least = rows.where("n_shingles > 0").groupBy("component").agg(F.min("doc_id").alias("component_id"))
    least = written(least, "component-ids")
    return rows.join(least, "component", "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def deduplicated(docs: DataFrame, join: TrieJoin = TrieJoin()) -> DataFrame:
    """The documents with all their columns, one of each component: that with
    the smallest doc_id (null ids last). Documents without shingles all stay."""
    packed = rows_as(docs).select("_row", F.col("_row.doc_id").cast("long").alias("doc_id"),
                                  F.col("_row.text").alias("text"))
    keyed = packed.withColumn("key", F.xxhash64("text"))
    rows = _grouped(join, keyed.select("doc_id", "key", "text"))
    ident = F.struct(F.coalesce("doc_id", F.lit(2 ** 63 - 1)).alias("_id"), "key")
    first = rows.where("n_shingles > 0").groupBy("component").agg(F.min(ident).alias("_first"))
    gone = (rows.join(first, "component").where((F.col("n_shingles") > 0) & (ident != F.col("_first")))
            .select(ident.alias("_gone")).select("_gone._id", "_gone.key").distinct())
    once = (keyed.select("_row", F.coalesce("doc_id", F.lit(2 ** 63 - 1)).alias("_id"), "key")
            .join(broadcast_if_small(gone), ["_id", "key"], "left_anti"))
    return unpacked(once, docs.columns)
