"""A Merkle tree over a dataset, with proofs that are folded from hash midstates.

Every row is a leaf; the leaves of a source, in doc_id order, form a tree in
which up to ``FANOUT`` consecutive nodes have one parent, and the roots of the
sources, in order, form the tree of the dataset. A node is the SHA-256 of its
children's digests as hexadecimal text.

A parent hashes its children one after another and keeps a copy of the hash
state before each of them (``Parent``). To fold another digest into a child's
place, it resumes the state before that place and adds the replacement and the
siblings to the right; what stands left of it is not hashed again.

Leaves are numbered by a range sort and counts per range, and dealt by blocks of
``FANOUT ** BLOCK_LEVELS`` consecutive leaves, whose trees are built inside a
task; so neither a task nor a group holds a source. The levels above have one
node a block and are built by grouping; each block then gets the digests of its
ancestors' runs, which are as many as the tree is high.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import broadcast_if_small, written

FANOUT = 16
#: Levels of a tree that are built inside a task: its block has FANOUT ** 3 leaves at most.
BLOCK_LEVELS = 3
BLOCK = FANOUT ** BLOCK_LEVELS
#: Rows in a range of the sort that numbers leaves, about.
RANGE_ROWS = 500_000
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

PROOFS = ("doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, "
          "verified boolean")


class Parent:
    """An inner node: its children's digests, and the hash state before each."""

    def __init__(self, children: list[str]):
        self.children = "".join(children).encode("ascii")
        self.before, state = [], hashlib.sha256()
        for i in range(len(children)):
            self.before.append(state.copy())
            state.update(self.children[64 * i:64 * (i + 1)])
        self.digest = state.hexdigest()

    def siblings(self, slot: int) -> tuple[bytes, bytes]:
        return self.children[:64 * slot], self.children[64 * (slot + 1):]

    def folded(self, slot: int, child: str) -> str:
        """The node's digest with another child at ``slot``."""
        state = self.before[slot].copy()
        state.update(child.encode("ascii"))
        state.update(self.children[64 * (slot + 1):])
        return state.hexdigest()


def grown(digests: list[str], levels: int) -> list[list[Parent]]:
    """The parents of each of ``levels`` levels above ``digests``."""
    out = []
    for _ in range(levels):
        out.append([Parent(digests[i:i + FANOUT]) for i in range(0, len(digests), FANOUT)])
        digests = [p.digest for p in out[-1]]
    return out


def height(n: int) -> int:
    """Levels above ``n`` nodes until one is left."""
    levels = 0
    while n > 1:
        n, levels = -(-n // FANOUT), levels + 1
    return levels


def field(value: Column) -> Column:
    value = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf(fields: list[Column]) -> Column:
    """SHA-256 of the fields, each ``-`` if null, else its length in bytes, ``:`` and its value."""
    return F.sha2(F.concat(*map(field, fields)).cast("binary"), 256)


def numbered(rows: DataFrame, tree: str, order: list[str], tag: str) -> DataFrame:
    """``rows`` with ``pos``, their place in their ``tree`` (not null) by ``order``
    (nulls first), and ``n``, the tree's size.

    ``rows`` must be a written table. Rows that tie in everything are placed as
    they are read; their places are interchangeable.
    """
    spark = rows.sparkSession
    n_ranges = max(spark.sparkContext.defaultParallelism, -(-rows.count() // RANGE_ROWS))
    keys = [F.col(c).asc_nulls_first() for c in [tree, *order, "_place"]]
    ranged = (rows.withColumn("_place", F.monotonically_increasing_id()).repartitionByRange(n_ranges, *keys)
              .sortWithinPartitions(*keys).drop("_place").withColumn("_at", F.monotonically_increasing_id()))
    ranged = written(ranged, tag)
    part = F.shiftright("_at", 33)
    counts = written(ranged.groupBy(F.col(tree).alias("_tree"), part.alias("_part")).agg(
        F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n")), f"{tag}-counts")
    whole = Window.partitionBy("_tree")
    starts = broadcast_if_small(counts.select(
        "_tree", "_part", (F.col("_first") - F.coalesce(F.sum("_n").over(
            whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).alias("_zero"),
        F.sum("_n").over(whole).alias("n")))
    return ranged.join(starts, (F.col(tree) == F.col("_tree")) & (part == F.col("_part"))).select(
        *rows.columns, (F.col("_at") - F.col("_zero")).alias("pos"), "n")


def runs_of(nodes: DataFrame, tree: str) -> DataFrame:
    """The next level above ``nodes`` (tree, pos, digest, n) of trees with more
    than one: (tree, pos, digests of the run, digest, n)."""
    return (nodes.where("n > 1").groupBy(tree, F.floor(F.col("pos") / FANOUT).alias("pos")).agg(
        F.array_sort(F.collect_list(F.struct("pos", "digest")))["digest"].alias("digests"),  # FANOUT of them at most
        F.ceil(F.first("n") / FANOUT).alias("n"))
        .select(tree, "pos", "digests", F.sha2(F.array_join("digests", "").cast("binary"), 256).alias("digest"), "n"))


class Upper:
    """The levels above ``nodes`` (tree, pos, digest, n), as written tables."""

    def __init__(self, nodes: DataFrame, tree: str, tag: str):
        self.tree, self.levels = tree, [nodes]
        most = nodes.agg(F.max("n").alias("n")).first().n or 0
        for k in range(height(most)):
            self.levels.append(written(runs_of(self.levels[-1], tree), f"{tag}-{k}"))

    def roots(self) -> DataFrame:
        """(tree, digest) of the node that is left of each tree."""
        parts = [x.where("n = 1").select(self.tree, "digest") for x in self.levels]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    def paths(self, above: DataFrame) -> DataFrame:
        """(tree, pos, path, ...) of the lowest nodes: from their own run upwards,
        each with the node's slot, then the path that ``above`` (tree, path, ...)
        has for the tree's root."""
        rest = [c for c in above.columns if c not in (self.tree, "path")]
        ended = [x.where("n = 1").select(self.tree, F.col("pos")).join(above, self.tree) for x in self.levels]
        out = ended[-1]
        for runs, done in zip(self.levels[:0:-1], ended[-2::-1]):
            below = (runs.select(self.tree, "pos", "digests").join(out, [self.tree, "pos"])
                     .select(self.tree, F.col("pos").alias("_run"), "digests", "path", *rest,
                             F.posexplode("digests").alias("slot", "_digest")))
            own = F.array(F.struct(F.col("slot").cast("int").alias("slot"), F.col("digests")))
            out = below.select(self.tree, (F.col("_run") * FANOUT + F.col("slot")).alias("pos"),
                               F.concat(own, "path").alias("path"), *rest).unionByName(done.select(
                                   self.tree, "pos", "path", *rest))
        return out


def leaves(docs: DataFrame) -> DataFrame:
    """(tree, doc_id, leaf, changed) of every row; ``changed`` is the leaf after
    tampering. Trees sort as sources do: null first, then by bytes."""
    tampered = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0) & F.col("text").rlike("[A-Z]")
    fields = [F.col(c) for c in FIELDS]
    own = leaf(fields)
    # a lambda variable would keep text twice; the second hash is taken of tampered rows alone
    return docs.select(
        F.coalesce(F.concat(F.lit("1"), F.col("source")), F.lit("0")).alias("tree"),
        F.col("doc_id").cast("long").alias("doc_id"), own.alias("leaf"),
        F.when(tampered, leaf([*fields[:-1], F.translate("text", UPPER, LOWER)])).alias("changed"))


def block_roots(rows: DataFrame) -> DataFrame:
    """(tree, pos, digest, n) of each block of leaves: the node that stands for
    it on the level where blocks meet, or the root of a tree that ends below."""

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by("pos")
        n = group["n"][0].as_py()
        levels = grown(group["leaf"].to_pylist(), min(BLOCK_LEVELS, height(n)))
        digest = levels[-1][0].digest if levels else group["leaf"][0].as_py()
        return pa.table({"tree": group["tree"].slice(0, 1).cast(pa.string()), "pos": pa.array([group["pos"][0].as_py() // BLOCK], pa.int64()),
                         "digest": pa.array([digest], pa.string()), "n": pa.array([-(-n // BLOCK)], pa.int64())})

    return (rows.select("tree", "pos", "leaf", "n").groupBy("tree", F.floor(F.col("pos") / BLOCK).alias("_block"))
            .applyInArrow(run, "tree string, pos long, digest string, n long"))


def proofs(rows: DataFrame, paths: DataFrame) -> DataFrame:
    """``PROOFS`` of every leaf, block by block, from the block's own tree and
    the ``paths`` (tree, pos, path, subroot, root) above it."""

    def run(group: pa.Table, above: pa.Table) -> Iterator[pa.Table] | pa.Table:
        group = group.sort_by("pos")
        n, own = group["n"][0].as_py(), group["leaf"].to_pylist()
        levels = grown(own, min(BLOCK_LEVELS, height(n)))
        up = [(Parent(x["digests"]), x["slot"]) for x in above["path"][0].as_py()]
        subroot, root = above["subroot"][0].as_py(), above["root"][0].as_py()
        proof, folded = [], []
        for i, (digest, changed) in enumerate(zip(own, group["changed"].to_pylist())):
            sha, now = hashlib.sha256(), changed or digest
            steps = [(parents[i // FANOUT ** (k + 1)], i // FANOUT ** k % FANOUT) for k, parents in enumerate(levels)]
            for parent, slot in steps + up:
                left, right = parent.siblings(slot)
                sha.update(left)
                sha.update(right)
                now = parent.folded(slot, now)
            proof.append(sha.hexdigest())
            folded.append(now)
        return pa.table({
            "doc_id": group["doc_id"], "leaf": pa.array(own, pa.string()), "subroot": pa.array([subroot] * len(own), pa.string()),
            "root": pa.array([root] * len(own), pa.string()), "proof_sha256": pa.array(proof, pa.string()),
            "folded_root": pa.array(folded, pa.string()), "verified": pa.array([f == root for f in folded], pa.bool_())})

    blocks = rows.groupBy("tree", F.floor(F.col("pos") / BLOCK).alias("_block"))
    return blocks.cogroup(paths.withColumnRenamed("pos", "_block").groupBy("tree", "_block")).applyInArrow(run, PROOFS)


def manifest(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, leaf, subroot (of its source), root (of the
    dataset), proof_sha256 (of its siblings' digests from the leaf's run to the
    root's, left to right), folded_root and verified.

    Where 5 divides the crc32 of the decimal doc_id, the text's A-Z are
    lower-cased before the leaf is folded; texts without any are not changed by
    that, and a null doc_id or text is never tampered with. Leaves ascend by
    doc_id, nulls first, those of one doc_id by their digests; repeated rows are
    leaves of their own and equal ones take any of their places. A null source
    is a source, the first. A lone leaf is its subroot, a lone subroot the root;
    an empty table gives no rows; other columns are not read.
    """
    rows = written(numbered(written(leaves(docs), "leaves"), "tree", ["doc_id", "leaf"], "sorted-leaves"), "placed-leaves")
    sources = Upper(written(block_roots(rows), "blocks"), "tree", "sources")
    roots = written(sources.roots().select(F.lit("").alias("dataset"), "tree", "digest"), "subroots")
    tops = written(numbered(roots, "dataset", ["tree"], "sorted-subroots"), "placed-subroots")
    dataset = Upper(tops.select("dataset", "pos", "digest", "n"), "dataset", "dataset")
    step = "array<struct<slot:int,digests:array<string>>>"
    top = dataset.roots().select("dataset", F.array().cast(step).alias("path"), F.col("digest").alias("root"))
    above = dataset.paths(top).join(tops.select("dataset", "pos", "tree", F.col("digest").alias("subroot")), ["dataset", "pos"])
    paths = written(sources.paths(above.select("tree", "path", "subroot", "root")), "paths")
    return proofs(rows, paths)
