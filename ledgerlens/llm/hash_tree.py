"""Sharding by a hierarchical weighted hash tree.

Shards are the leaves of a tree of regions and racks. A document descends from
the root: at every node each child draws -ln(u) / weight from a hash of the
doc_id and the child's name, and the smallest draw wins, so a child gets rows
in proportion to its weight. A child's draw depends on nothing but its own name
and weight: where weights change, rows move only into or out of the subtrees
that changed, and a child added beside others takes rows only into itself.

Growth by one shard therefore adds a region of one rack and one shard: no
weight on the path of an existing shard changes.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, prefix_sums, written


@dataclass(frozen=True)
class Node:
    """A region, a rack or (with ``shard``) a shard."""

    name: str
    children: tuple[Node, ...] = ()
    shard: int | None = None
    own_weight: float = 1.0

    @property
    def weight(self) -> float:
        return sum(c.weight for c in self.children) if self.children else self.own_weight


@dataclass(frozen=True)
class Tree:
    regions: tuple[Node, ...] = field(default_factory=tuple)

    @property
    def root(self) -> Node:
        return Node("root", self.regions)


def region(name: str, racks: int, shards_per_rack: int, first: int, weight: float = 1.0) -> Node:
    return Node(name, tuple(
        Node(f"{name}/{r}", tuple(Node(f"{name}/{r}/{s}", (), first + r * shards_per_rack + s, weight)
                                  for s in range(shards_per_rack))) for r in range(racks)))


#: 24 shards: two regions of three racks of four shards.
TREE = Tree((region("r0", 3, 4, 0), region("r1", 3, 4, 12)))


def grown(tree: Tree, shard: int) -> Tree:
    """``tree`` with one more shard, in a region of its own."""
    return Tree((*tree.regions, region(f"r{len(tree.regions)}", 1, 1, shard)))


def draw(doc_id: Column, name: Column, weight: Column) -> Column:
    """-ln(u) / weight with u from the first 52 bits of an md5."""
    bits = F.conv(F.substring(F.md5(F.concat(name, F.lit(":"), doc_id).cast("binary")), 1, 13), 16, 10)
    return -F.log((bits.cast("double") + 0.5) / float(2 ** 52)) / weight


def leaf(doc_id: Column, tree: Tree) -> Column:
    """The shard that ``doc_id`` (a string) falls to. Children weighing nothing
    are passed over; of equal draws the earlier child wins.

    The tree is a table (node -> children) and the descent one lookup and one
    least draw a level, so the expression grows with the depth alone.
    """
    nodes, depth, level = [tree.root], 0, [tree.root]
    while level := [c for n in level for c in n.children if c.weight > 0]:
        nodes += level
        depth += 1
    number = {n.name: i for i, n in enumerate(nodes)}
    child = "array<struct<name:string,weight:double,node:int>>"
    table = F.array(*[F.array(*[
        F.struct(F.lit(c.name).alias("name"), F.lit(c.weight).alias("weight"), F.lit(number[c.name]).alias("node"))
        for c in n.children if c.weight > 0]).cast(child) for n in nodes])
    at = F.lit(0)
    for _ in range(depth):
        at = let(at, lambda here: let(F.get(table, here), lambda children: F.when(
            F.size(children) == 0, here).otherwise(F.array_min(F.transform(
                children, lambda c, i: F.struct(draw(doc_id, c["name"], c["weight"]).alias("draw"), i.alias("i"),
                                                c["node"].alias("node"))))["node"])))
    return F.get(F.array(*[F.lit(n.shard).cast("int") for n in nodes]), at)


def sharded(docs: DataFrame, tree: Tree = TREE) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    The doc_id and the tree alone decide the shard, so rows repeated with one
    doc_id share it; a null doc_id counts as the empty string. Slots number a
    shard's rows from 0 without gaps in the order of md5(doc_id), then doc_id,
    size and text_crc32. A null text has no bytes; an empty table gives no
    rows; other columns are not read.
    """
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    body = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    more = max(s.shard for r in tree.regions for k in r.children for s in k.children) + 1
    rows = written(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), (F.length(body) + 8).cast("long").alias("size"),
        F.crc32(body).alias("text_crc32"), F.md5(key.cast("binary")).alias("_key"), F.lit(1).cast("long").alias("_one"),
        leaf(key, tree).cast("int").alias("shard"),
        leaf(key, grown(tree, more)).cast("int").alias("grown_shard")), "sharded")
    return (prefix_sums(rows, rows, "shard", "_key", "_one", ["doc_id", "size", "text_crc32"], "slot")
            .select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
                    F.col("slot").cast("long").alias("slot"), "grown_shard"))
