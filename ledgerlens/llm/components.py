"""Connected components of links between nodes, as joins and groupings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _both_ways(links: DataFrame) -> DataFrame:
    return links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the least one of them."""
    near = _both_ways(links)
    least = near.groupBy("a").agg(F.min("b").alias("_m")).select("a", F.least("a", "_m").alias("_m"))
    return near.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("_m").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the least of them."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("_m"))
    return (down.join(least, "a").where("b <> _m").select(F.col("b").alias("a"), F.col("_m").alias("b"))
            .unionByName(least.select("a", F.col("_m").alias("b"))).distinct())


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node in ``links`` (a, b); the component is its
    least node.

    Large and small stars take turns until every link leads to the least node
    of its component; the number of rounds grows with the logarithm of the
    number of nodes. Rounds are written, so a lost executor costs one of them.
    """
    now = written(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                  .distinct(), "links")
    before = None
    while True:
        state = now.agg(F.count(F.lit(1)), F.sum(F.hash("a", "b").cast("long"))).first()
        if state == before:
            break
        before = state
        now = written(_small_star(_large_star(now)), "links")
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()
