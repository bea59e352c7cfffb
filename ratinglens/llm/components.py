"""Connected components of a table of links, as Spark jobs whose results are written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratinglens.llm.common import shuffled
from ratinglens.session import staged


def components(links: DataFrame) -> DataFrame:
    """(node, component) for each node of links (a, b); component is the smallest node reachable.

    Each round links every node to the smallest of its neighbours, then every neighbour of a node to the smallest
    node it knows (large star, small star). Both are aggregations and joins by node; hot nodes are combined before
    the shuffle and split in the joins. A round's links are written, so no lineage grows and a lost executor costs
    no earlier round. Links of a node to itself, repeated links and an empty table are allowed.
    """
    edges = staged(links.select("a", "b").where("a <> b").distinct(), "links")
    mark = _mark(edges)
    while True:
        larger = _large_star(edges)
        smaller = _small_star(larger)
        new = staged(smaller, "links")
        before, edges = mark, new
        mark = _mark(edges)
        if mark == before:  # a star forest stays as it is
            break
    stars = edges.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("component"))
    return stars.union(stars.select("component", "component")).groupBy("node").agg(F.min("component").alias("component"))


def _mark(edges: DataFrame) -> tuple:
    """Tells sets of links apart, without their order."""
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.hash("b", "a"))).first())


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _rekeyed(least: DataFrame) -> DataFrame:
    """The same rows, under a key that Spark doesn't know to be dealt already.

    Adaptive execution splits the rows of a hot node only where both sides of a join have a shuffle of their own.
    """
    return least.withColumn("a", F.col("a").bitwiseXOR(F.lit(0).cast("long")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of each node go to its smallest neighbour or itself."""
    ways = _both_ways(edges)
    least = ways.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return ways.where("b > a").join(shuffled(_rekeyed(least)), "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Smaller neighbours of each node, and the node, go to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b")
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    joined = down.join(shuffled(_rekeyed(least)), "a")
    moved = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
    return moved.where("a <> b").distinct()
