"""Connected components of an edge table by alternating large and small stars.

Each round links every node's greater neighbours, then its smaller ones, to the least
node it sees; stars remain.  Minima are aggregated before shuffles, every round is
stored in the shared folder, and nothing but a count and a checksum reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import stored


def _stars(edges: DataFrame) -> bool:
    """Whether the edges, each from a greater node to a smaller one, are stars: no node
    points to two others, and none that points is pointed to.  A star's centre is then
    the least node of its component."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("hub")).unionByName(
        edges.select(F.col("b").alias("node"), F.lit(0).alias("out"), F.lit(1).alias("hub")))
    seen = ends.groupBy("node").agg(F.sum("out").alias("out"), F.max("hub").alias("hub"))
    return seen.agg(F.count_if((F.col("out") > 1) | ((F.col("out") > 0) & (F.col("hub") > 0)))).first()[0] == 0


def _large_star(e: DataFrame) -> DataFrame:
    both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    return (both.join(least, "a").where(F.col("b") > F.col("a"))
            .select(F.col("b").alias("a"), F.col("m").alias("b")))


def _small_star(e: DataFrame) -> DataFrame:
    down = e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    linked = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return linked.unionByName(least.select("a", F.col("m").alias("b"))).where("a != b").distinct()


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component`` (the least node) of every node that has an edge to another."""
    ends = edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
    e = stored(ends.where("a != b").distinct(), "edges")
    while not _stars(e):
        e = stored(_small_star(_large_star(e)), "edges")
    nodes = e.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.unionByName(e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
