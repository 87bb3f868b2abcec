"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pacewright.llm.scratch import Scratch


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Hang the larger (``large``) or the smaller neighbours of each node on its least neighbour."""
    both = edges if not large else edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    # a > b in edges: a small star needs only each node's smaller neighbours
    least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    hung = both.join(least, "a")
    if large:
        out = hung.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = hung.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
    return out.where("a <> b").distinct()


def components(scratch: Scratch, edges: DataFrame) -> DataFrame:
    """(node, component) of every node in ``edges(a, b)``: the least node that it reaches.

    Null ends, loops and repeated edges have no effect; an empty table gives an empty result.
    Each step leaves every component connected and ends when two steps change nothing; the
    number of steps grows with the logarithm of the number of nodes.
    """
    now = scratch.save(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    mark = None
    while not now.isEmpty():
        after = scratch.save(_star(_star(now, large=True), large=False))
        seen = after.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        scratch.drop(now)
        now = after
        if (seen.n, seen.s) == mark:
            break
        mark = (seen.n, seen.s)
    stars = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.unionByName(stars.select(F.col("component").alias("node"), "component").distinct())
