"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorecast.llm.common import written


def _large_star(e: DataFrame) -> DataFrame:
    both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    return (both.filter("b > a").join(least, "a")
            .select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct())


def _small_star(e: DataFrame) -> DataFrame:
    """Edges come with a > b."""
    least = e.groupBy("a").agg(F.min("b").alias("m"))
    near = e.join(least, "a")
    return (near.select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
            .union(least.select("a", F.col("m").alias("b"))).distinct())


def _state(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count(F.lit(1)), F.sum(F.hash("a", "b").cast("long")),
                       F.sum(F.hash("b", "a", F.lit(1)).cast("long"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, component): component is the smallest node reachable, for every
    node that has an edge. ``edges`` has long columns a and b.

    Minima are aggregated before they are joined back, so a node with many
    neighbours is no single task; every step is a written table, so a lost
    executor costs at most one step. The steps end when the edges, which then
    are stars around the smallest node of each component, no longer change.
    """
    e = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    e = written(e, "edges")
    state = _state(e)
    while True:
        e = written(_small_star(_large_star(e)), "edges")
        now = _state(e)
        if now == state:
            break
        state = now
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
