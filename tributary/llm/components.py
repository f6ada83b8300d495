"""Distributed connected components by alternating large-star and small-star
steps (each a grouped minimum and a join), for edge tables of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import stage


def _steps(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star step.  The least neighbour of a node
    is a partial aggregate and one row, so that a node with very many
    neighbours only splits the join's other side."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    large = both.where("b > a").join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    joined = down.join(least, "a")
    small = joined.where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return small.union(least.select("a", F.col("m").alias("b"))).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for each node of ``edges`` (columns a and b, any
    ordered type): component is the least node that can be reached.  Nulls and
    self-loops link nothing; no edges give an empty table.  Each round is cut
    off by a table in the shared folder."""
    now = stage(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    mark = None
    while True:
        told = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        if told.n == 0 or (told.n, told.s) == mark:
            break
        mark = (told.n, told.s)
        now = stage(_steps(now))
    stars = now.groupBy("a").agg(F.min("b").alias("b"))
    return stars.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        stars.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
