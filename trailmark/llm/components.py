"""Connected components of a graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailmark.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (x, y); a component is its least node.

    Alternating stars: a round links each node's larger neighbours to its least one, then
    its smaller ones, until nothing changes. A hub's neighbours are rows of a join, which
    adaptive execution splits, and every round ends in the shared folder. Rounds grow with
    the logarithm of the path lengths.
    """
    now = stored(edges.where("x <> y").select("x", "y").distinct(), "edges")
    before = None
    while True:
        both = now.union(now.select(F.col("y").alias("x"), F.col("x").alias("y")))
        large = both.join(_least(both), "x").where("y > x").select(
            F.col("y").alias("x"), F.least("x", "m").alias("y")
        )
        # Each node keeps its least neighbour, and hands it to its other smaller ones.
        down = large.where("x <> y")
        small = down.join(_least(down), "x").select(F.col("y").alias("x"), F.col("m").alias("y"))
        kept = small.where("x <> y").union(_least(down).withColumnRenamed("m", "y"))
        after = stored(kept.distinct(), "edges")
        mark = tuple(after.agg(F.count("*"), F.sum(F.xxhash64("x", "y").cast("decimal(38,0)"))).first())
        now = after
        if mark == before:
            break
        before = mark
    leaves = now.select(F.col("x").alias("node"), F.col("y").alias("component"))
    roots = now.select(F.col("y").alias("node"), F.col("y").alias("component"))
    return leaves.union(roots).distinct()


def _least(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("x").agg(F.min("y").alias("m"))
