"""Connected components of an edge table, by following least neighbours and contracting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gantrylake.llm.scratch import Scratch


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (columns ``a`` and ``b``); root is the least node reachable.

    Each round every node follows its least neighbour if that is less than itself, chains are shortened until all
    point at their end, and the edges are drawn anew between those ends; what is left shrinks by half at
    least. Every step is written to the shared folder, and a node with very many edges is combined before
    the shuffle. NULL ends are ignored.
    """
    scratch = Scratch(edges.sparkSession, "components")
    kept = edges.where("a is not null and b is not null and a != b")
    left = scratch.write(kept.select("a", "b").union(kept.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    roots = left.select(F.col("a").alias("node")).distinct().select("node", F.col("node").alias("root"))
    while left.limit(1).count():
        least = left.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("up"))
        parents = _shortened(scratch.write(least, "parents"), scratch)
        ends = parents.select(F.col("node").alias("root"), "up")
        roots = scratch.write(roots.join(ends, "root", "left").select("node", F.coalesce("up", "root").alias("root")), "roots")
        ups = parents.select(F.col("node").alias("a"), F.col("up").alias("up_a")), parents.select(F.col("node").alias("b"), F.col("up").alias("up_b"))
        drawn = left.join(ups[0], "a").join(ups[1], "b").where("up_a != up_b")
        left = scratch.write(drawn.select(F.col("up_a").alias("a"), F.col("up_b").alias("b")).distinct(), "edges")
    return scratch.finish(roots)


def _shortened(parents: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, up) with every node pointing at the end of its chain."""
    while True:
        above = parents.select(F.col("node").alias("up"), F.col("up").alias("top"))
        moved = parents.join(above, "up").select("node", F.col("top").alias("up"), (F.col("top") != F.col("up")).alias("moved"))
        moved = scratch.write(moved, "parents")
        parents = moved.select("node", "up")
        if not moved.where("moved").limit(1).count():
            return parents
