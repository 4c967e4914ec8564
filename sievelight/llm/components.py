"""Connected components of an edge table, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sievelight.session import cut_lineage


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Hang neighbours on the smallest node around each node; ``edges`` run from the larger (u) to the smaller node (v)."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    moved = both.join(least, "u")
    if large:
        out = moved.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = moved.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return out.where(F.col("u") != F.col("v")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` of every node of ``edges(a, b)``; the component is its smallest node.

    Rounds are logarithmic in the longest chain. A node of many edges is only summarised (map-side
    minimum) and joined, never gathered. Each round is cut by a checkpoint, so a lost executor
    replays one round. Loops and repeated edges are allowed; null nodes are dropped.
    """
    now = cut_lineage(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    seen = None
    while True:
        state = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if state == seen or not state["n"]:
            break
        seen = state
        now = cut_lineage(_star(_star(now, True), False))
    roots = now.select(F.col("v").alias("node")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component")))
