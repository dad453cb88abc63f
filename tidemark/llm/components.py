"""Connected components by alternating star contraction, DataFrame only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.store import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the node's smallest neighbour."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    hop = down.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hop.unionByName(low.select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges`` (u, v) -> (node, root): the smallest node reachable from each.

    Alternates the two star steps until the edge set no longer changes: every
    node then points straight at its root. Only per-node minima are grouped
    (combined before the shuffle) and every join has one row per node on one
    side, so a hub with very many neighbours is split like any skewed join.
    Each round is written to the shared folder. Roots themselves, and nodes
    without an edge to another node, are not returned; null ends and loops
    are ignored.
    """
    edges = stored(edges.select("u", "v").where("u <> v").distinct(), "cc-0")
    seen, step = None, 0
    while True:
        mark = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == seen or not mark[0]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen, step = mark, step + 1
        edges = stored(_small_star(_large_star(edges)), f"cc-{step}")
