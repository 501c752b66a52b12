"""Connected components of an edge table by alternating star contraction (no collection, lineage cut per round)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airshed.llm.common import stage


def _digest(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _point_to_least(pairs: DataFrame, keep_larger: bool) -> DataFrame:
    """Every neighbour of u (the larger ones, or all with u itself) now points to the least of u and its neighbours."""
    least = pairs.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    out = pairs.join(least, "u")
    if keep_larger:
        out = out.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = out.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            least.select("u", F.col("m").alias("v")))
    return out.where(F.col("u") != F.col("v")).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges (u, v)``; root is the least node that can be reached.

    Each round lets the larger neighbours of a node point to the least one, then the smaller ones; the edge count never
    grows, and the rounds grow with the logarithm of the longest path. Edges with a null end are ignored. Each round is
    a written table, whose size Spark knows when it plans the next one.
    """
    edges = edges.select("u", "v").where("u is not null and v is not null and u != v")
    edges = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    edges = stage(edges, "component-edges")
    before = _digest(edges)
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _point_to_least(both, keep_larger=True)
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        edges = stage(_point_to_least(down, keep_larger=False), "component-edges")
        after = _digest(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
