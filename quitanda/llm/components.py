"""Connected components of an edge table by alternating large-star and small-star steps.

Nodes are longs, a component is named by its smallest node.  Each step is a
group-by and a join; the edges after a step are written to the shared folder.
A centre with a third of all nodes has one aggregated row in each step and its
edges are a join side that adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quitanda.llm.common import stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step over edges (u, v) with u > v."""
    if large:
        near = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        near = edges.select("u", "v")
    least = near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    joined = near.join(least, "u")
    if large:
        # every larger neighbour moves to the least node around u
        out = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        # u and its smaller neighbours move to the least of them
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v")))
    return out.where("u > v").distinct()


def _digest(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.max("u")).first()
    return tuple(row)


def components(edges: DataFrame, name: str = "cc") -> DataFrame:
    """(node, comp) for every node of ``edges`` (u, v); ``comp`` is its smallest reachable node.

    Self loops, repeated edges and edges with a null end are ignored; an empty
    table gives an empty result.
    """
    now = stored(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                 .distinct(), name)
    seen = _digest(now)
    while seen[0]:
        # read from the written edges; two steps, then one write
        now = stored(_star(_star(now, True), False), name)
        after = _digest(now)
        if after == seen:
            break
        seen = after
    # a star forest: every edge is (node, smallest node)
    return now.select(F.col("u").alias("node"), F.col("v").alias("comp")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct())
