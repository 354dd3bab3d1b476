"""Connected components of an edge table by alternating large and small stars.

Each round is two aggregations and two joins over the edges; a node's smallest
neighbour is found with map-side aggregation, so a node of any degree is no hot
group. Edges are stored after each round. Rounds grow with the logarithm of the
number of nodes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from utxolake.llm.common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """``edges`` have u > v."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1_000_003), F.bit_xor(F.xxhash64("u", "v"))).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (u, v; longs) that isn't the smallest of its component."""
    edges = stored(
        edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges"
    )
    state = _state(edges)
    while state[0]:
        edges = stored(_small_star(_large_star(edges)), "edges")
        before, state = state, _state(edges)
        if state == before:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
