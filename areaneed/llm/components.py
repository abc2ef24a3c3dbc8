"""Connected components of a graph too large for one task: alternating stars.

Each round hangs every node's neighbours on its smallest neighbour, first the larger ones, then
the smaller ones; the graph keeps its components and becomes a set of stars in a few rounds.
A round is two aggregations of minima and two joins, so a node with very many links costs
no task more than its share. Each round is written, so lineage stays short.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areaneed.sources.scratch import materialise


def _star(edges: DataFrame) -> DataFrame:
    """(u, v) with u > v, in: any links both ways; out: stars after one round."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    large = (
        both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    ).distinct()
    small_least = large.groupBy("u").agg(F.min("v").alias("m"))
    small = large.join(small_least, "u").select(
        F.explode(F.array(F.struct("u", "m"), F.struct(F.col("v").alias("u"), "m"))).alias("e")
    )
    return small.select("e.u", F.col("e.m").alias("v")).where("u <> v").distinct()


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component): every node with a link and the smallest node it reaches.

    ``edges`` has two columns of longs, in any order and with repeats. Loops are ignored.
    """
    u, v = edges.columns
    state = materialise(
        edges.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v"))
        .where("u <> v")
        .distinct(),
        "links",
    )
    size = [F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))]
    mark = tuple(state.agg(*size).first())
    for _ in range(max_rounds):
        state = materialise(_star(state), "stars")
        new = tuple(state.agg(*size).first())
        if new == mark:
            return state.select(F.col("u").alias("node"), F.col("v").alias("component"))
        mark = new
    raise RuntimeError(f"no fixed point after {max_rounds} rounds")
