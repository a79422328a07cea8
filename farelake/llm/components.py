"""Connected components of an edge table, with every step a join or an aggregate over stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import Staging


def connected_components(edges: DataFrame, staging: Staging, left: str = "a", right: str = "b") -> DataFrame:
    """(node, component): the smallest node that each node of an edge reaches.

    Alternates two steps until the edges stay the same: every node hangs its larger neighbours on its smallest
    neighbour, then its smaller ones. The minimum of a node is a combined aggregate, and it is stored before it is joined
    back, so that a node with a large part of all edges is split by the skew join. Self-loops and nulls are ignored; no
    edges give an empty result.
    """
    clean = edges.select(F.greatest(left, right).alias("u"), F.least(left, right).alias("v"))
    current = staging.write(clean.where("u > v").distinct(), "edges")
    before = None
    while True:
        state = current.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(state) == before or state[0] == 0:
            break
        before = tuple(state)
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        smallest = staging.write(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "smallest")
        large = staging.write(
            both.where("v > u").join(smallest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large")
        smallest = staging.write(large.groupBy("u").agg(F.min("v").alias("m")), "smallest")
        hung = large.join(smallest, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        current = staging.write(hung.unionByName(smallest.select("u", F.col("m").alias("v"))).distinct(), "edges")
    stars = current.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component"))
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return stars.unionByName(roots)
