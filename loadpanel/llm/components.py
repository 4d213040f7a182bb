"""Connected components by alternating large and small stars.

Repeated edges, edges both ways and edges of a node with itself change nothing; a node that only its own edge names is
in no component. Nodes are never null here. Without edges, no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from loadpanel.scale import materialize


def _fingerprint(edges: DataFrame) -> tuple:
    """Count and order-free sum of an edge table, to see whether it still changes."""
    hashed = F.xxhash64("u", "v").cast("decimal(38,0)")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(hashed)).first())


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Each node's neighbours (the larger ones, or the smaller ones and itself) move to its least neighbour."""
    if large:
        around = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        around = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = around.groupBy("u").agg(F.min("v").alias("least")).withColumn("least", F.least("least", "u"))
    # A hub's neighbours are many rows of one key: a sort-merge join lets them be split.
    moved = around.join(least.hint("merge"), "u")
    if large:
        moved = moved.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("least").alias("v"))
    else:
        own = least.select("u", F.col("least").alias("v"))
        moved = moved.select(F.col("v").alias("u"), F.col("least").alias("v")).unionByName(own)
    return moved.filter(F.col("u") != F.col("v")).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edge table (u, v); the root is the least node of its component."""
    edges = materialize(edges.filter(F.col("u") != F.col("v")).select("u", "v").distinct(), "component-edges")
    before = None
    while True:
        edges = materialize(_star(_star(edges, large=True), large=False), "component-edges")
        now = _fingerprint(edges)
        if now == before:
            break
        before = now
    members = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return members.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
