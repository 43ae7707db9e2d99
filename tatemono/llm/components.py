"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tatemono.operators.joins import lookup_join
from tatemono.sources import scratch

SLICE_ROWS = 20_000


# bytes of a node with its smallest neighbour in a broadcast table, on the high side
_NODE_BYTES = 64


def _least(edges: DataFrame, rows: DataFrame, m: Column, at_most: int) -> DataFrame:
    """``rows`` with ``m``, an aggregate over the edges of their node ``u``. An
    edge table of few rows has few nodes, so its aggregate may be broadcast."""
    least = edges.groupBy("u").agg(m.alias("m"), F.count(F.lit(1)).alias("n"))
    if at_most * _NODE_BYTES <= scratch.BROADCAST_BYTES:
        return rows.join(F.broadcast(least.drop("n")), "u")
    return lookup_join(rows, scratch.store(least, "least"), ["u"], ["v"], "n", SLICE_ROWS)


def _large_star(edges: DataFrame, count: int) -> DataFrame:
    """Every node links its larger neighbours to its smallest one, itself included."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    larger = both.where(F.col("v") > F.col("u"))
    linked = _least(both, larger, F.least(F.min("v"), F.col("u")), 2 * count)
    return linked.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")


def _small_star(edges: DataFrame, count: int) -> DataFrame:
    """Every node links its smaller neighbours and itself to the smallest."""
    linked = _least(edges, edges, F.min("v"), count)
    ends = F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v"))))
    return linked.select(ends.alias("e")).select("e.u", "e.v").where("u != v").distinct()


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node has one smaller neighbour or is a centre."""
    nodes = edges.select(
        F.explode(F.array(F.struct(F.col("u").alias("x"), F.lit(1).alias("leaf")), F.struct(F.col("v").alias("x"), F.lit(0).alias("leaf")))).alias("e")
    ).select("e.x", "e.leaf")
    sums = nodes.groupBy("x").agg(F.sum("leaf").alias("leaf"), F.max(1 - F.col("leaf")).alias("centre"))
    return sums.where((F.col("leaf") > 1) | ((F.col("leaf") > 0) & (F.col("centre") > 0))).isEmpty()


def connected_components(edges: DataFrame) -> DataFrame:
    """Stored table ``node, component`` of all nodes that are not the smallest
    of their component; ``edges`` holds two id columns.

    Each step is stored, so no lineage grows. The steps end when the edges are
    stars; a star's centre is its smallest node, because edges always lead
    from larger to smaller ones.
    """
    a, b = (F.col(f"`{c}`") for c in edges.columns[:2])
    current = scratch.store(
        edges.where(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges"
    )
    while not _are_stars(current):
        large = scratch.store(_large_star(current, current.count()), "edges")
        current = scratch.store(_small_star(large, large.count()), "edges")
    return current.select(F.col("u").alias("node"), F.col("v").alias("component"))
