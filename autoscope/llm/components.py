"""Distributed union-find over pairs of long keys.

Alternating large-star and small-star rounds (Kiveris et al., 2014): every
round is one minimum per node and one join, so no component ever meets in one
task, and skewed nodes are split by the adaptive join.  Each round's links are
written to the shared folder, which cuts lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from autoscope.session import materialize


def _both_ways(links: DataFrame) -> DataFrame:
    return links.select(F.explode(F.array(F.struct(F.col("a").alias("u"), F.col("b").alias("v")),
                                          F.struct(F.col("b").alias("u"), F.col("a").alias("v")))).alias("x")).select("x.u", "x.v")


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the least neighbour."""
    ways = _both_ways(links)
    least = ways.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return (ways.where("v > u").join(least, "u").where("v <> m")
            .select(F.col("m").alias("a"), F.col("v").alias("b")).distinct())


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the least of them."""
    down = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("m").alias("a"), F.col("v").alias("b"))
    return moved.union(least.select(F.col("m").alias("a"), F.col("u").alias("b"))).where("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (columns a, b): the
    component is the least node reachable.  Links of a node to itself and
    nulls are ignored; no links give an empty table."""
    edges = materialize(links.select("a", "b").where("a <> b").distinct(), "links")
    state = None
    while True:
        edges = materialize(_small_star(_large_star(edges)), "links")
        row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        if (row["n"], row["s"]) == state:
            break
        state = (row["n"], row["s"])
    leaves = edges.select(F.col("b").alias("node"), F.col("a").alias("component"))
    roots = edges.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
    return leaves.union(roots)
