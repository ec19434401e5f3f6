"""Connected components of links, by turns of large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """One turn over edges (u, v) with u > v. Every node hangs its neighbours (those above it
    for a large star, those below it and itself for a small one) on the least of them."""
    sides = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    least = sides.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select(F.col("u").alias("_u"), F.least("u", "m").alias("m") if large else F.col("m"))
    hung = sides.join(least, F.col("u") == F.col("_u"))
    if large:
        out = hung.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = hung.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select(F.col("_u").alias("u"), F.col("m").alias("v"))
        )
    return out.where("u <> v").distinct()


def components(links: DataFrame) -> DataFrame:
    """(a, b) -> (id, component): the smallest id that each linked id can reach.

    Each turn is stored, and nothing but its size comes to the driver. The end is a turn that
    leaves every edge as it was. Links of an id with itself and null ids count for nothing.
    """
    edges = stored(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges"
    )
    count = edges.count()
    while count:
        turned = stored(_stars(_stars(edges, large=True), large=False), "edges")
        before, count = count, turned.count()
        # Edges are distinct, so as many without a new one are the same.
        same = count == before and turned.join(edges, ["u", "v"], "left_anti").isEmpty()
        edges = turned
        if same:
            break
    nodes = edges.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return nodes.unionByName(edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
