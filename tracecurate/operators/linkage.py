"""Rows that belong together: connected components over shared keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..sources.staging import materialize


def _hung(edges: DataFrame, least: DataFrame) -> DataFrame:
    """Edges (u, v) with the least node ``m`` around each u."""
    return edges.join(least.select(F.col("u").alias("_u"), "m"), F.col("u") == F.col("_u")).drop("_u")


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node hangs its greater neighbours on the least node around it."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
    return _hung(both, least).filter("v > u and v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node hangs its smaller neighbours and itself on the least of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    lower = _hung(edges, least).filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return lower.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _are_stars(edges: DataFrame) -> bool:
    """Whether each node hangs on one other that hangs on none: nothing is left to do."""
    split = edges.groupBy("u").agg(F.count("*").alias("n")).filter("n > 1")
    chained = edges.select("u").join(edges.select(F.col("v").alias("u")), "u", "left_semi")
    return split.isEmpty() and chained.isEmpty()


def connected(edges: DataFrame) -> DataFrame:
    """(a, b) -> (node, root): the least node that each can reach, for nodes other than it.

    Large and small stars by turns, until the edges are stars; that is tested exactly. A
    component of any size is never in one task, and every turn is stored.
    """
    found = edges.filter("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    found = materialize(found.distinct(), "edges")
    while not _are_stars(found):
        found = materialize(_small_star(_large_star(found)), "edges")
    return found.select(F.col("u").alias("node"), F.col("v").alias("root"))


def row_components(rows: DataFrame, keys: list[str], row_id: str = "example_id") -> DataFrame:
    """(row_id, component) of every row: the least id among those it is linked with, directly or
    through others. Rows are linked that have the same value in one of the ``keys``; a null links nothing.

    All rows of a value are linked with the least of them, so a value that many rows have
    costs one link a row.
    """
    groups = [
        rows.filter(F.col(key).isNotNull()).select(
            row_id, F.concat(F.lit(f"{key}:"), F.md5(F.col(key).cast("string"))).alias("value")
        )
        for key in keys
    ]
    links = groups[0]
    for group in groups[1:]:
        links = links.unionByName(group)
    links = materialize(links, "links")
    hubs = links.groupBy("value").agg(F.min(row_id).alias("hub"), F.count("*").alias("n")).filter("n > 1")
    edges = links.join(hubs, "value").select(F.col(row_id).alias("a"), F.col("hub").alias("b"))
    roots = connected(edges).withColumnRenamed("node", row_id)
    return rows.select(row_id).join(roots, row_id, "left").select(
        row_id, F.coalesce("root", row_id).alias("component")
    )
