"""Exact row numbers over a whole table or over groups of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..sources.staging import materialize

# monotonically_increasing_id() holds the partition in the bits above this one.
_POSITION_BITS = 33


def number_rows(
    df: DataFrame, *order: str, name: str = "row_no", total: str | None = None
) -> DataFrame:
    """Number all rows 1, 2, .. in the given order, without a one-task window.

    ``total`` names a column for the number of all rows.

    The rows are range-partitioned, sorted per partition and stored with their place. The
    offsets to add are one row per partition, so their broadcast is bounded by the
    partition count.
    """
    place = F.monotonically_increasing_id()
    stored = materialize(
        df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_place", place),
        "numbered",
    ).withColumn("_block", F.shiftright("_place", _POSITION_BITS))
    blocks = Window.orderBy("_block")
    earlier = blocks.rowsBetween(Window.unboundedPreceding, -1)
    whole = blocks.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    added = {"_offset": F.coalesce(F.sum("_rows").over(earlier), F.lit(0))}
    if total is not None:
        added[total] = F.sum("_rows").over(whole)
    offsets = (
        stored.groupBy("_block").agg(F.count("*").alias("_rows")).withColumns(added).drop("_rows")
    )
    position = F.col("_place").bitwiseAND(2**_POSITION_BITS - 1)
    return (
        stored.join(F.broadcast(offsets), "_block")
        .withColumn(name, F.col("_offset") + position + 1)
        .drop("_block", "_place", "_offset")
    )


def number_in_groups(df: DataFrame, group: list[str], *order: str, name: str = "row_no") -> DataFrame:
    """Number the rows of each group 1, 2, .. in the given order; a group may have any size.

    As in ``number_rows`` rows are range-partitioned and stored with their place. A row's number
    is its place in its block, less the group's first there, plus the group's rows in earlier
    blocks. The join goes by block and group, so a large group is spread over its blocks.
    """
    placed = materialize(
        df.repartitionByRange(*group, *order)
        .sortWithinPartitions(*group, *order)
        .withColumn("_place", F.monotonically_increasing_id()),
        "numbered",
    ).withColumn("_block", F.shiftright("_place", _POSITION_BITS))
    earlier = Window.partitionBy(*group).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    parts = (
        placed.groupBy("_block", *group)
        .agg(F.count("*").alias("_rows"), F.min("_place").alias("_first"))
        .withColumn("_offset", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) + 1 - F.col("_first"))
        .drop("_rows", "_first")
    )
    return (
        placed.join(parts, ["_block", *group])
        .withColumn(name, F.col("_place") + F.col("_offset"))
        .drop("_block", "_place", "_offset")
    )


def split_by_group_size(
    df: DataFrame, group: str, limit: int, broadcast_rows: int, sizes_of: DataFrame | None = None
) -> tuple[DataFrame, DataFrame | None]:
    """Rows of groups of up to ``limit`` rows, and rows of larger ones (None if there are none).

    Group sizes are counted with map-side combine over the group column only, so a large
    group costs one row per input partition. ``sizes_of`` may name a cheaper table to
    count: one with at least the rows of ``df`` in every group.
    """
    large = (
        (df if sizes_of is None else sizes_of)
        .groupBy(group)
        .agg(F.count("*").alias("_rows"))
        .filter(F.col("_rows") > limit)
        .select(group)
    )
    if large.isEmpty():
        return df, None
    large = materialize(large, "large-groups")
    if large.count() <= broadcast_rows:
        large = F.broadcast(large)
    return df.join(large, group, "left_anti"), df.join(large, group, "left_semi")
