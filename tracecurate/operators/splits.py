"""Exact-size, reproducible splits that move no rows.

A row's place in the lottery is the md5 of its key and the seed. The split takes the k
rows with the smallest place, so it is enough to know the k-th smallest one: it is found
from counts over hash prefixes, and the split itself is a filter.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..config import CurationConfig
from ..sources.staging import materialize
from .linkage import row_components
from .numbering import number_rows

_DIGITS_PER_STEP = 4
_HASH_DIGITS = 32


def lottery(key: str, seed: int) -> Column:
    return F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed))))


def _kth_place(draws: DataFrame, k: int):
    """The k-th smallest ``(place, key)`` of a table with columns ``place, key``.

    Prefixes grow until one row is left, in tables of any size.

    Each step counts the rows under every continuation of the prefix found so far: at most
    16**4 = 65,536 counts however large the table, which is why the running sum over them
    may be an unpartitioned window.
    """
    prefix, left = "", k
    running = Window.orderBy("digits").rowsBetween(Window.unboundedPreceding, -1)
    rows = None
    while len(prefix) < _HASH_DIGITS and rows != 1:
        counts = (
            draws.filter(F.startswith("place", F.lit(prefix)))
            .groupBy(F.substring("place", 1, len(prefix) + _DIGITS_PER_STEP).alias("digits"))
            .agg(F.count("*").alias("rows"))
            .withColumn("before", F.coalesce(F.sum("rows").over(running), F.lit(0)))
        )
        found = counts.filter(
            (F.col("before") < left) & (F.col("before") + F.col("rows") >= left)
        ).first()
        prefix, left, rows = found["digits"], left - found["before"], found["rows"]
    last = draws.filter(F.startswith("place", F.lit(prefix))).orderBy("place", "key").limit(left)
    return last.agg(F.max(F.struct("place", "key")).alias("last")).first()["last"]


def draw(df: DataFrame, size: int, key: str = "example_id", seed: int = 42) -> Column:
    """Predicate that is true for exactly ``size`` rows of ``df``.

    ``key`` must be unique and ``df`` a stored table: its key column is read a few times.
    """
    if size <= 0:
        return F.lit(False)
    place = lottery(key, seed)
    draws = df.select(place.alias("place"), F.col(key).cast("string").alias("key"))
    last = _kth_place(draws, size)
    return (place < last["place"]) | (
        (place == last["place"]) & (F.col(key).cast("string") <= last["key"])
    )


def with_example_id(training: DataFrame) -> DataFrame:
    """Give rows that come without ids, as from a CSV export, a unique ``example_id``.

    Rows are numbered by a hash of their content, so the same rows get the same numbers.
    Equal rows are told apart by where they were read: a content that is repeated very
    often is still spread over many range partitions.
    """
    content = F.concat_ws("\x1f", *[F.coalesce(F.col(c), F.lit("")) for c in training.columns])
    numbered = number_rows(
        training.withColumns({"_content": F.md5(content), "_read": F.monotonically_increasing_id()}),
        "_content",
        "_read",
        name="_number",
    )
    return numbered.withColumn("example_id", F.col("_number").cast("string")).drop(
        "_content", "_read", "_number"
    )


def holdout_size(rows: int, config: CurationConfig = CurationConfig()) -> int:
    """Share of the rows, halves rounded to even."""
    return round(config.holdout_fraction * rows)


def validation_size(rows: int, config: CurationConfig = CurationConfig()) -> int:
    """Share of the rows, rounded up."""
    return math.ceil(config.validation_fraction * rows)


def split_holdout(
    training: DataFrame, config: CurationConfig = CurationConfig(), key: str = "example_id"
) -> tuple[DataFrame, DataFrame]:
    """The holdout and the remaining rows. Each is a filter on ``training``."""
    rows = training.count()
    chosen = draw(training, holdout_size(rows, config), key, config.seed)
    return training.filter(chosen), training.filter(~chosen)


def split_validation(
    trainval: DataFrame, config: CurationConfig = CurationConfig(), key: str = "example_id"
) -> DataFrame:
    """``trainval`` with a ``split`` column, ``train`` or ``validation``."""
    # Another salt than the holdout's, or the rows next in its lottery would be drawn.
    rows = trainval.count()
    chosen = draw(trainval, validation_size(rows, config), key, config.seed + 1)
    return trainval.withColumn("split", F.when(chosen, "validation").otherwise("train"))


def split_groups(
    df: DataFrame, group: str, config: CurationConfig = CurationConfig()
) -> DataFrame:
    """``df`` with a ``split`` column, ``holdout`` or ``train``, that divides no group.

    The share is one of groups: that many distinct values of ``group`` are drawn, and their
    rows follow by a filter. Rows without a group are ``train``.
    """
    groups = materialize(df.filter(F.col(group).isNotNull()).select(group).distinct(), "groups")
    chosen = draw(groups, holdout_size(groups.count(), config), group, config.seed)
    return df.withColumn("split", F.when(chosen, "holdout").otherwise("train"))


def _first_beyond(draws: DataFrame, amount: int):
    """The ``(place, key)`` at which the running sum of ``size`` first exceeds ``amount``, in the
    order of places; None if it never does. Found from sums over hash prefixes, as in
    ``_kth_place``."""
    total = draws.agg(F.sum("size").alias("size")).first()["size"]
    if total is None or total <= amount:
        return None
    prefix, left, rows = "", amount, None
    running = Window.orderBy("digits").rowsBetween(Window.unboundedPreceding, -1)
    while len(prefix) < _HASH_DIGITS and rows != 1:
        sums = (
            draws.filter(F.startswith("place", F.lit(prefix)))
            .groupBy(F.substring("place", 1, len(prefix) + _DIGITS_PER_STEP).alias("digits"))
            .agg(F.sum("size").alias("size"), F.count("*").alias("rows"))
            .withColumn("before", F.coalesce(F.sum("size").over(running), F.lit(0)))
        )
        beyond = sums.filter((F.col("before") <= left) & (F.col("before") + F.col("size") > left))
        found = beyond.first()
        prefix, left, rows = found["digits"], left - found["before"], found["rows"]
    # Left are those of one hash, in practice a single one.
    reached = F.sum("size").over(Window.orderBy("key").rowsBetween(Window.unboundedPreceding, 0))
    last = draws.filter(F.startswith("place", F.lit(prefix))).withColumn("reached", reached)
    return last.filter(F.col("reached") > left).orderBy("key").first()


def draw_components(sizes: DataFrame, rows: int, seed: int) -> Column:
    """Predicate on (component, size): a weighted lottery that draws at most ``rows`` rows.

    A component with more rows than that is never drawn; of the others those are that come
    first, as long as their rows fit. ``sizes`` is a stored table.
    """
    place, key = lottery("component", seed), F.col("component").cast("string")
    fits = F.col("size") <= rows
    draws = sizes.filter(fits).select(place.alias("place"), key.alias("key"), "size")
    first = _first_beyond(draws, rows)
    if first is None:
        return fits
    before = (place < first["place"]) | ((place == first["place"]) & (key < first["key"]))
    return fits & before


def split_leak_free(
    training: DataFrame,
    links: DataFrame,
    config: CurationConfig = CurationConfig(),
) -> DataFrame:
    """``training`` with ``component`` and ``split``: ``holdout``, ``validation`` or ``train``.

    Rows of one session, copies of one seed and rows with equal input stay on one side, also
    when they are linked through others. ``links`` has ``example_id, session_id, seed_id``; a
    training row without an entry there is linked by its input alone. Shares are of rows: as
    many components are drawn as fit into the size of an ordinary holdout and validation part.
    """
    keyed = training.select("example_id", F.md5("input").alias("input_hash")).join(
        links.select("example_id", "session_id", "seed_id"), "example_id", "left"
    )
    keyed = materialize(keyed, "keyed")
    parts = materialize(row_components(keyed, ["session_id", "seed_id", "input_hash"]), "components")
    sizes = materialize(parts.groupBy("component").agg(F.count("*").alias("size")), "sizes")

    def rows(of: DataFrame) -> int:
        return of.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("rows")).first()["rows"]

    held = draw_components(sizes, holdout_size(rows(sizes), config), config.seed)
    rest = materialize(sizes.filter(~held), "rest")
    checked = draw_components(rest, validation_size(rows(rest), config), config.seed + 1)
    split = F.when(held, "holdout").when(checked, "validation").otherwise("train")
    assigned = parts.join(sizes.select("component", split.alias("split")), "component")
    return training.join(assigned.select("example_id", "component", "split"), "example_id")
