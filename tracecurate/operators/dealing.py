"""Requests dealt into tasks of equal cost."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

# Sums of so many hash buckets are put in order in one task, whatever the number of rows.
_BUCKETS = 1 << 14
_LETTERS_PER_TOKEN = 4


def call_cost(letters: Column, max_tokens: int | Column) -> Column:
    """Tokens that a call may cost: those of the prompt, estimated, and the longest answer."""
    answer = F.lit(max_tokens) if isinstance(max_tokens, int) else max_tokens
    return F.ceil(F.coalesce(letters, F.lit(0)) / _LETTERS_PER_TOKEN) + F.coalesce(answer, F.lit(0)) + 1


def deal_by_cost(rows: DataFrame, tasks: int, key: str = "request_key", cost: str = "cost") -> DataFrame:
    """Add ``task``, 0 to ``tasks`` - 1: stretches of about equal summed cost in an order by hash.

    A stretch differs from the mean by less than one row's cost at each end. The order follows
    from the keys, so that costly neighbours in the input come apart. ``key`` is distinct and
    ``cost`` positive; ``rows`` is read twice, so it should be stored.
    """
    placed = rows.withColumn("_bucket", F.pmod(F.xxhash64(key), F.lit(_BUCKETS)).cast("int"))
    buckets = Window.orderBy("_bucket")
    earlier = buckets.rowsBetween(Window.unboundedPreceding, -1)
    whole = buckets.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    sums = placed.groupBy("_bucket").agg(F.sum(cost).alias("_sum"))
    offsets = sums.select(
        "_bucket",
        F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_sum").over(whole).alias("_total"),
    )
    inside = Window.partitionBy("_bucket").orderBy(key).rowsBetween(Window.unboundedPreceding, 0)
    dealt = placed.withColumn("_within", F.sum(cost).over(inside)).join(F.broadcast(offsets), "_bucket")
    middle = F.col("_before") + F.col("_within") - F.col(cost) / 2
    task = F.floor(middle * tasks / F.col("_total"))
    return dealt.withColumn("task", F.least(task, F.lit(tasks - 1)).cast("int")).drop(
        "_bucket", "_within", "_before", "_total"
    )
