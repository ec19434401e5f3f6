"""The k-th row of an order in tables of any size and for any k, without a sort.

Values are narrowed down by counts over their leading digits, at most 65,536 a step. A step
starts at the first bit or byte in which what is left differs, so common beginnings cost none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..sources.staging import materialize

_BITS = 16


def _narrowed(rows: DataFrame, value: str, left: int, digits) -> tuple[DataFrame, object, int]:
    """The rows that share the ``left``-th smallest value, that value, and the place among them.

    ``digits(low, high)`` is a column that keeps the order of values between the two, has few
    distinct values and tells the two apart.
    """
    ends = [F.min(value).alias("low"), F.max(value).alias("high")]
    found = rows.agg(*ends).first()
    # The window is over the counts of one step, a bounded number whatever the table.
    running = Window.orderBy("digits").rowsBetween(Window.unboundedPreceding, 0)
    while found["low"] != found["high"]:
        counts = rows.groupBy(digits(found["low"], found["high"]).alias("digits")).agg(
            F.count("*").alias("rows"), *ends
        )
        reached = counts.withColumn("reached", F.sum("rows").over(running))
        found = reached.filter(F.col("reached") >= left).orderBy("digits").first()
        left -= found["reached"] - found["rows"]
        rows = rows.filter(F.col(value).between(F.lit(found["low"]), F.lit(found["high"])))
    return rows, found["low"], left


def _leading_bits(low: int, high: int) -> Column:
    differing = (low ^ high) & (2**64 - 1)
    return F.shiftright("age", max(0, differing.bit_length() - _BITS))


def _leading_bytes(low: bytes, high: bytes) -> Column:
    same = next((i for i, (a, b) in enumerate(zip(low, high)) if a != b), min(len(low), len(high)))
    return F.substring("key", same + 1, _BITS // 8)


def nth_newest(rows: DataFrame, position: int) -> dict | None:
    """``age`` (microseconds) and ``trace_id`` of the row at a place of ``(at, trace_id)`` rows,
    newest first and then by id; None beyond the end. A null id reads as an empty one."""
    if position < 1:
        return None
    id_bytes = F.coalesce("trace_id", F.lit("")).cast("binary")
    # Turned round, the newest time is the smallest number; no overflow, unlike a minus.
    turned = F.bitwise_not(F.unix_micros("at"))
    narrow = materialize(rows.select(turned.alias("age"), id_bytes.alias("key")), "times")
    if narrow.count() < position:
        return None
    equal, age, left = _narrowed(narrow, "age", position, _leading_bits)
    _, key, _ = _narrowed(equal, "key", left, _leading_bytes)
    return {"age": ~age, "trace_id": bytes(key).decode()}
