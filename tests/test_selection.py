"""The k-th newest row against a sort, for every place and for large ones."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from tracecurate.operators import selection
from tracecurate.operators.selection import nth_newest

SCHEMA = "at timestamp, trace_id string"
START = datetime.datetime(2024, 1, 1)


def by_sort(rows):
    return sorted(rows, key=lambda r: (-((r[0] - START) / datetime.timedelta(microseconds=1)), (r[1] or "").encode()))


def places(spark, rows, wanted):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = []
    for k in wanted:
        last = nth_newest(df, k)
        found.append(last and (START + datetime.timedelta(microseconds=last["age"] - 1704067200000000), last["trace_id"]))
    return found


def test_every_place_of_a_small_table(spark):
    """Ties in time, repeated rows, ids that begin alike, an empty, a null and a non-ASCII one."""
    ids = ["run-1", "run-10", "run-1", "run-2", "", None, "ünder", "z"]
    rows = [(START + datetime.timedelta(microseconds=m), i) for m, i in zip([5, 5, 5, 5, 5, 0, 5, -(10**15)], ids)]
    expected = [(at, i or "") for at, i in by_sort(rows)]
    assert places(spark, rows, range(1, len(rows) + 1)) == expected
    assert places(spark, rows, [0, len(rows) + 1]) == [None, None]


def test_random_times_around_the_epoch(spark):
    draw = random.Random(4)
    rows = [(START + datetime.timedelta(days=draw.randint(-40000, 9000), microseconds=draw.randint(0, 3)), f"t{draw.randint(0, 30)}") for _ in range(400)]
    wanted = [1, 77, 200, 400]
    assert places(spark, rows, wanted) == [by_sort(rows)[k - 1] for k in wanted]


def test_nothing_in_an_empty_table(spark):
    assert nth_newest(spark.createDataFrame([], SCHEMA), 1) is None


def test_a_million_places_without_a_sort_of_rows(spark, monkeypatch):
    """All of equal time, then all of different: no step sorts or collects more than its counts."""
    plans = []
    kept = selection._narrowed

    def noted(rows, value, place, digits):
        def seen(low, high):
            column = digits(low, high)
            left = rows.filter(F.col(value).between(F.lit(low), F.lit(high)))
            counts = left.groupBy(column.alias("digits")).count()
            plans.append((counts.count(), counts._jdf.queryExecution().executedPlan().toString()))
            return column

        return kept(rows, value, place, seen)

    monkeypatch.setattr(selection, "_narrowed", noted)
    ids = F.format_string("trace-%08d", "id").alias("trace_id")
    same = spark.range(1_500_000).select(F.lit(START).alias("at"), ids)
    assert nth_newest(same, 1_000_000)["trace_id"] == "trace-00999999"
    spread = spark.range(1_500_000).select(F.timestamp_micros(F.col("id") * 977).alias("at"), ids)
    assert nth_newest(spread, 1_000_000)["age"] == 500_000 * 977
    assert plans and max(n for n, _ in plans) <= 65_536
    for _, plan in plans:
        assert not any(word in plan for word in ("Sort", "Limit", "SinglePartition", "TakeOrdered"))


@pytest.mark.parametrize("low, high", [(b"", b"a"), (b"ab", b"abc"), (b"abx", b"aby")])
def test_leading_bytes_tell_the_ends_apart(spark, low, high):
    df = spark.createDataFrame([(low,), (high,)], "key binary")
    digits = selection._leading_bytes(low, high)
    assert [bytes(r.d) for r in df.orderBy("key").select(digits.alias("d")).collect()] in (
        [b"", high[len(low):]], [b"x", b"y"]
    )
