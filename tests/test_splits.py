"""Exact sizes, disjoint parts, and agreement with a full sort."""

import hashlib

import pytest
from pyspark.sql import functions as F

from tracecurate.config import CurationConfig
from tracecurate.operators import report, splits


def rows(spark, n):
    return spark.range(n).select(F.concat(F.lit("e"), "id").alias("example_id"))


def ids(df):
    return {r.example_id for r in df.collect()}


@pytest.mark.parametrize("n,size", [(0, 0), (4, 0), (5, 0), (6, 1), (15, 2), (25, 2), (35, 4)])
def test_holdout_size(spark, n, size):
    holdout, rest = splits.split_holdout(rows(spark, n))
    assert (holdout.count(), rest.count()) == (size, n - size)


def expected_draw(keys, size, seed):
    place = lambda k: (hashlib.md5(f"{k}:{seed}".encode()).hexdigest(), k)
    return set(sorted(keys, key=place)[:size])


@pytest.mark.parametrize("size", [1, 2, 499, 999, 1000])
def test_draw_is_the_smallest_places(spark, size):
    df = rows(spark, 1000)
    chosen = ids(df.filter(splits.draw(df, size, seed=7)))
    assert chosen == expected_draw(ids(df), size, 7)


def test_prefixes_are_followed_to_the_end(spark, monkeypatch):
    """Other steps, same rows."""
    monkeypatch.setattr(splits, "_DIGITS_PER_STEP", 8)
    df = rows(spark, 200)
    assert ids(df.filter(splits.draw(df, 77))) == expected_draw(ids(df), 77, 42)


def test_groups_are_not_divided(spark):
    df = spark.range(90).select(
        F.concat(F.lit("e"), "id").alias("example_id"),
        F.when(F.col("id") % 10 != 9, F.concat(F.lit("s"), F.col("id") % 25)).alias("session_id"),
    )
    found = splits.split_groups(df, "session_id").collect()
    drawn = expected_draw({f"s{i % 25}" for i in range(90) if i % 10 != 9}, 2, 42)
    assert {r.session_id for r in found if r.split == "holdout"} == drawn
    assert all((r.split == "holdout") == (r.session_id in drawn) for r in found)


def test_parts_are_disjoint_and_whole(spark):
    df = rows(spark, 155)
    holdout, rest = splits.split_holdout(df)
    assigned = splits.split_validation(rest)
    train = ids(assigned.filter("split = 'train'"))
    validation = ids(assigned.filter("split = 'validation'"))
    parts = [ids(holdout), train, validation]
    assert [len(p) for p in parts] == [16, 125, 14]
    assert set.union(*parts) == ids(df)
    assert sum(map(len, parts)) == 155


def test_partitioning_does_not_matter(spark):
    df = rows(spark, 100)
    other = df.repartition(9)
    assert ids(splits.split_holdout(df)[0]) == ids(splits.split_holdout(other)[0])


def test_seeds_differ(spark):
    df = rows(spark, 100)
    first = ids(splits.split_holdout(df, CurationConfig(seed=1))[0])
    assert first != ids(splits.split_holdout(df, CurationConfig(seed=2))[0])


@pytest.mark.parametrize("n,plan", [(0, (0, 0, 1)), (7, (7, 0, 1)), (80, (80, 10, 3)), (1234, (1234, 154, 46))])
def test_training_plan(spark, n, plan):
    assert tuple(report.training_plan(spark.range(n)).first()) == plan


def test_counts(spark):
    df = spark.createDataFrame([("a",), ("b",), ("b",)], "source string")
    assert [tuple(r) for r in report.source_counts(df).collect()] == [("b", 2), ("a", 1)]
