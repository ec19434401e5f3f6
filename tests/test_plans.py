"""What the physical plans must and must not hold."""

import re

import pytest
from pyspark.sql import functions as F

from catalog.adapter import traces
from conftest import SF_DIR
from tracecurate.config import CurationConfig
from tracecurate.operators import completions, explore, ingest, sessions, splits
from tracecurate.sources.staging import materialize


@pytest.fixture(scope="module")
def stored(spark):
    """Traces and turns as stored tables, read without broadcast joins."""
    found = materialize(traces(spark, SF_DIR), "traces")
    return found, materialize(ingest.clean_turns(found), "turns")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(plan):
    return len(re.findall(r"\bExchange (?:hash|range|single|round)", plan))


def test_clean_turns_moves_no_rows(stored):
    plan = plan_of(ingest.clean_turns(stored[0]))
    assert exchanges(plan) == 0
    assert "spans" not in plan
    # The state is tested at the scan, below the payload extraction.
    assert plan.index("upper(state") > plan.index("Generate inline")


def test_one_exchange_for_numbers_and_histories(stored):
    plan = plan_of(sessions.unroll_examples(stored[1]))
    assert exchanges(plan) == 1
    shuffled = re.search(r"Exchange.*?\n.*?Project \[(.*?)\]", plan, re.S).group(1)
    assert shuffled.count("request#") == 1  # the texts travel once


def test_session_ids_need_two_columns(stored):
    found = stored[0]
    ids = found.select(ingest.session_id(found, CurationConfig().session_key).alias("session_id"))
    schema = re.search(r"ReadSchema: struct<(.*?)>", plan_of(ids.groupBy("session_id").count())).group(1)
    assert schema == "trace_id:string,trace_metadata:string"


def test_first_trace_is_limited_before_the_shuffle(stored):
    found = stored[0].withColumn("session_id", F.col("trace_id"))
    plan = plan_of(explore.session_trace(found, 1))
    assert plan.count("WindowGroupLimit") == 2


def test_root_spans_are_filtered_inside_the_array(stored):
    plan = plan_of(explore.root_spans(stored[0]))
    assert "explode(filter" in plan and exchanges(plan) == 0


def test_splits_move_no_rows(spark):
    rows = materialize(spark.range(500).select(F.col("id").cast("string").alias("example_id")), "r")
    holdout, rest = splits.split_holdout(rows)
    for part in (holdout, rest, splits.split_validation(rest)):
        assert exchanges(plan_of(part)) == 0


def test_fan_out_is_narrow(spark):
    plan = plan_of(completions.fan_out(spark.range(3), 3))
    assert exchanges(plan) == 0 and "Join" not in plan


def test_newest_traces_are_a_top_k(stored):
    few = ingest.scan_traces(stored[0].repartition(5), 30)
    plan = plan_of(few)
    assert "TakeOrderedAndProject" not in plan and "Limit" not in plan
    assert few.rdd.getNumPartitions() > 1 and few.count() == 30


def test_a_prompt_asked_by_a_third_of_the_rows_is_split(spark):
    """AQE splits the hot key's partition on the row side of the completion join."""
    settings = {
        "spark.sql.shuffle.partitions": "32",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
        # A hot partition is split by the map tasks that wrote it, so there must be several.
        "spark.sql.files.maxPartitionBytes": "400KB",
        "spark.sql.files.openCostInBytes": "0",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        rows = materialize(
            spark.range(60_000).select(
                F.concat(F.lit("e"), "id").alias("example_id"),
                F.when(F.col("id") % 3 == 0, F.lit("hot"))
                .otherwise(F.col("id").cast("string"))
                .alias("request_key"),
                F.sha2(F.col("id").cast("string"), 512).alias("text"),
            ).repartition(16),
            "rows",
        )
        answers = materialize(
            rows.select("request_key", F.lit("a").alias("raw")).distinct(), "answers"
        )
        joined = completions.attach_completions(rows, answers)
        assert joined.count() == 60_000
        whole = joined.select("example_id", "text", "completion")
        assert len(whole.collect()) == 60_000
        assert "skew=true" in plan_of(whole)
        assert whole.filter("completion is null").count() == 0
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
