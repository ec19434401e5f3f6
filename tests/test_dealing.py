"""Requests dealt by cost, a shared rate, and resume at the cost of what is missing."""

import re
import time

import pytest
from pyspark.sql import functions as F

from tracecurate.operators import completions
from tracecurate.operators.dealing import deal_by_cost
from tracecurate.sources.staging import materialize, new_stage_path


def examples(spark, count):
    rows = [(f"e{i:03d}", "User: " + "x" * (1 + 40 * (i % 50 == 0) * i) + str(i), "b") for i in range(count)]
    return spark.createDataFrame(rows, "example_id string, conversation_str string, target_response string")


@pytest.mark.parametrize("tasks", [1, 7])
def test_tasks_cost_the_same(spark, tasks):
    skewed = F.when(F.col("id") % 500 == 0, 4000).otherwise(F.col("id") % 20 + 1)
    rows = spark.range(60_000).select(F.sha2(F.col("id").cast("string"), 256).alias("request_key"), skewed.alias("cost"))
    rows = materialize(rows, "costs")
    dealt = deal_by_cost(rows, tasks)
    sums = [r[0] for r in dealt.groupBy("task").agg(F.sum("cost")).select("sum(cost)").collect()]
    assert len(sums) == tasks and dealt.count() == 60_000
    assert max(sums) <= 1.2 * sum(sums) / tasks
    assert deal_by_cost(rows.limit(0), tasks).count() == 0
    one = deal_by_cost(rows.filter("cost = 4000").limit(1), tasks).collect()
    assert [0 <= r.task < tasks for r in one] == [True]


def test_a_task_is_a_partition(spark):
    requests = completions.judge_requests(examples(spark, 200))
    wanted = materialize(completions.wanted_keys(requests, None), "wanted")
    dealt = completions.dealt_requests(requests, wanted, 5)
    placed = dealt.repartitionById(5, F.col("task")).select("task", F.spark_partition_id().alias("p")).distinct()
    assert sorted(map(tuple, placed.collect())) == [(i, i) for i in range(5)]
    assert dealt.select("request_key").distinct().count() == dealt.count() == 200


def test_only_what_is_missing_moves(spark):
    """With one answer missing of two hundred, one prompt is left after the sieve."""
    requests = completions.judge_requests(examples(spark, 200))
    path = new_stage_path(spark, "answers")
    most = requests.filter("example_id <> 'e007'")
    completions.complete_pending(most, path, lambda *a: "Score: 5", waves=2)
    wanted = materialize(completions.wanted_keys(requests, completions.read_responses(spark, path)), "wanted")
    assert [r._row for r in wanted.collect()] == ["e007"]
    sifted = completions.sift(completions._with_row(requests), wanted, "_row")
    assert sifted.count() == 1
    plan = completions.dealt_requests(requests, wanted, 4)
    text = plan._sc._jvm.PythonSQLUtils.explainString(plan._jdf.queryExecution(), "formatted")
    moved = re.findall(r"\bExchange\nInput \[\d+\]: \[[^\]]*\bmessages#", text)
    assert len(moved) <= 1 and "BroadcastHashJoin LeftSemi" in text
    assert completions.complete_pending(requests, path, lambda *a: "Score: 6", waves=2).count() == 200


def test_calls_of_a_task_share_its_rate(spark):
    requests = completions.judge_requests(examples(spark, 12))
    begin = time.time()
    answers = completions.complete_with(requests, lambda *a: "Score: 5", 12, 1, calls_per_second=10)
    assert answers.count() == 12
    assert time.time() - begin >= 1.0
