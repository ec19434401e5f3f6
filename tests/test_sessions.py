"""Turn order and histories, in one task and in blocks, and exact numbering."""

import datetime
import random

from pyspark.sql import functions as F

from tracecurate.config import CurationConfig
from tracecurate.operators import explore, sessions
from tracecurate.operators.numbering import number_rows, split_by_group_size

SCHEMA = "session_id string, trace_id string, request_time timestamp, request string, response string"


def at(second):
    return datetime.datetime(2024, 1, 1) + datetime.timedelta(seconds=second)


def make_turns(spark, sizes, seed=1):
    """Sessions of the given sizes, shuffled, with equal times in between."""
    rows = [
        (name, f"{name}-{i:04d}", at(i // 2), f"q{i}", f"a{i}")
        for name, size in sizes.items()
        for i in range(size)
    ]
    random.Random(seed).shuffle(rows)
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


def brute_force(turns):
    """The examples, built in plain Python."""
    by_session = {}
    for r in turns.collect():
        by_session.setdefault(r.session_id, []).append(r)
    expected = set()
    for name, rows in by_session.items():
        rows.sort(key=lambda r: (r.request_time, r.trace_id))
        for i, row in enumerate(rows):
            lines = []
            for earlier in rows[:i]:
                lines += [f"User: {earlier.request}", f"Assistant: {earlier.response}"]
            lines.append(f"User: {row.request}")
            expected.add((row.trace_id, name, i + 1, "\n".join(lines), row.response))
    return expected


def as_set(examples):
    return {
        (r.example_id, r.session_id, r.turn_no, r.conversation_str, r.target_response)
        for r in examples.collect()
    }


def test_histories_in_one_task(spark):
    turns = make_turns(spark, {"a": 1, "b": 2, "c": 9})
    assert as_set(sessions.unroll_examples(turns)) == brute_force(turns)


def test_histories_in_blocks(spark):
    turns = make_turns(spark, {"hot": 53, "warm": 12, "b": 3, "c": 1})
    config = CurationConfig(long_history_turns=5, history_block_turns=4)
    examples = sessions.unroll_examples(turns, config)
    assert as_set(examples) == brute_force(turns)
    sizes = {r.turn_no: r.n for r in examples.filter("session_id = 'hot'").select(
        "turn_no", F.size("messages").alias("n")).collect()}
    assert sizes == {i: 2 * i - 1 for i in range(1, 54)}


def test_histories_in_blocks_without_broadcast(spark):
    turns = make_turns(spark, {"hot": 23, "warm": 12, "b": 3})
    config = CurationConfig(long_history_turns=5, history_block_turns=5, broadcast_rows=0)
    assert as_set(sessions.unroll_examples(turns, config)) == brute_force(turns)


def test_sizes_may_come_from_a_larger_table(spark):
    turns = make_turns(spark, {"a": 4, "b": 2})
    wider = turns.select("session_id").unionByName(turns.select("session_id"))
    config = CurationConfig(long_history_turns=5)
    assert as_set(sessions.unroll_examples(turns, config, wider)) == brute_force(turns)


def test_turn_numbers_of_hot_sessions(spark):
    turns = make_turns(spark, {"hot": 200, "b": 7, "c": 1})
    plain = sessions.sessionize(turns)
    split = sessions.sessionize(turns, CurationConfig(hot_session_turns=20))
    numbers = lambda df: {(r.trace_id, r.turn_no) for r in df.collect()}
    assert numbers(plain) == numbers(split)
    assert ("hot-0199", 200) in numbers(split)


def test_same_result_for_any_partitioning(spark):
    turns = make_turns(spark, {"a": 6, "b": 9})
    assert as_set(sessions.unroll_examples(turns.repartition(1))) == as_set(
        sessions.unroll_examples(turns.repartition(13, "response"))
    )


def test_number_rows_is_exact(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1009).alias("k")).repartition(7)
    got = number_rows(df, "k", name="n", total="all").orderBy("k").collect()
    assert [r.n for r in got] == list(range(1, 1001))
    assert {r["all"] for r in got} == {1000}


def test_number_rows_of_nothing(spark):
    assert number_rows(spark.range(0), "id").count() == 0


def test_groups_within_the_limit_need_no_second_path(spark):
    df = spark.range(10).withColumn("g", F.col("id") % 2)
    usual, large = split_by_group_size(df, "g", 5, 10)
    assert large is None and usual is df
    usual, large = split_by_group_size(df.filter("id <> 0"), "g", 4, 10)
    assert (usual.count(), large.count()) == (4, 5)


def test_session_search_and_positions(spark):
    turns = make_turns(spark, {"a": 5, "b": 2})
    found = {r.session_id: r for r in explore.session_search(turns).collect()}
    assert (found["a"].traces, found["a"].first_time, found["a"].last_time) == (5, at(0), at(2))
    second = explore.session_trace(turns, 2).collect()
    assert {r.trace_id for r in second} == {"a-0001", "b-0001"}
    assert [r.trace_id for r in explore.session_trace(turns, 4).collect()] == ["a-0003"]
    assert explore.nth_trace(turns, 3).first().trace_id == "a-0003"
    assert explore.nth_trace(turns, 99).count() == 0
