"""Examples rendered from stored turns, and what a run keeps and renders."""

import os
import re

import pytest
from pyspark.sql import functions as F

from test_sessions import as_set, brute_force, make_turns
from tracecurate.config import CurationConfig
from tracecurate.operators import completions, sessions
from tracecurate.operators.histories import chain_turns, render_examples
from tracecurate.sources.staging import materialize, new_stage_path

CONFIG = CurationConfig(history_block_turns=4)


@pytest.fixture(scope="module")
def stored(spark):
    turns = make_turns(spark, {"hot": 53, "warm": 12, "even": 8, "b": 3, "c": 1})
    return turns, materialize(chain_turns(turns), "chain")


def size_of(path):
    return sum(os.path.getsize(os.path.join(path, f)) for f in os.listdir(path) if f.endswith(".parquet"))


@pytest.mark.parametrize("size", [1, 4, 200])
def test_all_examples(stored, size):
    turns, chain = stored
    rendered = render_examples(chain, None, CurationConfig(history_block_turns=size))
    assert as_set(rendered) == brute_force(turns)
    plain = {r.example_id: r.messages for r in sessions.unroll_examples(turns).collect()}
    assert {r.example_id: r.messages for r in rendered.collect()} == plain


def test_wanted_examples_keep_their_columns_and_copies(spark, stored):
    turns, chain = stored
    places = [("hot", 1, 7), ("hot", 17, 8), ("hot", 53, 9), ("hot", 53, 9), ("even", 8, 1), ("c", 1, 2)]
    none = [("hot", 54, 0), ("hot", 57, 0), ("gone", 1, 0)]
    wanted = spark.createDataFrame(places + none, "session_id string, turn_no int, score int")
    rendered = render_examples(chain, wanted, CONFIG)
    assert rendered.columns == ["session_id", "turn_no", "score", "messages", "target_response", "conversation_str"]
    texts = {(s, n): (text, answer) for _, s, n, text, answer in brute_force(turns)}
    expected = sorted((s, n, score, *texts[s, n]) for s, n, score in places)
    got = [(r.session_id, r.turn_no, r.score, r.conversation_str, r.target_response) for r in rendered.collect()]
    assert sorted(got) == expected


def test_nothing_wanted_and_no_turns(spark, stored):
    none = stored[1].filter("turn_no < 0")
    assert render_examples(stored[1], none.select("session_id", "turn_no"), CONFIG).count() == 0
    assert render_examples(none, None, CONFIG).count() == 0


def test_null_texts_end_nothing(spark):
    chain = spark.createDataFrame(
        [("a", "s", 1, "q", None), ("b", "s", 2, None, "r")],
        "example_id string, session_id string, turn_no int, request string, response string",
    )
    rows = render_examples(chain, None, CONFIG).orderBy("turn_no").collect()
    assert [(r.example_id, r.target_response, len(r.messages)) for r in rows] == [("a", None, 1), ("b", "r", 3)]


def test_stored_bytes_are_linear_in_a_long_session(spark):
    """Ten times the turns take about ten times the room; histories would take a hundred."""

    def stored_size(turns):
        rows = spark.range(turns).select(
            F.lit("hot").alias("session_id"),
            F.format_string("t%06d", "id").alias("trace_id"),
            F.timestamp_seconds("id").alias("request_time"),
            F.sha2(F.col("id").cast("string"), 256).alias("request"),
            F.sha2((F.col("id") + turns).cast("string"), 512).alias("response"),
        )
        path = new_stage_path(spark, "long")
        chain = materialize(chain_turns(rows), "chain", path)
        return chain, size_of(path)

    small, large = stored_size(2_000)[1], stored_size(20_000)
    assert 8 < large[1] / small < 12
    wanted = spark.createDataFrame([("hot", 20_000), ("hot", 4_321)], "session_id string, turn_no int")
    rendered = render_examples(large[0], wanted).select("turn_no", F.size("messages").alias("n"), F.length("conversation_str").alias("size"))
    assert {r.turn_no: r.n for r in rendered.collect()} == {20_000: 39_999, 4_321: 8_641}


def test_unwanted_turns_stay_where_they_are(spark, stored):
    """Below the exchange by session and block the turns are sifted."""
    wanted = materialize(spark.createDataFrame([("b", 3)], "session_id string, turn_no int"), "wanted")
    plan = render_examples(stored[1], wanted, CONFIG)._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("REPARTITION_BY_NUM"):]
    assert "BroadcastHashJoin" in below and "LeftSemi" in below
    assert not re.search("Window|CartesianProduct|BroadcastNestedLoopJoin", plan)


def test_a_resume_renders_only_what_is_missing(spark, stored):
    """Of equal prompts one is asked; a call that failed is rendered again, alone."""
    chain = stored[1]
    keyed = completions.with_judge_key(render_examples(chain, None, CONFIG))
    columns = ["example_id", "session_id", "turn_no", "request_key"]
    copy = F.concat(F.lit("copy-"), "example_id").alias("example_id")
    keys = keyed.select(columns)
    keys = materialize(keys.unionByName(keys.select(copy, *columns[1:])), "keys")
    path, rendered = new_stage_path(spark, "responses"), []

    def requests_of(wanted):
        rendered.append([r.example_id for r in wanted.collect()])
        return completions.keyed_judge_requests(render_examples(chain, wanted, CONFIG))

    def fails(messages, temperature, max_tokens):
        if "q52" in messages[1]["content"]:
            raise OSError("later")
        return "Score: 9"

    with pytest.raises(RuntimeError, match="1 requests have no answer"):
        completions.complete_wanted(keys, requests_of, path, fails, waves=3, tasks=2)
    distinct = keys.select("request_key").distinct().count()
    assert len(rendered) == 3 and sum(map(len, rendered)) == distinct < keys.count()
    least = {r[0] for r in keys.groupBy("request_key").agg(F.min("example_id").alias("i")).select("i").collect()}
    assert {i for part in rendered for i in part} == least
    rendered.clear()
    answers = completions.complete_wanted(keys, requests_of, path, lambda *a: "Score: 9", waves=3, tasks=2)
    assert rendered == [["copy-hot-0052"]]
    assert answers.select("request_key").distinct().count() == answers.count() == distinct
    rendered.clear()
    completions.complete_wanted(keys, requests_of, path, lambda *a: 1 / 0, waves=3, tasks=2)
    assert rendered == []
