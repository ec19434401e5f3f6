"""Requests, answers, resume, and what is asked of the model."""

import os
import re

import pytest
from pyspark.sql import functions as F

from tracecurate.config import CurationConfig
from tracecurate.operators import assembly, completions, compare, scoring, seeding, synthesis
from tracecurate.sources.staging import new_stage_path


def examples(spark, *pairs):
    rows = [(f"e{i}", "s", c, t) for i, (c, t) in enumerate(pairs)]
    return spark.createDataFrame(
        rows, "example_id string, session_id string, conversation_str string, target_response string"
    )


def asked(path):
    """Calls noted by ``noting``, one file per call."""
    return len(os.listdir(path)) if os.path.isdir(path) else 0


def noting(path):
    def complete(messages, temperature, max_tokens):
        import os
        import uuid

        os.makedirs(path, exist_ok=True)
        open(os.path.join(path, uuid.uuid4().hex), "w").close()
        text = f"Score: {len(messages[1]['content']) % 10}\nReason: {temperature}/{max_tokens}"
        return text if len(text) % 2 else [{"content": ""}, {"content": text}]

    return complete


def test_same_prompt_has_one_key(spark):
    keys = [r.request_key for r in completions.judge_requests(
        examples(spark, ("User: a", "b"), ("User: a", "b"), ("User: a", "c"))).collect()]
    assert keys[0] == keys[1] != keys[2]


def test_key_tells_message_borders(spark):
    df = spark.createDataFrame(
        [([("user", "ab"), ("user", "c")],), ([("user", "a"), ("user", "bc")],), ([("user", "abuser:1:c")],)],
        "m array<struct<role:string,content:string>>",
    )
    keys = df.select(completions.request_key("s", F.col("m"), 0.0, 1).alias("k")).collect()
    assert len({r.k for r in keys}) == 3


def test_key_depends_on_settings_and_copy(spark):
    df = spark.createDataFrame([([("user", "a")],)], "m array<struct<role:string,content:string>>")
    key = lambda *settings: completions.request_key(settings[0], F.col("m"), *settings[1:])
    first = key("s", 0.0, 1)
    row = df.select(
        first.alias("a"),
        key("t", 0.0, 1).alias("b"),
        key("s", 0.8, 1).alias("c"),
        key("s", 0.0, 2).alias("d"),
        completions.copy_key(first, F.lit(0)).alias("e"),
        completions.copy_key(first, F.lit(1)).alias("f"),
    ).first()
    assert len(set(row)) == 6


def test_generation_copies_have_their_own_keys(spark):
    seeds = examples(spark, ("User: a", "b"), ("User: a", "b"))
    requests = completions.generate_requests(seeds, CurationConfig(copies=3))
    keys = {r.request_key for r in requests.collect()}
    assert len(keys) == 6


@pytest.mark.parametrize("n", [0, 1, 3])
def test_fan_out(spark, n):
    got = completions.fan_out(examples(spark, ("a", "b"), ("c", "d")), n).collect()
    assert sorted((r.example_id, r.generation_idx) for r in got) == [
        (e, i) for e in ("e0", "e1") for i in range(n)
    ]


def test_fan_out_rejects_negative(spark):
    with pytest.raises(ValueError):
        completions.fan_out(examples(spark, ("a", "b")), -1)


@pytest.mark.parametrize("waves", [1, 3])
def test_resume_asks_nothing_twice(spark, tmp_path, waves):
    calls, path = str(tmp_path / "calls"), new_stage_path(spark, "answers")
    few = completions.judge_requests(examples(spark, ("User: a", "b"), ("User: a", "b"), ("User: c", "d")))
    answers = completions.complete_pending(few, path, noting(calls), 2, waves)
    assert (answers.count(), asked(calls)) == (2, 2)
    again = completions.complete_pending(few, path, noting(calls), 2, waves)
    assert (again.count(), asked(calls)) == (2, 2)
    more = completions.judge_requests(examples(spark, ("User: a", "b"), ("User: new", "d")))
    assert completions.complete_pending(more, path, noting(calls), 2, waves).count() == 3
    assert asked(calls) == 3


def test_a_late_failure_costs_no_answer(spark, tmp_path):
    """One of twenty calls fails: nineteen answers are kept, and only one is asked again."""
    calls, path = str(tmp_path / "calls"), new_stage_path(spark, "answers")
    note = noting(calls)

    def failing(messages, temperature, max_tokens):
        if "q19" in messages[1]["content"]:
            raise RuntimeError("over capacity")
        return note(messages, temperature, max_tokens)

    requests = completions.judge_requests(examples(spark, *[(f"User: q{i:02d}", "b") for i in range(20)]))
    with pytest.raises(RuntimeError, match="1 requests have no answer.*over capacity"):
        completions.complete_pending(requests, path, failing, 3, 2, tasks=4, attempts=2)
    assert completions.read_responses(spark, path).count() == asked(calls) == 19
    assert [r.error for r in completions.read_failures(spark, path).collect()] == ["RuntimeError: over capacity"]
    assert completions.complete_pending(requests, path, note, 3, 2, tasks=4).count() == asked(calls) == 20
    assert completions.read_failures(spark, path).count() == 0


def test_calls_of_a_task_are_in_flight_together(spark):
    import time

    def slow(messages, temperature, max_tokens):
        time.sleep(0.5)
        return "Score: 5"

    requests = completions.judge_requests(examples(spark, *[(f"User: {i}", "b") for i in range(16)]))
    begin = time.time()
    assert completions.complete_with(requests, slow, 16, 1).count() == 16
    assert time.time() - begin < 6


def test_prompts_move_once(spark, tmp_path):
    """Finding what to ask shuffles keys only; prompts go straight to the tasks that call."""
    requests = completions.judge_requests(examples(spark, *[(f"User: {i % 3}", "b") for i in range(9)]))
    path = new_stage_path(spark, "answers")
    answers = completions.complete_pending(requests.filter("example_id = 'e0'"), path, noting(str(tmp_path / "c")))
    left = completions.pending_requests(requests, answers, tasks=5)
    carried = completions.complete_with(left, noting(str(tmp_path / "d")), tasks=None)
    shuffled = re.findall(
        r"\bExchange\nInput \[\d+\]: \[[^\]]*\bmessages#",
        carried._sc._jvm.PythonSQLUtils.explainString(carried._jdf.queryExecution(), "formatted"),
    )
    assert len(shuffled) == 1
    assert left.rdd.getNumPartitions() == 5
    assert left.count() == 2


def test_requests_without_id_or_key(spark):
    requests = completions.judge_requests(examples(spark, ("User: a", "b"), ("User: a", "b"), (None, "b"), ("User: c", "d")))
    nameless = requests.withColumn("example_id", F.lit(None).cast("string"))
    assert completions.dedupe_requests(nameless.unionByName(nameless)).count() == 3
    assert completions.pending_requests(requests.drop("example_id"), None, True, 2).count() == 4
    keyless = requests.withColumn("request_key", F.nullif("request_key", F.lit(requests.first().request_key)))
    assert completions.dedupe_requests(keyless).count() == 2
    assert completions.pending_requests(keyless, None, True, 2).count() == 2
    assert completions.dedupe_requests(requests.filter("false")).count() == 0


def test_scores_from_the_model(spark, tmp_path):
    df = examples(spark, ("User: a", "b"), ("User: a", "bb"))
    path = new_stage_path(spark, "answers")
    answers = completions.complete_pending(
        completions.judge_requests(df), path, noting(str(tmp_path / "c")), 2
    )
    scored = scoring.score_examples(df, answers).orderBy("example_id").collect()
    assert [r.judge_reason for r in scored] == ["0.0/1024", "0.0/1024"]
    assert abs(scored[0].quality_score - scored[1].quality_score) in (1, 9)
    assert "request_key" not in scoring.score_examples(df, answers).columns


def test_unanswered_rows_stay_with_null_score(spark):
    df = examples(spark, ("User: a", "b"))
    none = spark.createDataFrame([], "request_key string, raw string")
    scored = scoring.score_examples(df, none)
    report = scoring.scores_report(scored).first()
    assert (report.quality_score, report.judge_reason, report.included) == (None, "", False)
    assert scoring.keep_good(scored).count() == 0


def test_included_is_what_is_kept(spark):
    df = examples(spark, *[("User: a", "x" * i) for i in range(12)])
    scored = df.withColumns(
        {
            "quality_score": F.when(F.length("target_response") > 0, F.length("target_response")).cast("bigint"),
            "judge_reason": F.lit(""),
        }
    )
    included = scoring.scores_report(scored).filter("included")
    assert included.count() == scoring.keep_good(scored).count() == 5


def synthetic(spark, *pairs):
    return spark.createDataFrame(
        [(f"e{i}", q, a) for i, (q, a) in enumerate(pairs)],
        "example_id string, generated_request string, generated_response string",
    )


LONG_Q, LONG_A = "please describe the whole setup", "follow these five simple steps"


def test_synthetic_rows_and_skips(spark):
    df = synthetic(
        spark,
        (f" USER: {LONG_Q}", f"{LONG_A} "),
        ("", LONG_A),
        (None, LONG_A),
        ("user:", LONG_A),
        (LONG_Q, None),
        ("short", LONG_A),
        (LONG_Q, f"[{LONG_A}]"),
    )
    kept = assembly.training_synthetic(df).collect()
    assert [(r.source, r.input, r.output) for r in kept] == [("synthetic", f"User: {LONG_Q}", LONG_A)]
    reasons = {r.example_id: r.reason for r in assembly.synthetic_skipped(df).collect()}
    assert reasons == {
        "e1": "empty request",
        "e2": "empty request",
        "e3": "empty request",
        "e4": "empty response",
        "e5": "placeholder request",
        "e6": "placeholder response",
    }


def test_curated_request_is_not_tested(spark):
    df = examples(spark, ("User: x", f" {LONG_A} "), ("User: " + LONG_Q, "short"))
    rows = assembly.training_curated(df).collect()
    assert [(r.input, r.output) for r in rows] == [("User: x", LONG_A)]


def test_judge_input_replaces_the_first_judgement(spark):
    df = examples(spark, ("User: old", "old"), ("User: old", "old")).withColumns(
        {
            "generation_idx": F.lit(1),
            "quality_score": F.lit(9),
            "judge_content": F.lit("x"),
            "judge_reason": F.lit("y"),
            "generated_request": F.when(F.col("example_id") == "e0", "new q"),
            "generated_response": F.lit("new a"),
        }
    )
    rows = synthesis.synthetic_judge_input(df).collect()
    assert [(r.example_id, r.conversation_str, r.target_response) for r in rows] == [
        ("e0#1", "User: new q", "new a")
    ]
    assert not {"quality_score", "judge_content", "judge_reason"} & set(rows[0].asDict())


def test_eval_rows_match_by_id(spark):
    holdout = spark.createDataFrame(
        [("a", "curated", "User: q1\nAssistant: x\nUser: q2", "out"), ("b", "synthetic", "nothing", "o")],
        "example_id string, source string, input string, output string",
    )
    base = spark.createDataFrame([("b", " bb "), ("a", "ba")], "example_id string, response string")
    tuned = spark.createDataFrame([("a", "ta\n")], "example_id string, response string")
    got = {r.example_id: r for r in compare.eval_results(holdout, base, tuned).collect()}
    assert tuple(got["a"])[1:] == ("curated", "q2", "out", "ba", "ta")
    assert tuple(got["b"])[1:] == ("synthetic", "", "o", "bb", None)
    listed = compare.eval_preview(compare.eval_results(holdout, base, tuned), 2).orderBy("position")
    assert [(r.position, r.total, r.reference) for r in listed.collect()] == [(1, 2, "ou"), (2, 2, "o")]


def test_run_names_keep_long_numbers(spark):
    got = spark.createDataFrame([(1,), (42,), (1000,), (12345,)], "i int").select(
        seeding.run_name(F.col("i")).alias("n")
    )
    assert [r.n for r in got.collect()] == ["trace-001", "trace-042", "trace-1000", "trace-12345"]


def test_seeding_reports_failed_prompts(spark):
    prompts = spark.createDataFrame([(1, "a"), (2, "b")], "prompt_index int, prompt string")
    keyed = seeding.with_prompt_key(prompts, "Be kind.").filter("prompt_index = 1")
    answers = keyed.select("request_key", F.lit("fine").alias("raw"))
    got = seeding.seed_traces(prompts, answers, "run", "Be kind.").orderBy("run_name").collect()
    assert [(r.state, r.tags["prompt_index"]) for r in got] == [("OK", "1"), ("ERROR", "2")]
