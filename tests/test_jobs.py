"""The whole run on the given conversations, with a stand-in for the model."""

import math
import os

import pytest
from pyspark.sql import functions as F

from catalog.adapter import traces
from conftest import SF_DIR
from tracecurate.config import CurationConfig
from tracecurate.operators import ingest, report
from tracecurate.plans import jobs
from tracecurate.schema import EVAL_RESULTS, TRAINING
from tracecurate.sources import tables
from tracecurate.sources.staging import new_stage_path

CONFIG = CurationConfig(copies=2, concurrency=2, call_tasks=2, call_waves=1, attempts=1)


def model(notes):
    """Scores by prompt length; writes a pair in tags. Notes each call as a file."""

    def complete(messages, temperature, max_tokens):
        import os
        import uuid

        os.makedirs(notes, exist_ok=True)
        open(os.path.join(notes, uuid.uuid4().hex), "w").close()
        size = len(messages[1]["content"])
        if temperature > 0:
            if size % 7 == 0:
                return "nothing in tags"
            request = "short" if size % 5 == 0 else f"how do I set up machine number {size}"
            return (
                f"<user_request>{request}</user_request>"
                f"<assistant_response>open the panel of machine {size}</assistant_response>"
            )
        text = f"Score: {size % 11}\nReason: size {size}"
        return text if size % 2 else [{"content": ""}, {"content": text}]

    return complete


def calls(notes):
    return len(os.listdir(notes)) if os.path.isdir(notes) else 0


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    notes = str(tmp_path_factory.mktemp("calls") / "c")
    out = new_stage_path(spark, "run")
    counts = jobs.run_curation(traces(spark, SF_DIR), model(notes), out, CONFIG)
    return out, counts, notes, calls(notes)


def test_counts_agree_with_the_tables(spark, run):
    out, counts, _, asked = run
    rows = lambda name: spark.read.parquet(f"{out}/{name}").count()
    assert counts["sessions"] == 19
    assert counts["examples"] == rows("scores_report") == 29
    assert counts["kept"] == rows("curated_traces") > 0
    assert counts["generated"] == 2 * counts["kept"] == rows("generated")
    assert counts["synthetic_judged"] == rows("synthetic_scored")
    assert counts["synthetic_unparsed"] == counts["generated"] - counts["synthetic_judged"]
    assert counts["training_rows"] == rows("training_data")
    assert counts["synthetic_skipped"] == rows("synthetic_skipped")
    # Equal prompts at temperature 0 are asked once.
    assert asked <= counts["examples"] + counts["generated"] + counts["synthetic_judged"]


def test_only_outputs_hold_histories(spark, run):
    columns = lambda name: spark.read.parquet(f"{run[0]}/{name}").columns
    assert columns("chain") == ["example_id", "session_id", "turn_no", "request", "response"]
    for name in ("judge_keys", "scored"):
        assert not {"messages", "conversation_str", "target_response"} & set(columns(name))


def test_a_second_run_asks_nothing(spark, run):
    out, counts, notes, asked = run
    again = jobs.run_curation(traces(spark, SF_DIR), model(notes), out, CONFIG, csv=False)
    assert again == counts
    assert calls(notes) == asked


def test_exports_hold_the_same_rows(spark, run):
    out = run[0]
    training = spark.read.parquet(f"{out}/training_data").drop("example_id")
    exported = tables.read_csv(spark, f"{out}/training_data_csv", TRAINING)
    assert sorted(map(tuple, exported.collect())) == sorted(map(tuple, training.collect()))
    included = spark.read.parquet(f"{out}/scores_report").filter("included").count()
    assert included == spark.read.parquet(f"{out}/curated_traces").count()


def test_prepared_parts_cover_the_training_data(spark, run):
    training = spark.read.parquet(f"{run[0]}/training_data")
    prepared = jobs.prepare(training, CONFIG)
    ids = lambda df: {r.example_id for r in df.collect()}
    parts = [ids(prepared.holdout), ids(prepared.train), ids(prepared.validation)]
    assert sum(map(len, parts)) == training.count() and set.union(*parts) == ids(training)
    text = prepared.train.first().text
    assert text.startswith("<|im_start|>system\n") and text.endswith("<|im_end|>\n")


def test_tokens_are_cut_on_the_right(spark):
    df = spark.createDataFrame([("a b　c  d ",), ("",)], "text string")
    config = CurationConfig(max_sequence_tokens=3)
    budget = report.length_budget(df, "text", config).drop("text").collect()
    assert [tuple(r) for r in budget] == [(4, 3, True), (0, 0, False)]
    cut = report.truncate_tokens(df, "text", config)
    assert cut.columns == ["tokens"]
    assert [r.tokens for r in cut.collect()] == [["a", "b", "c"], []]


def test_a_tokenizer_of_the_caller(spark):
    import pandas as pd

    @F.pandas_udf("array<int>")
    def characters(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: [ord(c) for c in t])

    df = spark.createDataFrame([("abcd",)], "text string")
    cut = report.truncate_tokens(df, "text", CurationConfig(max_sequence_tokens=2), characters)
    assert cut.first().tokens == [97, 98]


def test_nothing_good_gives_empty_tables_with_columns(spark):
    out = new_stage_path(spark, "run")
    bad = lambda messages, temperature, max_tokens: "Score: 1"
    counts = jobs.run_curation(traces(spark, SF_DIR), bad, out, CONFIG)
    assert counts["examples"] == 29 and counts["kept"] == counts["training_rows"] == 0
    assert spark.read.parquet(f"{out}/training_data").columns == [
        "example_id", "source", "input", "output"
    ]


def test_no_traces_at_all(spark):
    out = new_stage_path(spark, "run")
    none = traces(spark, SF_DIR).filter("state = 'none of these'")
    never = lambda messages, temperature, max_tokens: 1 / 0
    counts = jobs.run_curation(none, never, out, CONFIG)
    assert set(counts.values()) == {0}


def test_a_seeded_store_runs_through(spark, tmp_path):
    """Seeding, curation, preparation and evaluation from the CSV export of the holdout."""
    prompts = spark.createDataFrame(
        [(i, f"how do I set up printer number {i} on floor {i % 3}") for i in range(1, 31)],
        "prompt_index int, prompt string",
    )
    answer = lambda messages, temperature, max_tokens: "first " + messages[1]["content"]
    seeded = jobs.run_seeding(prompts, answer, new_stage_path(spark, "seed"), "Be kind.", "r", CONFIG)
    out = new_stage_path(spark, "run")
    counts = jobs.run_curation(seeded.unionByName(seeded), model(str(tmp_path / "c")), out, CONFIG)
    assert (counts["traces"], counts["repeated_traces"], counts["examples"]) == (60, 30, 30)
    prep = new_stage_path(spark, "prep")
    plan = jobs.run_preparation(spark.read.parquet(f"{out}/training_data"), prep, CONFIG)
    assert plan["over_budget"] == 0 and "n_tokens" in spark.read.parquet(f"{prep}/train").columns
    holdout = tables.read_csv(spark, f"{prep}/holdout_csv", TRAINING)
    last = lambda messages, temperature, max_tokens: messages[-1]["content"]
    results = jobs.run_evaluation(holdout, last, last, new_stage_path(spark, "eval"), CONFIG)
    assert results.count() == holdout.count() > 0


def test_rows_that_share_an_id_are_refused(spark):
    rows = spark.createDataFrame([("a", "s", "User: q", "o")] * 2, "example_id string, source string, input string, output string")
    with pytest.raises(ValueError, match="distinct values of example_id"):
        jobs.run_preparation(rows, new_stage_path(spark, "prep"), CONFIG)
    with pytest.raises(ValueError, match="distinct values of example_id"):
        jobs.run_evaluation(rows, None, None, new_stage_path(spark, "eval"), CONFIG)


def test_preparation_without_leaks(spark, run):
    """With the links of the run no session and no seed is on two sides."""
    out = run[0]
    prep, training = new_stage_path(spark, "prep"), spark.read.parquet(f"{out}/training_data")
    links = spark.read.parquet(f"{out}/training_links")
    assert training.join(links, "example_id").count() == training.count() > 0
    jobs.run_preparation(training, prep, CONFIG, csv=False, links=links)
    sides = [spark.read.parquet(f"{prep}/{name}").select("example_id") for name in ("holdout", "train", "validation")]
    assert sum(s.count() for s in sides) == training.count()
    for column in ("session_id", "seed_id"):
        own = [{r[0] for r in s.join(links, "example_id").select(column).collect()} for s in sides]
        assert not own[0] & own[1] and not own[0] & own[2] and not own[1] & own[2]


def test_unreadable_traces_are_stored_and_counted(spark):
    rows = traces(spark, SF_DIR)
    broken = rows.withColumn("trace_metadata", F.when(F.col("timestamp_ms") % 2 == 0, "junk").otherwise("{}"))
    out = new_stage_path(spark, "run")
    counts = jobs.run_curation(broken, lambda *a: "Score: 1", out, CONFIG, csv=False)
    kept = spark.read.parquet(f"{out}/quarantine")
    assert counts["traces"] == 48 and counts["quarantined"] == kept.count() > 0
    assert counts["quarantined"] + counts["examples"] == 29


def test_the_newest_traces_only(spark):
    few = jobs.build_examples(traces(spark, SF_DIR), CurationConfig(max_traces=10))
    newest = {
        r.trace_id
        for r in traces(spark, SF_DIR).orderBy(F.desc("request_time"), "trace_id").limit(10).collect()
    }
    found = {r.example_id for r in few.collect()}
    assert found and found <= newest


def test_preparation_of_an_export_without_ids(spark, run):
    out = new_stage_path(spark, "prep")
    exported = tables.read_csv(spark, f"{run[0]}/training_data_csv", TRAINING)
    # Copies are rows of their own: nothing is lost to equal content.
    doubled = exported.unionByName(exported)
    plan = jobs.run_preparation(doubled, out, CONFIG)
    n = doubled.count()
    held = round(0.1 * n)
    validation = math.ceil(0.1 * (n - held))
    assert spark.read.parquet(f"{out}/holdout").count() == held
    assert tables.read_csv(spark, f"{out}/holdout_csv", TRAINING).count() == held
    assert spark.read.parquet(f"{out}/validation").count() == validation
    assert plan["train_rows"] == n - held - validation
    ids = spark.read.parquet(f"{out}/training").select("example_id")
    assert ids.distinct().count() == n
    again = new_stage_path(spark, "prep")
    jobs.run_preparation(doubled.repartition(7), again, CONFIG, csv=False)
    rows = lambda path: sorted(
        (r.input, r.output) for r in spark.read.parquet(f"{path}/holdout").collect()
    )
    assert rows(out) == rows(again)


def test_evaluation_asks_both_models(spark):
    out = new_stage_path(spark, "eval")
    holdout = spark.createDataFrame(
        [("a", "curated", "User: q1\nAssistant: x\nUser: q2", "out"), ("b", "synthetic", "User: z", "o")],
        "example_id string, source string, input string, output string",
    )
    base = lambda messages, temperature, max_tokens: f" {len(messages)} {temperature} {max_tokens}\n"
    tuned = lambda messages, temperature, max_tokens: [{"content": messages[-1]["content"]}]
    results = jobs.run_evaluation(holdout, base, tuned, out, CONFIG)
    got = {r.example_id: (r.user_input, r.base_response, r.finetuned_response) for r in results.collect()}
    assert got == {"a": ("q2", "3 0.0 512", "q2"), "b": ("z", "1 0.0 512", "z")}
    exported = tables.read_csv(spark, f"{out}/eval_results_csv", EVAL_RESULTS)
    assert exported.count() == 2 and exported.columns == EVAL_RESULTS.names


def test_seeded_traces_can_be_curated(spark):
    out = new_stage_path(spark, "seed")
    prompts = spark.createDataFrame(
        [(1, "how do I print"), (2, "fail please"), (3, "how do I scan")], "prompt_index int, prompt string"
    )

    def complete(messages, temperature, max_tokens):
        if "fail" in messages[1]["content"]:
            raise RuntimeError("no answer")
        return "like this: " + messages[1]["content"]

    seeded = jobs.run_seeding(prompts, complete, out, "Be kind.", "run-7", CONFIG)
    assert sorted((r.run_name, r.state) for r in seeded.collect()) == [
        ("trace-001", "OK"), ("trace-002", "ERROR"), ("trace-003", "OK")
    ]
    reasons = {r.run_name: r.error for r in seeded.collect()}
    assert reasons == {"trace-001": None, "trace-002": "RuntimeError: no answer", "trace-003": None}
    turns = ingest.clean_turns(seeded).orderBy("trace_id").collect()
    # The run's session id is a tag, not trace metadata: each trace is its own session.
    assert [(r.session_id, r.request, r.response) for r in turns] == [
        ("run-7-1", "how do I print", "like this: how do I print"),
        ("run-7-3", "how do I scan", "like this: how do I scan"),
    ]


def test_a_failing_model_fails_the_run(spark):
    out = new_stage_path(spark, "run")
    broken = lambda messages, temperature, max_tokens: 1 / 0
    with pytest.raises(Exception, match="ZeroDivisionError"):
        jobs.run_curation(traces(spark, SF_DIR), broken, out, CONFIG)
