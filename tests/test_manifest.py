"""Runs that broke off go on; finished stages are not built again."""

import os
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from catalog.adapter import traces
from conftest import SF_DIR
from test_jobs import CONFIG, calls, model
from tracecurate.operators import report
from tracecurate.plans import jobs, manifest
from tracecurate.sources.staging import new_stage_path


def never(*args, **kwargs):
    raise AssertionError("built again")


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("in put") / "traces")
    traces(spark, SF_DIR).write.parquet(path)
    return path


def test_a_broken_run_goes_on(spark, stored, tmp_path, monkeypatch):
    out, whole, notes = new_stage_path(spark, "run"), new_stage_path(spark, "run"), str(tmp_path / "c")
    source = spark.read.parquet(stored)
    want = jobs.run_curation(source, model(str(tmp_path / "w")), whole, CONFIG, csv=False)
    with monkeypatch.context() as broken:
        broken.setattr(jobs, "generate_examples", never)
        with pytest.raises(AssertionError):
            jobs.run_curation(source, model(notes), out, CONFIG, csv=False)
    asked = calls(notes)
    with monkeypatch.context() as finished:
        for name in ("clean_turns", "quarantined_traces", "chain_turns", "with_judge_key", "complete_wanted", "scores_report"):
            finished.setattr(jobs, name, never)
        assert jobs.run_curation(spark.read.parquet(stored), model(notes), out, CONFIG, csv=False) == want
    assert calls(notes) > asked
    with monkeypatch.context() as finished:
        for name in ("render_examples", "complete_pending", "training_data", "training_links", "synthetic_skipped"):
            finished.setattr(jobs, name, never)
        assert jobs.run_curation(source, never, out, CONFIG, csv=True) == want
    rows = lambda at: sorted(map(tuple, spark.read.parquet(f"{at}/training_data").collect()))
    assert rows(out) == rows(whole)
    assert os.path.isdir(f"{out.removeprefix('file:')}/training_data_csv")


def test_changed_settings_and_files_are_seen(spark, stored, tmp_path, monkeypatch):
    out, notes = new_stage_path(spark, "run"), str(tmp_path / "c")
    source = spark.read.parquet(stored)
    counts = jobs.run_curation(source, model(notes), out, CONFIG, csv=False)
    with monkeypatch.context() as finished:
        finished.setattr(jobs, "chain_turns", never)  # turns do not depend on the threshold
        lower = jobs.run_curation(source, model(notes), out, replace(CONFIG, score_threshold=1), csv=False)
    assert lower["kept"] > counts["kept"] and lower["examples"] == counts["examples"]
    some = source.filter(F.pmod(F.xxhash64("trace_id"), F.lit(2)) == 0)
    assert jobs.run_curation(some, model(notes), out, CONFIG, csv=False)["traces"] == some.count() < counts["traces"]
    print_of = manifest.source_fingerprint
    assert print_of(source) == print_of(spark.read.parquet(stored)) != print_of(some)
    assert print_of(spark.createDataFrame([(1,)], "a int")) is None
    grown = str(tmp_path / "grown")
    source.write.parquet(grown)
    before = print_of(spark.read.parquet(grown))
    source.limit(1).write.mode("append").parquet(grown)
    assert print_of(spark.read.parquet(grown)) != before


def test_a_table_written_in_part_is_built_again(spark):
    out = new_stage_path(spark, "run")
    run = manifest.Run(spark, out, CONFIG, "same files")
    table = lambda n: lambda: spark.range(n)
    first = run.stage("numbers", table(3), count=lambda t: {"n": t.count()})
    assert run.stage("numbers", never).counts == {"n": 3}
    with pytest.raises(AssertionError):  # another fingerprint, and the write does not end
        run.stage("numbers", never, [first])
    assert run.stage("numbers", table(5), count=lambda t: {"n": t.count()}).counts == {"n": 5}


def test_preparation_goes_on_and_writes_tokens(spark, stored, tmp_path, monkeypatch):
    out = new_stage_path(spark, "prep")
    rows = [(f"e{i}", "curated", f"User: question {i} " + "word " * i, "an answer") for i in range(40)]
    path = str(tmp_path / "training")
    spark.createDataFrame(rows, "example_id string, source string, input string, output string").write.parquet(path)
    config = replace(CONFIG, max_sequence_tokens=12)
    plan = jobs.run_preparation(spark.read.parquet(path), out, config, csv=False, tokenized=True)
    train = spark.read.parquet(f"{out}/train").join(spark.read.parquet(f"{out}/train_tokens"), "example_id")
    assert train.count() == plan["train_rows"] > plan["over_budget"] > 0
    assert train.filter("size(tokens) <> kept_tokens or size(tokens) > 12").isEmpty()
    monkeypatch.setattr(jobs, "length_budget", never)
    monkeypatch.setattr(jobs, "prepare", never)
    assert jobs.run_preparation(spark.read.parquet(path), out, config, csv=False, tokenized=True) == plan


def test_words_are_counted_without_an_array(spark):
    texts = [(t,) for t in ("", " ", "a", " a b\x1c c　d\n", "ein Wort", "\x1f\x1fx", None)]
    df = spark.createDataFrame(texts, "text string")
    counted = report.length_budget(df, "text", CONFIG)
    assert [r.n_tokens for r in counted.collect()] == [r[0] for r in df.select(F.size(report.words(F.col("text"))).cast("bigint")).collect()]
