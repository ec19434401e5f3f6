"""The stream of traces against the batch job over the same traces."""

import pytest
from pyspark.sql import functions as F

from catalog.adapter import traces
from conftest import SF_DIR
from tracecurate.operators import increments
from tracecurate.operators.ingest import clean_turns
from tracecurate.operators.sessions import sessionize
from tracecurate.sources.staging import materialize
from tracecurate.streaming import curation


@pytest.fixture(scope="module")
def found(spark):
    return materialize(traces(spark, SF_DIR), "stream-source").orderBy("trace_id")


def listed(df):
    return sorted((r.session_id, r.trace_id, r.turn_no, r.request, r.response) for r in df.select("session_id", "trace_id", "turn_no", "request", "response").collect())


def run(spark, folder, out, checkpoint):
    stream = curation.read_trace_stream(spark, folder, files_per_batch=1)
    query = curation.stream_sessions(stream, out, checkpoint)
    query.awaitTermination()
    assert query.exception() is None
    return query.recentProgress


def deliver(df, folder):
    df.coalesce(1).write.mode("append").parquet(folder)


def test_stream_equals_batch_with_late_and_doubled_traces_and_restarts(spark, found, tmp_path):
    folder, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    number = F.pmod(F.xxhash64("trace_id"), F.lit(4))
    # The newest first, so that all that follows is late; the second delivery repeats a part of it.
    newest = found.filter(number == 3)
    deliver(newest, folder)
    deliver(found.filter(number == 0).unionByName(newest.limit(9)), folder)
    progress = run(spark, folder, out, checkpoint)
    assert len([p for p in progress if p["numInputRows"]]) == 2
    half = sessionize(increments.latest_deliveries(clean_turns(found.filter(number.isin(0, 3)))))
    assert listed(increments.read_sessions(spark, out)) == listed(half)

    # Started again, it reads what is new and remembers what it read.
    assert not [p for p in run(spark, folder, out, checkpoint) if p["numInputRows"]]
    deliver(newest, folder)
    deliver(found.filter(number.isin(1, 2)), folder)
    progress = run(spark, folder, out, checkpoint)
    states = [p["stateOperators"][0] for p in progress if p["numInputRows"]]
    assert sum(s["customMetrics"]["numDroppedDuplicateRows"] for s in states) >= clean_turns(newest).count()
    assert listed(increments.read_sessions(spark, out)) == listed(sessionize(increments.latest_deliveries(clean_turns(found))))


def test_a_batch_that_broke_off_is_taken_again(spark, found, tmp_path, monkeypatch):
    folder, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    deliver(found, folder)
    real = curation.append_turns

    def broken(batch, path, number, config):
        real(batch, path, number, config)
        raise RuntimeError("lost after the entry was written")

    monkeypatch.setattr(curation, "append_turns", broken)
    with pytest.raises(Exception, match="lost after"):
        run(spark, folder, out, checkpoint)
    monkeypatch.setattr(curation, "append_turns", real)
    run(spark, folder, out, checkpoint)
    assert listed(increments.read_sessions(spark, out)) == listed(sessionize(increments.latest_deliveries(clean_turns(found))))


def test_the_stream_runs_the_batch_expressions(spark, tmp_path):
    (tmp_path / "in").mkdir()
    turns = curation.stream_turns(curation.read_trace_stream(spark, str(tmp_path / "in")))
    assert turns.isStreaming and turns.columns == ["session_id", "trace_id", "request_time", "request", "response"]
