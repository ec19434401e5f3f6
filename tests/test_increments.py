"""Sessions kept by a log of changes against sessions built at once."""

import re

from pyspark.sql import functions as F

from catalog.adapter import traces
from conftest import SF_DIR
from tracecurate.config import CurationConfig
from tracecurate.operators import increments
from tracecurate.operators.ingest import clean_turns
from tracecurate.operators.sessions import sessionize
from tracecurate.sources.staging import materialize



def turns_of(spark, rows):
    return spark.createDataFrame(rows, "session_id string, trace_id string, at long, request string, response string").select(
        "session_id", "trace_id", F.timestamp_millis("at").alias("request_time"), "request", "response"
    )


def listed(df):
    return sorted((r.session_id, r.trace_id, r.turn_no, r.request) for r in df.collect())


def at_once(batches):
    whole = batches[0]
    for batch in batches[1:]:
        whole = whole.unionByName(batch)
    return listed(sessionize(increments.latest_deliveries(whole)))


def test_every_batch_leaves_what_a_rebuild_gives(spark, tmp_path):
    batches = [
        turns_of(spark, [("a", "1", 10, "q1", "r"), ("a", "2", 30, "q2", "r"), ("b", "3", 10, "q3", "r"), ("c", "4", 5, "q4", "r")]),
        # A late turn, a doubled one, a new session.
        turns_of(spark, [("a", "5", 20, "q5", "r"), ("a", "5", 20, "q5", "r"), ("d", "6", 1, "q6", "r")]),
        # A later delivery with another text, an older one that must not win, one that moves to another session.
        turns_of(spark, [("a", "1", 11, "q1 anew", "r"), ("a", "2", 29, "old", "r"), ("d", "3", 12, "q3", "r")]),
        turns_of(spark, []),
    ]
    path = str(tmp_path / "log")
    for number, batch in enumerate(batches):
        increments.append_turns(batch, path, number)
        assert listed(increments.read_sessions(spark, path)) == at_once(batches[: number + 1])
    changes = increments.open_log(spark, path)
    found = {(r.batch, r.session_id, r.trace_id): (r.change, r.turn_no) for r in changes.collect()}
    assert found[1, "a", "5"] == ("added", 2) and found[1, "a", "2"] == ("replaced", 3)
    assert (1, "a", "1") not in found and (1, "b", "3") not in found
    assert found[2, "b", "3"][0] == "removed" and found[2, "d", "3"] == ("added", 2)
    assert (2, "a", "2") not in found and not [k for k in found if k[0] == 3]
    assert listed(increments.read_sessions(spark, path, batch=0)) == at_once(batches[:1])


def test_a_batch_given_again_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "log")
    first = turns_of(spark, [("a", "1", 10, "q1", "r"), ("a", "2", 30, "q2", "r")])
    second = turns_of(spark, [("a", "3", 20, "q3", "r")])
    increments.append_turns(first, path, 0)
    increments.append_turns(second, path, 1)
    after = listed(increments.read_sessions(spark, path))
    increments.append_turns(second, path, 1)
    assert listed(increments.read_sessions(spark, path)) == after
    assert increments.session_changes(increments.open_log(spark, path), first.unionByName(second)).collect() == []


def test_hot_session_and_same_time(spark, tmp_path):
    config = CurationConfig(hot_session_turns=5)
    rows = [("hot", f"t{k:03d}", k // 4, f"q{k}", "r") for k in range(60)] + [(f"s{k}", f"u{k}", k, "q", "r") for k in range(20)]
    path = str(tmp_path / "log")
    parts = [turns_of(spark, rows[k::3]) for k in range(3)]
    for number, part in enumerate(parts):
        increments.append_turns(part, path, number, config)
    assert listed(increments.read_sessions(spark, path)) == at_once(parts)


def test_latest_delivery_is_the_same_in_any_order(spark):
    rows = [("a", "1", 10, "x", "r"), ("b", "1", 10, "y", "r"), ("a", "1", 9, "z", "r")]
    for order in (rows, rows[::-1]):
        (kept,) = increments.latest_deliveries(turns_of(spark, order)).collect()
        assert kept.request in ("x", "y")
        first = kept if order is rows else first
    assert kept == first


def test_untouched_sessions_are_not_shuffled(spark, tmp_path):
    turns = materialize(clean_turns(traces(spark, SF_DIR)), "turns")
    path = str(tmp_path / "log")
    increments.append_turns(turns, path, 0)
    log = increments.open_log(spark, path)
    session = turns.orderBy("session_id").first().session_id
    touched = materialize(turns.filter(F.col("session_id") == session).select("session_id").distinct(), "touched")
    sifted = increments.sift(log, touched, "session_id")
    plan = sifted._jdf.queryExecution().executedPlan().toString()
    # The only exchange is that of the bucket numbers; the log's rows stay where they are.
    assert "BroadcastHashJoin" in plan and not re.search("SortMergeJoin|ShuffledHashJoin", plan)
    scan = plan.index("FileScan") if "FileScan" in plan else plan.index("Scan parquet")
    assert "Exchange hashpartitioning" not in plan[:scan]
    sessions = {r.session_id for r in sifted.select("session_id").distinct().collect()}
    assert session in sessions and len(sessions) <= 2 < turns.select("session_id").distinct().count()
