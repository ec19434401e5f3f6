"""Requests, responses, metadata and completions in all their encodings."""

import json

import pytest
from pyspark.sql import functions as F, types as T

from tracecurate.functions import payload
from tracecurate.functions.prompts import chat_text, render_template
from tracecurate.operators import ingest

VARIANT = T.VariantType()


def text(value):
    """A payload that is a plain string."""
    return ("text", value)


def of_kind(spark, values):
    """VARIANT column from JSON values and plain strings."""
    rows = [
        (i, None if isinstance(v, tuple) or v is None else json.dumps(v),
         v[1] if isinstance(v, tuple) else None)
        for i, v in enumerate(values)
    ]
    df = spark.createDataFrame(rows, "i int, j string, t string")
    return df.select("i", F.coalesce(F.parse_json("j"), F.col("t").cast("variant")).alias("v"))


def run(spark, function, values):
    rows = of_kind(spark, values).select("i", function(F.col("v")).alias("o")).orderBy("i")
    return [r.o for r in rows.collect()]


def said(*pairs):
    return {"messages": [{"role": r, "content": c} for r, c in pairs]}


REQUESTS = [
    (said(), ""),
    (said(("user", " hi ")), "hi"),
    (said(("system", "s"), ("user", "a"), ("assistant", "x"), ("user", "b")), "a b"),
    (said(("system", "only")), ""),
    (said(("user", "a"), ("user", None), ("user", "b")), "a  b"),
    ({"messages": [{"role": "user"}, {"role": "user", "content": "b"}]}, "b"),
    (said(("user", ["part"]), ("user", "kept")), "kept"),
    (text('{"messages": [{"role": "user", "content": "x"}]}'),
     '{"messages": [{"role": "user", "content": "x"}]}'),
    (text("  plain \n"), "plain"),
    (text("0"), "0"),
    (0, ""),
    ([], ""),
    (False, ""),
    ({}, ""),
    ({"other": 1}, ""),
    (5, "5"),
    (None, ""),
]


def test_request_text(spark):
    values, expected = zip(*REQUESTS)
    assert run(spark, payload.request_text, values) == list(expected)


RESPONSES = [
    ({"choices": []}, ""),
    ({"choices": [{"message": {"content": " a "}}, {"message": {"content": "b"}}]}, "a"),
    ({"choices": [{"message": {"content": None}}]}, ""),
    ({"choices": [{}]}, ""),
    ({}, ""),
    (text(" plain "), "plain"),
    (None, ""),
]


def test_response_text(spark):
    values, expected = zip(*RESPONSES)
    assert run(spark, payload.response_text, values) == list(expected)


def test_payloads_as_structs_maps_and_strings(spark):
    df = spark.createDataFrame(
        [("t", {"messages": [{"role": "user", "content": "a"}]}, "plain ")],
        "trace_id string, request struct<messages:array<struct<role:string,content:string>>>,"
        " response string",
    )
    row = df.select(
        ingest.request_text(df).alias("q"), ingest.response_text(df).alias("a")
    ).first()
    assert (row.q, row.a) == ("a", "plain")


def test_json_text_is_parsed_on_request_only(spark):
    asked = json.dumps(said(("user", "hi")))
    df = spark.createDataFrame(
        [(asked,), (" plain",), ("{not json",), ("5",)], "request string"
    )
    texts = lambda **options: [
        r.t for r in df.select(ingest.request_text(df, **options).alias("t")).collect()
    ]
    assert texts() == [asked, "plain", "{not json", "5"]
    assert texts(parse_json=True) == ["hi", "plain", "{not json", "5"]


COMPLETIONS = [
    (text("Score: 7"), "Score: 7"),
    ([{"content": ""}, {"content": "second"}, {"content": "third"}], "second"),
    ([{"other": 1}, "loose", {"content": "found"}], "found"),
    ([], "[]"),
    ([{"content": ""}], '[{"content":""}]'),
    (None, None),
]


def test_completion_text(spark):
    values, expected = zip(*COMPLETIONS)
    found = run(spark, lambda c: payload.completion_text(c, VARIANT), values)
    assert found == list(expected)


KEY = "mlflow.trace.session"
METADATA = [
    # metadata, session, unreadable
    (None, "t", False),
    ("", "t", False),
    ("{}", "t", False),
    (f"{{'{KEY}': 'conv-1', 'flag': None}}", "conv-1", False),
    (f"{{'{KEY}': \"it's\", 'flag': True}}", "it's", False),
    (f"{{'flag': None}}", "t", False),
    (json.dumps({KEY: '"conv-2"'}), "conv-2", False),
    (json.dumps({KEY: "conv-3"}), "conv-3", False),
    (json.dumps({KEY: "'a'"}), "a", False),
    (json.dumps({KEY: "\"'a'\""}), "a", False),
    (json.dumps({KEY: ""}), "t", False),
    (json.dumps({"nested": {KEY: "no"}}), "t", False),
    ("[1, 2]", "t", True),
    ("{broken", "t", True),
    ("{broken}", "t", True),
    ("words", "t", True),
]


def test_session_and_quarantine(spark):
    rows = [(i, "t", meta) for i, (meta, _, _) in enumerate(METADATA)]
    df = spark.createDataFrame(rows, "i int, trace_id string, trace_metadata string")
    got = (
        df.select(
            "i",
            ingest.session_id(df, KEY).alias("session"),
            ingest.unreadable_metadata(df).alias("bad"),
        )
        .orderBy("i")
        .collect()
    )
    assert [(r.session, r.bad) for r in got] == [(s, b) for _, s, b in METADATA]


def test_metadata_as_map_and_struct(spark):
    as_map = spark.createDataFrame(
        [("t", {KEY: "m"}), ("u", {}), ("w", None)], "trace_id string, trace_metadata map<string,string>"
    )
    got = as_map.select(ingest.session_id(as_map, KEY).alias("s")).collect()
    assert [r.s for r in got] == ["m", "u", "w"]
    as_struct = as_map.select(
        "trace_id", F.struct(F.lit("x").alias(KEY)).alias("trace_metadata")
    )
    assert as_struct.select(ingest.session_id(as_struct, KEY).alias("s")).first().s == "x"
    as_variant = as_map.select(
        "trace_id", F.parse_json(F.lit(json.dumps({KEY: "v"}))).alias("trace_metadata")
    )
    assert as_variant.select(ingest.session_id(as_variant, KEY).alias("s")).first().s == "v"


def test_first_metadata_that_holds_something_wins(spark):
    named = json.dumps({KEY: "b"})
    df = spark.createDataFrame(
        [("t", "", named), ("u", "{}", named), ("v", None, named)],
        "trace_id string, trace_metadata string, request_metadata string",
    )
    got = df.select("trace_id", ingest.session_id(df, KEY).alias("s")).collect()
    # Text that says "{}" is something, and it names no session.
    assert {r.trace_id: r.s for r in got} == {"t": "b", "u": "u", "v": "b"}


def test_template_values_stay_literal(spark):
    df = spark.createDataFrame([("{{ b }}", "x")], "a string, b string")
    out = df.select(
        render_template("{{ a }}-{{b}}-{{ a }}", a=F.col("a"), b=F.col("b")).alias("o")
    ).first()
    assert out.o == "{{ b }}-x-{{ b }}"


def test_chat_text_adds_a_system_turn_once(spark):
    df = spark.createDataFrame(
        [([("user", "q")],), ([("system", "s"), ("user", "q")],), ([],)],
        "m array<struct<role:string,content:string>>",
    )
    got = [r.o for r in df.select(chat_text(F.col("m"), open_answer=True).alias("o")).collect()]
    system = "<|im_start|>system\nYou are a helpful assistant.<|im_end|>\n"
    user, opener = "<|im_start|>user\nq<|im_end|>\n", "<|im_start|>assistant\n"
    assert got == [
        system + user + opener,
        "<|im_start|>system\ns<|im_end|>\n" + user + opener,
        opener,
    ]
