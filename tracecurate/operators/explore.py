"""Looking around in a trace store: sessions, single traces, spans."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, Window, functions as F

from ..config import ATTRIBUTE_WORDS
from .selection import nth_newest


def session_search(traces: DataFrame) -> DataFrame:
    """One row per session: traces, first and last time. Counted map-side first."""
    return traces.groupBy("session_id").agg(
        F.count("*").alias("traces"),
        F.min("request_time").alias("first_time"),
        F.max("request_time").alias("last_time"),
    )


def session_trace(traces: DataFrame, position: int = 1) -> DataFrame:
    """The k-th trace of every session, as a flat row.

    ``traces`` carries ``session_id`` and ``request_time``; payloads are best taken apart
    after the pick. Only ids and times are ranked, and the first k of a session are kept
    before the shuffle; the traces picked are then looked up by id.
    """
    by_time = Window.partitionBy("session_id").orderBy("request_time", "trace_id")
    picked = (
        traces.select("session_id", "request_time", "trace_id")
        .withColumn("_position", F.row_number().over(by_time))
        .filter(F.col("_position") <= position)
        .filter(F.col("_position") == position)
        .select("session_id", "trace_id")
    )
    return traces.join(picked, ["session_id", "trace_id"], "left_semi")


def nth_trace(traces: DataFrame, position: int) -> DataFrame:
    """The k-th newest trace of the whole store, found from times and ids alone."""
    last = nth_newest(traces.select(F.col("request_time").alias("at"), "trace_id"), position)
    if last is None:
        return traces.filter(F.lit(False))
    return traces.filter(
        (F.unix_micros("request_time") == last["age"]) & (F.col("trace_id") == last["trace_id"])
    )


def _listed(rows: DataFrame) -> DataFrame:
    return rows.select(
        "trace_id",
        "span.span_id",
        "span.parent_id",
        "span.name",
        "span.span_type",
        F.to_json("span.inputs").alias("inputs"),
        F.to_json("span.outputs").alias("outputs"),
    )


def explode_spans(traces: DataFrame) -> DataFrame:
    """One row per span: name, type, inputs and outputs as JSON text."""
    return _listed(traces.select("trace_id", F.explode("spans").alias("span")))


def root_spans(traces: DataFrame) -> DataFrame:
    """The spans without a parent, picked inside the array before it is exploded."""
    roots = F.filter("spans", lambda span: span["parent_id"].isNull())
    return _listed(traces.select("trace_id", F.explode(roots).alias("span")))


def span_attributes(traces: DataFrame, words: tuple[str, ...] = ATTRIBUTE_WORDS) -> DataFrame:
    """One row per span attribute whose key holds one of the words, in any case."""

    def wanted(key, _value):
        return reduce(or_, [F.contains(F.lower(key), F.lit(word)) for word in words])

    spans = traces.select("trace_id", F.explode("spans").alias("span"))
    return spans.select(
        "trace_id",
        "span.span_id",
        "span.name",
        F.explode(F.map_filter("span.attributes", wanted)).alias("key", "value"),
    )
