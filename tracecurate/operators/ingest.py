"""From raw traces to clean turns. Every step is narrow: no shuffle."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..config import CurationConfig
from ..functions import payload
from ..schema import CORRUPT, require_columns
from .selection import nth_newest


def scan_traces(traces: DataFrame, max_results: int | None) -> DataFrame:
    """The newest traces, cut before any filter; ``None`` reads all.

    The place of the cut is found from times and ids alone; the traces are then filtered
    where they are, in as many tasks as before. Copies of the trace at the cut all stay.
    """
    if max_results is None:
        return traces
    if max_results < 1:
        return traces.filter(F.lit(False))
    last = nth_newest(traces.select(event_time(traces).alias("at"), "trace_id"), max_results)
    if last is None:
        return traces
    age, key = F.unix_micros(event_time(traces)), F.col("trace_id")
    return traces.filter((age > last["age"]) | ((age == last["age"]) & (key <= last["trace_id"])))


def event_time(traces: DataFrame) -> Column:
    """``request_time``, else ``timestamp_ms``, as a timestamp; the epoch without both."""
    found = []
    for name in ("request_time", "timestamp_ms"):
        if name in traces.columns:
            dtype = traces.schema[name].dataType
            number = F.nullif(F.col(name).try_cast("bigint"), F.lit(0))
            if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
                found.append(F.col(name).cast("timestamp"))
            elif isinstance(dtype, T.StringType):
                # Digits are milliseconds, anything else a date; what is neither has no time.
                found += [F.timestamp_millis(number), F.try_to_timestamp(F.col(name))]
            else:
                found.append(F.timestamp_millis(number))
    return F.coalesce(*found, F.timestamp_millis(F.lit(0)))


def state(traces: DataFrame) -> Column:
    """``status``, else ``state``, row by row."""
    names = [n for n in ("status", "state") if n in traces.columns]
    return F.coalesce(*[F.col(n) for n in names or require_columns(traces, ["state"]).columns])


def _metadata_columns(traces: DataFrame) -> list[str]:
    """The metadata columns that are there; without any, no trace has metadata."""
    return [n for n in ("trace_metadata", "request_metadata") if n in traces.columns]


def _of_first_metadata(traces: DataFrame, expression, empty: Column) -> Column:
    """Apply ``expression(column, type)`` to the first metadata column holding something."""
    result = empty
    for name in reversed(_metadata_columns(traces)):
        col, dtype = F.col(name), traces.schema[name].dataType
        result = F.when(
            payload.is_blank_metadata(col, dtype), result
        ).otherwise(expression(col, dtype))
    return result


def session_id(traces: DataFrame, key: str) -> Column:
    """Session named in the metadata, else the trace stands for itself."""
    value = _of_first_metadata(
        traces,
        lambda col, dtype: payload.metadata_value(col, dtype, key),
        F.lit(None).cast("string"),
    )
    return F.coalesce(F.nullif(payload.unquoted(value), F.lit("")), F.col("trace_id"))


def unreadable_metadata(traces: DataFrame) -> Column:
    return _of_first_metadata(traces, payload.is_unreadable_metadata, F.lit(False))


def _payload(traces: DataFrame, name: str, parse_json: bool) -> Column:
    return payload.as_payload(F.col(name), traces.schema[name].dataType, parse_json)


def request_text(traces: DataFrame, parse_json: bool = False) -> Column:
    return payload.request_text(_payload(traces, "request", parse_json))


def response_text(traces: DataFrame, parse_json: bool = False) -> Column:
    return payload.response_text(_payload(traces, "response", parse_json))


def is_success(traces: DataFrame, states: tuple[str, ...]) -> Column:
    return F.upper(state(traces)).isin(*states)


def is_housekeeping(text: Column, phrases: tuple[str, ...]) -> Column:
    """True when a text holds one of the phrases, in any case."""
    lowered = F.lower(text)
    return reduce(or_, [F.contains(lowered, F.lit(p)) for p in phrases], F.lit(False))


def is_complete(request: Column, response: Column) -> Column:
    return (request != "") & (response != "")


def normalize_traces(traces: DataFrame, config: CurationConfig = CurationConfig()) -> DataFrame:
    """One layout for all trace layouts: state, time, session and the two texts.

    The texts come out of a one-row ``inline``. Filters on them then stay above it; they
    would otherwise be pushed below the projection, each with its own copy of the whole
    payload extraction.
    """
    texts = F.struct(
        request_text(traces, config.parse_json_strings).alias("request"),
        response_text(traces, config.parse_json_strings).alias("response"),
    )
    return traces.select(
        "trace_id",
        session_id(traces, config.session_key).alias("session_id"),
        event_time(traces).alias("request_time"),
        state(traces).alias("state"),
        unreadable_metadata(traces).alias("unreadable_metadata"),
        F.inline(F.array(texts)),
    )


def _real_turns(traces: DataFrame, config: CurationConfig) -> DataFrame:
    """Traces that succeeded, say something on both sides, and are no housekeeping.

    The state is tested first: it is a plain column, so failed traces go before their
    payloads are taken apart.
    """
    require_columns(traces, ["trace_id", "request", "response"])
    if CORRUPT in traces.columns:
        traces = traces.filter(F.col(CORRUPT).isNull())
    request, response = F.col("request"), F.col("response")
    return (
        normalize_traces(traces.filter(is_success(traces, config.success_states)), config)
        .filter(is_complete(request, response))
        .filter(~is_housekeeping(request, config.housekeeping_phrases))
    )


def clean_turns(traces: DataFrame, config: CurationConfig = CurationConfig()) -> DataFrame:
    """Turns fit for training, with the session they belong to."""
    return (
        _real_turns(traces, config)
        .filter(~F.col("unreadable_metadata"))
        .select("session_id", "trace_id", "request_time", "request", "response")
    )


def quarantined_traces(
    traces: DataFrame, config: CurationConfig = CurationConfig()
) -> DataFrame:
    """What cannot be used for want of being readable: traces that would be turns but for
    their metadata, and lines that are no traces, with ``record`` the whole line."""
    found = (
        _real_turns(traces, config)
        .filter("unreadable_metadata")
        .select(
            "trace_id",
            "request_time",
            F.lit("unreadable metadata").alias("reason"),
            F.lit(None).cast("string").alias("record"),
        )
    )
    if CORRUPT not in traces.columns:
        return found
    # Spark refuses to read the record column alone, so the filter, true for any id, names another.
    size = F.length("trace_id")
    broken = traces.filter(F.col(CORRUPT).isNotNull() & (size.isNull() | (size >= 0))).select(
        "trace_id",
        F.lit(None).cast("timestamp").alias("request_time"),
        F.lit("unreadable line").alias("reason"),
        F.col(CORRUPT).alias("record"),
    )
    return found.unionByName(broken)
