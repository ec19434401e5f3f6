"""Declared schemas and input contracts."""

from __future__ import annotations

from pyspark.sql import DataFrame, types as T

MESSAGE = T.StructType(
    [T.StructField("role", T.StringType()), T.StructField("content", T.StringType())]
)
MESSAGES = T.ArrayType(MESSAGE)

SPAN = T.StructType(
    [
        T.StructField("span_id", T.StringType()),
        T.StructField("parent_id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("span_type", T.StringType()),
        T.StructField("inputs", T.VariantType()),
        T.StructField("outputs", T.VariantType()),
        T.StructField("attributes", T.MapType(T.StringType(), T.StringType())),
    ]
)

TRACES = T.StructType(
    [
        T.StructField("trace_id", T.StringType()),
        T.StructField("request_time", T.TimestampType()),
        T.StructField("timestamp_ms", T.LongType()),
        T.StructField("state", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("request", T.VariantType()),
        T.StructField("response", T.VariantType()),
        T.StructField("trace_metadata", T.StringType()),
        T.StructField("request_metadata", T.StringType()),
        T.StructField("spans", T.ArrayType(SPAN)),
    ]
)

# Holds a line or row that could not be read, whole.
CORRUPT = "_corrupt_record"

RESPONSES = T.StructType(
    [
        T.StructField("request_key", T.StringType()),
        T.StructField("raw", T.VariantType()),
        T.StructField("error", T.StringType()),
    ]
)

TRAINING = T.StructType(
    [
        T.StructField("source", T.StringType()),
        T.StructField("input", T.StringType()),
        T.StructField("output", T.StringType()),
    ]
)

EVAL_RESULTS = T.StructType(
    [
        T.StructField(name, T.StringType())
        for name in ("source", "user_input", "reference", "base_response", "finetuned_response")
    ]
)


def require_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """Fail before any job runs when an input lacks a column a stage needs."""
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise ValueError(f"input lacks required columns {missing}; it has {df.columns}")
    return df


def require_row_count(df: DataFrame, expected: int) -> DataFrame:
    """Check a corpus-size contract (runs a count)."""
    found = df.count()
    if found != expected:
        raise ValueError(f"expected {expected} rows, found {found}")
    return df
