"""Seeding a trace store from a prompt corpus."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.prompts import dialogue
from ..functions.text import preview
from .completions import attach_completions, copy_key, request_key
from .numbering import number_rows

# What stands for the settings of the serving side, for callers that send none.
_TEMPERATURE, _MAX_TOKENS = 1.0, 0


def number_prompts(prompts: DataFrame, *order: str) -> DataFrame:
    """Give a corpus without one a 1-based ``prompt_index``."""
    return number_rows(prompts, *order, name="prompt_index")


def new_run_id() -> str:
    """One session id for a whole run; draw it once, not per row."""
    return str(uuid.uuid4())


def run_name(index: Column) -> Column:
    """``trace-001`` and so on; longer numbers stay whole."""
    return F.format_string("trace-%03d", index)


def tag_prompts(prompts: DataFrame, run_id: str) -> DataFrame:
    """Prompts with the run's session id, a run name and the tags of their trace."""
    index = F.col("prompt_index")
    return prompts.withColumns(
        {
            "session_id": F.lit(run_id),
            "run_name": run_name(index),
            "tags": F.create_map(
                F.lit("session_id"),
                F.lit(run_id),
                F.lit("prompt_index"),
                index.cast("string"),
            ),
        }
    )


def _messages(system: str) -> Column:
    return dialogue(system, F.col("prompt"))


def with_prompt_key(
    prompts: DataFrame, system: str, temperature: float = _TEMPERATURE, max_tokens: int = _MAX_TOKENS
) -> DataFrame:
    # The index is in the key: a prompt that occurs twice is asked twice.
    prompt = request_key("seed", _messages(system), temperature, max_tokens)
    key = copy_key(prompt, F.col("prompt_index"))
    return prompts.withColumn("request_key", key)


def prompt_requests(
    prompts: DataFrame, system: str, temperature: float = _TEMPERATURE, max_tokens: int = _MAX_TOKENS
) -> DataFrame:
    """A fixed system message and the prompt, one request per prompt."""
    return with_prompt_key(prompts, system, temperature, max_tokens).select(
        "request_key",
        F.lit("seed").alias("stage"),
        "prompt_index",
        _messages(system).alias("messages"),
        F.lit(temperature).alias("temperature"),
        F.lit(max_tokens).alias("max_tokens"),
    )


def seed_traces(
    prompts: DataFrame,
    responses: DataFrame,
    run_id: str,
    system: str,
    failures: DataFrame | None = None,
    begun_ms: int = 0,
    temperature: float = _TEMPERATURE,
    max_tokens: int = _MAX_TOKENS,
) -> DataFrame:
    """Prompts and their answers as traces; an unanswered prompt becomes a failed trace, with
    its reason in ``error`` if ``failures`` has one.

    Traces follow ``begun_ms``, the run's time, by their place in the corpus: number 1 by a
    millisecond. They name no session, so each is one of its own.
    """
    keyed = with_prompt_key(prompts, system, temperature, max_tokens)
    if failures is not None:
        reasons = failures.select("request_key", "error")
        keyed = keyed.join(reasons, "request_key", "left")
    else:
        keyed = keyed.withColumn("error", F.lit(None).cast("string"))
    answered = attach_completions(keyed, responses, "answer")
    reply = F.struct(
        F.lit("assistant").alias("role"), F.col("answer").alias("content")
    ).alias("message")
    has_answer = F.col("answer").isNotNull()
    return tag_prompts(answered, run_id).select(
        F.concat_ws("-", F.lit(run_id), "prompt_index").alias("trace_id"),
        F.timestamp_millis(F.lit(begun_ms) + F.col("prompt_index").cast("bigint")).alias("request_time"),
        "run_name",
        "tags",
        F.when(has_answer, "OK").otherwise("ERROR").alias("state"),
        F.lit("{}").alias("trace_metadata"),
        F.to_variant_object(F.struct(_messages(system).alias("messages"))).alias("request"),
        F.when(
            has_answer, F.to_variant_object(F.struct(F.array(F.struct(reply)).alias("choices")))
        ).alias("response"),
        F.when(~has_answer, F.col("error")).alias("error"),
    )


def seed_preview(
    prompts: DataFrame, responses: DataFrame, system: str
) -> DataFrame:
    """A listing of the run: the beginning of each prompt and of its answer, if it has one."""
    answered = attach_completions(with_prompt_key(prompts, system), responses, "answer")
    return answered.select(
        "prompt_index",
        preview(F.col("prompt"), 80).alias("prompt"),
        preview(F.col("answer"), 100).alias("answer"),
        F.col("answer").isNull().alias("failed"),
    )
