"""Deterministic stand-ins for the model: the same answers on every run and in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tracecurate.config import CurationConfig
from tracecurate.operators.completions import with_generate_key, with_judge_key
from tracecurate.operators.seeding import with_prompt_key
from tracecurate.sources.staging import materialize

CONVERSATION, ANSWER = "conversation_str", "target_response"


def _as_response(text: Column) -> Column:
    """Half of the answers come as a list of parts whose first part is empty."""
    parts = F.array(
        F.struct(F.lit("").alias("content")), F.struct(text.alias("content"))
    )
    return F.when(F.length(text) % 2 == 0, F.to_variant_object(parts)).otherwise(
        text.cast("variant")
    )


def _stored(rows: DataFrame, text: Column, name: str) -> DataFrame:
    answers = rows.select("request_key", text.alias("text")).dropDuplicates(["request_key"])
    return materialize(
        answers.select("request_key", _as_response(F.col("text")).alias("raw")), name
    )


def judge_text() -> Column:
    bucket = (F.length(CONVERSATION) * 7 + F.length(ANSWER)) % 23
    return (
        F.when(bucket == 0, "I cannot score this.")
        .when(bucket == 1, "**Score:** 9")
        .when(bucket == 2, "Score: 15\nReason: over range")
        .when(bucket == 3, "Score: 7.5")
        .otherwise(
            F.concat(F.lit("Score: "), 1 + bucket % 10, F.lit("\nReason: bucket "), bucket)
        )
    )


def judge_answers(examples: DataFrame, stage: str, config: CurationConfig) -> DataFrame:
    return _stored(with_judge_key(examples, stage, config), judge_text(), f"{stage}-answers")


def generate_text() -> Column:
    i = F.col("generation_idx")
    bucket = (F.length(CONVERSATION) + i * 31 + F.length(ANSWER)) % 11
    request = F.concat(
        F.lit("Synthetic request "), i, F.lit(" for "), "example_id", F.lit(" "),
        F.repeat(F.lit("x"), F.length(CONVERSATION) % 37),
    )
    answer = F.concat(
        F.lit("Synthetic answer "), i, F.lit(" covering "), F.length(ANSWER),
        F.lit(" characters "), F.repeat(F.lit("y"), F.length(ANSWER) % 29),
    )
    u, end_u = F.lit("<user_request>"), F.lit("</user_request>")
    a, end_a = F.lit("<assistant_response>"), F.lit("</assistant_response>")
    br = F.lit("\n")
    second = F.lit(
        "\n<user_request>second</user_request><assistant_response>second</assistant_response>"
    )
    noise = F.concat(F.lit("short"), F.repeat(F.lit("n"), F.length(CONVERSATION) % 37))
    return (
        F.when(bucket == 0, "no tags here")
        .when(bucket == 1, F.concat(u, request, end_u, a, F.lit("["), answer, F.lit("]"), end_a))
        .when(bucket == 2, F.concat(u, noise, end_u, a, answer, end_a))
        .when(bucket == 3, F.concat(u, request, end_u, a, answer))
        .when(bucket == 4, F.concat(u, request, end_u, a, answer, end_a, second))
        .when(bucket == 5, F.concat(u, F.lit(" USER:  "), request, F.lit(" "), end_u, a, answer, end_a))
        .otherwise(F.concat(u, br, request, br, end_u, br, a, br, answer, br, end_a))
    )


def generate_answers(curated: DataFrame, config: CurationConfig) -> DataFrame:
    return _stored(with_generate_key(curated, config), generate_text(), "generate-answers")


def seed_answers(prompts: DataFrame, system: str) -> DataFrame:
    """Answers to all prompts but those ending in a question mark."""
    answered = with_prompt_key(prompts, system).filter(~F.endswith("prompt", F.lit("?")))
    return _stored(answered, F.concat(F.lit("echo "), F.md5("prompt")), "seed-answers")


def base_answers(holdout: DataFrame) -> DataFrame:
    return holdout.select("example_id", F.concat(F.lit("base "), F.md5("input")).alias("response"))


def tuned_answers(holdout: DataFrame) -> DataFrame:
    text = F.md5(F.concat("input", "output"))
    return holdout.select("example_id", F.concat(F.lit("tuned "), text, F.lit("\n")).alias("response"))
