"""Synthetic examples: copies of good seeds, generated text, a second judgement."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..config import CurationConfig
from ..functions.instructions import REQUEST_TAG, RESPONSE_TAG
from ..functions.text import USER_PREFIX, parse_tag
from .completions import attach_completions, with_generate_key, with_judge_key
from .scoring import keep_good, score_keyed


def generate_examples(
    seeds: DataFrame, responses: DataFrame, config: CurationConfig = CurationConfig()
) -> DataFrame:
    """Copies of the seeds with the generated text and its two parsed parts."""
    answered = attach_completions(
        with_generate_key(seeds, config), responses, "generated_content"
    )
    return answered.withColumns(
        {
            "generated_request": parse_tag(F.col("generated_content"), REQUEST_TAG),
            "generated_response": parse_tag(F.col("generated_content"), RESPONSE_TAG),
        }
    )


def synthetic_judge_input(generated: DataFrame) -> DataFrame:
    """Turn generated pairs into examples to judge.

    Generations without both parts go: they can never become training rows, so the model is
    not asked about them.
    """
    return (
        generated.filter(F.col("generated_request").isNotNull() & F.col("generated_response").isNotNull())
        .withColumns(
            {
                "example_id": F.concat_ws("#", "example_id", "generation_idx"),
                "conversation_str": F.concat(F.lit(USER_PREFIX), "generated_request"),
                "target_response": F.col("generated_response"),
            }
        )
        .select(
            "example_id",
            "session_id",
            "generation_idx",
            "generated_request",
            "generated_response",
            "conversation_str",
            "target_response",
        )
    )


def judge_synthetic(
    judge_input: DataFrame, responses: DataFrame, config: CurationConfig = CurationConfig()
) -> DataFrame:
    """Score synthetic examples; the reason is not kept for them."""
    # The prompt's texts repeat the generated ones, so they stay behind once it is hashed.
    keyed = with_judge_key(judge_input, "judge_synthetic", config).drop(
        "conversation_str", "target_response"
    )
    return score_keyed(keyed, responses).drop("judge_reason")


def keep_synthetic(scored: DataFrame, config: CurationConfig = CurationConfig()) -> DataFrame:
    return keep_good(scored, config)
