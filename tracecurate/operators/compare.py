"""Two response sets side by side over the holdout."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..config import ChatTemplate, CurationConfig
from ..functions.prompts import chat_text
from ..functions.text import last_user_message, parse_transcript, preview, pystrip
from .completions import attach_completions, request_key
from .numbering import number_rows

_PREVIEW = 120
_GREEDY = 0.0


def chat_prompts(holdout: DataFrame, template: ChatTemplate = ChatTemplate()) -> DataFrame:
    """The prompt of each holdout row, open for the assistant's answer."""
    messages = parse_transcript(F.col("input"))
    return holdout.select(
        "example_id", chat_text(messages, template, open_answer=True).alias("prompt")
    )


def _with_eval_key(holdout: DataFrame, model: str, config: CurationConfig) -> DataFrame:
    messages = parse_transcript(F.col("input"))
    key = request_key(model, messages, _GREEDY, config.eval_max_tokens)
    return holdout.withColumn("request_key", key)


def eval_requests(
    holdout: DataFrame, model: str, config: CurationConfig = CurationConfig()
) -> DataFrame:
    """The requests that get one model's answers to the holdout, decoded greedily."""
    return _with_eval_key(holdout, model, config).select(
        "request_key",
        F.lit(model).alias("stage"),
        "example_id",
        parse_transcript(F.col("input")).alias("messages"),
        F.lit(_GREEDY).alias("temperature"),
        F.lit(config.eval_max_tokens).alias("max_tokens"),
    )


def eval_answers(
    holdout: DataFrame,
    responses: DataFrame,
    model: str,
    config: CurationConfig = CurationConfig(),
) -> DataFrame:
    """One model's answers by ``example_id``."""
    keyed = _with_eval_key(holdout, model, config).select("example_id", "request_key")
    return attach_completions(keyed, responses, "response")


def eval_results(holdout: DataFrame, base: DataFrame, tuned: DataFrame) -> DataFrame:
    """Source, last user text, reference and both answers, matched by ``example_id``.

    ``base`` and ``tuned`` hold ``example_id, response``. All three are joined on the same
    key, so each is shuffled once at most.
    """

    def answers(responses: DataFrame, name: str) -> DataFrame:
        return responses.select("example_id", pystrip(F.col("response")).alias(name))

    return (
        holdout.join(answers(base, "base_response"), "example_id", "left")
        .join(answers(tuned, "finetuned_response"), "example_id", "left")
        .select(
            "example_id",
            "source",
            last_user_message(parse_transcript(F.col("input"))).alias("user_input"),
            F.col("output").alias("reference"),
            "base_response",
            "finetuned_response",
        )
    )


def eval_preview(results: DataFrame, length: int = _PREVIEW) -> DataFrame:
    """A listing: position, total and the beginning of each text."""
    return number_rows(
        results.select(
            "example_id",
            "source",
            *[
                preview(F.col(name), length).alias(name)
                for name in ("user_input", "reference", "base_response", "finetuned_response")
            ],
        ),
        "example_id",
        name="position",
        total="total",
    )
