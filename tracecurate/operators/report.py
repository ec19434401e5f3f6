"""Counts and sizes that describe a run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..config import CurationConfig
from ..functions.text import BLANK_CLASS
from .scoring import passes


def source_counts(training: DataFrame) -> DataFrame:
    """Training rows by source, largest first."""
    return training.groupBy("source").agg(F.count("*").alias("rows")).orderBy(F.desc("rows"))


def split_counts(assigned: DataFrame) -> DataFrame:
    """Rows by split."""
    return assigned.groupBy("split").agg(F.count("*").alias("rows"))


def turn_counts(turns: DataFrame) -> DataFrame:
    return turns.agg(
        F.count_distinct("session_id").alias("sessions"), F.count("*").alias("examples")
    )


def judge_counts(scored: DataFrame, config: CurationConfig = CurationConfig()) -> DataFrame:
    """Rows judged and rows kept, in one pass."""
    return scored.agg(
        F.count("*").alias("judged"), F.count_if(passes(config.score_threshold)).alias("kept")
    )


def as_metrics(counts: DataFrame, stage: str) -> DataFrame:
    """A one-row table of counts as rows ``stage, metric, value``."""
    return counts.unpivot([], counts.columns, "metric", "value").select(
        F.lit(stage).alias("stage"), "metric", F.col("value").cast("bigint").alias("value")
    )


def training_plan(train: DataFrame, config: CurationConfig = CurationConfig()) -> DataFrame:
    """Optimizer steps per epoch and warm-up steps of a training run over ``train``."""
    rows = F.count("*")
    steps = F.floor(rows / (config.batch_size * config.gradient_accumulation))
    warmup = F.greatest(F.lit(1), (F.lit(0.1) * steps * config.epochs).cast("int"))
    return train.agg(
        rows.alias("train_rows"),
        steps.cast("bigint").alias("steps_per_epoch"),
        warmup.cast("bigint").alias("warmup_steps"),
    )


def words(text: Column) -> Column:
    """Default token list: runs of characters that are not white space."""
    return F.array_remove(F.split(text, f"(?U)[{BLANK_CLASS}]+"), "")


def length_budget(
    rows: DataFrame,
    text: str = "text",
    config: CurationConfig = CurationConfig(),
    tokens=words,
) -> DataFrame:
    """Tokens per text, the tokens left after the cap, and whether the cap cuts.

    ``tokens`` turns the text into a token array; pass the caller's tokenizer as a
    ``pandas_udf`` to count what a model would see.
    """
    if tokens is words:  # counted without being built
        count = F.regexp_count(F.col(text), F.lit(f"(?U)[^{BLANK_CLASS}]+"))
    else:
        count = F.size(tokens(F.col(text)))
    return rows.withColumns(
        {
            "n_tokens": count.cast("bigint"),
            "kept_tokens": F.least(count, F.lit(config.max_sequence_tokens)).cast("bigint"),
            "over_budget": count > config.max_sequence_tokens,
        }
    )


def truncate_tokens(
    rows: DataFrame,
    text: str = "text",
    config: CurationConfig = CurationConfig(),
    tokens=words,
) -> DataFrame:
    """Replace the text by its tokens, cut on the right at the sequence cap."""
    kept = F.slice(tokens(F.col(text)), 1, config.max_sequence_tokens)
    return rows.withColumn("tokens", kept).drop(text)
