"""Training rows from kept real and synthetic examples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import USER_PREFIX, is_placeholder, pystrip, strip_user_label


def _training(rows: DataFrame, source: str, text: Column, answer: Column) -> DataFrame:
    return rows.select(
        "example_id", F.lit(source).alias("source"), text.alias("input"), answer.alias("output")
    )


def training_curated(curated: DataFrame) -> DataFrame:
    """Real examples whose answer is not a placeholder; their request is not tested."""
    answer = pystrip(F.col("target_response"))
    return _training(
        curated.filter(~is_placeholder(answer)), "curated", F.col("conversation_str"), answer
    )


def _cleaned(synthetic: DataFrame) -> DataFrame:
    empty = F.lit("")
    return synthetic.withColumns(
        {
            "_request": strip_user_label(F.coalesce("generated_request", empty)),
            "_response": pystrip(F.coalesce("generated_response", empty)),
        }
    )


def _skip_reason() -> Column:
    request, response = F.col("_request"), F.col("_response")
    return (
        F.when(request == "", "empty request")
        .when(response == "", "empty response")
        .when(is_placeholder(request), "placeholder request")
        .when(is_placeholder(response), "placeholder response")
    )


def training_synthetic(synthetic: DataFrame) -> DataFrame:
    """Synthetic examples with both texts present and real."""
    rows = _cleaned(synthetic).filter(_skip_reason().isNull())
    return _training(
        rows, "synthetic", F.concat(F.lit(USER_PREFIX), "_request"), F.col("_response")
    )


def synthetic_skipped(synthetic: DataFrame) -> DataFrame:
    """The other side of ``training_synthetic``: what was left out, and why."""
    return (
        _cleaned(synthetic)
        .withColumn("reason", _skip_reason())
        .filter(F.col("reason").isNotNull())
        .select(
            "example_id",
            "reason",
            F.col("_request").alias("request"),
            F.col("_response").alias("response"),
        )
    )


def training_data(curated: DataFrame, synthetic: DataFrame) -> DataFrame:
    """All training rows. Both parts are kept whole; nothing is deduplicated."""
    return training_curated(curated).unionByName(training_synthetic(synthetic))


def training_links(curated: DataFrame, synthetic: DataFrame) -> DataFrame:
    """(example_id, session_id, seed_id): where training rows come from, for splits that must not
    divide it. The seed of a curated example is itself, that of a copy the part before ``#``
    and the number that ``synthetic_judge_input`` puts there."""
    seed = F.regexp_replace("example_id", "#[^#]*$", "")
    return curated.select("example_id", "session_id", F.col("example_id").alias("seed_id")).unionByName(
        synthetic.select("example_id", "session_id", seed.alias("seed_id"))
    )
