"""The given ``conversations`` table seen as a trace store and as a prompt corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tracecurate.functions.text import message


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def traces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One trace per user message, answered by the message after it.

    Turns are numbered without gaps, so the answer is found by an equality on a unique
    key; no conversation has to fit into one task.
    """
    rows = table(spark, sf_dir, "conversations")
    answers = rows.filter("role = 'assistant'").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("answer")
    )
    told = rows.filter("role = 'system'").groupBy("conv_id").agg(F.min_by("text", "turn").alias("told"))
    joined = (
        rows.filter("role = 'user'")
        .join(answers, ["conv_id", "turn"], "left")
        .join(told, "conv_id", "left")
    )

    conv, turn = F.col("conv_id"), F.col("turn")
    prefix = F.when((conv + turn) % 19 == 0, "Please REVIEW the conversation above. ").otherwise("")
    number = (conv * 7 + turn) % 17
    name = F.concat(F.lit("conv-"), conv)
    base = joined.select(
        conv,
        turn,
        F.concat_ws("-", F.lit("tr"), conv, turn).alias("trace_id"),
        F.timestamp_millis(conv * 1000 + turn).alias("request_time"),
        (conv * 1000 + turn).alias("timestamp_ms"),
        F.when(number == 0, "ERROR")
        .when(number == 2, "ok")
        .when(number == 4, "TRACE_STATE_OK")
        .otherwise("OK")
        .alias("state"),
        F.concat(prefix, "text").alias("asked"),
        F.coalesce("answer", F.lit("")).alias("answered"),
        "told",
        # Every encoding of metadata: none, a dict literal, quoted JSON, plain JSON.
        F.when(conv % 5 == 0, "{}")
        .when(
            conv % 5 == 1,
            F.concat(F.lit("{'mlflow.trace.session': '"), name, F.lit("', 'flag': None}")),
        )
        .when(
            conv % 5 == 2,
            F.concat(F.lit('{"mlflow.trace.session": "\\"'), name, F.lit('\\""}')),
        )
        .otherwise(F.concat(F.lit('{"mlflow.trace.session": "'), name, F.lit('"}')))
        .alias("trace_metadata"),
    )
    return base.withColumns(
        {"request": _request(), "response": _response(), "spans": _spans()}
    ).drop("conv_id", "turn", "asked", "answered", "told")


def _is_object():
    return F.col("conv_id") % 2 == 0


def _request():
    asked = message("user", F.col("asked"))
    with_system = F.array(message("system", F.col("told")), asked)
    messages = F.when(F.col("told").isNotNull(), with_system).otherwise(F.array(asked))
    as_object = F.parse_json(F.to_json(F.struct(messages.alias("messages"))))
    return F.when(_is_object(), as_object).otherwise(F.col("asked").cast("variant"))


def _response():
    choice = F.struct(message("assistant", F.col("answered")).alias("message"))
    choices = F.when(F.col("answered") != "", F.array(choice)).otherwise(
        F.array().cast("array<struct<message:struct<role:string,content:string>>>")
    )
    as_object = F.parse_json(F.to_json(F.struct(choices.alias("choices"))))
    return F.when(_is_object(), as_object).otherwise(F.col("answered").cast("variant"))


def _spans():
    """A root span and one child."""

    def span(kind, parent, name, span_type, attributes):
        return F.struct(
            F.concat_ws("-", "trace_id", F.lit(kind)).alias("span_id"),
            parent.alias("parent_id"),
            F.lit(name).alias("name"),
            F.lit(span_type).alias("span_type"),
            F.to_variant_object(F.struct(F.col("asked").alias("text"))).alias("inputs"),
            F.to_variant_object(F.struct(F.col("answered").alias("text"))).alias("outputs"),
            attributes.alias("attributes"),
        )

    root = span(
        "root",
        F.lit(None).cast("string"),
        "answer",
        "CHAIN",
        F.create_map(
            F.lit("Input.length"),
            F.length("asked").cast("string"),
            F.lit("retries"),
            F.lit("0"),
        ),
    )
    child = span(
        "child",
        F.concat_ws("-", "trace_id", F.lit("root")),
        "chat",
        "CHAT_MODEL",
        F.create_map(
            F.lit("gen_ai.system"),
            F.lit("stub"),
            F.lit("LLM.output"),
            F.length("answered").cast("string"),
            F.lit("color"),
            F.lit("blue"),
        ),
    )
    return F.array(root, child)


def prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A prompt corpus: every user message, grouped by tone."""
    return (
        table(spark, sf_dir, "conversations")
        .filter("role = 'user'")
        .select(
            "conv_id",
            "turn",
            F.when(F.contains("text", F.lit("?")), "question").otherwise("statement").alias("category"),
            F.col("text").alias("prompt"),
        )
    )
