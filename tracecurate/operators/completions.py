"""Model completions as tables: requests, answers, and the join between them.

A completion is costly and may differ on every call, so it is always stored before it is
read: ``complete_pending`` writes answers to a table, and nothing else calls the model.
"""

from __future__ import annotations

import json
import threading
import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..config import CurationConfig
from ..functions.payload import completion_text
from ..functions.prompts import generate_messages, judge_messages
from ..schema import RESPONSES, require_columns
from ..sources.staging import materialize
from .dealing import call_cost, deal_by_cost
from .increments import sift

# messages, temperature, max_tokens -> text, or a list of parts with "content"
Completer = Callable[[list[dict], float, int], "str | list[dict]"]


def request_key(
    stage: str, messages: Column, temperature: float, max_tokens: int
) -> Column:
    """Key of a wanted completion: same key, same answer.

    Each message is written with its length, so that two different lists never read the
    same.
    """
    texts = F.transform(
        messages,
        lambda m: F.concat(m["role"], F.lit(":"), F.length(m["content"]), F.lit(":"), m["content"]),
    )
    settings = F.lit(f"{stage}|{temperature}|{max_tokens}|")
    return F.sha2(F.concat(settings, F.array_join(texts, "")), 256)


def copy_key(key: Column, copy: Column) -> Column:
    """Key of one of several answers wanted to the same prompt."""
    return F.sha2(F.concat_ws("|", key, copy), 256)


def with_judge_key(
    examples: DataFrame, stage: str = "judge", config: CurationConfig = CurationConfig()
) -> DataFrame:
    require_columns(examples, ["conversation_str", "target_response"])
    messages = judge_messages(
            F.col("conversation_str"), F.col("target_response"), config.judge_system
        )
    return examples.withColumn(
        "request_key",
        request_key(stage, messages, config.judge_temperature, config.judge_max_tokens),
    )


def judge_requests(
    examples: DataFrame, stage: str = "judge", config: CurationConfig = CurationConfig()
) -> DataFrame:
    """One judge request per example."""
    return keyed_judge_requests(with_judge_key(examples, stage, config), stage, config)


def keyed_judge_requests(
    keyed: DataFrame, stage: str = "judge", config: CurationConfig = CurationConfig()
) -> DataFrame:
    """The same for examples that carry their ``request_key``, and their ``task`` if they were dealt."""
    return keyed.select(
        *[c for c in ("task",) if c in keyed.columns],
        "request_key",
        F.lit(stage).alias("stage"),
        "example_id",
        judge_messages(
            F.col("conversation_str"), F.col("target_response"), config.judge_system
        ).alias("messages"),
        F.lit(config.judge_temperature).alias("temperature"),
        F.lit(config.judge_max_tokens).alias("max_tokens"),
    )


def fan_out(seeds: DataFrame, copies: int) -> DataFrame:
    """Each seed ``copies`` times, numbered from 0 in ``generation_idx``. Narrow: no join."""
    if copies < 0:
        raise ValueError("copies must not be negative")
    numbers = F.array(*[F.lit(i) for i in range(copies)]).cast("array<int>")
    return seeds.withColumn("generation_idx", F.explode(numbers))


def with_generate_key(
    seeds: DataFrame, config: CurationConfig = CurationConfig()
) -> DataFrame:
    """The copies of each seed with their keys. A prompt is hashed once, not per copy."""
    require_columns(seeds, ["conversation_str", "target_response"])
    prompt = request_key(
        "generate",
        generate_messages(
            F.col("conversation_str"), F.col("target_response"), config.generate_system
        ),
        config.generate_temperature,
        config.generate_max_tokens,
    )
    # The seed is in the key: two seeds with the same text want different answers as well.
    copy = F.concat_ws("#", "example_id", "generation_idx")
    return (
        fan_out(seeds.withColumn("_prompt", prompt), config.copies)
        .withColumn("request_key", copy_key(F.col("_prompt"), copy))
        .drop("_prompt")
    )


def judge_cost(config: CurationConfig = CurationConfig()) -> Column:
    """Estimated tokens of a judge call over an example."""
    letters = F.length("conversation_str") + F.length("target_response") + len(config.judge_system)
    return call_cost(letters, config.judge_max_tokens)


def generate_requests(
    seeds: DataFrame, config: CurationConfig = CurationConfig()
) -> DataFrame:
    """One generation request per copy of a seed."""
    return with_generate_key(seeds, config).select(
        "request_key",
        F.lit("generate").alias("stage"),
        "example_id",
        "generation_idx",
        generate_messages(
            F.col("conversation_str"), F.col("target_response"), config.generate_system
        ).alias("messages"),
        F.lit(config.generate_temperature).alias("temperature"),
        F.lit(config.generate_max_tokens).alias("max_tokens"),
    )


def dedupe_requests(requests: DataFrame) -> DataFrame:
    """One row per key. All kept columns follow from the key, so any row will do."""
    return pending_requests(requests, None)


def pending_requests(
    requests: DataFrame,
    responses: DataFrame | None,
    unique_keys: bool = False,
    tasks: int | None = None,
) -> DataFrame:
    """Distinct requests that have no answer yet, dealt into ``tasks`` parts if given.

    What is wanted is found from keys and ids alone: for each key without an answer the
    least ``example_id``. Prompts then move once, dealt by key and id, so that a prompt
    repeated very often is spread. ``unique_keys`` tells that no two requests share a key;
    they need no id then. A request without a key, that is without messages, is not asked.
    """
    place = ["request_key"]
    rows = requests.select("request_key", "stage", "messages", "temperature", "max_tokens")
    if not unique_keys:
        place.append("_row")
        row = F.coalesce(F.col("example_id").cast("string"), F.lit(""))
        rows = requests.select(*rows.columns, row.alias("_row"))
    keys = rows.select(*place)
    if responses is not None:
        keys = keys.join(responses.select("request_key"), "request_key", "left_anti")
    if not unique_keys:
        keys = keys.groupBy("request_key").agg(F.min("_row").alias("_row"))
    if unique_keys and responses is None:
        found = rows.filter(F.col("request_key").isNotNull())
        return found if tasks is None else found.repartition(tasks, "request_key")
    if tasks is not None:
        # A join keeps a dealing into no fewer parts than the session's; coalesce moves no row.
        parts = max(tasks, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        rows, keys = rows.repartition(parts, *place), keys.repartition(parts, *place)
    # An inner join, as the keys are distinct: a semi-join would go below the dealing, and
    # prompts would move for both.
    found = rows.join(keys, place)
    if not unique_keys:
        found = found.dropDuplicates(place).drop("_row")
    return found if tasks is None else found.coalesce(tasks)


def attach_completions(
    rows: DataFrame, responses: DataFrame, name: str = "completion"
) -> DataFrame:
    """Add the text of each row's completion; null where none was given.

    Answers are unique by key. A key shared by very many rows is split by AQE's
    skew join, since only the row side repeats it.
    """
    text = completion_text(F.col("raw"), responses.schema["raw"].dataType)
    answers = responses.select("request_key", text.alias(name))
    return rows.join(answers, "request_key", "left").drop("request_key")


def complete_with(
    requests: DataFrame,
    complete: Completer,
    concurrency: int = 8,
    tasks: int | None = 8,
    attempts: int = 1,
    calls_per_second: float | None = None,
) -> DataFrame:
    """Ask the model for every request: ``(request_key, raw, error)``.

    ``tasks`` is how many parts the requests are dealt into, by their ``task`` if they have one
    (None: they are dealt already), ``concurrency`` how many calls each has in flight. All calls
    of a task share its part of ``calls_per_second``, repeated ones included. A call that
    fails ``attempts`` times gives a row with the error and no answer, so it costs none of the
    answers around it.
    """
    if tasks is not None:
        by_task = "task" in requests.columns
        requests = requests.repartitionById(tasks, F.col("task")) if by_task else requests.repartition(tasks)
    pause = 0.0 if calls_per_second is None else (tasks or 1) / calls_per_second

    def answer(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        turn, free_at = threading.Lock(), time.monotonic()

        def wait() -> None:
            nonlocal free_at
            with turn:
                begin = max(free_at, time.monotonic())
                free_at = begin + pause
            time.sleep(max(0.0, begin - time.monotonic()))

        def ask(messages: str, temperature: float, max_tokens: int):
            for left in reversed(range(max(1, attempts))):
                if pause:
                    wait()
                try:
                    return complete(json.loads(messages), temperature, max_tokens), None
                except Exception as error:
                    if not left:
                        return None, f"{type(error).__name__}: {error}"

        with ThreadPoolExecutor(max(1, concurrency)) as pool:
            for batch in batches:
                found = list(
                    pool.map(ask, batch["messages"], batch["temperature"], batch["max_tokens"])
                )
                answers = [a for a, _ in found]
                text = [a if isinstance(a, str) else None for a in answers]
                parts = [
                    None if a is None or isinstance(a, str) else json.dumps(a) for a in answers
                ]
                yield pd.DataFrame(
                    {
                        "request_key": batch["request_key"],
                        "plain": text,
                        "parts": parts,
                        "error": [e for _, e in found],
                    }
                )

    return (
        requests.select(
            "request_key", F.to_json("messages").alias("messages"), "temperature", "max_tokens"
        )
        .mapInPandas(answer, "request_key string, plain string, parts string, error string")
        .select(
            "request_key",
            F.coalesce(F.parse_json("parts"), F.col("plain").cast("variant")).alias("raw"),
            "error",
        )
    )


def _read(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.schema(RESPONSES).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def read_responses(spark: SparkSession, path: str) -> DataFrame | None:
    """The answers stored at ``path``, None if there is no such table."""
    found = _read(spark, path)
    return None if found is None else found.filter(F.col("raw").isNotNull()).drop("error")


def read_failures(spark: SparkSession, path: str) -> DataFrame:
    """``(request_key, error)``: one reason for each request that has still no answer."""
    found = _read(spark, path)
    failed = found.groupBy("request_key").agg(
        F.max("error").alias("error"), F.count_if(F.col("raw").isNotNull()).alias("answers")
    )
    return failed.filter("answers = 0 and error is not null").drop("answers")


def _with_row(requests: DataFrame) -> DataFrame:
    """``_row``: what tells where a request came from, the key itself if it has no id."""
    row = F.col("example_id") if "example_id" in requests.columns else F.col("request_key")
    return requests.withColumn("_row", F.coalesce(row.cast("string"), F.lit("")))


def wanted_keys(
    requests: DataFrame, responses: DataFrame | None, unique_keys: bool = False
) -> DataFrame:
    """``(request_key, _row, cost)`` of the requests without an answer: for each key the least id.

    ``cost`` estimates the tokens of the call. No prompt is shuffled or stored. ``unique_keys``
    tells that no two requests share a key.
    """
    letters = F.aggregate("messages", F.lit(0), lambda n, m: n + F.coalesce(F.length(m["content"]), F.lit(0)))
    keys = _with_row(requests).select(
        "request_key", "_row", call_cost(letters, F.col("max_tokens")).alias("cost")
    )
    keys = keys.filter(F.col("request_key").isNotNull())
    if responses is not None:
        keys = keys.join(responses.select("request_key"), "request_key", "left_anti")
    if unique_keys:
        return keys
    # Requests of one key have one prompt, so one cost.
    return keys.groupBy("request_key").agg(F.min("_row").alias("_row"), F.min("cost").alias("cost"))


def dealt_requests(
    requests: DataFrame, wanted: DataFrame, tasks: int, unique_keys: bool = False
) -> DataFrame:
    """The requests of ``wanted``, a stored table of ``wanted_keys``, each with its ``task``.

    Others are sifted out where they are read, by hash buckets of their rows, so what moves is
    what is asked and little else.
    """
    dealt = deal_by_cost(wanted, tasks).drop("cost")
    place = ["request_key", "_row"]
    found = sift(_with_row(requests), wanted, "_row").join(dealt, place)
    columns = ("request_key", "stage", "messages", "temperature", "max_tokens", "task")
    return (found if unique_keys else found.dropDuplicates(place)).select(*columns)


def complete_pending(
    requests: DataFrame,
    path: str,
    complete: Completer,
    concurrency: int = 8,
    waves: int = 1,
    skip_errors: bool = False,
    unique_keys: bool = False,
    tasks: int = 8,
    attempts: int = 1,
    calls_per_second: float | None = None,
) -> DataFrame:
    """Answer what has no answer in the table at ``path`` yet, append it there, return all.

    What is wanted is found once, as keys. It is answered in ``waves``, jobs that are committed
    one by one, so a lost driver costs one wave; each renders its own prompts and deals them into
    ``tasks`` of equal cost. Failed calls are stored with their reason and asked again by the
    next run. Unless ``skip_errors``, a run that leaves some raises in the end, when all
    other answers are stored.
    """
    spark = requests.sparkSession
    answered = read_responses(spark, path)
    wanted = materialize(wanted_keys(requests, answered, unique_keys), "wanted")
    for wave in range(waves):
        part = wanted.filter(F.pmod(F.xxhash64("_row"), F.lit(waves)) == wave)
        # Even a table without answers is begun, so that it can be read.
        if (wave == 0 and answered is None) or not part.isEmpty():
            dealt = dealt_requests(requests, part, tasks, unique_keys)
            answers = complete_with(dealt, complete, concurrency, tasks, attempts, calls_per_second)
            answers.write.mode("append").parquet(path)
    if not skip_errors:
        _raise_failures(wanted, path)
    return read_responses(spark, path)


def _raise_failures(requests: DataFrame, path: str) -> None:
    asked = requests.select("request_key").distinct()
    failures = read_failures(requests.sparkSession, path).join(asked, "request_key", "left_semi")
    count, reason = failures.agg(F.count("*"), F.max("error")).first()
    if count:
        raise RuntimeError(f"{count} requests have no answer; one of the reasons: {reason}")


def complete_wanted(
    keys: DataFrame,
    requests_of: Callable[[DataFrame], DataFrame],
    path: str,
    complete: Completer,
    concurrency: int = 8,
    waves: int = 1,
    tasks: int = 8,
    attempts: int = 1,
    calls_per_second: float | None = None,
) -> DataFrame:
    """``complete_pending`` for prompts that are not stored: only those still wanted are written.

    ``keys`` is a stored table with ``request_key`` and what names an example. Of the examples that
    share a key the least is asked; ``requests_of`` gets those rows and gives their requests. So
    a run that has little left to ask renders and moves that little. With a column ``cost`` the
    rows come with a ``task``, so that all tasks cost the same. A row without a key is not asked.
    """
    spark = keys.sparkSession
    example = F.struct(*[c for c in keys.columns if c != "request_key"])
    for wave in range(waves):
        part = keys.filter(F.pmod(F.xxhash64("request_key"), F.lit(waves)) == wave)
        part = part.filter(F.col("request_key").isNotNull())
        answered = read_responses(spark, path)
        if answered is not None:
            part = part.join(answered.select("request_key"), "request_key", "left_anti")
        wanted = part.groupBy("request_key").agg(F.min(example).alias("example"))
        wanted = materialize(wanted.select("request_key", "example.*"), "wanted")
        # Even a table without answers is begun, so that it can be read.
        if answered is None or not wanted.isEmpty():
            if "cost" in wanted.columns:
                wanted = deal_by_cost(wanted, tasks).drop("cost")
            answers = complete_with(
                requests_of(wanted), complete, concurrency, tasks, attempts, calls_per_second
            )
            answers.write.mode("append").parquet(path)
    _raise_failures(keys, path)
    return read_responses(spark, path)
