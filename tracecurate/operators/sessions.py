"""Sessions: turn numbers, and one training example per turn with its full history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..config import CurationConfig
from ..functions.text import ASSISTANT_PREFIX, USER_PREFIX, message
from .numbering import number_in_groups, split_by_group_size

_TURN_ORDER = ("request_time", "trace_id")


def _number_large_sessions(turns: DataFrame) -> DataFrame:
    """Turn numbers for sessions too large for one task."""
    numbered = number_in_groups(turns, ["session_id"], *_TURN_ORDER, name="turn_no")
    return numbered.withColumn("turn_no", F.col("turn_no").cast("int"))


def sessionize(
    turns: DataFrame,
    config: CurationConfig = CurationConfig(),
    sizes_of: DataFrame | None = None,
) -> DataFrame:
    """Number the turns of each session by time; equal times are ordered by trace id."""
    usual, large = split_by_group_size(
        turns, "session_id", config.hot_session_turns, config.broadcast_rows, sizes_of
    )
    by_time = Window.partitionBy("session_id").orderBy(*_TURN_ORDER)
    numbered = usual.withColumn("turn_no", F.row_number().over(by_time))
    if large is None:
        return numbered
    return numbered.unionByName(_number_large_sessions(large))


def _history_in_one_task(turns: DataFrame) -> DataFrame:
    """Turn number and history from one window: a single exchange by session."""
    by_time = Window.partitionBy("session_id").orderBy(*_TURN_ORDER)
    earlier = by_time.rowsBetween(Window.unboundedPreceding, -1)
    return turns.withColumns(
        {
            "turn_no": F.row_number().over(by_time),
            "history": F.collect_list("turn").over(earlier),
        }
    )


def _history_by_blocks(turns: DataFrame, block_turns: int) -> DataFrame:
    """The same for long sessions, split into blocks of consecutive turns.

    A turn's history is what came in earlier blocks plus what came earlier in its own.
    The first is put together once per block and joined to the block's rows, so the
    quadratic work is spread over the blocks of a session. A task holds the histories of its
    blocks; that of a last turn is the whole session, as the result has it.
    """
    partitions = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    numbered = _number_large_sessions(turns).withColumn(
        "_block", F.floor((F.col("turn_no") - 1) / block_turns)
    )
    in_block = Window.partitionBy("session_id", "_block").orderBy("turn_no")
    # The partition count is given: by the small input size alone, AQE would put all blocks
    # into one task, which then writes all of the far larger output.
    rows = numbered.repartition(partitions, "session_id", "_block").withColumn(
        "_recent",
        F.collect_list("turn").over(in_block.rowsBetween(Window.unboundedPreceding, -1)),
    )
    in_order = F.sort_array(F.collect_list(F.struct("turn_no", "turn")))
    blocks = numbered.groupBy("session_id", "_block").agg(in_order["turn"].alias("_turns"))
    last = numbered.groupBy("session_id").agg(F.max("_block").alias("_last"))
    # Every block goes to each later one of its session, so what came before a block is put
    # together in the block's own task, not in one for the whole session.
    sent = (
        blocks.join(last, "session_id")
        .filter("_block < _last")
        .select(
            "session_id",
            F.explode(F.sequence(F.col("_block") + 1, "_last")).alias("_to"),
            "_block",
            "_turns",
        )
    )
    parts = F.sort_array(F.collect_list(F.struct("_block", "_turns")))
    earlier = (
        sent.groupBy("session_id", "_to")
        .agg(F.flatten(parts["_turns"]).alias("_earlier"))
        .withColumnRenamed("_to", "_block")
    )
    # The size of the histories is not that of the input, so they are never broadcast.
    return (
        rows.join(earlier.hint("merge"), ["session_id", "_block"], "left")
        .withColumn(
            "history",
            F.when(F.col("_earlier").isNull(), F.col("_recent")).otherwise(
                F.concat("_earlier", "_recent")
            ),
        )
        .drop("_block", "_recent", "_earlier")
    )


def example_texts(history: Column, request: Column) -> tuple[Column, Column]:
    """Messages and transcript of a request after its ``history`` of turns."""
    earlier_messages = F.flatten(
        F.transform(
            history,
            lambda t: F.array(message("user", t["request"]), message("assistant", t["response"])),
        )
    )
    earlier_lines = F.transform(
        history,
        lambda t: F.concat(
            F.lit(USER_PREFIX), t["request"], F.lit("\n" + ASSISTANT_PREFIX), t["response"]
        ),
    )
    last_line = F.array(F.concat(F.lit(USER_PREFIX), request))
    return (
        F.concat(earlier_messages, F.array(message("user", request))),
        F.array_join(F.concat(earlier_lines, last_line), "\n"),
    )


def unroll_examples(
    turns: DataFrame,
    config: CurationConfig = CurationConfig(),
    sizes_of: DataFrame | None = None,
) -> DataFrame:
    """One example per turn: the whole earlier conversation, the request, the answer.

    Histories are never trimmed, so the output grows with the square of a session.
    """
    # The texts travel in one struct: as columns of their own they would be shuffled twice,
    # once for themselves and once as the window's argument.
    packed = turns.select(
        "session_id", *_TURN_ORDER, F.struct("request", "response").alias("turn")
    )
    usual, large = split_by_group_size(
        packed, "session_id", config.long_history_turns, config.broadcast_rows, sizes_of
    )
    with_history = _history_in_one_task(usual)
    if large is not None:
        with_history = with_history.unionByName(
            _history_by_blocks(large, config.history_block_turns)
        )
    messages, transcript = example_texts(F.col("history"), F.col("turn.request"))
    return with_history.select(
        F.col("trace_id").alias("example_id"),
        "session_id",
        "turn_no",
        messages.alias("messages"),
        F.col("turn.response").alias("target_response"),
        transcript.alias("conversation_str"),
    )
