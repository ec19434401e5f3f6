"""Histories from stored turns: a turn is stored once, an example is rendered where it is read.

A numbered turn leads back to the one before it, its number less one, down to the first of its
session. The stored table is therefore linear in the turns, where histories are quadratic. An
example is rendered from the turns of its own block and from what came in earlier blocks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..config import CurationConfig
from .increments import sift
from .sessions import example_texts, sessionize

_BLOCK = ["session_id", "_block"]


def chain_turns(
    turns: DataFrame,
    config: CurationConfig = CurationConfig(),
    sizes_of: DataFrame | None = None,
) -> DataFrame:
    """(example_id, session_id, turn_no, request, response): each turn with its place."""
    return sessionize(turns, config, sizes_of).select(
        F.col("trace_id").alias("example_id"), "session_id", "turn_no", "request", "response"
    )


def render_examples(
    chain: DataFrame,
    wanted: DataFrame | None = None,
    config: CurationConfig = CurationConfig(),
) -> DataFrame:
    """The examples of ``wanted`` with ``messages``, ``target_response`` and ``conversation_str``.

    ``chain`` is a stored table of ``chain_turns``. ``wanted`` has ``session_id`` and ``turn_no``,
    and any further columns, which stay; None asks for every turn. Rows that name no turn of
    the chain give nothing, and a row that is there twice is rendered twice.

    All joins go by session and block, so a session of any size is spread, and of a session
    only blocks up to the last wanted turn move. What came before a block is put together
    in a task of its own, and only for blocks in which a turn is wanted.
    """
    size = config.history_block_turns
    partitions = int(chain.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    block = F.floor((F.col("turn_no") - 1) / size)
    turns = chain.select("session_id", "turn_no", F.struct("request", "response").alias("turn"))
    if wanted is None:
        wanted = chain.select("example_id", "session_id", "turn_no")
        turns = turns.withColumn("_block", block)
    else:
        last = wanted.groupBy("session_id").agg(F.max(block).alias("_last"))
        needed = last.select("session_id", F.explode(F.sequence(F.lit(0).cast("bigint"), "_last")).alias("_block"))
        turns = sift(turns, wanted, "session_id").withColumn("_block", block).join(needed, _BLOCK)
    wanted = wanted.withColumn("_block", block)

    # The partition count is given: by the small input size alone, AQE would put all blocks
    # into one task, which then writes all of the far larger output.
    in_order = F.sort_array(F.collect_list(F.struct("turn_no", "turn")))
    blocks = turns.repartition(partitions, *_BLOCK).groupBy(*_BLOCK).agg(in_order["turn"].alias("_turns"))
    sent = (
        wanted.filter("_block > 0")
        .select(*_BLOCK)
        .distinct()
        .select(
            "session_id",
            F.col("_block").alias("_to"),
            F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_block") - 1)).alias("_block"),
        )
    )
    parts = F.sort_array(F.collect_list(F.struct("_block", "_turns")))
    earlier = (
        sent.join(blocks.hint("merge"), _BLOCK)
        .groupBy("session_id", "_to")
        .agg(F.flatten(parts["_turns"]).alias("_earlier"))
        .withColumnRenamed("_to", "_block")
    )
    # The size of the histories is not that of the input, so they are never broadcast.
    rows = wanted.join(blocks.hint("merge"), _BLOCK).join(earlier.hint("merge"), _BLOCK, "left")
    place = (F.pmod(F.col("turn_no") - 1, F.lit(size)) + 1).cast("int")
    recent = F.slice("_turns", F.lit(1), place - 1)
    history = F.when(F.col("_earlier").isNull(), recent).otherwise(F.concat("_earlier", recent))
    turn = F.get("_turns", place - 1)
    packed = rows.select(*wanted.drop("_block").columns, history.alias("history"), turn.alias("turn"))
    messages, transcript = example_texts(F.col("history"), F.col("turn.request"))
    return packed.filter(F.col("turn").isNotNull()).select(
        *wanted.drop("_block").columns,
        messages.alias("messages"),
        F.col("turn.response").alias("target_response"),
        transcript.alias("conversation_str"),
    )
