"""Traces as a stream: clean turns, repeated deliveries dropped, sessions kept in a log.

The stream runs the same ``clean_turns`` as a batch job. Its state store remembers which
deliveries were read lately and drops repeated ones before they reach the log; it forgets by the
time of reading, not by that of the event, so a trace that comes late is a turn like any other.
A delivery repeated after it was forgotten finds its turn in the log and changes nothing: the
state saves work, the result does not depend on it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..config import CurationConfig
from ..operators.increments import append_turns, content_hash
from ..operators.ingest import clean_turns
from ..schema import TRACES


def read_trace_stream(
    spark: SparkSession, path: str, file_format: str = "parquet", files_per_batch: int | None = None
) -> DataFrame:
    """Traces from the files of a folder, new ones as they come."""
    reader = spark.readStream.schema(TRACES).format(file_format)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def stream_turns(
    traces: DataFrame, config: CurationConfig = CurationConfig(), remember: str = "1 day"
) -> DataFrame:
    """Clean turns of a stream of traces, each delivery once while it is remembered.

    Two deliveries are the same if id, time and texts are; one that differs goes on.
    """
    turns = clean_turns(traces, config)
    seen = turns.withColumns({"_content": content_hash(), "_read_at": F.current_timestamp()})
    once = seen.withWatermark("_read_at", remember).dropDuplicatesWithinWatermark(
        ["trace_id", "request_time", "_content"]
    )
    return once.drop("_content", "_read_at")


def stream_sessions(
    traces: DataFrame,
    out: str,
    checkpoint: str,
    config: CurationConfig = CurationConfig(),
    remember: str = "1 day",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Start keeping the sessions of a stream in the log below ``out``.

    ``checkpoint`` holds what was read and the state; started again with it, the stream goes on
    where it ended. A batch that broke off comes again under its number and overwrites its
    entry, so nothing is lost or counted twice. ``trigger`` is that of ``writeStream``; by default
    all that is there is read, and the stream ends.
    """

    def keep(batch: DataFrame, number: int) -> None:
        append_turns(batch, out, number, config)

    writer = stream_turns(traces, config, remember).writeStream.foreachBatch(keep)
    writer = writer.option("checkpointLocation", checkpoint).queryName("sessions")
    return writer.trigger(**(trigger or {"availableNow": True})).start()
