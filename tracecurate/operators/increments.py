"""Sessions kept up to date: a log of changes instead of a table rebuilt for every batch.

The log holds, for each batch of new turns, the turns that were added, replaced (another number
or another delivery) or removed (a trace that now belongs to another session). What a session
looks like is told by the last entry of each of its traces. A batch reads only sessions
that it touches: they are found by hash buckets, so the rest of the log is not shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..config import CurationConfig
from ..sources.staging import materialize
from .sessions import sessionize

_SIEVE_BITS = 18
_TURN = ("session_id", "trace_id", "request_time", "request", "response")
CHANGES = T.StructType(
    [
        T.StructField("session_id", T.StringType()),
        T.StructField("trace_id", T.StringType()),
        T.StructField("request_time", T.TimestampType()),
        T.StructField("request", T.StringType()),
        T.StructField("response", T.StringType()),
        T.StructField("turn_no", T.IntegerType()),
        T.StructField("change", T.StringType()),
    ]
)


def content_hash() -> Column:
    return F.xxhash64("session_id", "request", "response")


def latest_deliveries(turns: DataFrame) -> DataFrame:
    """One row a trace: of several deliveries the latest, by time and then by a content hash.

    Unlike any one of them, this is the same in every run and in every order of arrival.
    """
    delivery = F.struct("request_time", content_hash(), "session_id", "request", "response")
    latest = turns.groupBy("trace_id").agg(F.max(delivery).alias("t"))
    return latest.select(*[F.col(c if c == "trace_id" else f"t.{c}").alias(c) for c in _TURN])


def sift(rows: DataFrame, keys: DataFrame, column: str) -> DataFrame:
    """The rows whose ``column`` may be among ``keys``, where they are.

    Hash buckets are sent, 2**18 at most whatever the number of keys. A bucket may hold other
    values too, so an exact join follows, of what is left.
    """
    bucket = F.xxhash64(column).bitwiseAND(2**_SIEVE_BITS - 1)
    wanted = keys.select(bucket.alias("_bucket")).distinct()
    sifted = rows.withColumn("_bucket", bucket).join(F.broadcast(wanted), "_bucket", "left_semi")
    return sifted.drop("_bucket")


def current_turns(log: DataFrame) -> DataFrame:
    """Numbered turns as the log leaves them."""
    rest = [c for c in CHANGES.names if c not in ("session_id", "trace_id")]
    last = log.groupBy("session_id", "trace_id").agg(F.max_by(F.struct(*rest), "batch").alias("t"))
    return last.filter("t.change != 'removed'").select(*[F.col(c if c in ("session_id", "trace_id") else f"t.{c}").alias(c) for c in (*_TURN, "turn_no")])


def session_changes(
    log: DataFrame, new: DataFrame, config: CurationConfig = CurationConfig()
) -> DataFrame:
    """What ``new`` turns change, in the columns of ``CHANGES``.

    Touched are the sessions of new turns and those that hold an earlier delivery of them. A turn
    that stays as it is gives no row, so the same batch again changes nothing.
    """
    new = materialize(latest_deliveries(new), "new-turns")
    ids, keys = new.select("trace_id"), log.select("session_id", "trace_id")
    held = sift(keys, ids, "trace_id").join(ids, "trace_id", "left_semi").select("session_id")
    touched = materialize(new.select("session_id").union(held).distinct(), "touched")
    entries = sift(log, touched, "session_id").join(touched, "session_id", "left_semi")
    before = materialize(current_turns(entries), "before")
    rebuilt = latest_deliveries(before.select(*_TURN).unionByName(new.select(*_TURN)))
    after = sessionize(rebuilt, config).select(*_TURN, "turn_no")

    kept = [c for c in CHANGES.names if c not in ("session_id", "trace_id", "change")]
    both = before.select("session_id", "trace_id", F.struct(*kept).alias("old")).join(
        after.select("session_id", "trace_id", F.struct(*kept).alias("new")),
        ["session_id", "trace_id"],
        "full",
    )
    change = (
        F.when(F.col("old").isNull(), "added")
        .when(F.col("new").isNull(), "removed")
        .when(F.col("old") != F.col("new"), "replaced")
    )
    row = F.coalesce("new", "old")
    found = both.select("session_id", "trace_id", row.alias("row"), change.alias("change"))
    return found.filter("change is not null").select(
        *[F.col(f"row.{c}").alias(c) if c in kept else F.col(c) for c in CHANGES.names]
    )


def open_log(spark: SparkSession, path: str) -> DataFrame:
    """The log below ``path``, begun if there is none."""
    spark.createDataFrame([], CHANGES).write.mode("ignore").parquet(f"{path}/batch=-1")
    return spark.read.schema(T.StructType([*CHANGES, T.StructField("batch", T.LongType())])).parquet(path)


def append_turns(
    new: DataFrame, path: str, batch: int, config: CurationConfig = CurationConfig()
) -> None:
    """Write the changes of one batch to the log below ``path``.

    Only earlier batches are read and the entry is overwritten, so a batch that broke off can
    be given again under its number.
    """
    earlier = open_log(new.sparkSession, path).filter(F.col("batch") < batch)
    changes = session_changes(earlier, new, config)
    changes.write.mode("overwrite").parquet(f"{path}/batch={batch}")


def read_sessions(spark: SparkSession, path: str, batch: int | None = None) -> DataFrame:
    """Numbered turns of all sessions, now or as they were after a batch."""
    log = open_log(spark, path)
    return current_turns(log if batch is None else log.filter(F.col("batch") <= batch))
