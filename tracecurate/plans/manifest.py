"""What a run has finished: a record per stage, so that a run that broke off goes on.

The fingerprint of a stage is made of the input's files, of the settings that the stage depends
on and of the fingerprints of the stages it reads. Its record is written after its table. A stage
whose record has the same fingerprint is read back instead of built. Records are blanked before
a table is overwritten, so one that was written in part is never taken for whole.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from ..config import CurationConfig
from ..sources.staging import materialize

_RECORD = "fingerprint string, columns string, counts string"


def _digest(*parts) -> str:
    return hashlib.sha256(json.dumps(parts, default=str).encode()).hexdigest()


def _found(read: Callable[[], DataFrame]) -> DataFrame | None:
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def source_fingerprint(df: DataFrame) -> str | None:
    """Names, sizes and times of the files below ``df``, and what is done to them; None if it
    reads no files that can be listed. Contents are not read."""
    paths = [unquote(path) for path in df.inputFiles()]
    spark = df.sparkSession
    files = _found(lambda: spark.read.format("binaryFile").load(paths)) if paths else None
    if files is None:
        return None
    file = F.xxhash64("path", "modificationTime", "length")
    sums = F.count("*"), F.bit_xor(file), F.sum(file.cast("decimal(20,0)"))
    return _digest(df.semanticHash(), df.schema.json(), *files.agg(*sums).first())


@dataclass(frozen=True)
class Stage:
    fingerprint: str
    table: DataFrame | None
    counts: dict[str, int]


class Run:
    """The stages below ``out``. Without a ``source`` none is taken over from an earlier run."""

    def __init__(self, spark: SparkSession, out: str, config: CurationConfig, source: str | None):
        self.spark, self.out, self.config = spark, out, config
        self.source = source or uuid.uuid4().hex

    def _path(self, name: str) -> str:
        return f"{self.out}/manifest/{name}"

    def _finished(self, name: str, fingerprint: str):
        read = _found(lambda: self.spark.read.schema(_RECORD).json(self._path(name)))
        rows = [] if read is None else read.collect()
        return next((row for row in rows if row["fingerprint"] == fingerprint), None)

    def _record(self, name: str, fingerprint: str = "", columns: str = "", counts: str = "") -> None:
        values = {"fingerprint": fingerprint, "columns": columns, "counts": counts}
        row = self.spark.range(0, 1, 1, 1).select(*[F.lit(v).alias(k) for k, v in values.items()])
        row.write.mode("overwrite").json(self._path(name))

    def _fingerprint(self, name: str, after: Iterable[Stage], settings: Iterable[str], also: str) -> str:
        own = {field: getattr(self.config, field) for field in settings}
        return _digest(name, self.source, own, [stage.fingerprint for stage in after], also)

    def stage(
        self,
        name: str,
        build: Callable[[], DataFrame],
        after: Iterable[Stage] = (),
        settings: Iterable[str] = (),
        seen: Observation | None = None,
        count: Callable[[DataFrame], dict[str, int]] | None = None,
        also: str = "",
    ) -> Stage:
        """The stored table ``name``, from ``build`` unless a run has finished it.

        ``seen`` observes counts while the table is written, ``count`` takes further ones from it.
        """
        fingerprint = self._fingerprint(name, after, settings, also)
        path = f"{self.out}/{name}"
        done = self._finished(name, fingerprint)
        if done is not None:
            columns = T.StructType.fromJson(json.loads(done["columns"]))
            table = self.spark.read.schema(columns).parquet(path)
            return Stage(fingerprint, table, json.loads(done["counts"]))
        self._record(name)
        df = build()
        table = materialize(df, name, path)
        counts = (seen.get if seen is not None else {}) | (count(table) if count else {})
        self._record(name, fingerprint, df.schema.json(), json.dumps(counts))
        return Stage(fingerprint, table, counts)

    def step(self, name: str, write: Callable[[], None], after: Iterable[Stage] = (), also: str = "") -> None:
        """Something written that no stage reads, such as an export."""
        fingerprint = self._fingerprint(name, after, (), also)
        if self._finished(name, fingerprint) is None:
            self._record(name)
            write()
            self._record(name, fingerprint)
