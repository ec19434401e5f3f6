"""What the corpus operators share: tables, stored stages, views of texts, hashes of words."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracecurate.sources.staging import materialize

PIECE = 1 << 20  # bytes of text whose arrays are held at once


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """A stage in the shared folder: it survives lost executors and cuts the lineage."""
    return materialize(df, name)


def narrow(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under the operator's own names; any others stay outside."""
    return df.select(*[F.col(f"`{source}`").alias(name) for name, source in columns.items()])


def filter_texts(docs: DataFrame, text_col: str, make: Callable[[], Callable[[list[bytes]], list[bool]]]) -> DataFrame:
    """The rows of ``docs`` whose text passes; no row moves. ``make`` builds the test once a task."""
    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        test = make()
        for batch in batches:
            yield batch.filter(pa.array(test(list(byte_texts(batch.column(place)))), pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def byte_texts(column: pa.Array) -> Iterator[bytes]:
    """The UTF-8 bytes of each text, one at a time; null reads as empty."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    for value in column.cast(kind):
        yield value.as_py() or b""


def _mix(x: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every bit of a 64-bit value."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def seeds(count: int, start: int) -> np.ndarray:
    """Fixed pseudo-random 64-bit values, the same in every process."""
    return _mix((np.arange(1, count + 1, dtype=np.uint64) + np.uint64(start)) * np.uint64(0x9E3779B97F4A7C15))


_BYTE_CODES = seeds(256, 1)
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS = np.ones(1, dtype=np.uint64)
_INVERSES = np.ones(1, dtype=np.uint64)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


def _powers(length: int) -> tuple[np.ndarray, np.ndarray]:
    global _POWERS, _INVERSES
    if len(_POWERS) < length:
        size = max(length, PIECE + 1)
        base = np.full(size, _BASE, dtype=np.uint64)
        inverse = np.full(size, _INVERSE, dtype=np.uint64)
        base[0] = inverse[0] = 1
        _POWERS, _INVERSES = np.multiply.accumulate(base), np.multiply.accumulate(inverse)
    return _POWERS, _INVERSES


def word_hashes(text: bytes) -> np.ndarray:
    """A 64-bit hash of each word of ``text``, words being runs of bytes other than ASCII blanks.

    The text is read in pieces that end at a blank, so memory does not grow with its length.
    """
    out, start = [], 0
    while start < len(text):
        end = min(len(text), start + PIECE)
        while end < len(text) and not _SPACE[text[end]]:
            end += 1
        out.append(_piece_hashes(np.frombuffer(text, dtype=np.uint8, count=end - start, offset=start)))
        start = end
    return np.concatenate(out) if out else np.zeros(0, dtype=np.uint64)


def _piece_hashes(data: np.ndarray) -> np.ndarray:
    inside = np.zeros(len(data) + 2, dtype=np.int8)
    inside[1:-1] = ~_SPACE[data]
    edges = np.diff(inside)
    first, last = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    powers, inverses = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTE_CODES[data] * powers[: len(data)], out=sums[1:])
    return _mix((sums[last] - sums[first]) * inverses[first] + (last - first).astype(np.uint64))


_STEP = np.uint64(0xD6E8FEB86659FD93)


def shingle_runs(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the runs of ``size`` words in their order; all of a shorter text is one run."""
    if not len(words):
        return words
    size = min(size, len(words))
    count = len(words) - size + 1
    mixed = words[:count].copy()
    for k in range(1, size):
        mixed = _mix(mixed * _STEP + words[k : k + count])
    return mixed


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """The same, sorted and distinct."""
    return np.unique(shingle_runs(words, size))
