"""Substring dedup by content-defined chunking.

A gear hash rolls over the bytes of a text; a chunk ends where the hash is the greatest of its
neighbourhood, so that cuts depend on the bytes around them only and an insertion moves none
beyond it. Chunks with equal digests are copies; the first by document id and place stays.
Runs of copied chunks are reported, and can be cut out of the texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import PIECE, byte_texts, narrow, seeds, stored

WINDOW = 16  # bytes that the hash depends on
REACH = 20  # a cut has no greater hash so many bytes before or after it
LONGEST = 256  # bytes of a chunk in a text without cuts, such as a row of equal marks

_GEAR = (seeds(256, 1000) >> np.uint64(32)).astype(np.uint32)


def gear(data: np.ndarray) -> np.ndarray:
    """h = 4 h + gear[byte], modulo 2**32, for each byte: a sum over the last WINDOW bytes,
    built by doubling the number of bytes summed."""
    hashes, span = _GEAR[data], 1
    while span < WINDOW:
        older = np.zeros_like(hashes)
        older[span:] = hashes[:-span]
        hashes = hashes + (older << np.uint32(2 * span))
        span *= 2
    return hashes


def _greatest(values: np.ndarray, width: int) -> np.ndarray:
    """The greatest of each value and the ``width - 1`` before it."""
    out, span = values.copy(), 1
    while span < width:
        step = min(span, width - span)
        before = out[:-step].copy()
        np.maximum(out[step:], before, out=out[step:])
        span += step
    return out


def cuts(text: bytes) -> np.ndarray:
    """The ends of the chunks of a text, the last being its end."""
    found, margin = [], WINDOW + REACH + 1
    for start in range(0, len(text), PIECE):  # the hash needs some bytes around a piece
        begin, end = max(0, start - margin), min(len(text), start + PIECE + REACH + 1)
        hashes = gear(np.frombuffer(text, dtype=np.uint8, count=end - begin, offset=begin))
        before = _greatest(hashes, REACH + 1)
        after = _greatest(hashes[::-1], REACH + 1)[::-1]
        peak = (hashes == after) & (hashes == before)
        peak[1:] &= before[:-1] < hashes[1:]
        at = np.flatnonzero(peak) + begin + 1
        # Too near either end of the text for the hash or its neighbourhood to be whole.
        at = at[(at > start) & (at <= start + PIECE) & (at >= margin) & (at <= len(text) - REACH)]
        found.append(at)
    ends = np.concatenate([*found, [len(text)]]).astype(np.int64) if text else np.zeros(0, dtype=np.int64)
    gaps = np.diff(ends, prepend=0)
    if len(gaps) and gaps.max() > LONGEST:  # counted from the cut before
        parts = -(-gaps // LONGEST)
        starts = ends - gaps
        index = np.arange(int(parts.sum())) - np.repeat(np.cumsum(parts) - parts, parts) + 1
        ends = np.minimum(np.repeat(starts, parts) + index * LONGEST, np.repeat(ends, parts))
    return ends


def chunk_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, version, chunk, start, bytes, last, digest) of every chunk of every text, in bytes
    of UTF-8; ``last`` is the chunk at the end of its text. ``version`` tells apart rows of one id
    with different texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, chunks, starts, sizes, lasts, digests = [], [], [], [], [], []
            held = 0
            rows_of = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), byte_texts(batch.column(2)), strict=True)
            for doc, version, text in rows_of:
                ends = cuts(text)
                begins = np.concatenate([[0], ends[:-1]]).astype(np.int64)[: len(ends)]
                view = memoryview(text)
                for k in range(0, len(ends), 50_000):
                    a, b = begins[k : k + 50_000], ends[k : k + 50_000]
                    digests += [hashlib.blake2b(view[x:y], digest_size=12).digest() for x, y in zip(a.tolist(), b.tolist(), strict=True)]
                    ids.append((doc, version, len(a)))
                    chunks.append(np.arange(k, k + len(a), dtype=np.int64))
                    starts.append(a)
                    sizes.append(b - a)
                    lasts.append(b == len(text))
                    held += len(a)
                    if held >= 50_000:
                        yield pack(ids, chunks, starts, sizes, lasts, digests)
                        ids, chunks, starts, sizes, lasts, digests, held = [], [], [], [], [], [], 0
            if held:
                yield pack(ids, chunks, starts, sizes, lasts, digests)

    def pack(ids, chunks, starts, sizes, lasts, digests) -> pa.RecordBatch:
        owner = pa.array(np.repeat(np.arange(len(ids)), [n for _, _, n in ids]))
        return pa.RecordBatch.from_arrays(
            [
                pa.array([d for d, _, _ in ids], id_type).take(owner),
                pa.array([v for _, v, _ in ids], pa.int32()).take(owner),
                pa.array(np.concatenate(chunks)),
                pa.array(np.concatenate(starts)),
                pa.array(np.concatenate(sizes).astype(np.int32)),
                pa.array(np.concatenate(lasts)),
                pa.array(digests, pa.binary()),
            ],
            ["doc_id", "version", "chunk", "start", "bytes", "last", "digest"],
        )

    rows = narrow(docs, doc_id=id_col, text=text_col).where("doc_id is not null and text is not null")
    rows = rows.select("doc_id", F.hash("text").alias("version"), "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    id_type = pa.string() if kind == "string" else pa.int32() if kind == "int" else pa.int64()
    return rows.mapInArrow(run, f"doc_id {kind}, version int, chunk bigint, start bigint, bytes int, last boolean, digest binary")


def find_repeats(docs: DataFrame, least_bytes: int = 64, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Repeated stretches as (doc_id, first_doc_id, start, end, chunks), offsets in UTF-8 bytes.

    A stretch is a run of neighbouring chunks that each occurred before, in a document of a
    smaller id or earlier in the same one, of at least ``least_bytes`` unless it is a whole text,
    which may be of any size; ``first_doc_id`` is the smallest document that holds one of its
    chunks. Documents without an id, null and empty texts are in no row. Rows of one id and text are one document, so neither is a copy
    of the other; rows of one id and different texts are compared like any two.
    """
    return _stretches(docs, least_bytes, id_col, text_col).drop("version")


def _stretches(docs: DataFrame, least_bytes: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    chunks = stored(chunk_table(docs, id_col, text_col), "chunks")
    place = F.struct("doc_id", "version", "chunk")
    firsts = chunks.groupBy("digest").agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first < last")
    # A digest with many copies is one row here; its copies are on the side that can be split.
    firsts = firsts.select(F.col("digest").alias("_digest"), "first")
    copies = (
        chunks.join(firsts, F.col("digest") == F.col("_digest"))
        .where(place > F.col("first"))
        .select("doc_id", "version", "chunk", "start", (F.col("start") + F.col("bytes")).alias("end"), "last", F.col("first.doc_id").alias("first_doc_id"))
    )
    order = W.partitionBy("doc_id", "version").orderBy("chunk")
    return (
        copies.withColumn("run", F.col("chunk") - F.dense_rank().over(order))
        .groupBy("doc_id", "version", "run")
        .agg(
            F.min("first_doc_id").alias("first_doc_id"),
            F.min("start").alias("start"),
            F.max("end").alias("end"),
            F.count_distinct("chunk").alias("chunks"),
            ((F.min("start") == 0) & F.bool_or("last")).alias("whole"),
        )
        .where(F.col("whole") | (F.col("end") - F.col("start") >= least_bytes))
        .drop("run", "whole")
    )


def remove_repeats(docs: DataFrame, least_bytes: int = 64) -> DataFrame:
    """``docs`` with the repeated stretches cut out of ``text``; where a cut falls inside a
    character, that character stays. Other columns and rows are kept as they are."""
    found = _stretches(docs, least_bytes).groupBy("doc_id", "version")
    spans = found.agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias("_spans"))

    @F.pandas_udf("string")
    def cut(texts, cuts_of):
        import pandas as pd

        out = []
        for text, found in zip(texts, cuts_of, strict=True):
            if text is None or found is None:
                out.append(text)
                continue
            data, at, kept = text.encode(), 0, []
            for span in found:
                begin, end = span["start"], span["end"]
                while begin < end and data[begin] & 0xC0 == 0x80:
                    begin += 1
                while end > begin and end < len(data) and data[end] & 0xC0 == 0x80:
                    end -= 1
                kept.append(data[at:begin])
                at = max(at, end)
            out.append(b"".join([*kept, data[at:]]).decode())
        return pd.Series(out)

    joined = docs.alias("_d").join(
        spans.alias("_s"), (F.col("_d.doc_id") == F.col("_s.doc_id")) & (F.hash("_d.text") == F.col("_s.version")), "left"
    )
    text = cut(F.col("_d.text"), F.col("_s._spans")).alias("text")
    return joined.select(*[text if c == "text" else F.col(f"_d.`{c}`").alias(c) for c in docs.columns])
