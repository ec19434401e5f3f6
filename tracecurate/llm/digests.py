"""Document fingerprints: a quartile bucket digest.

Every window of five bytes gives six triplets: its first byte and two of the four that follow.
Triplets are hashed into buckets and counted over the whole text. A bucket's code is the number
of quartiles of all counts that its own count exceeds, 0 to 3, so the codes of two texts agree
where the same triplets are common, wherever they stand. The digest spells the logarithm of the
length, the ratios of the quartiles, and the codes as hexadecimal digits. Two digests differ by
the sum of the differences of their codes, lengths and ratios, each of them bounded.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import PIECE, byte_texts, narrow, seeds, stored

BUCKETS = 256
BLOCK_BYTES = 8 << 20  # of text in a block, as long as there are not too many blocks
MOST_BLOCKS = 1 << 16
_SAMPLES = 20  # sampled documents a block
_AHEAD = 4
_TRIPLETS = [(i, j) for i in range(1, _AHEAD) for j in range(i + 1, _AHEAD + 1)]
_FACTORS = (seeds(3 * len(_TRIPLETS), 7_000) >> np.uint64(32)).astype(np.uint32).reshape(-1, 3) | np.uint32(1)
_LENGTH_STEPS = 8  # codes a doubling of the length
_LENGTH_CAP = 32
_LENGTH_WEIGHT = 4
_RATIO_WEIGHT = 4
MOST = 3 * BUCKETS + _LENGTH_CAP * _LENGTH_WEIGHT + 2 * 15 * _RATIO_WEIGHT


def bucket_counts(texts: list[bytes]) -> np.ndarray:
    """Counts of triplets, one row a text. Texts are read in pieces, so that the arrays held at
    once do not grow with their length; zeros follow the end of a text."""
    counts = np.zeros((len(texts), BUCKETS), dtype=np.int64)
    parts: list[bytes] = []
    owners: list[int] = []
    size = 0

    def count() -> None:
        data = np.frombuffer(b"".join(parts), dtype=np.uint8).astype(np.uint32)
        lengths = np.array([len(part) for part in parts])
        row = np.repeat(np.arange(len(parts)) * BUCKETS, lengths)
        ends = np.cumsum(lengths)
        inside = np.ones(len(data), dtype=bool)
        inside[(ends[:, None] - np.arange(1, _AHEAD + 1)).ravel()] = False
        at = np.flatnonzero(inside)
        row, first = row[at], data[at]
        total = np.zeros(len(parts) * BUCKETS, dtype=np.int64)
        for (i, j), (a, b, c) in zip(_TRIPLETS, _FACTORS):
            mixed = first * a ^ data[at + i] * b ^ data[at + j] * c
            mixed = (mixed ^ (mixed >> np.uint32(15))) * np.uint32(0x9E3779B1)
            total += np.bincount(row + (mixed >> np.uint32(24)), minlength=len(total))
        np.add.at(counts, owners, total.reshape(-1, BUCKETS))

    for k, text in enumerate(texts):
        for start in range(0, len(text), PIECE):
            used = min(PIECE, len(text) - start)
            parts.append(text[start : start + used + _AHEAD].ljust(used + _AHEAD, b"\0"))
            owners.append(k)
            size += used
            if size >= PIECE:
                count()
                parts, owners, size = [], [], 0
    if parts:
        count()
    return counts


def digests(texts: list[bytes]) -> list[bytes]:
    """The digest of each text: a byte of length, one of two quartile ratios, the codes."""
    if not texts:
        return []
    counts = bucket_counts(texts)
    ordered = np.sort(counts, axis=1)
    q1, q2, q3 = (ordered[:, BUCKETS * k // 4 - 1] for k in (1, 2, 3))
    codes = sum((counts > q[:, None]).astype(np.uint8) for q in (q1, q2, q3))
    quads = codes.reshape(len(texts), -1, 4)
    body = quads[..., 0] << 6 | quads[..., 1] << 4 | quads[..., 2] << 2 | quads[..., 3]
    lengths = np.array([len(text) for text in texts], dtype=np.float64)
    header = np.empty((len(texts), 2), dtype=np.uint8)
    header[:, 0] = np.minimum(np.round(np.log2(lengths + 1) * _LENGTH_STEPS), 255)
    top = np.maximum(q3, 1)
    header[:, 1] = np.minimum(q1 * 16 // top, 15) << 4 | np.minimum(q2 * 16 // top, 15)
    return [row.tobytes() for row in np.concatenate([header, body.astype(np.uint8)], axis=1)]


def fingerprints(texts: list[bytes]) -> list[str]:
    """The digests as hexadecimal digits."""
    return [digest.hex() for digest in digests(texts)]


def likeness(a: list[bytes], b: list[bytes]) -> np.ndarray:
    """1 for equal digests, 0 for the greatest difference there can be."""
    x, y = (np.frombuffer(b"".join(d), dtype=np.uint8).reshape(len(d), -1).astype(np.int16) for d in (a, b))
    length = np.minimum(np.abs(x[:, 0] - y[:, 0]), _LENGTH_CAP) * _LENGTH_WEIGHT
    ratios = (np.abs((x[:, 1] >> 4) - (y[:, 1] >> 4)) + np.abs((x[:, 1] & 15) - (y[:, 1] & 15))) * _RATIO_WEIGHT
    codes = sum(np.abs((x[:, 2:] >> s & 3) - (y[:, 2:] >> s & 3)).sum(axis=1) for s in (0, 2, 4, 6))
    return 1 - (length + ratios + codes) / MOST


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint) of every row, where it is: no row moves. Null reads as empty."""
    rows = narrow(docs, doc_id=id_col, text=text_col)
    place = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = pa.array(fingerprints(list(byte_texts(batch.column(1)))), pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), prints], names=["doc_id", "fingerprint"])

    return rows.mapInArrow(run, f"doc_id {place}, fingerprint string")


def _order(doc_id, version: int) -> tuple:
    """Documents go by id, null ids first, then by the hash of their text."""
    return (doc_id is not None, 0 if doc_id is None else doc_id, version)


def _dealt(rows: DataFrame, splitters: list[tuple]) -> DataFrame:
    """``rows`` (doc_id, version, text) with their block, the number of splitters up to them. A
    splitter, the first document of its block, also goes to the block before, as its guest.
    What a task has sent once it does not send again."""
    shared = rows.sparkSession.sparkContext.broadcast(splitters)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cuts, seen = shared.value, set()
        for batch in batches:
            at: list[int] = []
            blocks: list[int] = []
            guests: list[bool] = []
            for k, name in enumerate(map(_order, batch.column("doc_id").to_pylist(), batch.column("version").to_pylist())):
                if name in seen:
                    continue
                seen.add(name)
                block = bisect_right(cuts, name) - 1
                at.append(k)
                blocks.append(block)
                guests.append(False)
                if cuts[block] == name:
                    at.append(k)
                    blocks.append((block - 1) % len(cuts))
                    guests.append(True)
            columns = [c.take(pa.array(at, pa.int64())) for c in batch.columns]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(blocks, pa.int32()), pa.array(guests, pa.bool_())], names=[*batch.schema.names, "block", "guest"])

    return rows.mapInArrow(run, rows.select("*", F.lit(0).alias("block"), F.lit(True).alias("guest")).schema)


def _edits(dealt: DataFrame) -> DataFrame:
    """One row a document, from blocks in order: each document meets the one after it, the last
    of a block its guest. Two documents are held besides the batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # (name, guest, doc_id, version, text, digest)
        for batch in batches:
            own = []
            before = last and last[0]
            for block, guest, doc_id, version, text in zip(*[batch.column(c).to_pylist() for c in ("block", "guest", "doc_id", "version", "text")]):
                name = (block, guest, doc_id, version)
                if name != before:
                    own.append((name, guest, doc_id, version, text))
                before = name
            prints = digests([d[4].encode() for d in own])
            run_ = [*([last] if last else []), *[(*d, p) for d, p in zip(own, prints)]]
            pairs = [(a, b) for a, b in zip(run_, run_[1:]) if not a[1]]
            last = run_[-1] if run_ else None
            if not pairs:
                continue
            edited = [(a[4][: len(a[4]) - len(a[4]) // 4] + b[4][: len(a[4]) // 4]).encode() for a, b in pairs]
            edited_prints, own_prints = digests(edited), [a[5] for a, _ in pairs]
            columns = [
                pa.array([a[2] for a, _ in pairs], batch.column("doc_id").type),
                pa.array([a[3] for a, _ in pairs], pa.int64()),
                pa.array([len(a[4]) for a, _ in pairs], pa.int64()),
                pa.array([hashlib.sha256(e).digest() for e in edited], pa.binary()),
                pa.array(own_prints, pa.binary()),
                pa.array(edited_prints, pa.binary()),
                pa.array(likeness(own_prints, edited_prints), pa.float64()),
                pa.array(likeness(own_prints, [b[5] for _, b in pairs]), pa.float64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["_id", "_version", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    kind = dealt.schema["doc_id"].dataType.simpleString()
    schema = f"_id {kind}, _version bigint, n_chars bigint, edited_sha256 binary, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double"
    return dealt.mapInArrow(run, schema)


def fingerprint_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next)
    for every row of ``docs``.

    The edited text has its last quarter of code points replaced by the first as many of the
    next document, or all of it; ``near_next`` compares with the next document as it is. Null
    texts read as empty. Rows equal in id and text are one document. Documents are ordered by id,
    null ids first, then by a hash of the text; the first follows the last, and a single document
    follows itself. An empty table gives none.

    Splitters come from a bounded sample of ids and hashes. Each text is sent once, to the
    range between two splitters, where its block is sorted and read as a stream.
    """
    rows = narrow(docs, doc_id=id_col, text=text_col).withColumn("text", F.coalesce("text", F.lit("")))
    rows = rows.select("doc_id", F.xxhash64("text").alias("version"), "text")
    names = stored(rows.select("doc_id", "version", F.octet_length("text").alias("size")), "names")
    whole = names.agg(F.count("*").alias("rows"), F.sum(F.col("size").cast("bigint")).alias("bytes")).first()
    kind = names.schema["doc_id"].dataType.simpleString()
    if not whole["rows"]:
        schema = f"doc_id {kind}, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
        return docs.sparkSession.createDataFrame([], schema)
    blocks = min(MOST_BLOCKS, 1 + whole["bytes"] // BLOCK_BYTES)
    every = max(1, whole["rows"] // (_SAMPLES * blocks))
    # About _SAMPLES names a block, and the first of all.
    sample = names.where(F.pmod(F.xxhash64("doc_id", "version"), F.lit(every)) == 0).select("doc_id", "version").distinct()
    ordered = sorted({_order(*r) for r in sample.limit(2 * _SAMPLES * blocks).collect()})
    first = names.select("doc_id", "version").orderBy(F.col("doc_id").asc_nulls_first(), "version").first()
    splitters = sorted({_order(*first), *[ordered[len(ordered) * k // blocks] for k in range(1, blocks) if ordered]})
    dealt = _dealt(rows, splitters)
    found = _edits(dealt.repartition("block").sortWithinPartitions("block", "guest", F.col("doc_id").asc_nulls_first(), "version"))
    # One row a document moves once more, to every row of that document; digests go as bytes.
    spelled = [F.lower(F.hex(c)).alias(c) for c in ("edited_sha256", "fingerprint", "edited_fingerprint")]
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("version") == F.col("_version"))
    return names.join(found, same).select("doc_id", "n_chars", *spelled, "near_edited", "near_next")
