"""Sharding by multi-way Karmarkar-Karp differencing of indivisible groups.

Groups of rows with equal text stay together. The groups are dealt into bins by a hash; in
each bin, differencing packs them into many bundles, again and again until one bin is left,
whose bundles are differenced into the shards. A bin holds a bounded number of groups or of
bundles, so no task and nothing on the driver sees all of them. A group larger than a
bundle stays a bundle of its own, so the last differencing can fill the other shards
around it.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import narrow, stored


def differencing(sizes: np.ndarray, parts: int) -> np.ndarray:
    """The part of each item: the two partial partitions of largest spread are combined,
    one in falling and one in rising order, until one partition is left."""
    count = len(sizes)
    if not count:
        return np.zeros(0, dtype=np.int32)
    heap, sums = [], {}
    for item, size in enumerate(sizes):
        # A single item is a partition with one filled part; it is expanded when combined.
        heap.append((-int(size), item))
    heapq.heapify(heap)
    joined: list[tuple[int, int, np.ndarray]] = []

    def taken(node: int) -> np.ndarray:
        if node >= count:
            return sums.pop(node)
        alone = np.zeros(parts, dtype=np.int64)
        alone[0] = sizes[node]
        return alone

    while len(heap) > 1:
        a, b = heapq.heappop(heap)[1], heapq.heappop(heap)[1]
        both = taken(a) + taken(b)[::-1]
        order = np.argsort(-both, kind="stable")
        both = both[order]
        place = np.empty(parts, dtype=np.int32)
        place[order] = np.arange(parts, dtype=np.int32)
        node = count + len(joined)
        joined.append((a, b, place))
        sums[node] = both
        heapq.heappush(heap, (-int(both[0] - both[-1]), node))
    out = np.zeros(count, dtype=np.int32)
    slots = {heap[0][1]: np.arange(parts, dtype=np.int32)}
    for node in range(count + len(joined) - 1, -1, -1):
        own = slots.pop(node)
        if node < count:
            out[node] = own[0]
        else:
            a, b, place = joined[node - count]
            final = own[place]
            slots[a], slots[b] = final, final[::-1]
    return out


def _pack(items: DataFrame, key: str, bins: int, parts: int) -> DataFrame:
    """(key, bytes) -> (key, bytes, bin, part), differenced inside each bin."""

    def solve(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["bytes", key], ascending=[False, True], ignore_index=True)
        return frame.assign(part=differencing(frame["bytes"].to_numpy(), parts))

    kind = items.schema[key].dataType.simpleString()
    binned = items.select(key, "bytes", F.expr(f"cast(pmod(xxhash64({key}, 7), {bins}) as int)").alias("bin"))
    return binned.groupBy("bin").applyInPandas(solve, f"{key} {kind}, bytes bigint, bin int, part int")


def assign_groups(groups: DataFrame, key: str, shards: int, rows: int, per_bin: int = 20_000, bundles: int = 16) -> DataFrame:
    """(key, bytes) -> (key, shard). ``rows`` is an upper bound of the number of groups,
    ``bundles`` the bundles of a bin per shard."""
    bins = -(-rows // per_bin)
    if bins <= 1:
        return _pack(groups, key, 1, shards).select(key, F.col("part").alias("shard"))
    parts = shards * bundles
    packed = stored(_pack(groups, key, bins, parts), "bundles")
    bundle = f"{key}_bundle"
    named = packed.select(key, "bytes", F.expr(f"cast(bin as bigint) * {parts} + part").alias(bundle))
    above = named.groupBy(bundle).agg(F.sum("bytes").alias("bytes"))
    # At most so many bundles fit in the bins above; each level has fewer.
    placed = assign_groups(above, bundle, shards, bins * parts, max(per_bin, 2 * parts), bundles)
    return named.select(key, bundle).join(placed, bundle).select(key, "shard")


def shard_documents(
    docs: DataFrame,
    shards: int = 40,
    overhead: int = 16,
    id_col: str = "doc_id",
    text_col: str = "text",
    per_bin: int = 20_000,
) -> DataFrame:
    """Every row's shard and its slot there, as (doc_id, size, text_crc32, law, shard, slot, grown_shard).

    The size is the UTF-8 length of the text plus ``overhead``. Null texts count as empty
    ones in size and checksum and form a group of their own; null ids and repeated rows are
    rows like any other. Slots are gapless from 0 in each shard. An empty table gives no rows.
    """
    source = narrow(docs, doc_id=id_col, text=text_col)
    rows = stored(
        source.select(
            "doc_id",
            (F.coalesce(F.octet_length("text"), F.lit(0)) + overhead).cast("bigint").alias("size"),
            F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
            F.coalesce(F.unhex(F.md5("text")), F.lit(b"")).alias("digest"),
        ),
        "shard-rows",
    )
    count = rows.count()
    groups = rows.groupBy("digest").agg(F.sum("size").alias("bytes"))
    placed = stored(
        rows.join(assign_groups(groups, "digest", shards, count, per_bin), "digest").select(
            "doc_id", "size", "text_crc32", "shard", F.expr(f"pmod(xxhash64(doc_id, size), {1 + count // 100_000})").alias("tray")
        ),
        "sharded",
    )
    # A shard is numbered tray by tray, from the counts of the trays before.
    trays = placed.groupBy("shard", "tray").agg(F.count("*").alias("n"))
    before = trays.select(
        "shard", "tray", (F.sum("n").over(W.partitionBy("shard").orderBy("tray")) - F.col("n")).alias("offset")
    )
    inside = W.partitionBy("shard", "tray").orderBy("doc_id", "text_crc32", "size")
    return (
        placed.withColumn("nr", F.row_number().over(inside))
        .join(before, ["shard", "tray"])
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("bytes").alias("law"),
            "shard",
            (F.col("offset") + F.col("nr") - 1).cast("bigint").alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )
