"""Prefix trie of conversations, built in sorted shards under a skeleton of splitter paths.

A turn is a symbol, the digest of its role and text, and a conversation the path of its symbols.
Equal paths are one row, with their number. A bounded sample of paths gives splitters, each cut
to the shortest prefix that tells it from its neighbour, and splitters range-partition the paths
into shards. The skeleton is the trie of what lies above the splitters: only these nodes can have
members in more than one shard. It is broadcast, and every shard, sorted by path, finishes all
other nodes with a stack as deep as the path at hand. Of a skeleton node a shard gives a
partial aggregate, what lies below it outside the skeleton; the partials are summed, and the
skeleton, a few nodes a splitter, is added up from its leaves.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracecurate.operators.numbering import number_rows

from .common import stored

WIDTH = 16  # bytes of a symbol
SHARD_TURNS = 1 << 14  # turns of distinct paths in a shard, as long as there are not too many shards
MOST_SHARDS = 2048
_SAMPLES = 20  # sampled paths a shard
_SAMPLE_DEPTH = 64  # turns of a sampled path
_CHUNK = 1 << 20  # characters of joined ids in one row
_ROWS = 10_000
_NONE = hashlib.sha256(b"").hexdigest()
ROOT = hashlib.md5(b"").digest()

_NODE = "node binary, parent binary, depth bigint, size bigint, conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, ends_sha256 string, partial boolean"


def ordered_turns(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, pos, symbol, size): the turns of every conversation, numbered from 0.

    Order is by turn, null first, then by the digest of role and text. Null role and text are
    empty. Rows without an id belong to no conversation. Texts stay where they are; a
    conversation of any length is numbered by range partitions.
    """
    role, text = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role_col, text_col))
    rows = turns.select(
        F.col(f"`{id_col}`").cast("bigint").alias("conv_id"),
        F.col(f"`{turn_col}`").alias("turn"),
        F.unhex(F.md5(F.concat(F.md5(role), text))).alias("symbol"),
        F.octet_length(text).cast("bigint").alias("size"),
        F.monotonically_increasing_id().alias("salt"),  # so that rows repeated very often are split
    ).where("conv_id is not null")
    numbered = stored(number_rows(rows, "conv_id", "turn", "symbol", "salt", name="place").drop("turn", "salt"), "places")
    firsts = numbered.groupBy("conv_id").agg(F.min("place").alias("first"))
    return numbered.join(firsts, "conv_id").select("conv_id", (F.col("place") - F.col("first")).alias("pos"), "symbol", "size")


def with_borrowed_starts(turns: DataFrame, conversations: DataFrame, group: int = 5, most: int = 9) -> DataFrame:
    """Turns of rebuilt conversations: c begins with the first h turns of conversation
    c - c % group, all if it has fewer and none if it is absent, and goes on with its own turns
    after its first h; h = crc32(c in decimal) % most."""
    taken = lambda c: F.crc32(c.cast("string").cast("binary")) % most
    own = turns.where(F.col("pos") >= taken(F.col("conv_id")))
    c = F.col("conv_id")
    near = F.filter(F.transform(F.array(*[F.lit(k) for k in range(1 - group, group)]), lambda k: F.try_add(c, k.cast("bigint"))), lambda x: x.isNotNull() & (x - x % group == c))
    lent = turns.where((c % group == 0) & (F.col("pos") < most - 1)).select(F.explode(near).alias("to"), "pos", "symbol", "size")
    lent = lent.where(F.col("pos") < taken(F.col("to"))).withColumnRenamed("to", "conv_id")
    return own.unionByName(lent.join(conversations.select("conv_id"), "conv_id", "left_semi").select(own.columns))


def paths(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """(conv_id, path, sizes) of every conversation, turnless ones with an empty path."""
    listed = F.sort_array(F.collect_list(F.struct("pos", "symbol", "size")))
    found = turns.groupBy("conv_id").agg(listed.alias("t"))
    found = found.select("conv_id", F.unhex(F.array_join(F.transform("t.symbol", lambda s: F.hex(s)), "")).alias("path"), F.col("t.size").alias("sizes"))
    return conversations.select("conv_id").join(found, "conv_id", "left").select(
        "conv_id", F.coalesce("path", F.unhex(F.lit(""))).alias("path"), F.coalesce("sizes", F.array().cast("array<bigint>")).alias("sizes")
    )


def joined_digests(members: DataFrame) -> DataFrame:
    """(key, ends_sha256) from (key, conv_id): the SHA-256 of each key's ids, ascending, with commas.

    A key may hold any number of ids: they are sorted by range partitions and joined there
    into long texts, and only these meet in one task, which hashes them one by one.
    """

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, first, texts, size = None, 0, [], 0

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([first], pa.int64()), pa.array([",".join(texts)], pa.string())], names=["key", "first", "ids"])

        for batch in batches:
            for k, i in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if texts and (k != key or size >= _CHUNK):
                    yield row()
                    texts, size = [], 0
                if not texts:
                    key, first = k, i
                texts.append(str(i))
                size += len(texts[-1]) + 1
        if texts:
            yield row()

    def hash_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest = None, None
        names = ["key", "ends_sha256"]
        for batch in batches:
            done: list[tuple[bytes, str]] = []
            for k, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if digest is not None and k == key:
                    digest.update(b",")
                else:
                    if digest is not None:
                        done.append((key, digest.hexdigest()))
                    key, digest = k, hashlib.sha256()
                digest.update(ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.binary()), pa.array([d[1] for d in done], pa.string())], names=names)
        if digest is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([digest.hexdigest()], pa.string())], names=names)

    ordered = members.select("key", "conv_id").repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    chunks = ordered.mapInArrow(join, "key binary, first bigint, ids string")
    return chunks.repartition("key").sortWithinPartitions("key", "first").mapInArrow(hash_, "key binary, ends_sha256 string")


def distinct_paths(whole: DataFrame) -> DataFrame:
    """(path, sizes, n, conv_id, ends_sha256): every path once, with the number of its
    conversations, the smallest of them, and the digest of all."""
    keyed = whole.withColumn("key", F.unhex(F.md5("path")))
    groups = stored(
        keyed.groupBy("key").agg(F.any_value("path").alias("path"), F.any_value("sizes").alias("sizes"), F.count("*").alias("n"), F.min("conv_id").alias("conv_id")), "paths"
    )
    shared = groups.where("n > 1").select("key")
    digests = joined_digests(keyed.select("key", "conv_id").join(shared, "key", "left_semi"))
    alone = F.sha2(F.col("conv_id").cast("string").cast("binary"), 256)
    return groups.join(digests, "key", "left").select("path", "sizes", "n", "conv_id", F.coalesce("ends_sha256", alone).alias("ends_sha256"))


def common_turns(a: bytes, b: bytes) -> int:
    """How many symbols two paths begin with in common."""
    low, high = 0, min(len(a), len(b)) // WIDTH
    while low < high:
        middle = (low + high + 1) // 2
        if a[low * WIDTH : middle * WIDTH] == b[low * WIDTH : middle * WIDTH]:
            low = middle
        else:
            high = middle - 1
    return low


def choose_splitters(sample: Iterable[bytes], shards: int) -> list[bytes]:
    """At most ``shards - 1`` prefixes that cut the sorted sample evenly, each no longer than it
    takes to tell two neighbours apart."""
    ordered = sorted(sample)
    found = set()
    for k in range(1, shards):
        at = len(ordered) * k // shards
        if at:
            before, own = ordered[at - 1], ordered[at]
            found.add(own[: (common_turns(before, own) + 1) * WIDTH])
    # Equal neighbours differ nowhere; the prefix is then the whole path, and no worse a cut.
    return sorted(found - {b""})


def skeleton_of(splitters: list[bytes]) -> set[bytes]:
    """All proper prefixes of the splitters; the root is always among them."""
    return {b""} | {s[: k * WIDTH] for s in splitters for k in range(len(s) // WIDTH)}


def shard_nodes(rows: Iterable[tuple], skeleton: set[bytes]) -> Iterator[tuple]:
    """Nodes of the sorted paths of one shard, in the columns of ``_NODE``.

    ``rows`` are (path, sizes, n, conv_id, ends). A node is given when the next path leaves it,
    so that only the nodes of one path are held.
    """
    # [key, parent, depth, size, conv_id, n_convs, n_children, n_leaves, saved, ends, in skeleton]
    stack: list[list] = []
    last = b""

    def leave(depth: int) -> Iterator[tuple]:
        while len(stack) > depth:
            node = stack.pop()
            if not node[6]:
                node[7] = 1 if not node[10] else 0
            if not node[10]:
                node[8] += (node[5] - 1) * node[3]
                above = stack[-1]
                above[4] = node[4] if above[4] is None else min(above[4], node[4])
                above[5] += node[5]
                above[6] += 1
                above[7] += node[7]
                above[8] += node[8]
            yield tuple(node)

    for path, sizes, n, conv_id, ends in rows:
        if not stack:
            stack.append([ROOT, None, 0, 0, None, 0, 0, 0, 0, None, True])
        yield from leave(common_turns(last, path) + 1)
        for depth in range(len(stack), len(path) // WIDTH + 1):
            symbol = path[(depth - 1) * WIDTH : depth * WIDTH]
            above = stack[-1]
            inside = above[10] and path[: depth * WIDTH] in skeleton
            stack.append([hashlib.md5(above[0] + symbol).digest(), above[0], depth, sizes[depth - 1], None, 0, 0, 0, 0, None, inside])
        node = stack[-1]
        node[4] = conv_id if node[4] is None else min(node[4], conv_id)
        node[5] += n
        node[9] = ends
        last = path
    yield from leave(0)


def add_up(partials: list[dict]) -> list[tuple]:
    """The finished skeleton from its summed partials, children before parents."""
    nodes = {p["node"]: dict(p) for p in partials}
    for node in sorted(nodes.values(), key=lambda p: -p["depth"]):
        node["saved_tokens"] += (node["n_convs"] - 1) * node["size"]
        above = nodes.get(node["parent"])
        if above:
            ids = [i for i in (above["conv_id"], node["conv_id"]) if i is not None]
            above["conv_id"] = min(ids)
            above["n_children"] += 1
            for c in ("n_convs", "n_leaves", "saved_tokens"):
                above[c] += node[c]
    # A root without children is a leaf itself: all conversations are turnless.
    for node in nodes.values():
        if not node["n_children"]:
            node["n_leaves"] = 1
    names = [c.split()[0] for c in _NODE.split(", ")]
    return [tuple(node.get(c, False) for c in names) for node in nodes.values()]


def build_trie(distinct: DataFrame) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256)
    of every node over the rows of ``distinct_paths``."""
    spark = distinct.sparkSession
    distinct = stored(distinct, "distinct-paths")
    total = distinct.agg(F.count("*").alias("rows"), F.sum(F.size("sizes") + 1).alias("turns")).first()
    shards = min(MOST_SHARDS, 1 + (total["turns"] or 0) // SHARD_TURNS)
    every = max(1, total["rows"] // (_SAMPLES * shards))
    sample = distinct.where(F.pmod(F.xxhash64("path"), F.lit(every)) == 0).select(F.substring("path", 1, _SAMPLE_DEPTH * WIDTH).alias("path"))
    # About _SAMPLES paths a shard, none longer than _SAMPLE_DEPTH symbols, at most 2 * MOST_SHARDS times that.
    splitters = choose_splitters({bytes(r["path"]) for r in sample.limit(2 * _SAMPLES * MOST_SHARDS).collect()}, shards)
    shared = spark.sparkContext.broadcast((splitters, skeleton_of(splitters)))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers = [bisect_right(shared.value[0], path.as_py()) for path in batch.column("path")]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(numbers, pa.int32())], names=[*batch.schema.names, "shard"])

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(n, {"binary": pa.binary(), "bigint": pa.int64(), "string": pa.string(), "boolean": pa.bool_()}[t]) for n, t in (c.split() for c in _NODE.split(", "))])

        def rows() -> Iterator[tuple]:
            for batch in batches:
                yield from zip(*[batch.column(c).to_pylist() for c in ("path", "sizes", "n", "conv_id", "ends_sha256")])

        # Shards of one partition follow each other in order, so they are worked on as one.
        held: list[tuple] = []
        for node in shard_nodes(rows(), shared.value[1]):
            held.append(node)
            if len(held) == _ROWS:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
                held = []
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)

    routed = distinct.mapInArrow(route, distinct.withColumn("shard", F.lit(0)).schema)
    nodes = stored(routed.repartition("shard").sortWithinPartitions("shard", "path").mapInArrow(finish, _NODE), "nodes")
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    partials = nodes.where("partial").groupBy("node", "parent", "depth", "size").agg(F.min("conv_id").alias("conv_id"), *sums, F.max("ends_sha256").alias("ends_sha256"))
    # One row a skeleton node: at most _SAMPLE_DEPTH a splitter.
    skeleton = spark.createDataFrame(add_up([r.asDict() for r in partials.collect()]), _NODE)
    finished = nodes.where("not partial")
    parents = lambda df: df.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    # A node with very many children has members in several shards, so it is in the skeleton.
    above = F.broadcast(parents(skeleton).withColumn("top", F.lit(True)))
    marked = finished.unionByName(skeleton).join(above, "parent", "left")
    inner = marked.where("top is null and depth > 0").drop("parent_conv_id").join(parents(finished.where("n_children > 0")), "parent")
    outer = marked.where("top is not null or depth = 0")
    found = outer.unionByName(inner.select(outer.columns))
    return found.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(_NONE)).alias("ends_sha256")
    )


def prefix_trie(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", borrow: bool = False) -> DataFrame:
    """The trie of all conversations of ``turns``, as rows of ``build_trie``.

    A node is a distinct sequence of first turns, named by its depth and its smallest
    conversation. With ``borrow`` conversations are rebuilt first, see ``with_borrowed_starts``.
    Turns are ordered as in ``ordered_turns``, where ties and nulls are told. An empty table has no
    node. The digests of one conversation, 24 bytes a turn, are held as one row; texts never move.
    """
    ordered = stored(ordered_turns(turns, id_col, turn_col, role_col, text_col), "turns")
    conversations = stored(ordered.select("conv_id").distinct(), "conversations")
    if borrow:
        ordered = with_borrowed_starts(ordered, conversations)
    return build_trie(distinct_paths(stored(paths(ordered, conversations), "whole-paths")))
