"""Ranked lexical search over posting lists cut into geometric blocks.

A document is a vector with one coordinate a term, the impact of that term in it. Documents are
put in the order of a sign code of their vectors, in which similar ones are neighbours, and
each term's posting list is cut, in that order, into blocks of similar documents. A block is stored with
its coordinatewise maximum: the greatest impact of every coordinate over its documents. The
product of an item with that summary is at least the score of each document in the block, so a
block is skipped if, and only if, its bound is below a score that ten documents reach.

An item need not look into all its lists. Ten documents of its rarest lists give a first score
to beat; terms whose greatest contributions together stay below it cannot lift a document into
the result alone, so their lists are left out. All documents that could rank are in the
others. Summaries hold the coordinates that an item asks for together with the list's term,
as no other can enter a bound. All sums are integers.

Items go through in blocks of a bounded number of terms. Terms are known by 64-bit hashes.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tracecurate.operators.numbering import number_rows

from .common import PIECE, byte_texts, narrow, seeds, stored

_TERM = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
_SIEVE_BITS = 20  # buckets of the sieve that documents' terms pass first
_CACHE = 1 << 20  # hashes of terms kept by a task
_SIGNS = 32
BLOCK_DOCS = 64  # documents in a block of a posting list
BLOCK_TERMS = 1 << 19  # (item, term) rows worked on at once
_EXPANDED = 1 << 19  # (document, item, term) rows held at once


def term_counts(text: bytes) -> Counter:
    """How often each term occurs. The text is read in pieces that end with a term."""
    counts: Counter = Counter()
    start = 0
    while start < len(text):
        end = min(len(text), start + PIECE)
        rest = _TERM.match(text, end)
        end = rest.end() if rest else end
        counts.update(_TERM.findall(text[start:end].lower()))
        start = end
    return counts


def _hash(term: bytes) -> int:
    value = xxhash.xxh64_intdigest(term)
    return value - (1 << 64) if value >> 63 else value


def _lists(lengths: list[int] | np.ndarray, values: np.ndarray, kind: pa.DataType) -> pa.Array:
    offsets = np.zeros(len(lengths) + 1, dtype=np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def _item_terms(items: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """(item_id, term) of every distinct pair; texts of one id are one item."""
    rows = narrow(items, item_id=item_col, text=text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, text in enumerate(byte_texts(batch.column(1))):
                hashes = [_hash(term) for term in term_counts(text)]
                ids = pa.array([batch.column(0)[k].as_py()] * len(hashes), batch.column(0).type)
                yield pa.RecordBatch.from_arrays([ids, pa.array(hashes, pa.int64())], names=["item_id", "term"])

    return rows.mapInArrow(run, f"item_id {rows.schema['item_id'].dataType.simpleString()}, term bigint").distinct()


def _vectors(docs: DataFrame, sieve: np.ndarray, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, n, terms, tfs) of every document with a term: all its terms are counted in ``n``, those
    that pass the sieve are listed."""
    rows = narrow(docs, doc_id=id_col, text=text_col)
    mask = (1 << _SIEVE_BITS) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int | None] = {}
        for batch in batches:
            kept, sizes, lengths = [], [], []
            terms: list[int] = []
            tfs: list[int] = []
            for k, text in enumerate(byte_texts(batch.column(1))):
                counts = term_counts(text)
                if not counts:
                    continue
                before = len(terms)
                for term, tf in counts.items():
                    if term in known:
                        value = known[term]
                    else:
                        if len(known) >= _CACHE:
                            known.clear()
                        value = _hash(term)
                        value = known[term] = value if sieve[value & mask] else None
                    if value is not None:
                        terms.append(value)
                        tfs.append(tf)
                kept.append(k)
                sizes.append(counts.total())
                lengths.append(len(terms) - before)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(kept, pa.int64())),
                    pa.array(sizes, pa.int64()),
                    _lists(lengths, np.array(terms, dtype=np.int64), pa.int64()),
                    _lists(lengths, np.array(tfs, dtype=np.int64), pa.int64()),
                ],
                names=["doc_id", "n", "terms", "tfs"],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n bigint, terms array<bigint>, tfs array<bigint>")


def _spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start, start + 1, .. for as many places as counted, one range after the other."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - counts), counts)


class Items:
    """A block of items: its terms, their weights, and which items hold them."""

    def __init__(self, rows: list, docs: int, length: int):
        """``rows`` are (item, term, df, top): df the documents of a term, top its greatest impact."""
        item, term, df, top = np.array([tuple(r) for r in rows], dtype=np.int64).T
        self.terms, first, idx = np.unique(term, return_index=True, return_inverse=True)
        self.items, local = np.unique(item, return_inverse=True)
        self.docs, self.length, self.width = docs, length, len(self.terms)
        self.df, self.top = df[first], top[first]
        self.weight = np.floor(1000 * np.log((2.0 * docs + 2) / (2.0 * self.df + 1))).astype(np.int64)
        # One entry an (item, term) pair, by term; ``keys`` are the pairs in the order of items.
        order = np.lexsort((local, idx))
        self.entry_item, self.entry_term = local[order], idx[order]
        self.count = np.bincount(idx, minlength=self.width)
        self.start = np.cumsum(self.count) - self.count
        self.keys = np.sort(local * self.width + idx)
        self.floor = np.zeros(len(self.items), dtype=np.int64)
        self.open = np.zeros(len(idx), dtype=bool)

    def open_rarest(self, docs: int) -> None:
        """Open each item's rarest lists, up to ``docs`` postings or just beyond."""
        df = self.df[self.entry_term]
        order = np.lexsort((self.entry_term, df, self.entry_item))
        self._open(order, df[order], lambda before, own, item: before < docs)

    def open_needed(self) -> None:
        """Open the lists without which a document could reach the floor: all but the longest
        whose greatest contributions together stay below it."""
        df = self.df[self.entry_term]
        best = (self.weight * self.top)[self.entry_term]
        order = np.lexsort((self.entry_term, -df, self.entry_item))
        self._open(order, best[order], lambda before, own, item: before + own >= self.floor[item])

    def _open(self, order: np.ndarray, amount: np.ndarray, test) -> None:
        item = self.entry_item[order]
        sums = np.cumsum(amount) - amount
        first = np.flatnonzero(np.diff(item, prepend=-1))
        before = sums - np.repeat(sums[first], np.diff(np.append(first, len(item))))
        self.open = np.zeros(len(order), dtype=bool)
        self.open[order] = test(before, amount, item)
        self.open &= self.weight[self.entry_term] > 0

    def impacts(self, tf: np.ndarray, n: np.ndarray) -> np.ndarray:
        m = 100 - 90 + (90 * n * self.docs) // self.length
        return (1_000_000_000 * tf) // (1000 * tf + 8 * m)

    def products(self, item: np.ndarray, owner: np.ndarray, idx: np.ndarray, impact: np.ndarray, owners: int) -> np.ndarray:
        """For each owner the sum of weight times impact over the terms of its item."""
        key = item * self.width + idx
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        out = np.zeros(owners, dtype=np.int64)
        held = self.keys[at] == key
        np.add.at(out, owner[held], (self.weight[idx] * impact)[held])
        return out


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Lengths and values of a list column."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    return lengths, column.flatten().to_numpy(zero_copy_only=False)


def _placed(vectors: DataFrame, block: Items) -> DataFrame:
    """(row, doc_id, idx, impacts, code): vectors over the terms of the block, in the order of their codes."""
    shared = vectors.sparkSession.sparkContext.broadcast(block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        signs = (seeds(own.width, 9_000)[:, None] >> np.arange(_SIGNS, dtype=np.uint64) & np.uint64(1)).astype(np.float32) * 2 - 1
        for batch in batches:
            lengths, terms = _flat(batch.column("terms"))
            tfs = _flat(batch.column("tfs"))[1]
            at = np.minimum(np.searchsorted(own.terms, terms), own.width - 1)
            held = own.terms[at] == terms
            owner = np.repeat(np.arange(len(lengths)), lengths)[held]
            idx, n = at[held], batch.column("n").to_numpy()
            impact = own.impacts(tfs[held], n[owner])
            codes = np.zeros(len(lengths), dtype=np.int64)
            strength = (own.weight[idx] * impact).astype(np.float32)
            for bit in range(_SIGNS):
                side = np.bincount(owner, strength * signs[idx, bit], minlength=len(lengths))
                codes = codes << 1 | (side > 0)
            counts = np.bincount(owner, minlength=len(lengths))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"),
                    batch.column("doc_id"),
                    _lists(counts, idx.astype(np.int32), pa.int32()),
                    _lists(counts, impact, pa.int64()),
                    pa.array(codes, pa.int64()),
                ],
                names=["row", "doc_id", "idx", "impacts", "code"],
            )

    kind = vectors.schema["doc_id"].dataType.simpleString()
    found = vectors.mapInArrow(run, f"row bigint, doc_id {kind}, idx array<int>, impacts array<bigint>, code bigint").where("size(idx) > 0")
    return stored(found.repartitionByRange("code", "row").sortWithinPartitions("code", "row"), "placed")


def cut_lists(rows: np.ndarray, lengths: np.ndarray, idx: np.ndarray, impact: np.ndarray, block: Items):
    """Blocks of the open lists of these documents: terms, members and summaries.

    Returns the term of each block, the numbers and rows of its members, and the numbers,
    coordinates and maxima of its summary.
    """
    owner = np.repeat(np.arange(len(rows)), lengths)
    counts = block.count[idx]
    which = np.repeat(np.arange(len(idx)), counts)
    entry = _spread(block.start[idx], counts)
    order = np.argsort(owner[which] * len(block.items) + block.entry_item[entry], kind="stable")
    which, entry = which[order], entry[order]
    pair = owner[which] * len(block.items) + block.entry_item[entry]
    first = np.flatnonzero(np.diff(pair, prepend=-1))
    size = np.diff(np.append(first, len(pair)))
    group = np.repeat(np.arange(len(first)), size)
    lead = np.flatnonzero(block.open[entry])
    # Each open posting with all coordinates that one of its items asks for.
    from_ = np.repeat(which[lead], size[group[lead]])
    to = which[_spread(first[group[lead]], size[group[lead]])]
    posting, place = np.unique(idx[from_].astype(np.int64) * len(rows) + owner[from_], return_inverse=True)
    term = posting // max(len(rows), 1)
    begin = np.flatnonzero(np.diff(term, prepend=-1))
    ordinal = np.arange(len(posting)) - np.repeat(begin, np.diff(np.append(begin, len(posting))))
    starts = ordinal % BLOCK_DOCS == 0
    number = np.cumsum(starts) - 1
    key = number[place] * block.width + idx[to]
    order = np.argsort(key, kind="stable")
    key, value = key[order], impact[to][order]
    edge = np.flatnonzero(np.diff(key, prepend=-1))
    tops = np.maximum.reduceat(value, edge) if len(edge) else value
    blocks = int(starts.sum())
    return (
        term[starts],
        np.bincount(number, minlength=blocks),
        rows[posting % max(len(rows), 1)],
        np.bincount(key[edge] // block.width, minlength=blocks),
        (key[edge] % block.width).astype(np.int32),
        tops,
    )


def _index(placed: DataFrame, block: Items) -> DataFrame:
    """(term, members, coordinates, tops) of every block of the open lists."""
    shared = placed.sparkSession.sparkContext.broadcast(block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            rows = batch.column("row").to_numpy()
            lengths, idx = _flat(batch.column("idx"))
            impact = _flat(batch.column("impacts"))[1]
            ends = np.cumsum(lengths)
            load = np.cumsum(np.add.reduceat(own.count[idx], ends - lengths)) if len(rows) else ends
            part = load // _EXPANDED
            cuts = np.append(np.flatnonzero(np.diff(part, prepend=-1)), len(rows))
            for a, b in zip(cuts[:-1], cuts[1:]):
                inside = slice(ends[a] - lengths[a], ends[b - 1])
                term, sizes, members, widths, at, tops = cut_lists(rows[a:b], lengths[a:b], idx[inside], impact[inside], own)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(term, pa.int32()),
                        _lists(sizes, members, pa.int64()),
                        _lists(widths, at, pa.int32()),
                        _lists(widths, tops, pa.int64()),
                    ],
                    names=["term", "members", "coordinates", "tops"],
                )

    return stored(placed.mapInArrow(run, "term int, members array<bigint>, coordinates array<int>, tops array<bigint>"), "index")


def _survivors(index: DataFrame, block: Items) -> DataFrame:
    """(row, item) of all members of blocks whose bound reaches the floor of an item."""
    shared = index.sparkSession.sparkContext.broadcast(block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        opened = np.flatnonzero(own.open)
        count = np.bincount(own.entry_term[opened], minlength=own.width)
        start = np.cumsum(count) - count
        for batch in batches:
            term = batch.column("term").to_numpy()
            sizes, members = _flat(batch.column("members"))
            widths, at = _flat(batch.column("coordinates"))
            tops = _flat(batch.column("tops"))[1]
            number = np.repeat(np.arange(len(term)), count[term])
            item = own.entry_item[opened[_spread(start[term], count[term])]]
            spot = _spread((np.cumsum(widths) - widths)[number], widths[number])
            owner = np.repeat(np.arange(len(number)), widths[number])
            bound = own.products(item[owner], owner, at[spot], tops[spot], len(number))
            left = np.flatnonzero(bound >= np.maximum(own.floor[item], 1))
            number, item = number[left], item[left]
            row = members[_spread((np.cumsum(sizes) - sizes)[number], sizes[number])]
            yield pa.RecordBatch.from_arrays(
                [pa.array(row, pa.int64()), pa.array(np.repeat(item, sizes[number]), pa.int32())], names=["row", "item"]
            )

    return index.mapInArrow(run, "row bigint, item int").distinct()


def _scores(survivors: DataFrame, placed: DataFrame, block: Items, k: int) -> DataFrame:
    """(item, doc_id, score, rank) of each item's best ``k`` among the survivors."""
    shared = placed.sparkSession.sparkContext.broadcast(block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            lengths, idx = _flat(batch.column("idx"))
            impact = _flat(batch.column("impacts"))[1]
            owner = np.repeat(np.arange(len(lengths)), lengths)
            item = batch.column("item").to_numpy().astype(np.int64)
            score = own.products(item[owner], owner, idx, impact, len(lengths))
            yield pa.RecordBatch.from_arrays([batch.column("item"), batch.column("doc_id"), pa.array(score, pa.int64())], names=["item", "doc_id", "score"])

    kind = placed.schema["doc_id"].dataType.simpleString()
    pairs = survivors.join(placed.select("row", "doc_id", "idx", "impacts"), "row").select("item", "doc_id", "idx", "impacts")
    found = pairs.mapInArrow(run, f"item int, doc_id {kind}, score bigint").where("score > 0")
    best = W.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return stored(found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k), "scores")


def _search_block(vectors: DataFrame, block: Items, k: int) -> DataFrame:
    """(item, rank, doc_id, score), items by their numbers in the block."""
    placed = _placed(vectors, block)
    block.open_rarest(10 * k)
    first = _scores(_survivors(_index(placed, block), block), placed, block, k)
    for row in first.where(F.col("rank") == k).select("item", "score").collect():  # one row an item of the block
        block.floor[row["item"]] = row["score"]
    block.open_needed()
    return _scores(_survivors(_index(placed, block), block), placed, block, k)


def rank_documents(
    docs: DataFrame,
    items: DataFrame,
    k: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of every item, exactly.

    The score sums, over the distinct terms of the item, w * (10**9 tf div (1000 tf + 8 m)), with
    w and m from the statistics of all of ``docs``. Every row is a document of its own, also where
    ids or rows repeat; null texts have no term. Equal scores go by ascending id, null ids
    last. Rows of one item id are one item, also those without an id. Items without a term
    that occurs, and empty tables, give no rows.
    """
    terms = stored(_item_terms(items, item_col, item_text_col), "item-terms")
    names = number_rows(terms.select("item_id").distinct(), "item_id", name="number")
    names = stored(names.select(F.col("item_id").alias("name"), "number"), "item-names")
    terms = stored(terms.join(names, F.col("item_id").eqNullSafe(F.col("name"))).select("number", "term"), "numbered-terms")

    mask = (1 << _SIEVE_BITS) - 1
    sieve = np.zeros(mask + 1, dtype=bool)  # at most 2**20 rows come to the driver
    sieve[[r[0] for r in terms.select(F.col("term").bitwiseAND(mask)).distinct().collect()]] = True
    vectors = stored(_vectors(docs, sieve, id_col, text_col).withColumn("row", F.monotonically_increasing_id()), "vectors")
    total = vectors.agg(F.count("*").alias("docs"), F.sum("n").alias("length")).first()

    kind = {f.name: f.dataType.simpleString() for f in [*names.schema, *vectors.schema]}
    empty = docs.sparkSession.createDataFrame([], f"item_id {kind['name']}, rank int, doc_id {kind['doc_id']}, score bigint")
    if not total["docs"]:
        return empty
    tf = F.col("x.tfs")
    m = F.expr(f"100 - 90 + (90 * n * {total['docs']}L) div {total['length']}L")
    each = vectors.select("n", F.explode(F.arrays_zip("terms", "tfs")).alias("x")).select(F.col("x.terms").alias("term"), tf.alias("tf"), m.alias("m"))
    lists = each.groupBy("term").agg(F.count("*").alias("df"), F.max(F.expr("(1000000000L * tf) div (1000L * tf + 8L * m)")).alias("top"))
    held = stored(terms.join(lists, "term").select(F.col("number").alias("item"), "term", "df", "top"), "held-terms")

    parts = max(1, -(-held.count() // BLOCK_TERMS))
    out = empty
    for part in range(parts):
        rows = held.where(F.pmod(F.xxhash64("item"), F.lit(parts)) == part).collect()
        if rows:
            block = Items(rows, total["docs"], total["length"])
            numbers = docs.sparkSession.createDataFrame([(k, int(n)) for k, n in enumerate(block.items)], "item int, number bigint")
            found = _search_block(vectors, block, k).join(numbers, "item").join(names, "number")
            out = out.unionByName(found.select(F.col("name").alias("item_id"), "rank", "doc_id", "score"))
    return out
