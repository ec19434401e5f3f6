"""Benchmark decontamination by greedy string tiling.

A document and a benchmark item that share a run of words are tiled: the longest common runs
of words not yet covered are marked in both, again and again, found by running Karp-Rabin
hashes of falling length. Tiles may lie in any order, so a passage whose parts were moved
about is still covered. An item counts as leaked where its covered share reaches a threshold.

Documents never move: the benchmark goes to them in blocks of a checked size.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_texts, filter_texts, narrow, shingle_hashes, shingle_runs, stored, word_hashes

BLOCK_BYTES = 16 << 20  # benchmark text in one broadcast
_PAIRS = 1 << 20  # places compared at once
_BASE = np.uint64(0xD1B54A32D192ED03)
_POINTS = b".,;:!?\"'()[]{}*_#"


def plain_words(text: bytes) -> np.ndarray:
    """Hashes of the words without ASCII case and punctuation."""
    return word_hashes(text.lower().translate(None, _POINTS))


def _window_hashes(words: np.ndarray, free: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the runs of ``length`` uncovered words, and their rolling hashes."""
    count = len(words) - length + 1
    if count < 1:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    covered = np.concatenate([[0], np.cumsum(~free)])
    starts = np.flatnonzero(covered[length:] == covered[:count])
    powers = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(len(words), _BASE)]))
    sums = np.concatenate([[np.uint64(0)], np.cumsum(words * powers[:-1], dtype=np.uint64)])
    # Brought to one power by multiplying up, for want of a division.
    return starts, (sums[starts + length] - sums[starts]) * powers[len(words) - starts]


def _matches(a, b, free_a, free_b, length: int, used: np.ndarray) -> np.ndarray:
    """Rows (length, start in a, start in b) of the longest matches of at least ``length`` words."""
    starts_a, hash_a = _window_hashes(a, free_a, length)
    starts_b, hash_b = _window_hashes(b, free_b, length)
    if not len(starts_a) or not len(starts_b):
        return np.zeros((0, 3), dtype=np.int64)
    # Hashes of windows are scaled by the length of their own text; bring both to the longer.
    scale = lambda h, own, other: h * used[max(other - own, 0)]
    hash_a, hash_b = scale(hash_a, len(a), len(b)), scale(hash_b, len(b), len(a))
    order = np.argsort(hash_b, kind="stable")
    low, high = np.searchsorted(hash_b[order], hash_a, "left"), np.searchsorted(hash_b[order], hash_a, "right")
    counts = high - low
    if not counts.any():
        return np.zeros((0, 3), dtype=np.int64)
    out = []
    begin, reach = 0, np.cumsum(counts)
    while begin < len(counts):  # a bounded number of pairs at a time; only starts of matches are kept
        done = reach[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(reach, done + _PAIRS, "right")))
        for shift in range(0, int(counts[begin]) if end == begin + 1 else 1, _PAIRS):
            n = np.minimum(counts[begin:end] - shift, _PAIRS) if end == begin + 1 else counts[begin:end]
            i = np.repeat(starts_a[begin:end], n)
            within = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            j = starts_b[order[np.repeat(low[begin:end], n) + within + shift]]
            inner = (i > 0) & (j > 0)
            inner[inner] = (a[i[inner] - 1] == b[j[inner] - 1]) & free_a[i[inner] - 1] & free_b[j[inner] - 1]
            i, j = i[~inner], j[~inner]
            size = np.zeros(len(i), dtype=np.int64)
            live = np.arange(len(i))
            while len(live):
                x, y = i[live] + size[live], j[live] + size[live]
                fits = (x < len(a)) & (y < len(b))
                live, x, y = live[fits], x[fits], y[fits]
                live = live[(a[x] == b[y]) & free_a[x] & free_b[y]]
                size[live] += 1
            out.append(np.stack([size, i, j], axis=1)[size >= length])
        begin = end
    return np.concatenate(out)


def tile(a: np.ndarray, b: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """Tiles (start in a, start in b, words) of two sequences of word hashes, longest first;
    among equals the first in ``a``, then in ``b``."""
    free_a, free_b = np.ones(len(a), dtype=bool), np.ones(len(b), dtype=bool)
    gap = abs(len(a) - len(b))
    used = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(gap, _BASE)]))
    tiles = []
    length = max(least, 1 << max(0, min(len(a), len(b)).bit_length() - 1))
    while True:
        while True:
            found = _matches(a, b, free_a, free_b, length, used)
            if not len(found):
                break
            found = found[np.lexsort((found[:, 2], found[:, 1], -found[:, 0]))]
            cut = 0
            for size, i, j in found.tolist():
                if size < cut:  # a match that was cut may still be longer than these
                    break
                fits = free_a[i : i + size] & free_b[j : j + size]
                if fits.all():
                    free_a[i : i + size] = False
                    free_b[j : j + size] = False
                    tiles.append((i, j, size))
                else:
                    edges = np.flatnonzero(np.diff(np.concatenate([[0], fits.astype(np.int8), [0]])))
                    cut = max(cut, int((edges[1::2] - edges[::2]).max()) if len(edges) else 0)
        if length <= least:
            return tiles
        length = max(least, length // 2)


def _blocks(items: DataFrame, *named: str) -> Iterator[list[tuple]]:
    """The distinct texts of the benchmark, with their number and the columns ``named``, in blocks of
    about BLOCK_BYTES, dealt by a hash. Copies are one row, so that no block is larger for them."""
    distinct = stored(items.groupBy(*named, "text").agg(F.count("*").alias("copies")), "items")
    held = distinct.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
    count = 1 + held // BLOCK_BYTES
    for block in range(count):
        rows = distinct.where(F.expr(f"pmod(xxhash64({', '.join((*named, 'text'))}), {count}) = {block}"))
        yield [((row["item_id"] if named else None, row["copies"]), row["text"].encode()) for row in rows.collect()]


_KINDS = {"string": pa.string(), "tinyint": pa.int8(), "smallint": pa.int16(), "int": pa.int32(), "bigint": pa.int64()}


class Benchmark:
    """A block of items with an index from their seeds to them."""

    def __init__(self, items: list[tuple[tuple, bytes]], least: int):
        self.least, self.words = least, {}
        self.short: dict[int, dict[int, list[int]]] = {}  # words -> hash of the whole item -> items
        seeds_of, owners, times = [], [], []
        for k, (item, text) in enumerate(sorted(items, key=lambda x: x[1])):
            words = plain_words(text)
            self.words[k] = (item, words)
            if len(words) >= least:
                own, counts = np.unique(shingle_runs(words, least), return_counts=True)
                seeds_of.append(own)
                owners.append(np.full(len(own), k))
                times.append(counts)
            elif len(words):
                whole = int(shingle_runs(words, len(words))[0])
                self.short.setdefault(len(words), {}).setdefault(whole, []).append(k)
        self.seeds = np.concatenate(seeds_of) if seeds_of else np.zeros(0, dtype=np.uint64)
        self.owners = np.concatenate(owners) if owners else np.zeros(0, dtype=np.int64)
        self.times = np.concatenate(times) if times else np.zeros(0, dtype=np.int64)
        order = np.argsort(self.seeds, kind="stable")
        self.seeds, self.owners, self.times = self.seeds[order], self.owners[order], self.times[order]

    def _short_leaks(self, words: np.ndarray) -> list[tuple[tuple, int, int, int]]:
        """Items too short for a tile are covered if they stand there whole."""
        out = []
        for size, wholes in sorted(self.short.items()):
            if len(words) >= size:
                known = np.fromiter(wholes, dtype=np.uint64, count=len(wholes))
                seen = known[np.isin(known, shingle_runs(words, size))]
                out += [(self.words[k][0], size, size, 1) for whole in seen.tolist() for k in wholes[whole]]
        return out

    def leaks(self, text: bytes, threshold: float) -> list[tuple[tuple, int, int, int]]:
        """(item, its words, covered words, tiles) of the items that the text covers."""
        words = plain_words(text)
        short = self._short_leaks(words) if self.short else []
        if len(words) < self.least or not len(self.seeds):
            return short
        own = shingle_hashes(words, self.least)
        low, high = np.searchsorted(self.seeds, own, "left"), np.searchsorted(self.seeds, own, "right")
        shared: dict[int, int] = defaultdict(int)
        for x, y in zip(low[high > low].tolist(), high[high > low].tolist(), strict=True):
            for owner, times in zip(self.owners[x:y].tolist(), self.times[x:y].tolist(), strict=True):
                shared[owner] += times
        out = []
        for k, seen in sorted(shared.items()):
            item, its = self.words[k]
            # A place of a shared seed covers at most ``least`` words.
            if seen * self.least < threshold * len(its):
                continue
            tiles = tile(words, its, self.least)
            covered = sum(size for _, _, size in tiles)
            if covered >= threshold * len(its):
                out.append((item, len(its), covered, len(tiles)))
        return short + out


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    threshold: float = 0.5,
    least: int = 5,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """(doc_id, item_id, item_words, covered_words, coverage, tiles) of the leaked items.

    Words are compared without regard to ASCII case. Tiles have ``least`` words or more; an item
    of fewer words is covered by a text in which it stands whole. Items without a word, null and
    empty texts are in no row. Repeated documents or items each give their rows; null ids are
    kept; ids of items that are neither text nor whole numbers are given as text. An empty table
    gives no rows.
    """
    source = narrow(docs, doc_id=id_col, text=text_col).where("text is not null")
    items = narrow(benchmark, item_id=item_col, text=item_text_col).where("text is not null")
    if items.schema["item_id"].dataType.simpleString() not in _KINDS:
        items = items.withColumn("item_id", F.col("item_id").cast("string"))
    kinds = [frame.schema[c].dataType.simpleString() for frame, c in ((source, "doc_id"), (items, "item_id"))]
    fields = f"doc_id {kinds[0]}, item_id {kinds[1]}, item_words int, covered_words int, coverage double, tiles int"

    def scan(shared):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            block = Benchmark(shared.value, least)
            for batch in batches:
                rows = []
                for doc, text in zip(batch.column(0).to_pylist(), byte_texts(batch.column(1)), strict=True):
                    for (item, copies), n, c, t in block.leaks(text, threshold):
                        rows += [(doc, item, n, c, c / n, t)] * copies
                types = [batch.column(0).type, *own]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(types)],
                    ["doc_id", "item_id", "item_words", "covered_words", "coverage", "tiles"],
                )

        own = [_KINDS[kinds[1]], pa.int32(), pa.int32(), pa.float64(), pa.int32()]
        return run

    # One block is alive at a time: what it found is stored before the next is read.
    found = None
    for block in _blocks(items, "item_id"):
        shared = docs.sparkSession.sparkContext.broadcast(block)
        part = stored(source.mapInArrow(scan(shared), fields), "leaks")
        shared.destroy()
        found = part if found is None else found.unionByName(part)
    return found


def decontaminate(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.5, least: int = 5, text_col: str = "text") -> DataFrame:
    """``docs`` without the rows whose text leaks a benchmark item; null texts stay."""
    items = narrow(benchmark, text="text").where("text is not null")

    def test(shared):
        def make():
            block = Benchmark(shared.value, least)
            return lambda texts: [not block.leaks(text, threshold) for text in texts]

        return make

    last = None
    for block in _blocks(items):
        if last is not None:  # one block is alive at a time
            docs = stored(docs, "filtered")
            last.destroy()
        last = docs.sparkSession.sparkContext.broadcast(block)
        docs = filter_texts(docs, text_col, test(last))
    return docs
