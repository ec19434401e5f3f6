"""Exact top-k search by segment statistics of several resolutions.

For every segment of a vector its mean and deviation are known. They bound the inner product
of two vectors from above (and their distance from below): in a segment of n components it is
at most n (mean mean' + deviation deviation'). The bound is taken over few long segments
first, then over more and shorter ones; only pairs whose bound reaches the k-th best score
known so far are carried on, and the score of those left at the end is computed.

Bounds are doubles with room for their rounding, scores are exact: where a sum of doubles could
be rounded, that is beyond 2**53, it is taken again over integers of any size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import narrow, stored

LEVELS = (4, 8, 16, 32)
BLOCK = 4096  # queries in one broadcast
BLOCK_BYTES = 1 << 25  # bytes of their vectors
_ROWS = 512  # candidates bounded at once
_EXACT = 2.0**53
_EPS = 2.0**-52


def features(vectors: np.ndarray, segments: int) -> np.ndarray:
    """Scaled means and deviations whose inner product is the bound."""
    width = -(-vectors.shape[1] // segments)
    padded = np.zeros((len(vectors), segments * width))
    padded[:, : vectors.shape[1]] = vectors
    parts = padded.reshape(len(vectors), segments, width)
    sums = parts.sum(axis=2) / np.sqrt(width)
    squares = (parts * parts).sum(axis=2)
    # What rounding may have taken away is given back, so that the bound holds.
    rest = np.sqrt(np.maximum(squares - sums * sums, 0) + (width + 8) * _EPS * squares)
    return np.concatenate([sums, rest], axis=1)


class Block:
    """A block of queries of one dimension with the best scores found so far."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int):
        self.ids, self.vectors, self.k = ids, vectors, k
        self.norms = np.linalg.norm(vectors, axis=1)
        self.levels = [n for n in LEVELS if n < vectors.shape[1]]
        self.features = {n: features(vectors, n) for n in self.levels}
        self.best: list[dict[int, int]] = [{} for _ in ids]
        self.floor = np.full(len(ids), -np.inf)

    def offer(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        """Compare candidates with all queries. A candidate with the query's id is its own."""
        alive = ids[None, :] != self.ids[:, None]
        norms = np.linalg.norm(vectors, axis=1)
        slack = (vectors.shape[1] + 64) * 4 * _EPS
        for depth, n in enumerate(self.levels):
            # Only queries and candidates that have a pair left; their bounds are one product.
            some, others = np.flatnonzero(alive.any(axis=1)), np.flatnonzero(alive.any(axis=0))
            if not len(some):
                return
            bound = self.features[n][some] @ features(vectors[others], n).T
            bound += slack * self.norms[some][:, None] * norms[others] + 1e-6
            left = alive[np.ix_(some, others)]
            # Scores of the most promising ones first, so that the others meet a high floor.
            if depth == 0 and not np.isfinite(self.floor).all():
                top = np.argsort(-np.where(left, bound, -np.inf), axis=1)[:, : 4 * self.k]
                q, r = np.repeat(np.arange(len(some)), top.shape[1]), top.ravel()
                keep = left[q, r]
                self._score(some[q[keep]], others[r[keep]], ids, vectors, norms)
            alive[np.ix_(some, others)] = left & (bound >= self.floor[some][:, None])
        query, row = np.nonzero(alive)
        self._score(query, row, ids, vectors, norms)

    def _score(self, query: np.ndarray, row: np.ndarray, ids: np.ndarray, vectors: np.ndarray, norms: np.ndarray) -> None:
        for start in range(0, len(query), 1 << 16):
            q, r = query[start : start + (1 << 16)], row[start : start + (1 << 16)]
            scores = np.einsum("ij,ij->i", self.vectors[q], vectors[r])
            # No partial sum is beyond the product of the norms.
            reach = self.norms[q] * norms[r] * (1 + 1e-9)
            rounded = reach >= _EXACT
            error = np.where(rounded, (vectors.shape[1] + 8) * 2 * _EPS * reach, 0)
            hit = scores + error >= self.floor[q]
            q, r, scores, rounded = q[hit], r[hit], scores[hit], rounded[hit]
            touched = np.unique(q)
            for n, (a, b, s) in enumerate(zip(q.tolist(), ids[r].tolist(), scores.tolist(), strict=True)):
                score = _product(self.vectors[a], vectors[r[n]]) if rounded[n] else int(s)
                own = self.best[a]
                own[b] = max(score, own.get(b, score))
            for a in touched.tolist():
                ranked = sorted(self.best[a].items(), key=lambda x: (-x[1], x[0]))[: self.k]
                self.best[a] = dict(ranked)
                if len(ranked) == self.k:
                    last = float(ranked[-1][1])  # may be rounded: step below it
                    self.floor[a] = last if abs(last) < _EXACT else last - abs(last) * 2 * _EPS


def _product(a: np.ndarray, b: np.ndarray) -> int:
    """The inner product in whole numbers; beyond a long it is the nearest long."""
    exact = sum(int(x) * int(y) for x, y in zip(a.tolist(), b.tolist(), strict=True))
    return max(-(1 << 63), min((1 << 63) - 1, exact))


def _integers(rows: DataFrame, scale: int) -> DataFrame:
    """(vec_id, v) with scaled components; rows that cannot take part are gone. They are rounded
    down as doubles where they are read, since a long does not hold them all."""
    usable = F.size("vector") > 0
    finite = ~F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    whole = F.transform("vector", lambda x: x.cast("double") * scale)
    return rows.where("vec_id is not null and vector is not null").where(usable & finite).select("vec_id", whole.alias("v"))


def top_k(
    vectors: DataFrame,
    queries: str = "vec_id % 50 = 0",
    k: int = 5,
    scale: int = 256,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    block: int = BLOCK,
) -> DataFrame:
    """(query_id, rank, vec_id, score): for every row that meets ``queries`` the ``k`` other
    rows of greatest inner product of floor(scale * component), ties to the smaller id.

    Rows with a null id, a null or empty vector, or a null or non-finite component take no
    part; vectors of different lengths are not compared. Rows that share an id are one
    candidate with the best score among them, and one query with the best score for each
    candidate; none of them is a candidate of its own id. Scores are exact; one beyond the range of
    a long counts as the nearest long.
    """
    rows = stored(_integers(narrow(vectors, vec_id=id_col, vector=vector_col), scale), "scaled")
    asked = stored(rows.where(queries).distinct(), "queries")
    size = asked.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.size("v")), F.lit(0)).alias("values")).first()
    count = max(1, -(-size["n"] // block), -(-8 * size["values"] // BLOCK_BYTES))
    spark, found = vectors.sparkSession, None
    for part in range(count):
        # A stated query set against all rows, in blocks of a bounded number of queries. One
        # block is alive at a time: what it found is stored before the next is read.
        own = asked.where(F.expr(f"pmod(xxhash64(vec_id, v), {count}) = {part}")).collect()
        shared = spark.sparkContext.broadcast([(row["vec_id"], np.floor(np.array(row["v"]))) for row in own])
        scored = rows.mapInArrow(_search(shared, k), "query_id bigint, vec_id bigint, score bigint")
        merged = stored(_best(scored, k).drop("rank"), "block-best")
        shared.destroy()
        found = merged if found is None else found.unionByName(merged)
    return _best(found, k).select("query_id", "rank", "vec_id", "score")


def _best(scored: DataFrame, k: int) -> DataFrame:
    """The ``k`` best rows of each query with their rank, each candidate once."""
    once = scored.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    best = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return once.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def _search(shared, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks: dict[int, Block] = {}
        by_length: dict[int, list] = {}
        for item in shared.value:
            by_length.setdefault(len(item[1]), []).append(item)
        for length, items in by_length.items():
            blocks[length] = Block(np.array([i for i, _ in items]), np.stack([v for _, v in items]), k)
        for batch in batches:
            lists = batch.column(1)
            lengths = lists.value_lengths().to_numpy()
            values = np.floor(lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
            starts, ids = np.cumsum(lengths) - lengths, batch.column(0).to_numpy(zero_copy_only=False)
            for length, own in blocks.items():
                mine = np.flatnonzero(lengths == length)
                for begin in range(0, len(mine), _ROWS):
                    some = mine[begin : begin + _ROWS]
                    own.offer(ids[some], values[starts[some][:, None] + np.arange(length)])
        out = [(int(q), b, s) for own in blocks.values() for q, best in zip(own.ids, own.best, strict=True) for b, s in best.items()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[c] for r in out], pa.int64()) for c in range(3)], ["query_id", "vec_id", "score"]
        )

    return run
