"""Language identification by rank-order profiles of character n-grams.

A profile is the list of the most frequent n-grams of 1 to 3 letters, words being set off by
a blank. A text gets the language whose profile has its n-grams the least out of place.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import PIECE, narrow, stored

UNKNOWN = "und"
_BITS = 21  # of a code point
_BLANK = 32
_LETTERS: np.ndarray | None = None
_FLUSH = 500_000  # n-grams that a task holds before it hands them on


def _letters() -> np.ndarray:
    global _LETTERS
    if _LETTERS is None:
        _LETTERS = np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000)
    return _LETTERS


def grams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-gram codes of a whole text, rising, and their counts."""
    points = np.frombuffer((text or "").lower().encode("utf-32-le", "replace"), dtype=np.uint32)
    points = np.where(_letters()[points], points, _BLANK).astype(np.int64)
    if len(points):  # runs of blanks become one, and one stands at either end
        points = points[(points != _BLANK) | np.concatenate([[True], points[:-1] != _BLANK])]
    if not (points != _BLANK).any():
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    end = np.full(1, _BLANK)
    points = np.concatenate([end, points[int(points[0] == _BLANK) :], end[: int(points[-1] != _BLANK)]])
    found = []
    for start in range(0, len(points), PIECE):  # neighbours overlap by what an n-gram needs
        a = points[start : start + PIECE + 2]
        ones, twos = a[:PIECE], a[: PIECE + 1]
        b = twos[:-1] | (twos[1:] << _BITS)
        c = a[:-2] | (a[1:-1] << _BITS) | (a[2:] << 2 * _BITS)
        found.append(np.unique(np.concatenate([ones[ones != _BLANK], b, c[a[1:-1] != _BLANK]]), return_counts=True))
    if len(found) == 1:
        return found[0]
    return _summed([codes for codes, _ in found], [counts for _, counts in found])


def _summed(codes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    distinct, where = np.unique(np.concatenate(codes), return_inverse=True)
    sums = np.zeros(len(distinct), dtype=np.int64)
    np.add.at(sums, where, np.concatenate(counts))
    return distinct, sums


def ranked(codes: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """The ``size`` most frequent codes, most frequent first, ties by code."""
    if len(codes) > 4 * size:  # sort only those that can be among them
        least = np.partition(counts, len(counts) - size)[len(counts) - size]
        codes, counts = codes[counts >= least], counts[counts >= least]
    return codes[np.argsort(-counts, kind="stable")[:size]]


def learn_profiles(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", size: int = 300) -> DataFrame:
    """(lang, rank, gram) of the ``size`` most frequent n-grams of each language, over all of
    ``docs``. Rows without language or letter teach nothing; equal counts are ranked by code."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[list, list]] = {}
        sizes = 0

        def flush():
            for lang, (codes, counts) in held.items():
                distinct, sums = _summed(codes, counts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(distinct), pa.string()), pa.array(distinct), pa.array(sums)], ["lang", "gram", "n"]
                )
            held.clear()

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                codes, counts = grams(text.as_py())
                own = held.setdefault(lang, ([], []))
                own[0].append(codes)
                own[1].append(counts)
                sizes += len(codes)
                if sizes > _FLUSH:
                    for key, (a, b) in list(held.items()):
                        x, y = _summed(a, b)
                        held[key] = ([x], [y])
                    sizes = sum(len(a[0]) for a, _ in held.values())
                    if sizes > _FLUSH // 2:
                        yield from flush()
                        sizes = 0
        yield from flush()

    rows = narrow(docs, lang=lang_col, text=text_col).where("lang is not null and text is not null")
    counted = rows.mapInArrow(count, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    best = W.partitionBy("lang").orderBy(F.desc("n"), "gram")
    return counted.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= size).select("lang", "rank", "gram")


class Profiles:
    """Ranks of n-grams by language."""

    def __init__(self, rows: list[tuple[str, int, int]], size: int):
        self.size = size
        self.langs = sorted({lang for lang, _, _ in rows})
        self.codes = np.unique(np.array([gram for _, _, gram in rows], dtype=np.int64))
        # A missing n-gram is as far out of place as can be; the last column stands for it.
        self.ranks = np.full((len(self.langs), len(self.codes) + 1), size, dtype=np.int64)
        for lang, rank, gram in rows:
            self.ranks[self.langs.index(lang), np.searchsorted(self.codes, gram)] = rank - 1
        self.missing = np.zeros(len(self.codes) + 1, dtype=bool)
        self.missing[-1] = True

    def predict(self, text: str | None) -> tuple[str, float]:
        codes = ranked(*grams(text), self.size)
        if not len(codes) or not self.langs:
            return UNKNOWN, 0.0
        at = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        at = np.where(self.codes[at] == codes, at, len(self.codes))
        ranks = self.ranks[:, at]
        places = np.where(ranks == self.size, self.size, np.abs(ranks - np.arange(len(codes))))
        distance = places.sum(axis=1)
        best = int(distance.argmin())  # the first in alphabetical order among equals
        return self.langs[best], float(1 - distance[best] / (self.size * len(codes)))


def identify(docs: DataFrame, profiles: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 300) -> DataFrame:
    """(doc_id, lang_pred, score) for every row. Texts that are null or hold no letter are
    ``und`` with score 0, as all are if nothing was learned; ties go to the language first
    in the alphabet. Null ids and repeated rows stay as they are."""
    known = Profiles([tuple(row) for row in profiles.select("lang", "rank", "gram").collect()], size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [known.predict(text.as_py()) for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                ["doc_id", "lang_pred", "score"],
            )

    rows = narrow(docs, doc_id=id_col, text=text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")


def held_out(doc_id, parts: int, part: int):
    """Whether a document is kept from learning: crc32 of its id as text; a null id is never."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % parts == part


def evaluate_languages(docs: DataFrame, parts: int = 4, part: int = 2, size: int = 300) -> DataFrame:
    """Learn from all documents but those held out, predict every one:
    (doc_id, held_out, lang_pred, score)."""
    profiles = stored(learn_profiles(docs.where(~held_out(F.col("doc_id"), parts, part)), size=size), "profiles")
    return identify(docs, profiles, size=size).select(
        "doc_id", held_out(F.col("doc_id"), parts, part).alias("held_out"), "lang_pred", "score"
    )
