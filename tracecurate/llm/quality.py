"""Quality classifier: regularised quadratic discriminant over document statistics.

Each class is a Gaussian over transformed statistics of a document. Its covariance is
shrunk towards the pooled one and that towards a multiple of the identity. The score is the
logistic function of the log-density difference, from Mahalanobis distances that are solved
with Cholesky factors made once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import PIECE, byte_texts, filter_texts, narrow, stored, word_hashes
from .language import held_out

STATISTICS = (
    "log bytes per word",
    "capitals among letters",
    "digits",
    "stops and commas",
    "other marks",
    "words equal to the one before",
    "distinct words, log ratio",
    "share of the commonest word",
)
# What plain prose has, and how many more bytes or words of it every text is given, so that
# the shares of a text of a few words do not stand out by chance.
_PROSE = {"word": 5.0, "capitals": 0.03, "digits": 0.005, "stops": 0.03, "others": 0.002, "again": 0.01, "common": 0.06}
_MORE_BYTES, _MORE_WORDS = 100, 20

_KIND = np.full(256, 5, dtype=np.int64)  # 0 small, 1 capital, 2 digit, 3 blank, 4 stop, 5 other mark
_KIND[ord("a") : ord("z") + 1] = 0
_KIND[128:] = 0
_KIND[ord("A") : ord("Z") + 1] = 1
_KIND[ord("0") : ord("9") + 1] = 2
_KIND[[32, 9, 10, 11, 12, 13]] = 3
_KIND[[ord(c) for c in ".,;:'\"()-"]] = 4


def _share(part: float, whole: float, usual: float, more: int) -> float:
    """Arcsine of the root of a share: evens out its variance."""
    return float(np.arcsin(np.sqrt((part + usual * more) / (whole + more))))


def statistics(text: bytes) -> list[float]:
    """The values of STATISTICS; those of plain prose for an empty text."""
    words = word_hashes(text)
    kinds = np.zeros(6, dtype=np.int64)
    for start in range(0, len(text), PIECE):
        seen = np.bincount(np.frombuffer(text[start : start + PIECE], dtype=np.uint8), minlength=256)
        kinds += np.bincount(_KIND, weights=seen, minlength=6).astype(np.int64)
    marks, letters, count = int(kinds.sum() - kinds[3]), int(kinds[0] + kinds[1]), len(words)
    ordered = np.sort(words)
    edges = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1], [True]]))
    distinct, most = (len(edges) - 1, int(np.diff(edges).max())) if count else (0, 0)
    again = int((words[1:] == words[:-1]).sum())
    return [
        float(np.log((marks + _PROSE["word"] * _MORE_WORDS) / (count + _MORE_WORDS))),
        _share(kinds[1], letters, _PROSE["capitals"], _MORE_BYTES),
        _share(kinds[2], marks, _PROSE["digits"], _MORE_BYTES),
        _share(kinds[4], marks, _PROSE["stops"], _MORE_BYTES),
        _share(kinds[5], marks, _PROSE["others"], _MORE_BYTES),
        _share(again, count, _PROSE["again"], _MORE_WORDS),
        float(np.log(distinct + _MORE_WORDS) / np.log(count + _MORE_WORDS)),
        _share(most, count, _PROSE["common"], _MORE_WORDS),
    ]


def document_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, x) for every row, from its whole text; a null text counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = pa.array([statistics(text) for text in byte_texts(batch.column(1))], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), values], ["doc_id", "x"])

    rows = narrow(docs, doc_id=id_col, text=text_col)
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, x array<double>")


@dataclass
class Discriminant:
    """Class means, Cholesky factors and log weights; classes are 0 and 1."""

    means: list[np.ndarray]
    factors: list[np.ndarray]
    weights: list[float]
    constant: float | None = None  # the score if a class was never seen

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        densities = []
        for mean, factor, weight in zip(self.means, self.factors, self.weights, strict=True):
            z = np.linalg.solve(factor, (x - mean).T)
            densities.append(weight - np.log(np.diag(factor)).sum() - 0.5 * (z * z).sum(axis=0))
        return 1 / (1 + np.exp(np.clip(densities[0] - densities[1], -700, 700)))


def fit(rows: DataFrame, to_pooled: float = 0.2, to_identity: float = 0.02) -> Discriminant:
    """Fit on (x, label) rows of labels 0 and 1 by one aggregation of sums and products.

    Without any row the score is 0.5; with one class only it is that class.
    """
    size = len(STATISTICS)
    pairs = [(i, j) for i in range(size) for j in range(i + 1)]
    sums = [F.sum(F.col("x")[i]).alias(f"s{i}") for i in range(size)]
    products = [F.sum(F.col("x")[i] * F.col("x")[j]).alias(f"p{i}_{j}") for i, j in pairs]
    found = {row["label"]: row for row in rows.where("label in (0, 1)").groupBy("label").agg(F.count("*").alias("n"), *sums, *products).collect()}
    if len(found) < 2:
        return Discriminant([], [], [], constant=float(next(iter(found), 0.5)))
    means, scatters, counts = [], [], []
    for label in (0, 1):
        row, n = found[label], found[label]["n"]
        mean = np.array([row[f"s{i}"] for i in range(size)]) / n
        scatter = np.zeros((size, size))
        for i, j in pairs:
            scatter[i, j] = scatter[j, i] = row[f"p{i}_{j}"] - n * mean[i] * mean[j]
        means.append(mean)
        scatters.append(scatter)
        counts.append(n)
    pooled = (scatters[0] + scatters[1]) / sum(counts)
    scale = np.diag(np.maximum(np.diag(pooled), 1e-6))
    factors = []
    for scatter, n in zip(scatters, counts, strict=True):
        own = (1 - to_pooled) * scatter / n + to_pooled * pooled
        factors.append(np.linalg.cholesky((1 - to_identity) * own + to_identity * scale))
    return Discriminant(means, factors, [float(np.log(n / sum(counts))) for n in counts])


def apply(stats: DataFrame, model: Discriminant) -> DataFrame:
    """(doc_id, x) -> (doc_id, score, predicted)."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            x = np.array(frame["x"].tolist(), dtype=np.float64).reshape(len(frame), len(STATISTICS))
            score = model.score(x)
            yield pd.DataFrame({"doc_id": frame["doc_id"], "score": score, "predicted": (score >= 0.5).astype("int32")})

    kind = stats.schema["doc_id"].dataType.simpleString()
    return stats.mapInPandas(run, f"doc_id {kind}, score double, predicted int")


def learn(stats: DataFrame, labels: DataFrame, label_col: str = "quality", parts: int = 3, part: int = 1) -> Discriminant:
    """Fit on the labelled documents that are not held out. Null labels teach nothing; a
    document that is labelled twice counts twice."""
    marks = narrow(labels, doc_id="doc_id", label=label_col).where("label is not null and doc_id is not null")
    seen = marks.where(~held_out(F.col("doc_id"), parts, part))
    return fit(stats.join(seen, "doc_id").select("x", "label"))


def classify(docs: DataFrame, labels: DataFrame, label_col: str = "quality", parts: int = 3, part: int = 1) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``.

    The score is the chance of label 1, 0.5 and more predicts 1. Empty and null texts are
    scored like any other; null ids and repeated rows stay as they are.
    """
    stats = stored(document_statistics(docs), "statistics")
    scored = apply(stats, learn(stats, labels, label_col, parts, part))
    return scored.select("doc_id", held_out(F.col("doc_id"), parts, part).alias("held_out"), "score", "predicted")


def keep_good(docs: DataFrame, labels: DataFrame, label_col: str = "quality", parts: int = 3, part: int = 1) -> DataFrame:
    """The rows of ``docs`` that are predicted 1, by a model learned as in ``classify``. The
    model is small and goes to the rows, so no text moves."""
    stats = stored(document_statistics(docs), "statistics")
    model = learn(stats, labels, label_col, parts, part)
    return filter_texts(
        docs, "text", lambda: lambda texts: (model.score(np.array([statistics(t) for t in texts]).reshape(-1, len(STATISTICS))) >= 0.5).tolist()
    )
