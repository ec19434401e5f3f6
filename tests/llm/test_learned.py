"""Quality and language: held-out accuracy, the method against plain numpy, and edges."""

import numpy as np
import pytest
from conftest import SF_DIR
from corpus_fixtures import edge_pairs, make_docs  # noqa: F401
from pyspark.sql import functions as F

from tracecurate.llm import language, quality

BIG = SF_DIR.replace("0.001", "0.01")


def test_quality_held_out(spark):
    docs, labels = (spark.read.parquet(f"{BIG}/{t}.parquet") for t in ("documents", "labels"))
    found = quality.classify(docs, labels)
    assert found.count() == docs.count()
    seen = found.join(labels, "doc_id").where("held_out").agg(F.count("*").alias("n"), F.sum((F.col("predicted") == F.col("quality")).cast("int")).alias("right")).first()
    assert seen.right / seen.n > 0.97


def test_discriminant_equals_the_plain_formula(spark):
    rng = np.random.default_rng(3)
    size = len(quality.STATISTICS)
    x = [rng.normal(k, 1 + k, (60, size)) for k in (0, 1)]
    rows = spark.createDataFrame([(v.tolist(), k) for k in (0, 1) for v in x[k]], "x array<double>, label int")
    model = quality.fit(rows, 0.2, 0.02)
    pooled = sum(np.cov(a.T, bias=True) * len(a) for a in x) / 120
    density = []
    for a in x:
        cov = 0.98 * (0.8 * np.cov(a.T, bias=True) + 0.2 * pooled) + 0.02 * np.diag(np.diag(pooled))
        d = x[0] - a.mean(axis=0)
        density.append(-0.5 * np.linalg.slogdet(cov)[1] - 0.5 * np.einsum("ij,jk,ik->i", d, np.linalg.inv(cov), d))
    assert np.allclose(model.score(x[0]), 1 / (1 + np.exp(density[0] - density[1])))


def test_quality_edges(spark, make_docs, edge_pairs):
    docs = make_docs(edge_pairs)
    kind = "doc_id bigint, quality int, toxic int"
    for rows in ([], [(4, 1, 0), (5, 1, 0), (None, 0, 0), (6, None, 0)], [(4, 1, 0), (4, 1, 0), (9, 0, 0), (8, 1, 1), (77, 0, 0)]):
        found = quality.classify(docs, spark.createDataFrame(rows, kind)).collect()
        assert len(found) == len(edge_pairs)
        assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in found)
    assert quality.classify(make_docs([]), spark.createDataFrame([], kind)).collect() == []
    kept = quality.keep_good(docs, spark.createDataFrame([(4, 1, 0)], kind))
    assert kept.columns == docs.columns and kept.count() == len(edge_pairs)


def test_labels_and_names_are_no_inputs(spark):
    docs, labels = (spark.read.parquet(f"{SF_DIR}/{t}.parquet") for t in ("documents", "labels"))
    held = labels.where(language.held_out(F.col("doc_id"), 3, 1))
    turned = labels.join(held.select("doc_id"), "doc_id", "left_anti").unionByName(held.withColumn("quality", 1 - F.col("quality")))
    score = lambda l: {r.doc_id: r.score for r in quality.classify(docs, l).collect()}
    assert score(labels) == pytest.approx(score(turned))


def test_language_held_out(spark):
    docs = spark.read.parquet(f"{BIG}/documents.parquet")
    found = language.evaluate_languages(docs)
    assert found.count() == docs.count()
    seen = found.join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    assert seen.where("lang = lang_pred").count() / seen.count() > 0.97


def test_grams_equal_plain_counting(monkeypatch):
    text = "Él niño, 12 años -- ÉL  niño\n" * 40
    plain = {}
    words = "".join(c if c.isalpha() else " " for c in text.lower()).split()
    joined = " " + " ".join(words) + " "
    for n in (1, 2, 3):
        for k in range(len(joined) - n + 1):
            g = joined[k : k + n]
            if g != " " and not (n == 3 and g[1] == " "):
                code = sum(ord(c) << (21 * p) for p, c in enumerate(g))
                plain[code] = plain.get(code, 0) + 1
    for piece in (1 << 20, 7):
        monkeypatch.setattr(language, "PIECE", piece)
        codes, counts = language.grams(text)
        assert dict(zip(codes.tolist(), counts.tolist())) == plain


def test_language_edges(spark, make_docs, edge_pairs):
    docs = make_docs([*edge_pairs, (50, "12 34 !!")])
    found = language.evaluate_languages(docs).collect()
    assert len(found) == len(edge_pairs) + 1
    unknown = {r.doc_id for r in found if r.lang_pred == "und"}
    assert {1, 2, 3, 50} <= unknown and not {4, 8, 10} & unknown
    assert all(0 <= r.score <= 1 for r in found)
    nothing = language.evaluate_languages(make_docs([(4, "words")], lang=None)).collect()
    assert [(r.lang_pred, r.score) for r in nothing] == [("und", 0.0)]
    assert language.evaluate_languages(make_docs([])).collect() == []
