"""The registered corpus queries: names, SQL, shapes, and the pipeline."""

import re

import corpus_pipeline
import pytest
from check_oracles import open_tables, same_rows
from conftest import SF_DIR
from corpus_fixtures import edge_pairs, make_docs  # noqa: F401
from pyspark.sql import functions as F
from test_lines import brute_runs

import __spark_entry__ as contract
from tracecurate.llm.queries import ORACLES, QUERIES


def test_one_query_an_operator():
    numbers = sorted(int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES)
    assert numbers == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, name):
    df = QUERIES[name](spark, SF_DIR)
    same, detail = same_rows(df, open_tables(SF_DIR).execute(ORACLES[name]))
    assert same, detail


@pytest.mark.parametrize("name", ["op5_quotations", "op10_line_dedup"])
def test_native_queries_run_no_python(spark, name):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|InArrow|CartesianProduct", plan)


def test_pipeline_stage_by_stage(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").cache()
    rows = {r.doc_id: r.text for r in docs.collect()}
    columns = docs.columns
    quality_of = {r.doc_id: r.predicted for r in QUERIES["op8_quality"](spark, SF_DIR).collect()}
    stages = dict(corpus_pipeline.STAGES)

    docs = stages["quality"](spark, docs, SF_DIR)
    kept = {r.doc_id: r.text for r in docs.collect()}
    assert kept == {i: t for i, t in rows.items() if quality_of[i] == 1} and docs.columns == columns

    docs = stages["line_dedup"](spark, docs, SF_DIR)
    want = {i: text for i, text, n, removed, *_ in brute_runs(sorted(kept.items()), 3) if not removed or text.strip()}
    kept = {r.doc_id: r.text for r in docs.collect()}
    assert kept == want and docs.columns == columns
    assert docs.where(F.col("n_chars") != F.length("text")).count() == 0

    grams = {i: {tuple(w[k : k + 5]) for k in range(len(w) - 4)} or ({tuple(w)} if w else set()) for i, w in ((i, t.lower().split()) for i, t in kept.items())}
    group = {i: i for i in kept}
    ids = sorted(kept)
    for k, i in enumerate(ids):
        for j in ids[:k]:
            both = len(grams[i] & grams[j])
            if both and 100 * both >= 80 * len(grams[i] | grams[j]):
                a, b = sorted((group[i], group[j]))
                group = {x: a if g == b else g for x, g in group.items()}
    docs = stages["near_dedup"](spark, docs, SF_DIR)
    kept = {r.doc_id: r.text for r in docs.collect()}
    assert set(kept) == {i for i, g in group.items() if i == g} and docs.columns == columns

    items = [" " + " ".join(r.text.lower().split()) + " " for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    leaked = {i for i, t in kept.items() if any(x in " " + " ".join(t.lower().split()) + " " for x in items)}
    docs = stages["decontaminate"](spark, docs, SF_DIR)
    clean = {r.doc_id for r in docs.collect()}
    assert leaked and clean <= set(kept) - leaked and len(clean) >= len(kept) - len(leaked) - 2 and docs.columns == columns

    out = corpus_pipeline.run(spark, SF_DIR)
    assert {r.doc_id for r in out.select("doc_id").collect()} == clean
