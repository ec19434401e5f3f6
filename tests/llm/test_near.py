"""Near-duplicates against all pairs, in texts with hot groups, ties and edges."""

import random
import re
from math import comb

import numpy as np
import pytest
from conftest import SF_DIR
from corpus_fixtures import edge_pairs, make_docs  # noqa: F401

from tracecurate.llm import near
from tracecurate.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, n):
    w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()


def brute(pairs, n, percent=80):
    sets = [(i, shingles(t, n)) for i, t in pairs]
    parent = {i: i for i, _ in sets if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    usable = [(i, s) for i, s in sets if i is not None and s]
    for k, (i, s) in enumerate(usable):
        for j, t in usable[:k]:
            both = len(s & t)
            if 100 * both >= percent * (len(s) + len(t) - both):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return sorted(((i is None, i or 0, len(s), None if i is None else find(i)) for i, s in sets), key=repr)


def ours(df):
    rows = df.collect()
    assert all(r.kept == (r.doc_id is None or r.doc_id == r.component_id) for r in rows)
    return sorted(((r.doc_id is None, r.doc_id or 0, r.n_shingles, r.component_id) for r in rows), key=repr)


@pytest.mark.parametrize("n", [2, 5])
def test_copies_of_all_degrees(make_docs, n):
    rng = random.Random(n)
    word = lambda: "".join(rng.choice("abcdef") for _ in range(rng.randint(1, 5)))
    base = [[word() for _ in range(rng.randint(10, 90))] for _ in range(12)]
    pairs = []
    for k in range(240):
        text = list(base[0] if k % 3 == 0 else base[k % 12])  # one group has a third of all rows
        for _ in range(rng.randrange(1 + len(text) // 6)):
            text[rng.randrange(len(text))] = word()
        pairs.append((k * 7 % 241, " ".join(text)))
    pairs += [(1000 + k, pairs[k][1].upper()) for k in range(30)]
    assert ours(near.near_duplicates(make_docs(pairs), n)) == brute(pairs, n)


def test_edges(make_docs, edge_pairs):
    assert ours(near.near_duplicates(make_docs(edge_pairs), 2)) == brute(edge_pairs, 2)
    assert near.near_duplicates(make_docs([])).collect() == []
    docs = make_docs(edge_pairs)
    kept = near.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    gone = {i for i, _ in edge_pairs} - {r.doc_id for r in kept.collect()}
    assert gone == {5}


def test_repeated_rows_of_one_id_are_kept_once(make_docs):
    long, other = "a text that is delivered many times under one id", "quite another text that has the same id"
    pairs = [(1, long)] * 50 + [(1, other)] * 3 + [(2, long)] * 4 + [(3, "")] * 2 + [(4, None)] * 2 + [(5, "only once here")] + [(None, long)] * 2
    docs = make_docs(pairs)
    kept = near.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    want = [(1, long), (1, other), (3, ""), (4, None), (5, "only once here"), (None, long), (None, long)]
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted(want, key=repr)


def test_rows_of_one_id_that_differ_in_another_column_stay(make_docs):
    docs = make_docs([(6, "the same words in two rows")]).unionByName(make_docs([(6, "the same words in two rows")] * 2, lang="de"))
    assert sorted(r.lang for r in near.drop_near_duplicates(docs).collect()) == ["de", "en"]


@pytest.mark.parametrize("percent", [50, 75, 80])
def test_small_sets_with_a_shared_shingle(make_docs, percent):
    """Sets of few shingles, each one away from others; those below the bound are not posted."""
    rng = random.Random(percent)
    texts = [" ".join(["thank", "you", *(rng.choice("abc") for _ in range(rng.randrange(7)))]) for _ in range(150)]
    pairs = [*enumerate(texts), (900, "thank you thank you"), (901, "you thank you"), (902, "thank")]
    assert ours(near.near_duplicates(make_docs(pairs), 2, percent)) == brute(pairs, 2, percent)


def test_many_small_sets_are_not_posted(make_docs):
    docs = make_docs([(k, f"thank you {k}") for k in range(10_000)])
    signed = near.signatures(docs, 2).withColumnRenamed("doc_id", "id")
    assert near._prefixes(signed, near.least_matches(80), 80).isEmpty()
    rows = near.near_duplicates(docs, 2).collect()
    assert len(rows) == 10_000 and all(r.kept for r in rows)


def test_given_table(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    pairs = [(r.doc_id, r.text) for r in docs.collect()]
    assert ours(near.near_duplicates(docs, 2)) == brute(pairs, 2)


def test_threshold_and_prefix_leave_out_few():
    t = near.least_matches(80)
    rng = np.random.default_rng(1)
    n = near.COORDINATES
    assert sum(comb(n, k) * 0.8**k * 0.2 ** (n - k) for k in range(t)) <= near.MISS
    for _ in range(200):  # pairs right at the threshold
        shared = rng.integers(0, 2**63, 80).astype(np.uint64)
        a = near.signature(np.unique(np.concatenate([shared, rng.integers(0, 2**63, 10).astype(np.uint64)])))
        b = near.signature(np.unique(np.concatenate([shared, rng.integers(0, 2**63, 10).astype(np.uint64)])))
        assert (a == b).sum() >= t


def test_components(spark):
    chain = [(k, k + 1) for k in range(40)] + [(100, 103), (103, 101), (101, 100), (7, 7), (None, 3), (500, 499)]
    found = {r.id: r.component for r in components(spark.createDataFrame(chain, "a bigint, b bigint")).collect()}
    assert found == {**dict.fromkeys(range(41), 0), 100: 100, 101: 100, 103: 100, 499: 499, 500: 499}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []
