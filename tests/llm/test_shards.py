"""Differencing, the law of sharding, and its edges."""

import zlib
from collections import defaultdict

import numpy as np
import pytest
from corpus_fixtures import edge_pairs, make_docs  # noqa: F401

from tracecurate.llm import shards


def totals(sizes, parts, k):
    return np.bincount(parts, weights=sizes, minlength=k)


@pytest.mark.parametrize("k", [2, 3, 7])
def test_differencing_is_tighter_than_largest_first(k):
    rng = np.random.default_rng(k)
    ours = greedy = 0
    for _ in range(20):
        sizes = rng.integers(1, 10_000, 60)
        sums = totals(sizes, shards.differencing(sizes, k), k)
        loads = np.zeros(k)
        for s in sorted(sizes, reverse=True):
            loads[loads.argmin()] += s
        assert sums.sum() == sizes.sum()
        ours, greedy = ours + sums.max() - sums.min(), greedy + loads.max() - loads.min()
    assert ours < greedy


def test_differencing_of_the_textbook_case():
    sizes = np.array([8, 7, 6, 5, 4])
    assert sorted(totals(sizes, shards.differencing(sizes, 2), 2)) == [14, 16]


def test_differencing_fills_around_a_large_item():
    sizes = np.array([1000] + [10] * 390)
    sums = np.sort(totals(sizes, shards.differencing(sizes, 40), 40))
    assert sums[-1] == 1000 and sums[-2] == sums[0] == 100


def check(rows, pairs, k):
    assert len(rows) == len(pairs)
    want = sorted((i is None, i or 0, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in pairs)
    assert sorted((r.doc_id is None, r.doc_id or 0, r.size, r.text_crc32) for r in rows) == want
    slots, places = defaultdict(list), defaultdict(set)
    for r in rows:
        slots[r.shard].append(r.slot)
        places[r.text_crc32, r.size].add(r.shard)
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < k
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return places


def test_edges(make_docs, edge_pairs):
    rows = shards.shard_documents(make_docs(edge_pairs), shards=4).collect()
    places = check(rows, edge_pairs, 4)
    assert len(places[zlib.crc32(b"one"), 19]) == 1


def test_empty_table(make_docs):
    assert shards.shard_documents(make_docs([])).collect() == []


def test_bins_and_a_hot_group(make_docs):
    pairs = [(i, f"text {i} " + "x" * (i * 37 % 501)) for i in range(1500)] + [(i, "hot " * 100) for i in range(1500, 2200)]
    rows = shards.shard_documents(make_docs(pairs), shards=5, per_bin=50).collect()
    check(rows, pairs, 5)
    loads = defaultdict(int)
    for r in rows:
        loads[r.shard] += r.size
    hot = 700 * 416
    assert max(loads.values()) <= hot * 1.02  # the hot group cannot be split
    others = sorted(loads.values())[:-1]
    assert max(others) - min(others) <= 0.02 * max(others)
