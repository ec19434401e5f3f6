"""Ranked search against plain scoring of all documents."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from corpus_fixtures import edge_pairs, make_docs, prose  # noqa: F401

from tracecurate.llm import search

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(pairs, items, k=10):
    docs = [(i, Counter(terms(t))) for i, t in pairs]
    docs = [(i, c) for i, c in docs if c]
    total, length = len(docs), sum(c.total() for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    out = []
    for item in {i for i, _ in items}:
        asked = {t for i, text in items if i == item for t in terms(text)}
        scored = []
        for i, c in docs:
            m = 100 - 90 + 90 * c.total() * total // length
            score = sum(math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in asked if c[t])
            if score > 0:
                scored.append((-score, i is None, i or 0))
        out += [(item, r, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


def ours(docs, items, **given):
    return sorted((tuple(r) for r in search.rank_documents(docs, items, **given).collect()), key=repr)


@pytest.fixture(scope="module")
def make_items(spark):
    return lambda items: spark.createDataFrame(items, "item_id bigint, text string")


def corpus(seed, count):
    rng = random.Random(seed)
    pairs = [(k, prose(seed * 1000 + k % 70, rng.randrange(1, 60), 40 if k % 3 else 900)) for k in range(count)]
    pairs += [(count + k, pairs[k % 5][1]) for k in range(60)] + [(7, pairs[7][1])] * 25
    items = [(k, " ".join(rng.choice(pairs)[1].split()[:12]) + " common tail") for k in range(25)]
    return pairs, items


def test_equals_brute_force(make_docs, make_items, edge_pairs):
    pairs, items = corpus(1, 220)
    pairs += edge_pairs
    items += [(100, None), (101, ""), (102, "!? --"), (None, "one word"), (None, "text of an item without an id"), (3, "the same words"), (104, "Çà NAÏVE naïve"), (105, "nowhere0")]
    assert ours(make_docs(pairs), make_items(items)) == brute(pairs, items)
    assert ours(make_docs(pairs), make_items(items), k=3) == brute(pairs, items, 3)


def test_small_blocks_of_items_and_documents(make_docs, make_items, monkeypatch):
    pairs, items = corpus(2, 90)
    monkeypatch.setattr(search, "BLOCK_TERMS", 60)
    monkeypatch.setattr(search, "BLOCK_DOCS", 3)
    monkeypatch.setattr(search, "_EXPANDED", 200)
    assert ours(make_docs(pairs), make_items(items)) == brute(pairs, items)


def test_empty_tables(make_docs, make_items):
    assert ours(make_docs([]), make_items([(1, "a")])) == []
    assert ours(make_docs([(1, "a")]), make_items([])) == []
    assert ours(make_docs([(1, "?"), (2, None)]), make_items([(1, "a")])) == []


def block_of(docs, items):
    """The block of plain items, and vectors (terms, impacts) of plain documents."""
    names = sorted({t for d in docs for t in d} | {t for i in items for t in i})
    number = {t: k for k, t in enumerate(names)}
    df = Counter(t for d in docs for t in set(d))
    length = sum(map(len, docs))
    first = search.Items([(0, k, 1, 1) for k in range(len(names))], len(docs), length)
    vectors = []
    for d in docs:
        c = Counter(d)
        idx = np.array(sorted(number[t] for t in c))
        vectors.append((idx, first.impacts(np.array([c[names[k]] for k in idx]), np.full(len(idx), len(d)))))
    top = np.zeros(len(names), dtype=np.int64)
    for idx, impact in vectors:
        np.maximum.at(top, idx, impact)
    rows = [(q, number[t], df[t], top[number[t]]) for q, item in enumerate(items) for t in set(item) if df[t]]
    block = search.Items(rows, len(docs), length)
    placed = []
    for idx, impact in vectors:
        held = np.isin(idx, block.terms)
        placed.append((np.searchsorted(block.terms, idx[held]), impact[held]))
    return block, placed


def test_bounds_hold_and_closed_lists_cannot_reach_the_floor():
    rng = random.Random(4)
    docs = [[f"w{min(rng.randrange(60), rng.randrange(60))}" for _ in range(rng.randrange(1, 40))] for _ in range(300)]
    items = [sorted({f"w{rng.randrange(60)}" for _ in range(8)}) for _ in range(12)]
    block, placed = block_of(docs, items)
    score = np.array([[block.products(np.full(len(i), q), np.zeros(len(i), dtype=np.int64), i, x, 1)[0] for i, x in placed] for q in range(len(block.items))])
    block.floor = np.sort(score, axis=1)[:, -10]
    block.open_needed()
    lengths = np.array([len(i) for i, _ in placed])
    term, sizes, members, widths, at, tops = search.cut_lists(np.arange(300), lengths, np.concatenate([i for i, _ in placed]), np.concatenate([x for _, x in placed]), block)
    assert sizes.max() <= search.BLOCK_DOCS and len(members) == sizes.sum()
    seen = [set() for _ in items]
    m0 = w0 = 0
    for t, size, width in zip(term, sizes, widths):
        own, where, top = members[m0 : m0 + size], at[w0 : w0 + width], tops[w0 : w0 + width]
        m0, w0 = m0 + size, w0 + width
        for entry in np.flatnonzero(block.open & (block.entry_term == t)):
            q = block.entry_item[entry]
            bound = block.products(np.full(width, q), np.zeros(width, dtype=np.int64), where, top, 1)[0]
            assert bound >= score[q, own].max()
            if bound >= block.floor[q]:
                seen[q] |= set(own.tolist())
    for q in range(len(items)):
        assert set(np.flatnonzero(score[q] >= max(block.floor[q], 1))) <= seen[q]


def test_pieces_end_with_a_term(monkeypatch):
    text = ("Abc dé9 " * 50 + "x" * 30 + "-Y").encode()
    whole = search.term_counts(text)
    monkeypatch.setattr(search, "PIECE", 7)
    assert search.term_counts(text) == whole and whole[b"abc"] == 50 and whole["dé9".encode()] == 50
