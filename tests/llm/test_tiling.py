"""Tiles against a plain greedy tiling, and the benchmark filter."""

import random

import numpy as np
import pytest
from conftest import SF_DIR
from corpus_fixtures import edge_pairs, make_docs  # noqa: F401

from tracecurate.llm import tiling


def plain(a, b, least):
    """Greedy string tiling by comparing every pair of places."""
    free_a, free_b, tiles = [True] * len(a), [True] * len(b), []
    while True:
        best = (least - 1, 0, 0)
        for i in range(len(a)):
            for j in range(len(b)):
                n = 0
                while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n] and free_a[i + n] and free_b[j + n]:
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        n, i, j = best
        if n < least:
            return tiles
        tiles.append((i, j, n))
        for k in range(n):
            free_a[i + k] = free_b[j + k] = False


@pytest.mark.parametrize("seed", range(12))
def test_tiles_equal_plain_ones(seed):
    rng = random.Random(seed)
    a = np.array([rng.randrange(3) for _ in range(rng.randrange(45))], dtype=np.uint64)
    b = np.array([rng.randrange(3) for _ in range(rng.randrange(30))], dtype=np.uint64)
    ours, theirs = tiling.tile(a, b, 3), plain(a.tolist(), b.tolist(), 3)
    assert sum(n for _, _, n in ours) == sum(n for _, _, n in theirs)
    assert sorted(n for _, _, n in ours) == sorted(n for _, _, n in theirs)
    assert all((a[i : i + n] == b[j : j + n]).all() for i, j, n in ours)


def test_repeated_words_keep_memory_bounded():
    a, b = np.full(20_000, 7, dtype=np.uint64), np.full(300, 7, dtype=np.uint64)
    assert tiling.tile(a, b, 5)[0][2] == 256 or sum(n for _, _, n in tiling.tile(a, b, 5)) == 300


WORDS = [f"w{i}x" for i in range(60)]
ITEM = " ".join(WORDS[:40])


@pytest.fixture(scope="module")
def items(spark):
    rows = [(1, ITEM, 5), (2, None, 5), (3, "too few words", 5), (4, "", 5), (None, " ".join(WORDS[40:]), 5)]
    return spark.createDataFrame(rows, "item_id bigint, text string, tiles int")


def test_moved_parts_are_covered(make_docs, items):
    parts = [WORDS[k : k + 8] for k in range(0, 40, 8)]
    moved = " ".join(w for p in (parts[3], ["z"], parts[0], ["y"], parts[4], parts[2], parts[1]) for w in p)
    docs = make_docs(
        [
            (1, "before " + ITEM.upper().replace(" ", ", ") + ". After"),
            (2, moved),
            (3, " ".join(WORDS[:15])),
            (4, " ".join(reversed(WORDS[:40]))),
            (5, " ".join(WORDS[40:])),
            (6, None),
            (7, ""),
            (1, ITEM),
        ]
    )
    found = {(r.doc_id, r.item_id): r for r in tiling.find_leaks(docs, items).collect()}
    assert set(found) == {(1, 1), (2, 1), (5, None)}
    assert found[2, 1].coverage == 1.0 and found[2, 1].tiles >= 4
    kept = tiling.decontaminate(docs, items)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [3, 4, 6, 7]


def test_blocks_change_nothing(make_docs, items, monkeypatch):
    docs = make_docs([(k, ITEM if k % 2 else "clean text of some more words") for k in range(6)])
    whole = sorted(map(tuple, tiling.find_leaks(docs, items).collect()))
    monkeypatch.setattr(tiling, "BLOCK_BYTES", 100)
    assert sorted(map(tuple, tiling.find_leaks(docs, items).collect())) == whole


def test_edges_and_empty_tables(make_docs, edge_pairs, items):
    assert tiling.find_leaks(make_docs([]), items).collect() == []
    assert tiling.find_leaks(make_docs(edge_pairs), items.limit(0)).collect() == []
    assert tiling.find_leaks(make_docs(edge_pairs), items).collect() == []
    assert tiling.decontaminate(make_docs(edge_pairs), items).count() == len(edge_pairs)


def test_given_tables_against_containment(spark):
    """All leaks of the given tables stand there whole and in order."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    items = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    texts = [(r.doc_id, " " + " ".join(r.text.lower().split()) + " ") for r in docs.collect()]
    want = {(d, i.item_id) for i in items.collect() for d, t in texts if " " + " ".join(i.text.lower().split()) + " " in t}
    got = {(r.doc_id, r.item_id) for r in tiling.find_leaks(docs, items).collect()}
    assert want and want <= got and len(got - want) <= 2


def test_items_of_few_words_must_stand_whole(spark, make_docs):
    rows = [(1, "Too few words"), (2, "one"), (3, "..."), (4, ITEM), (5, "few words and more")]
    items = spark.createDataFrame(rows, "item_id int, text string")
    docs = make_docs([(1, "here are too FEW words, and more"), (2, "too many few words"), (3, "one"), (4, ITEM + " too few words"), (5, "few too words")])
    found = sorted((r.doc_id, r.item_id, r.item_words, r.coverage, r.tiles) for r in tiling.find_leaks(docs, items).collect())
    assert [f[:2] for f in found] == [(1, 1), (1, 5), (3, 2), (4, 1), (4, 4)]
    assert all(f[3] == 1.0 for f in found) and found[0][2:] == (3, 1.0, 1)
    assert [r.doc_id for r in tiling.decontaminate(docs, items).orderBy("doc_id").collect()] == [2, 5]


def test_repeated_items_of_any_id(spark, make_docs, monkeypatch):
    docs = make_docs([(1, ITEM), (None, ITEM), (2, "clean words that are in no item")])
    items = spark.createDataFrame([(1, ITEM)] * 300 + [(2, ITEM)], "item_id int, text string")
    monkeypatch.setattr(tiling, "BLOCK_BYTES", 50)
    assert tiling.find_leaks(docs, items).groupBy("doc_id", "item_id").count().orderBy("doc_id", "item_id").collect() == [
        (None, 1, 300), (None, 2, 1), (1, 1, 300), (1, 2, 1)
    ]
    assert [r.doc_id for r in tiling.decontaminate(docs, items).collect()] == [2]
    for kind, want in (("smallint", 2), ("decimal(9,2)", "2.00"), ("date", None)):
        cast = items.where("item_id = 2").selectExpr(f"cast({'null' if kind == 'date' else 'item_id'} as {kind}) item_id", "text")
        assert {r.item_id for r in tiling.find_leaks(docs, cast).collect()} == {want}
