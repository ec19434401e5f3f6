"""Top-k search against brute force, with ties, repeated rows and unusable vectors."""

import math
import random

import numpy as np
import pytest

from tracecurate.llm import topk


def brute(rows, k, every):
    usable = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = {}
    for q, v in usable:
        if q % every == 0:
            own = out.setdefault(q, {})
            for c, w in usable:
                if c != q and len(w) == len(v):
                    s = min(max(sum(a * b for a, b in zip(v, w, strict=True)), -(2**63)), 2**63 - 1)
                    own[c] = max(own.get(c, s), s)
    return sorted((q, n + 1, c, s) for q, own in out.items() for n, (c, s) in enumerate(sorted(own.items(), key=lambda x: (-x[1], x[0]))[:k]))


def search(spark, rows, **more):
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").selectExpr("*", "1 as score", "2 as rank", "3 as v")
    return sorted(map(tuple, topk.top_k(df, queries="vec_id % 10 = 0", **more).collect()))


def test_equals_brute_force(spark):
    rng = random.Random(5)
    rows = [(i, [rng.gauss(0, 0.2) for _ in range(48)]) for i in range(700)]
    rows += [(i + 700, rows[i][1]) for i in range(60)]  # ties
    assert search(spark, rows) == brute(rows, 5, 10)
    assert search(spark, rows, block=8) == brute(rows, 5, 10)


def test_edges(spark):
    rows = [(0, [0.5, 0.1]), (0, [0.4, 0.9]), (10, [0.1] * 3), (20, None), (30, []), (40, [0.1, None]), (50, [0.1, float("nan")]), (60, [float("inf"), 0.0])]
    rows += [(None, [0.2, 0.2]), (1, [0.3, 0.3]), (1, [0.3, 0.3]), (2, [0.3, 0.3]), (3, [-1.0, -1.0]), (4, [0.1] * 3), (70, [])]
    assert search(spark, rows) == brute(rows, 5, 10)
    assert search(spark, []) == []
    assert search(spark, [(1, [0.5])]) == []


@pytest.mark.parametrize("n", [1, 2, 8, 16])
def test_bounds_hold(n):
    rng = np.random.default_rng(n)
    a, b = rng.integers(-150, 150, (50, 37)).astype(float), rng.integers(-150, 150, (60, 37)).astype(float)
    assert (topk.features(a, n) @ topk.features(b, n).T + 1e-6 >= a @ b.T).all()


@pytest.mark.parametrize("size", [1e6, 1e9, 1e15, 1e30])
def test_large_components_are_exact(spark, size):
    """Scores beyond 2**53 as whole numbers, those beyond a long as its ends."""
    rng = random.Random(int(size))
    rows = [(i, [rng.gauss(0, size) for _ in range(20)]) for i in range(120)]
    rows += [(i + 200, [x + rng.choice((0, size * 1e-7)) for x in rows[0][1]]) for i in range(30)]  # nearly ties
    rows += [(i + 300, [rng.gauss(0, 1) for _ in range(20)]) for i in range(20)]
    assert search(spark, rows) == brute(rows, 5, 10)


def test_many_blocks_long_vectors_and_repeated_queries(spark, monkeypatch):
    rng = random.Random(9)
    rows = [(i, [rng.gauss(0, 0.2) for _ in range(3000)]) for i in range(60)]
    rows += [rows[0]] * 400 + [(0, [rng.gauss(0, 0.2) for _ in range(3000)]) for _ in range(5)]
    monkeypatch.setattr(topk, "BLOCK_BYTES", 4 * 8 * 3000)
    assert search(spark, rows) == brute([*rows[:60], *rows[460:]], 5, 10)
