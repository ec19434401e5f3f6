"""Fingerprints against a plain count of triplets, and edits against plain slicing."""

import hashlib
import random

import numpy as np
import pytest
from corpus_fixtures import edge_pairs, make_docs, prose  # noqa: F401
from pyspark.sql import functions as F

from tracecurate.llm import common, digests


def plain_counts(text):
    counts, padded = [0] * digests.BUCKETS, text + b"\0" * 4
    for k in range(len(text)):
        for t, (i, j) in enumerate(digests._TRIPLETS):
            a, b, c = (int(f) for f in digests._FACTORS[t])
            mixed = (padded[k] * a & 0xFFFFFFFF) ^ (padded[k + i] * b & 0xFFFFFFFF) ^ (padded[k + j] * c & 0xFFFFFFFF)
            counts[((mixed ^ mixed >> 15) * 0x9E3779B1 & 0xFFFFFFFF) >> 24] += 1
    return counts


def plain_print(text):
    counts = plain_counts(text)
    q = [sorted(counts)[64 * k - 1] for k in (1, 2, 3)]
    bits = "".join(format(sum(c > x for x in q), "02b") for c in counts)
    header = [min(round(float(np.log2(len(text) + 1)) * 8), 255), min(q[0] * 16 // max(q[2], 1), 15) << 4 | min(q[1] * 16 // max(q[2], 1), 15)]
    return bytes(header).hex() + format(int(bits, 2), "0128x")


def plain_likeness(a, b):
    x, y = bytes.fromhex(a), bytes.fromhex(b)
    codes = lambda d: [v >> s & 3 for v in d[2:] for s in (6, 4, 2, 0)]
    diff = sum(abs(p - q) for p, q in zip(codes(x), codes(y))) + min(abs(x[0] - y[0]), 32) * 4
    diff += 4 * (abs((x[1] >> 4) - (y[1] >> 4)) + abs((x[1] & 15) - (y[1] & 15)))
    return 1 - diff / digests.MOST


def brute(pairs, version):
    """Every row's result, documents in the order of ids and text hashes."""
    order = sorted({(i is not None, i or 0, version[t or ""], t or "") for i, t in pairs})
    out = {}
    for k, (known, i, _, text) in enumerate(order):
        following = order[(k + 1) % len(order)][3]
        n = len(text) // 4
        edited = (text[: len(text) - n] + following[:n]).encode()
        prints = [plain_print(x) for x in (text.encode(), edited, following.encode())]
        out[(i if known else None, text)] = (
            len(text), hashlib.sha256(edited).hexdigest(), prints[0], prints[1],
            plain_likeness(prints[0], prints[1]), plain_likeness(prints[0], prints[2]),
        )
    return sorted(((i, *out[i, t or ""]) for i, t in pairs), key=repr)


@pytest.mark.parametrize("block", [digests.BLOCK_BYTES, 500])
def test_equals_brute_force(spark, make_docs, edge_pairs, monkeypatch, block):
    monkeypatch.setattr(digests, "BLOCK_BYTES", block)
    rng = random.Random(3)
    pairs = [(i, t if t is None or len(t) < 5_000 else t[:3_000]) for i, t in edge_pairs]
    pairs += [(20 + k, prose(k, rng.randrange(60))) for k in range(20)] + [(500, "copy of a row")] * 50
    texts = sorted({t or "" for _, t in pairs})
    hashes = spark.createDataFrame([(t,) for t in texts], "text string").select("text", F.xxhash64("text").alias("h")).collect()
    found = digests.fingerprint_edits(make_docs(pairs)).collect()
    assert sorted((tuple(r) for r in found), key=repr) == brute(pairs, {r.text: r.h for r in hashes})


def test_one_document_follows_itself_and_none_gives_none(make_docs):
    (row,) = digests.fingerprint_edits(make_docs([(1, "abcdefgh")])).collect()
    assert row.edited_sha256 == hashlib.sha256(b"abcdefab").hexdigest() and row.near_next == 1
    assert digests.fingerprint_edits(make_docs([])).collect() == []


def test_pieces_do_not_change_a_fingerprint(monkeypatch):
    texts = [prose(1, 4_000).encode(), b"", b"ab", prose(2, 900).encode()]
    whole = digests.fingerprints(texts)
    assert digests.fingerprints(texts[3:]) == whole[3:]
    monkeypatch.setattr(digests, "PIECE", 1_000)
    assert digests.fingerprints(texts) == whole == [plain_print(t) for t in texts]
    own = digests.digests(texts)
    assert digests.likeness(own, own).tolist() == [1.0] * 4


def test_documents_alone(make_docs):
    docs = make_docs([(1, "some text"), (2, "some text"), (3, None), (4, "")])
    found = {r.doc_id: r.fingerprint for r in digests.fingerprint_documents(docs).collect()}
    assert found[1] == found[2] == plain_print(b"some text") and found[3] == found[4] == plain_print(b"")


def test_edits_are_nearer_than_neighbours(spark):
    from conftest import SF_DIR

    rows = digests.fingerprint_edits(common.table(spark, SF_DIR, "documents")).where("n_chars >= 100").collect()
    assert sum(r.near_edited > r.near_next for r in rows) >= 0.95 * len(rows)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
