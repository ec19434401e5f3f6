"""Content-defined chunks: locality of cuts, whole copies found, clean texts left alone."""

import random

import numpy as np
from conftest import SF_DIR
from corpus_fixtures import edge_pairs, make_docs  # noqa: F401
from pyspark.sql import functions as F

from tracecurate.llm import chunks


def words(seed, n):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9))) for _ in range(n))


def test_gear_rolls():
    data = np.frombuffer(words(1, 50).encode(), dtype=np.uint8)
    state, plain = 0, []
    for byte in data:
        state = (4 * state + int(chunks._GEAR[byte])) % 2**32
        plain.append(state)
    assert chunks.gear(data).tolist() == plain


def test_cuts_cover_and_do_not_depend_on_pieces(monkeypatch):
    text = (words(2, 3000) + "=" * 2000 + words(3, 200)).encode()
    whole = chunks.cuts(text)
    assert whole[-1] == len(text) and (np.diff(whole) > 0).all() and np.diff(whole, prepend=0).max() <= chunks.LONGEST
    monkeypatch.setattr(chunks, "PIECE", 1000)
    assert chunks.cuts(text).tolist() == whole.tolist()


def test_an_insertion_moves_only_cuts_beside_it():
    text = words(4, 2000).encode()
    at = 5000
    longer = text[:at] + b"inserted" + text[at:]
    a, b = set(chunks.cuts(text).tolist()), {c - 8 if c > at + 8 else c for c in chunks.cuts(longer).tolist()}
    assert len(a ^ b) <= 4


def test_shifted_passages_are_found_and_clean_texts_are_not(make_docs):
    passages = [words(100 + k, 55) for k in range(20)]
    pairs = [(k, words(200 + k, 30 + k) + " " + passages[k] + " " + words(300 + k, 40)) for k in range(20)]
    pairs += [(50 + k, words(400 + k, 3 + 7 * k) + " " + passages[k] + " " + words(500 + k, 9)) for k in range(20)]
    pairs += [(200 + k, words(600 + k, 120)) for k in range(20)]
    found = chunks.find_repeats(make_docs(pairs)).collect()
    assert {(r.doc_id, r.first_doc_id) for r in found} == {(50 + k, k) for k in range(20)}
    texts = dict(pairs)
    for r in found:
        assert texts[r.doc_id].encode()[r.start : r.end].decode() in passages[r.first_doc_id]


def test_edges(make_docs, edge_pairs):
    docs = make_docs(edge_pairs)
    kept = chunks.remove_repeats(docs)
    assert kept.columns == docs.columns
    texts = sorted((r.doc_id is None, r.doc_id or 0, r.text or "", r.text is None) for r in kept.collect())
    # Document 5 is a whole copy of document 4, short as it is.
    want = sorted((i is None, i or 0, "" if i == 5 else t or "", t is None) for i, t in edge_pairs if i != 9)
    assert [t for t in texts if t[1] != 9] == want
    assert chunks.find_repeats(make_docs([])).collect() == []
    assert chunks.remove_repeats(make_docs([])).collect() == []


def test_rows_of_one_id_are_told_apart(make_docs):
    a, b = words(20, 200), words(21, 200)
    pairs = [(1, a), (2, a), (2, b), (2, b), (3, b)]
    kept = sorted((r.doc_id, r.text) for r in chunks.remove_repeats(make_docs(pairs)).collect())
    assert kept == sorted([(1, a), (2, ""), (2, b), (2, b), (3, "")])


def test_short_texts_are_found_as_wholes_only(make_docs):
    """A stretch under 64 bytes counts if it is all of its text, in one chunk or in several."""
    several = next(t for t in (words(k, 9)[:63] for k in range(700, 900)) if len(chunks.cuts(t.encode())) > 1)
    pairs = [(1, "one"), (2, "one"), (3, "one"), (4, "none"), (5, several), (6, several), (7, several + "!"), (8, "one " + words(30, 50))]
    found = {r.doc_id: (r.first_doc_id, r.start, r.end, r.chunks) for r in chunks.find_repeats(make_docs(pairs)).collect()}
    size = len(several)
    assert found == {2: (1, 0, 3, 1), 3: (1, 0, 3, 1), 6: (5, 0, size, len(chunks.cuts(several.encode())))}


def test_copies_lose_all_but_the_first(make_docs):
    text = "é" * 3 + words(9, 400) + "ü"
    kept = {r.doc_id: r.text for r in chunks.remove_repeats(make_docs([(3, text), (1, text), (2, text)])).collect()}
    assert kept == {1: text, 2: "", 3: ""}


def test_given_tables_against_brute_force(spark):
    """Every later exact copy of a whole text is found from end to end, short ones too."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    first, later = {}, {}
    for i, t in rows:
        if first.setdefault(t, i) != i and t:
            later[i] = len(t.encode())
    found = {r.doc_id: (r.a, r.b) for r in chunks.find_repeats(docs).groupBy("doc_id").agg(F.min("start").alias("a"), F.max("end").alias("b")).collect()}
    assert later and all(found[i] == (0, n) for i, n in later.items())
