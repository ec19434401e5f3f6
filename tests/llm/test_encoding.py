"""Byte-level BPE against the tiktoken library and plain merging."""

import base64
import hashlib
import random
import tracemalloc

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from corpus_fixtures import edge_pairs, make_docs  # noqa: F401

from tracecurate.llm import bpe
from tracecurate.llm.bpe import Prefixes

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def own():
    return bpe.codec(PATH, PATTERN)


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_edges_and_round_trip(make_docs, edge_pairs, library):
    rows = bpe.encode_documents(make_docs(edge_pairs), PATH, PATTERN).collect()
    assert len(rows) == len(edge_pairs)
    left = sorted((i is None, i or 0, hashlib.sha256((t or "").encode()).hexdigest(), library.encode_ordinary(t or "")) for i, t in edge_pairs)
    got = sorted((r.doc_id is None, r.doc_id or 0, r.decoded_sha256, list(r.ids)) for r in rows)
    assert got == left
    for r in rows:
        assert r.n_tokens == len(r.ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(r.ids, dtype="<u4").tobytes()).hexdigest()


def test_empty_table(make_docs):
    assert bpe.encode_documents(make_docs([]), PATH, PATTERN).collect() == []


def test_prefixes_hold_every_prefix(own):
    rng = random.Random(1)
    for piece in (b" unbelievably", b"aaaaaaaaaaaaaaaaab", bytes(rng.randrange(256) for _ in range(60))):
        table = Prefixes(own.vocabulary, piece)
        for end in range(len(piece) + 1):
            assert Prefixes(own.vocabulary, piece[:end]).ids() == own.vocabulary.merged(piece[:end])
        assert table.ids() == own.vocabulary.merged(piece)


def test_append_and_edit_equal_encoding_anew(own):
    rng = random.Random(2)
    letters = b"etaoin shrdlu"
    piece = bytes(rng.choice(letters) for _ in range(300))
    table = Prefixes(own.vocabulary, piece[:100])
    table.append(piece[100:])
    assert table.ids() == own.vocabulary.merged(piece)
    for _ in range(25):
        begin = rng.randrange(len(piece))
        end = min(len(piece), begin + rng.randrange(5))
        by = bytes(rng.choice(letters) for _ in range(rng.randrange(6)))
        table.replace(begin, end, by)
        piece = piece[:begin] + by + piece[end:]
        assert table.piece == piece
        assert table.ids() == own.vocabulary.merged(piece)


def test_an_edit_fills_only_its_neighbourhood(own):
    piece = b"the quick brown fox jumps over it " * 300
    table = Prefixes(own.vocabulary, piece)
    assert table.replace(20, 21, b"x") < 2_000 < len(piece)
    assert table.ids() == Prefixes(own.vocabulary, table.piece).ids()


def spread(seed, count, letters="etaoinshrdlu"):
    """Distinct words."""
    rng = random.Random(seed)
    words = set()
    while len(words) < count:
        words.add("".join(rng.choice(letters) for _ in range(rng.randint(6, 12))))
    return sorted(words)


def test_short_pieces_are_encoded_without_merging(library, monkeypatch):
    monkeypatch.setattr(bpe.Vocabulary, "merged", lambda *_: pytest.fail("merged again"))
    words = " ".join(spread(3, 3_000) + ["x", "  ", "\U0001f600\U0001f601 naïveté über", "12345678901", "\n\n \t ", "-=-=>>"])
    assert np.frombuffer(bpe.Codec(PATH, PATTERN).encode(words), dtype="<u4").tolist() == library.encode_ordinary(words)


def test_a_worker_remembers_few_pieces_and_no_pairs(library):
    own, words = bpe.Codec(PATH, PATTERN), spread(4, 250_000)
    texts = [" " + " ".join(words[k::10]) for k in range(10)]
    tracemalloc.start()
    for text in texts:
        assert len(own.encode(text)) // 4 >= 25_000
    kept = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert kept < 30e6
    assert np.frombuffer(own.encode(texts[0]), dtype="<u4").tolist() == library.encode_ordinary(texts[0])


def test_long_batches_leave_in_parts(make_docs, library):
    words = spread(5, 40_000)
    pairs = [(k, " ".join(words[k * 100 : k * 100 + 100]) * (40 if k % 3 else 1)) for k in range(400)] + [(None, None), (7, ""), (8, "ab" * 700_000)]
    sizes, begin = [], 0
    batch = pa.RecordBatch.from_arrays([pa.array([i for i, _ in pairs], pa.int64()), pa.array([t for _, t in pairs], pa.string())], ["doc_id", "text"])
    for part in bpe._slices(batch):
        assert part.equals(batch.slice(begin, part.num_rows))
        begin += part.num_rows
        sizes.append(sum(len(t or "") for t in part.column(1).to_pylist()[1:]))
    assert begin == len(pairs) and len(sizes) > 5 and max(sizes) <= bpe._SLICE
    assert list(bpe._slices(batch.slice(0, 0))) == []
    rows = bpe.encode_documents(make_docs(pairs[:-1]).coalesce(1), PATH, PATTERN).collect()
    assert sorted((r.doc_id or -1, list(r.ids)) for r in rows) == sorted((i or -1, library.encode_ordinary(t or "")) for i, t in pairs[:-1])


@pytest.mark.parametrize("seed", range(4))
def test_side_by_side_equals_one_by_one_in_any_vocabulary(seed, tmp_path):
    """Also where merging does not reach a token, or reaches it by falling ranks."""
    rng = random.Random(seed)
    tokens = {bytes([b]) for b in range(256)} | {bytes(rng.choice(b"abc") for _ in range(rng.randint(2, 6))) for _ in range(60)}
    ranks = sorted(tokens) if seed == 0 else rng.sample(sorted(tokens), len(tokens))
    path = tmp_path / "ranks"
    path.write_bytes(b"".join(base64.b64encode(t) + b" %d\n" % r for r, t in enumerate(ranks)))
    own = bpe.Vocabulary(str(path))
    tables = bpe.Tables(own)
    assert not tables._in_order.all()
    some = np.array([own.ranks[t] for t in sorted(tokens) if set(t) <= set(b"abc")])
    left, right = np.repeat(some, len(some)), np.tile(some, len(some))
    assert tables.compatible(left, right).tolist() == [own.merged(own.tokens[a] + own.tokens[b]) == [a, b] for a, b in zip(left, right)]

    def outcome(make):
        try:
            return make()
        except ValueError:
            return None

    for _ in range(60):
        piece = bytes(rng.choice(b"abcd") for _ in range(rng.randint(1, 30)))
        one = outcome(lambda: np.array(Prefixes(own, piece).ids(), dtype="<u4").tobytes())
        assert outcome(lambda: tables.encode([piece])) == (None if one is None else [one])
