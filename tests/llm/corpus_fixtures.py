import random

import pytest

COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint, rank int, _doc string, pair bigint, later boolean"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text) pairs, with columns named like those the operators use."""

    def make(pairs, lang="en"):
        rows = [(i, t, lang, "s", None if t is None else len(t), 1, "x", 2, True) for i, t in pairs]
        return spark.createDataFrame(rows, COLUMNS)

    return make


def prose(seed, words, vocabulary=3000):
    rng = random.Random(seed)
    return " ".join("".join(chr(97 + (rng.randrange(vocabulary) * 7 + k * 11) % 26) for k in range(rng.randint(2, 9))) for _ in range(words))


@pytest.fixture(scope="session")
def edge_pairs():
    """Null and empty texts, null and repeated ids, repeated rows, blanks only, a very long text."""
    return [
        (1, None),
        (2, ""),
        (3, " \n\t \n"),
        (None, "a text without an id but with words"),
        (None, None),
        (4, "one"),
        (5, "one"),
        (6, "the same words in two rows of one document"),
        (6, "the same words in two rows of one document"),
        (7, "first of two different texts"),
        (7, "second of two different texts"),
        (8, prose(8, 30_000)),
        (9, "word " * 5_000),
        (10, "çà et là  über naïve \U0001f600 \x00 end"),
        (-1, "negative id\r\nwith a line end"),
    ]
