"""Edge rows of the text functions, with expected values written by hand."""

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tracecurate.functions import text as T

PLACEHOLDERS = [
    ("short", True),
    ("running errands near narrow river", False),
    ("Restart printer now, run", True),  # n and r do not count
    ("." * 16, True),
    ("..", True),
    ("[the new user request here]", True),
    ("[a] something longer than that [b]", True),
    ("[a] something longer than that (b)", False),
    ("nr" * 15, True),
    ("é" * 15, False),
    (" " * 30 + "abc", True),
    ("", True),
    ("\\" * 40, True),
]


def test_placeholder(column):
    texts, expected = zip(*PLACEHOLDERS)
    assert column(T.is_placeholder, texts) == list(expected)


def test_strict_placeholder_counts_every_letter(column):
    strict = lambda c: T.is_placeholder(c, T.BLANK)
    assert column(strict, ["Restart printer now, run", "nr" * 15, " " * 40]) == [False, False, True]


SCORES = [
    ("Score: 7", 7),
    ("Score:8", 8),
    ("Score:\n9", 9),
    ("Score: 9", 9),
    ("Score: 15", 15),
    ("Score: 7.5", 7),
    ("Score: -3", None),
    ("**Score:** 9", None),
    ("score: 8", None),
    ("Score: 3 and Score: 9", 3),
    ("Score: 123456789012", 123456789012),
    ("Score: " + "9" * 30, 2**63 - 1),
    ("", None),
    (None, None),
]


def test_score(column):
    texts, expected = zip(*SCORES)
    assert column(T.parse_score, texts) == list(expected)


REASONS = [
    ("Score: 7\nReason: fine ", "fine"),
    ("Reason: one\ntwo", "one"),
    ("Reason:\n  later", "later"),
    ("Reason: a b", "a b"),
    ("Score: 7", ""),
    ("Reason: ", ""),
    (None, ""),
]


def test_reason(column):
    texts, expected = zip(*REASONS)
    assert column(T.parse_reason, texts) == list(expected)


TAGS = [
    ("no tags", None),
    ("<t></t>", ""),
    ("<t>\n a\n b \n</t>", "a\n b"),
    ("<t>one</t><t>two</t>", "one"),
    ("<t>open", None),
    ("<t>a<t>b</t>c</t>", "a<t>b"),
    ("</t><t>x</t>", "x"),
    ("</t><t>x", None),
    (None, None),
]


def test_tag(column):
    texts, expected = zip(*TAGS)
    assert column(lambda c: T.parse_tag(c, "t"), texts) == list(expected)


def test_strip_edges(column):
    texts = ["  a ", "\na\r\n", " a　", "\x1ca\x1f", "", " \t\n", "a​b​"]
    assert column(T.pystrip, texts) == [t.strip() for t in texts]


def test_blank_is_what_python_strips():
    assert set(T.BLANK) == {chr(i) for i in range(0x110000) if chr(i).isspace()}


def test_user_label(column):
    texts = ["user: hi", "  USER:\n hi ", "User:hi", "a user: hi", "users: hi", "user:"]
    assert column(T.strip_user_label, texts) == ["hi", "hi", "hi", "a user: hi", "users: hi", ""]


TRANSCRIPTS = [
    ("User: a\nAssistant: b\nUser: ", [("user", "a"), ("assistant", "b\nUser:")]),
    ("noise\nUser: a", [("user", "a")]),
    ("user: a", []),
    ("", []),
    ("User: a\nmore\nUser: b", [("user", "a\nmore"), ("user", "b")]),
    ("User: quote\nAssistant: said\nAssistant: again",
     [("user", "quote"), ("assistant", "said"), ("assistant", "again")]),
    ("  User:  a  ", [("user", "a")]),
    ("User: a\n\nAssistant: b", [("user", "a"), ("assistant", "b")]),
]


def test_parse_transcript(column):
    texts, expected = zip(*TRANSCRIPTS)
    parsed = column(T.parse_transcript, texts)
    assert [[tuple(m) for m in row] for row in parsed] == list(expected)


def test_last_user_message(column):
    last = lambda c: T.last_user_message(T.parse_transcript(c))
    texts = ["User: a\nAssistant: b\nUser: c", "Assistant: b", "", "User: a\nAssistant: b"]
    assert column(last, texts) == ["c", "", "", "a"]


def test_every_other_role_is_the_assistant(column):
    messages = [[("user", "a"), ("system", "b"), ("tool", "c")]]
    schema = "array<struct<role:string,content:string>>"
    assert column(T.format_transcript, messages, schema) == ["User: a\nAssistant: b\nAssistant: c"]


def test_messages_json_round_trip(column):
    messages = [[("user", 'a "quoted"\né\\'), ("assistant", "")], []]
    schema = "array<struct<role:string,content:string>>"
    back = column(lambda c: T.messages_from_json(T.messages_to_json(c)), messages, schema)
    assert [[tuple(m) for m in row] for row in back] == messages


_content = st.text(alphabet="abz :\n\"\\é[]", max_size=30).map(str.strip).filter(
    lambda s: "User: " not in s and "Assistant: " not in s and s != ""
)
_dialogue = st.lists(st.tuples(st.sampled_from(["user", "assistant"]), _content), max_size=5)


@settings(max_examples=5, deadline=None)
@given(st.lists(_dialogue, min_size=1, max_size=40))
def test_parse_undoes_format(column, dialogues):
    schema = "array<struct<role:string,content:string>>"
    back = column(lambda c: T.parse_transcript(T.format_transcript(c)), dialogues, schema)
    # A content that ends in a bare prefix would be re-split; none is generated here.
    assert [[tuple(m) for m in row] for row in back] == dialogues


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet=list(T.BLANK) + list("ab​"), max_size=12), min_size=1, max_size=80))
def test_strip_is_pythons(column, texts):
    assert column(T.pystrip, texts) == [t.strip() for t in texts]
