"""Quotation links: nested levels, partial quotes, edges."""

from tracecurate.llm import quotes

A = "The first message\nhas two lines."
B = "I do not agree."
C = "But why?\n\nSecond paragraph here."


def quote(text, mark="> "):
    return "\n".join(mark + x for x in text.split("\n"))


def run(spark, rows):
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, root int, _scope int, lines int")
    return {(r.scope, r.turn): r for r in quotes.conversations_without_quotes(df).collect()}


def test_nested_partial_and_branching(spark):
    b = f"Ann wrote:\n{quote(A)}\n\n{B}"
    rows = [
        (1, 0, "user", A),
        (1, 1, "bot", b),
        (1, 2, "user", f"{quote(b)}\n\n{C}"),
        (1, 3, "bot", f">Second   PARAGRAPH here.\n{B} Again."),  # a part, in other case
        (1, 4, "bot", f">> {B}\nanswers what was quoted twice"),
        (1, 5, "user", "> never said before\nalone"),
        (2, 0, "user", f"{quote(A)}\nother scope"),
        (2, 1, None, None),
        (2, None, "user", "no turn"),
        (None, 3, "user", quote(A)),
    ]
    found = run(spark, [(*r, 1, 2, 3) for r in rows])
    assert len(found) == len(rows)
    assert {k: (r.parent, r.root, r.depth) for k, r in found.items() if k[0] == 1} == {
        (1, 0): (None, 0, 0),
        (1, 1): (0, 0, 1),
        (1, 2): (1, 0, 2),
        (1, 3): (2, 0, 3),
        (1, 4): (1, 0, 2),
        (1, 5): (None, 5, 0),
    }
    assert [found[1, k].text for k in range(6)] == [A, B, C, f"{B} Again.", "answers what was quoted twice", "alone"]
    assert found[2, 0].parent is None and found[2, 0].text == "other scope"
    assert found[2, 1].text is None and found[2, 1].chat == "unknown: "
    assert found[None, 3].text == "" and found[2, None].root is None


def test_empty_and_repeated_rows(spark):
    assert run(spark, []) == {}
    rows = [(1, 0, "u", A), (1, 0, "u", A), (1, 1, "u", quote(A) + "\nyes")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    assert sorted((r.turn, r.parent, r.depth) for r in quotes.conversations_without_quotes(df).collect() if r.turn) == [(1, 0, 1)]
    assert quotes.conversations_without_quotes(df).count() == 3


def test_long_chain(spark):
    texts = [f"message number {k}" for k in range(40)]
    rows = [(1, k, "u", t if k == 0 else f"{quote(texts[k - 1])}\n{t}", 1, 2, 3) for k, t in enumerate(texts)]
    assert {t: (r.root, r.depth) for (_, t), r in run(spark, rows).items()} == {k: (0, k) for k in range(40)}


def test_positions_and_assembled_conversations(spark):
    """Replies follow what they answer; parts of any size hold the same order."""
    rows = [(1, 0, "u", A), (1, 1, "v", f"{quote(A)}\n{B}"), (1, 2, "w", "a second start"), (1, 3, "u", f"{quote('a second start')}\nto the second"), (1, 4, "u", f"{quote(B)}\nto the first")]
    rows += [(1, 5, "x", f"{quote(A)}\nalso to the first"), (1, 0, "u", A), (2, 7, None, None), (None, 1, "u", "no scope"), (1, None, "u", "no turn")]
    df = spark.createDataFrame([(*r, 9, 9) for r in rows], "conv_id bigint, turn bigint, role string, text string, position int, part int")
    found = quotes.conversations_without_quotes(df)
    assert found.count() == len(rows)
    places = {(r.scope, r.turn): (r.root, r.position) for r in found.collect()}
    assert places == {(1, 0): (0, 0), (1, 1): (0, 1), (1, 5): (0, 2), (1, 4): (0, 3), (1, 2): (2, 0), (1, 3): (2, 1), (2, 7): (7, 0), (None, 1): (1, None), (1, None): (None, None)}
    whole = {(r.scope, r.root): (r.part, r.first, r.n_messages, r.chat) for r in quotes.assemble(found).collect()}
    first = ["u: " + A, "v: " + B, "x: also to the first", "u: to the first"]
    assert whole == {(1, 0): (0, 0, 4, "\n\n".join(first)), (1, 2): (0, 0, 2, "w: a second start\n\nu: to the second"), (2, 7): (0, 0, 1, "unknown: ")}
    parts = sorted((r.part, r.first, r.chat) for r in quotes.assemble(found, 3).where("scope = 1 and root = 0").collect())
    assert parts == [(0, 0, "\n\n".join(first[:3])), (1, 3, first[3])]


def test_a_long_text_and_a_large_conversation(spark):
    """One message of a million letters, and one conversation with all rows."""
    rows = [(1, 0, "u", "start here")] + [(1, k, "u", f"> start here\nanswer {k}") for k in range(1, 3000)]
    rows.append((1, 3000, "u", "> start here\n" + "long line of words\n" * 50_000))
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    found = quotes.conversations_without_quotes(df).select("turn", "root", "depth", "position").collect()
    assert sorted(map(tuple, found)) == [(0, 0, 0, 0)] + [(k, 0, 1, k) for k in range(1, 3001)]
