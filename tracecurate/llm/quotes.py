"""Quotation linking: from messages that quote each other to conversations without quotes.

The lines of a message have a quote level, the number of ``>`` before them. Neighbouring
lines of one level are a passage. A quoted passage is linked, by the hash of its normalised
text, to the first message that has it as its own. Following the links gives every message
its root and its depth, an order in which each reply comes after what it answers. Messages are
numbered in that order, and conversations are put together from their own texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tracecurate.operators.numbering import number_in_groups

from .common import narrow, stored

# Blanks and marks before a quoted line, and the line that announces a quotation.
QUOTED = r"^(\s?>)+"
ANNOUNCED = r"(?i)\bwrote:\s*$"


def _key(text: Column) -> Column:
    """Hash of a text in small letters with single blanks."""
    return F.unhex(F.md5(F.btrim(F.regexp_replace(F.lower(text), r"\s+", " "))))


def passages(messages: DataFrame) -> DataFrame:
    """(scope, turn, block, level, lines): neighbouring lines of one level, without blank ones."""
    raw = messages.where("text is not null").select("scope", "turn", F.posexplode(F.split("text", "\n")).alias("nr", "raw"))
    marks = F.regexp_extract("raw", QUOTED, 0)
    lines = raw.select(
        "scope", "turn", "nr", F.length(F.regexp_replace(marks, r"\s", "")).alias("level"), F.btrim(F.expr(f"regexp_replace(raw, r'{QUOTED}', '')"), F.lit(" \t\r")).alias("line")
    )
    order = W.partitionBy("scope", "turn").orderBy("nr")  # one message
    before = F.lag(F.struct("level", (F.col("line") == "").alias("blank"))).over(order)
    announced = F.col("line").rlike(ANNOUNCED) & (F.col("level") == 0) & (F.lead("level").over(order) > 0)
    starts = before.isNull() | before["blank"] | (before["level"] != F.col("level"))
    cut = lines.withColumns({"starts": starts.cast("int"), "announced": F.coalesce(announced, F.lit(False))})
    cut = cut.withColumn("block", F.sum("starts").over(order)).where("line <> '' and not announced")
    return cut.groupBy("scope", "turn", "block", "level").agg(F.sort_array(F.collect_list(F.struct("nr", "line")))["line"].alias("lines"))


def _keys(blocks: DataFrame) -> DataFrame:
    """Every passage under its own key (kind 0) and those of its lines (kind 1)."""
    whole = F.struct(F.lit(0).alias("kind"), _key(F.array_join("lines", " ")).alias("key"))
    each = F.transform("lines", lambda x: F.struct(F.lit(1).alias("kind"), _key(x).alias("key")))
    return blocks.select("scope", "turn", "level", F.explode(F.concat(F.array(whole), each)).alias("x")).select("scope", "turn", "level", "x.kind", "x.key")


def reply_links(messages: DataFrame) -> DataFrame:
    """(scope, turn, parent): the message that each one answers, for those that quote one.

    The parent is the first message with a quoted passage: of the lowest level, a whole
    passage rather than a line of one, and the latest such message.
    """
    keys = stored(_keys(passages(messages.where("scope is not null and turn is not null"))), "passages")
    firsts = keys.where("level = 0").groupBy("scope", "key").agg(F.min("turn").alias("first"))
    firsts = firsts.select(F.col("scope").alias("_scope"), F.col("key").alias("_key"), "first")
    quoted = keys.where("level > 0").join(firsts, (F.col("scope") == F.col("_scope")) & (F.col("key") == F.col("_key")))
    best = F.min(F.struct("level", "kind", (-F.col("first")).alias("late")))
    return quoted.where("first < turn").groupBy("scope", "turn").agg((-best["late"]).alias("parent"))


def threads(links: DataFrame) -> DataFrame:
    """(scope, turn, parent, root, depth) by pointer doubling: each round a message looks up
    the ancestor of its ancestor, so rounds grow with the logarithm of the depth."""
    state = stored(links.select("scope", "turn", "parent", F.col("parent").alias("root"), F.lit(1).alias("depth")), "thread")
    while True:
        above = state.select(F.col("scope").alias("_scope"), F.col("turn").alias("_turn"), F.col("root").alias("further"), F.col("depth").alias("more"))
        joined = state.join(above, (F.col("scope") == F.col("_scope")) & (F.col("root") == F.col("_turn")), "left")
        state = stored(
            joined.select(
                "scope",
                "turn",
                "parent",
                F.coalesce("further", "root").alias("root"),
                (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"),
                F.col("further").isNotNull().alias("moved"),
            ),
            "thread",
        )
        if state.where("moved").isEmpty():
            return state.drop("moved")
        state = state.drop("moved")


def own_text() -> Column:
    """The column ``lines`` joined without quoted lines, lines that announce them, and blank
    lines at its ends."""
    return F.expr(
        rf"""btrim(array_join(filter(lines, (x, i) -> not x rlike r'{QUOTED}'
        and not (x rlike r'{ANNOUNCED}' and coalesce(try_element_at(lines, i + 2), '') rlike r'{QUOTED}')), '\n'), '\n\r')"""
    )


def conversations_without_quotes(
    messages: DataFrame, scope_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """(scope, turn, role, text, parent, root, depth, position, chat) for every row of ``messages``.

    ``scope`` is where a quoted message is looked for, such as a mailing list. A conversation is
    all rows of one scope and root; ``position`` numbers its messages from 0 by (depth, turn), so
    that each reply comes after what it answers, by range partitioning, so a conversation of any
    size is spread. ``chat`` is the message as a chat line. A message that quotes nothing known
    starts a conversation of depth 0. Null texts stay null; rows without scope or turn are
    linked with nothing and have no position; rows of one scope and turn count as one message
    and share its position.
    """
    rows = narrow(messages, scope=scope_col, turn=turn_col, role=role_col, text=text_col)
    found = threads(reply_links(rows)).withColumnsRenamed({"scope": "_scope", "turn": "_turn"})
    known = (F.col("scope") == F.col("_scope")) & (F.col("turn") == F.col("_turn"))
    places = rows.where("scope is not null and turn is not null").select("scope", "turn").distinct().join(found, known, "left")
    places = places.select("scope", "turn", "parent", F.coalesce("root", "turn").alias("root"), F.coalesce("depth", F.lit(0)).alias("depth"))
    numbered = number_in_groups(places, ["scope", "root"], "depth", "turn", name="position")
    numbered = numbered.withColumnsRenamed({"scope": "_scope", "turn": "_turn"})
    own = rows.withColumn("lines", F.split("text", "\n")).withColumn("own", own_text())
    return own.join(numbered, known, "left").select(
        "scope",
        "turn",
        "role",
        F.col("own").alias("text"),
        "parent",
        F.coalesce("root", "turn").alias("root"),
        F.coalesce("depth", F.lit(0)).alias("depth"),
        (F.col("position") - 1).alias("position"),
        F.concat(F.coalesce("role", F.lit("unknown")), F.lit(": "), F.coalesce("own", F.lit(""))).alias("chat"),
    )


def assemble(conversations: DataFrame, per_part: int = 1000) -> DataFrame:
    """(scope, root, part, first, n_messages, chat): conversations as texts, in reply order.

    Takes the rows of ``conversations_without_quotes``. A part holds ``per_part`` positions, the
    first of them ``first``, so that a conversation of any size is put together by many tasks;
    most have one part. ``chat`` joins the chat lines by blank lines. Equal rows of a position are
    one message, different ones follow each other. Rows without a position are in no
    conversation.
    """
    lines = conversations.where("position is not null").select("scope", "root", "position", "chat").distinct()
    parts = lines.groupBy("scope", "root", F.floor(F.col("position") / per_part).alias("part"))
    ordered = parts.agg(F.sort_array(F.collect_list(F.struct("position", "chat"))).alias("m"))
    return ordered.select(
        "scope", "root", "part", F.col("m")[0]["position"].alias("first"), F.size("m").cast("bigint").alias("n_messages"), F.array_join(F.col("m")["chat"], "\n\n").alias("chat")
    )


def as_mail(conversations: DataFrame) -> DataFrame:
    """The turns of ``conversations`` as mail: each quotes the two turns before it under
    nested marks. One conversation in five quotes nothing, another one only first lines."""
    quoted = lambda text, mark: F.concat(F.lit(mark), F.regexp_replace(text, "\n", f"\n{mark}"))
    turns = conversations.groupBy("conv_id", "turn").agg(F.min("text").alias("said"))

    def earlier(by: int) -> DataFrame:
        return turns.select(F.col("conv_id").alias(f"_c{by}"), (F.col("turn") + by).alias(f"_t{by}"), F.col("said").alias(f"said{by}"))

    out = conversations
    for by in (1, 2):
        out = out.join(earlier(by), (F.col("conv_id") == F.col(f"_c{by}")) & (F.col("turn") == F.col(f"_t{by}")), "left")
    kind = F.col("conv_id") % 5
    head = F.when(kind == 1, quoted(F.split("said1", "\n")[0], "> ")).otherwise(
        F.concat(quoted(F.col("said1"), "> "), F.coalesce(F.concat(F.lit("\n"), quoted(F.col("said2"), "> > ")), F.lit("")))
    )
    mail = F.when((kind == 0) | F.col("said1").isNull(), F.col("text")).otherwise(
        F.concat(F.lit("The one before wrote:\n"), head, F.lit("\n\n"), F.col("text"))
    )
    return out.select("conv_id", "turn", "role", mail.alias("text"))
