"""Text expressions: stripping, parsing of model answers, transcripts, placeholders."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# --- fixed values: what counts as blank, and the grammar of answers and transcripts ---
# The characters Python's str.strip() and the regex class \s treat as white space.
BLANK = "".join(
    map(
        chr,
        [
            *range(0x09, 0x0E),
            *range(0x1C, 0x21),
            0x85,
            0xA0,
            0x1680,
            *range(0x2000, 0x200B),
            0x2028,
            0x2029,
            0x202F,
            0x205F,
            0x3000,
        ],
    )
)
# The placeholder test ignores blanks, backslashes and the letters n and r.
PLACEHOLDER_NOISE = BLANK + "\\nr"
# What is left is a placeholder if it is shorter than 15, all dots, or one bracketed slot.
PLACEHOLDER_PATTERN = r"(?s)^(?:.{0,14}|\.{2,}|\[.*\])\z"
# The same characters inside a pattern that starts with (?U).
BLANK_CLASS = r"\s\x1c-\x1f"
SCORE_PATTERN = rf"(?U)Score:[{BLANK_CLASS}]*([0-9]+)"
REASON_PATTERN = rf"(?U)Reason:[{BLANK_CLASS}]*([^\n]+)"
USER_LABEL_PATTERN = rf"(?Ui)^user:[{BLANK_CLASS}]*"
USER_PREFIX = "User: "
ASSISTANT_PREFIX = "Assistant: "
TURN_BREAK = r"\n(?=User: |Assistant: )"
# --- end of fixed values ---

_MAX_LONG = 2**63 - 1


def pystrip(text: Column) -> Column:
    """Strip all Unicode white space from both ends (``trim`` strips only blanks)."""
    return F.btrim(text, F.lit(BLANK))


def is_placeholder(text: Column, noise: str = PLACEHOLDER_NOISE) -> Column:
    """True for text too short, made of dots only, or one bracketed slot.

    Pass ``noise=BLANK`` to ignore white space only, not backslashes, n and r. A text is read
    up to its fifteenth other character; only one that starts like dots or a slot is read on.
    """
    skip = "[" + "".join(f"\\x{{{ord(c):x}}}" for c in noise) + "]*+"
    long_enough = F.rlike(text, F.lit(rf"(?s)^(?:{skip}.){{15}}"))
    may_be_slot = F.rlike(text, F.lit(rf"^{skip}[.\[]"))
    matches = F.rlike(F.translate(text, noise, ""), F.lit(PLACEHOLDER_PATTERN))
    return F.when(long_enough & ~may_be_slot, F.lit(False)).otherwise(matches)


def parse_score(answer: Column) -> Column:
    """First ``Score: <digits>`` as bigint, null without one, unclamped.

    Digits beyond the bigint range read as its maximum, so they still pass a threshold.
    """
    digits = F.nullif(F.regexp_extract(answer, SCORE_PATTERN, 1), F.lit(""))
    return F.when(
        digits.isNotNull(), F.coalesce(digits.try_cast("bigint"), F.lit(_MAX_LONG))
    )


def parse_reason(answer: Column) -> Column:
    """First ``Reason:`` up to the end of its line, or an empty string."""
    return F.coalesce(pystrip(F.regexp_extract(answer, REASON_PATTERN, 1)), F.lit(""))


def parse_tag(answer: Column, tag: str) -> Column:
    """Stripped text of the first ``<tag>..</tag>`` block; null when there is no block."""
    opener, closer = f"<{tag}>", f"</{tag}>"
    start = F.instr(answer, opener)
    body = F.substr(answer, start + len(opener))
    end = F.instr(body, closer)
    return F.when((start > 0) & (end > 0), pystrip(F.left(body, end - 1)))


def strip_user_label(text: Column) -> Column:
    """Cut a leading ``user:`` in any case, with the blanks around it."""
    return F.regexp_replace(pystrip(text), USER_LABEL_PATTERN, "")


def message(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def format_transcript(messages: Column) -> Column:
    """``User: ..`` / ``Assistant: ..`` lines; every role but user is the assistant."""
    return F.array_join(
        F.transform(
            messages,
            lambda m: F.concat(
                F.when(m["role"] == "user", USER_PREFIX).otherwise(ASSISTANT_PREFIX),
                m["content"],
            ),
        ),
        "\n",
    )


def parse_transcript(text: Column) -> Column:
    """Inverse of ``format_transcript``; chunks without a role prefix are dropped."""

    def as_message(chunk: Column) -> Column:
        return F.when(
            F.startswith(chunk, F.lit(USER_PREFIX)),
            message("user", pystrip(F.substr(chunk, F.lit(len(USER_PREFIX) + 1)))),
        ).when(
            F.startswith(chunk, F.lit(ASSISTANT_PREFIX)),
            message("assistant", pystrip(F.substr(chunk, F.lit(len(ASSISTANT_PREFIX) + 1)))),
        )

    chunks = F.split(pystrip(text), TURN_BREAK)
    return F.filter(F.transform(chunks, as_message), lambda m: m.isNotNull())


def last_user_message(messages: Column) -> Column:
    """Content of the last user message, empty when there is none."""
    of_user = F.filter(messages, lambda m: m["role"] == "user")
    return F.coalesce(F.try_element_at(of_user, F.lit(-1))["content"], F.lit(""))


def messages_to_json(messages: Column) -> Column:
    return F.to_json(messages)


def messages_from_json(text: Column) -> Column:
    return F.from_json(text, "array<struct<role:string,content:string>>")


def preview(text: Column, length: int) -> Column:
    """The first characters of a text, for listings."""
    return F.substring(text, 1, length)
