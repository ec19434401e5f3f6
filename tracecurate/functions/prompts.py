"""Prompt templates and chat rendering."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from ..config import ChatTemplate
from .instructions import GENERATE_SYSTEM, JUDGE_SYSTEM
from .text import message

JUDGE_USER = """\
[dialogue]
{{ conversation_str }}
[reply]
{{ target_response }}
"""

GENERATE_USER = """\
[sample]
{{ conversation_str }}
[reply]
{{ target_response }}
"""

def render_template(template: str, **columns: Column) -> Column:
    """Fill ``{{ name }}`` slots. Slots are found once, here; filled-in values stay literal."""
    pieces = re.split(r"\{\{\s*(\w+)\s*\}\}", template)
    return F.concat(
        *[
            columns[piece] if i % 2 else F.lit(piece)
            for i, piece in enumerate(pieces)
            if i % 2 or piece
        ]
    )


def dialogue(system: str, user: Column) -> Column:
    """A system message followed by one user message."""
    return F.array(message("system", F.lit(system)), message("user", user))


def judge_messages(conversation: Column, answer: Column, system: str = JUDGE_SYSTEM) -> Column:
    user = render_template(JUDGE_USER, conversation_str=conversation, target_response=answer)
    return dialogue(system, user)


def generate_messages(
    conversation: Column, answer: Column, system: str = GENERATE_SYSTEM
) -> Column:
    user = render_template(GENERATE_USER, conversation_str=conversation, target_response=answer)
    return dialogue(system, user)


def chat_text(
    messages: Column, template: ChatTemplate = ChatTemplate(), open_answer: bool = False
) -> Column:
    """Messages as one chat-formatted text; ``open_answer`` starts an assistant turn."""

    def turn(role: Column, content: Column) -> Column:
        return F.concat(
            F.lit(template.turn_open), role, F.lit("\n"), content, F.lit(template.turn_close)
        )

    text = F.array_join(F.transform(messages, lambda m: turn(m["role"], m["content"])), "")
    if template.default_system is not None:
        has_own = F.get(messages, F.lit(0))["role"]
        system = turn(F.lit("system"), F.lit(template.default_system))
        text = F.concat(F.when(has_own != "system", system).otherwise(""), text)
    if open_answer:
        text = F.concat(text, F.lit(f"{template.turn_open}assistant\n"))
    return text
