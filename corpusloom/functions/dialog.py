"""Speaker-tagged dialogue strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed
from .text import quoted, strip_spaces


def speaker_tag(position: Column, role: Column | None = None) -> Column:
    """Even positions are speaker 1; with a role, everyone but the assistant is speaker 1."""
    second = position % 2 == 1 if role is None else role == "assistant"
    return F.when(second, F.lit(fixed.SPEAKER_2)).otherwise(F.lit(fixed.SPEAKER_1))


def tagged_turn(text: Column, position: Column, role: Column | None = None) -> Column:
    """Speaker tag, utterance, end mark."""
    return F.concat(speaker_tag(position, role), F.coalesce(text, F.lit("")), F.lit(fixed.SEP))


def dialog_text(content: Column) -> Column:
    """The training string of one dialogue given as an array of utterances."""
    turns = F.transform(content, lambda text, position: tagged_turn(text, position))
    return F.concat(F.lit(fixed.CLS), F.array_join(turns, ""))


def extract_reply(decoded: Column, n_history: Column) -> Column:
    """The utterance after ``n_history`` end marks, without tags and spaces; NULL if there is none."""
    reply = F.get(F.split(decoded, quoted(fixed.SEP)), n_history)
    for tag in fixed.SPEAKER_TOKENS:
        reply = F.replace(reply, F.lit(tag), F.lit(""))
    return strip_spaces(reply)
