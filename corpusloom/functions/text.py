"""Text projections: prompts, flattening, segment pairs and clean-up of generated text."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed


def quoted(separator: str) -> str:
    """A Java pattern that matches ``separator`` literally."""
    return re.sub(r"([\\.\[\]{}()*+?^$|])", r"\\\1", separator)


def title_prompt(title: Column, body: Column, sep: str = fixed.PARAGRAPH) -> Column:
    """Title line, separator, body. A missing title or body is written as ``nan``."""
    missing = F.lit(fixed.MISSING)
    return F.concat(
        F.lit(fixed.TITLE_OPEN),
        F.coalesce(title, missing),
        F.lit(fixed.TITLE_CLOSE + sep),
        F.coalesce(body, missing),
    )


def normalize_newlines(text: Column) -> Column:
    """Turn ``\\r\\n`` and lone ``\\r`` into ``\\n``."""
    return F.regexp_replace(text, r"\r\n?", "\n")


def flatten_lines(
    text: Column, stop: str = fixed.STOP_MARK, comma: str = fixed.COMMA_MARK
) -> Column:
    """Paragraph breaks, then line breaks, become ``stop``; ASCII spaces become ``comma``."""
    marked = text
    for old, new in ((fixed.PARAGRAPH, stop), (fixed.LINE, stop), (" ", comma)):
        marked = F.replace(marked, F.lit(old), F.lit(new))
    return marked


def split_segments(text: Column, sep: str) -> Column:
    """Literal split; empty parts at either end are kept."""
    return F.split(text, quoted(sep))


def last_segment_pair(text: Column, sep: str = fixed.PARAGRAPH) -> Column:
    """``struct(input, reference)``: the last segment is the reference, the rest plus one newline the input."""
    parts = split_segments(text, sep)
    head = F.slice(parts, 1, F.size(parts) - 1)
    return F.struct(
        F.concat(F.array_join(head, sep), F.lit(fixed.LINE)).alias("input"),
        F.element_at(parts, -1).alias("reference"),
    )


def cut_point(key: Column, n_segments: Column, seed: int = 0) -> Column:
    """A repeatable uniform cut in 1..n-1, from the first 32 bits of an MD5; NULL below two segments."""
    digest = F.md5(F.concat(key.cast("string"), F.lit(f":{seed}")))
    draw = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    return F.when(n_segments >= 2, (draw % (n_segments - 1) + 1).cast("int"))


def random_cut_pair(text: Column, key: Column, sep: str = fixed.STOP_MARK, seed: int = 0) -> Column:
    """``struct(n, input, reference)`` cut after ``n`` segments; NULL for a text of one segment."""
    parts = split_segments(text, sep)
    count = F.size(parts)
    cut = cut_point(key, count, seed)
    pair = F.struct(
        cut.alias("n"),
        F.concat(F.array_join(F.slice(parts, F.lit(1), cut), sep), F.lit(sep)).alias("input"),
        F.array_join(F.slice(parts, cut + 1, count), sep).alias("reference"),
    )
    return F.when(count >= 2, pair)


def head_segments(text: Column, sep: str = fixed.STOP_MARK, k: int = fixed.PROMPT_SEGMENTS) -> Column:
    """The first ``k`` segments, closed by the separator even when there are fewer."""
    return F.concat(F.array_join(F.slice(split_segments(text, sep), 1, k), sep), F.lit(sep))


def strip_prompt(generated: Column, prompt: Column) -> Column:
    """Drop as many leading characters as the prompt has, whatever they are."""
    return F.substr(generated, F.length(prompt) + 1)


def first_paragraph(text: Column) -> Column:
    """Text before the first blank line."""
    return F.substring_index(text, fixed.PARAGRAPH, 1)


def strip_spaces(text: Column) -> Column:
    """Remove every ASCII space."""
    return F.replace(text, F.lit(" "), F.lit(""))
