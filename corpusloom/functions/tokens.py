"""Pre-tokenisation and fixed-length blocks, as expressions on one row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed
from .text import quoted

# --- fixed values: the ideograph ranges that stand alone as tokens ---
IDEOGRAPHS = (
    r"\x{3400}-\x{4DBF}"
    r"\x{4E00}-\x{9FFF}"
    r"\x{F900}-\x{FAFF}"
    r"\x{20000}-\x{2A6DF}"
    r"\x{2A700}-\x{2CEAF}"
    r"\x{2F800}-\x{2FA1F}"
)
# A character that is a token of its own, and the space between tokens.
ALONE = rf"[{IDEOGRAPHS}\p{{P}}\p{{S}}]"
SPACE = r"[\s\p{Z}]"
# An ideograph or a punctuation mark, or a run of anything else that is not space.
TOKEN_PATTERN = rf"{ALONE}|[^\s\p{{Z}}{IDEOGRAPHS}\p{{P}}\p{{S}}]+"


def pretokenize(text: Column, lower: bool = True, reserved: Sequence[str] = ()) -> Column:
    """Token array of a text; ``reserved`` tokens stay whole and keep their case.

    Without reserved tokens, single-character tokens are set off with spaces and the text is split,
    which gives the matches of ``TOKEN_PATTERN`` in three quarters of the time.
    """
    if not reserved:
        source = F.lower(text) if lower else text
        spaced = F.regexp_replace(source, ALONE, " $0 ")
        return F.array_remove(F.split(spaced, f"{SPACE}+"), "")
    pattern = "|".join([*map(quoted, reserved), TOKEN_PATTERN])
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    if not lower:
        return found
    return F.transform(found, lambda t: F.when(t.isin(*reserved), t).otherwise(F.lower(t)))


def token_count(text: Column, lower: bool = True, reserved: Sequence[str] = ()) -> Column:
    """Number of tokens, NULL for a NULL text."""
    return F.size(pretokenize(text, lower, reserved))


def wrap_block(ids: Column, block: int, wrap: tuple[int, int] | None = None) -> Column:
    """Cut on the right to ``block`` ids; an opening and closing id count as part of the block."""
    if wrap is None:
        return F.slice(ids, 1, block)
    opening, closing = wrap
    return F.concat(F.array(F.lit(opening)), F.slice(ids, 1, block - 2), F.array(F.lit(closing)))


def pad_block(ids: Column, block: int, pad_id: int) -> Column:
    """Pad on the right to exactly ``block`` ids; ``ids`` must not be longer."""
    return F.concat(ids, F.array_repeat(F.lit(pad_id), F.lit(block) - F.size(ids)))


def pad_truncate(
    ids: Column, block: int, pad_id: int, wrap: tuple[int, int] | None = None
) -> Column:
    """Cut, optionally wrap, then pad: always exactly ``block`` ids."""
    return pad_block(wrap_block(ids, block, wrap), block, pad_id)


def attention_mask(n_tokens: Column, block: int) -> Column:
    """Ones for real ids, zeros for padding."""
    return F.concat(
        F.array_repeat(F.lit(1), n_tokens),
        F.array_repeat(F.lit(0), F.lit(block) - n_tokens),
    )
