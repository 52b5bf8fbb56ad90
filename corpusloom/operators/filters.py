"""Row filters and membership."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed


def keep_language(df: DataFrame, lang: str = "en", column: str = "lang") -> DataFrame:
    """Rows of one language; a missing language does not qualify. Reaches the scan as a pushed filter."""
    return df.where(F.col(column) == lang)


def keep_nonnull(df: DataFrame, column: str) -> DataFrame:
    """Rows with a body; empty strings stay."""
    return df.where(F.col(column).isNotNull())


def keep_listed(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows whose key is in the id list; repeated ids do not repeat rows.

    No broadcast hint: Spark broadcasts the list when its size is under the threshold and otherwise
    shuffles both sides, splitting a hot key of ``df`` as a skewed partition.
    """
    return df.join(ids.select(key), key, "left_semi")


def drop_listed(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """The complement of :func:`keep_listed`."""
    return df.join(ids.select(key), key, "left_anti")


def within_budget(
    df: DataFrame,
    n_tokens: str = "n_tokens",
    new: int = fixed.NEW_TOKENS,
    context: int = fixed.CONTEXT,
) -> DataFrame:
    """Rows whose input leaves room for ``new`` more tokens in the context."""
    return df.where(F.col(n_tokens) + new <= context)


def drop_empty_pairs(df: DataFrame, *columns: str) -> DataFrame:
    """Optional step: rows where every named side has a non-blank character."""
    for column in columns:
        df = df.where(F.col(column).rlike(r"(?U)\S"))
    return df
