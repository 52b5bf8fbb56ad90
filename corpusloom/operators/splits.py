"""Hold-outs by row order and by group.

Both find one cut value and compare against it. The cut is a scalar subquery over a top-k, so no row
is ranked against the whole table, nothing is shuffled, and a filter on the split becomes a pushed
range predicate on the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed


def _cut(keys: DataFrame, column: str, k: int) -> Column:
    """The k-th largest value (the smallest one there is when there are fewer)."""
    top = keys.select(column).where(F.col(column).isNotNull()).orderBy(F.desc(column)).limit(k)
    return top.agg(F.min(column)).scalar()


def tail_holdout(
    df: DataFrame, order: str, k: int = fixed.TEST_ROWS, flag: str = "is_test"
) -> DataFrame:
    """Flag the last ``k`` rows by ``order``, which must be unique; with ``k`` rows or fewer, all of them.

    Every row has a flag: with ``k`` of 0, and where ``order`` is NULL, it is false. The flag is a conjunction, so that
    a filter on it still becomes a pushed range on the scan.
    """
    return df.withColumn(flag, F.col(order).isNotNull() & (F.col(order) >= _cut(df, order, k)) if k else F.lit(False))


def group_holdout(
    df: DataFrame,
    group: str,
    k_train: int = fixed.HELD_OUT_GROUPS,
    k_eval: int = fixed.EVALUATED_GROUPS,
    role: str = "role",
) -> DataFrame:
    """Keep whole groups out of training: the last ``k_train`` by name, of which ``k_eval`` are evaluated.

    ``role`` is ``train``, ``heldout`` or ``eval``. Only the distinct group names are shuffled, after
    a map-side distinct, so the size of a group does not matter.
    """
    if k_eval > k_train:
        raise ValueError("evaluated groups must be held out of training")
    names = df.select(group).distinct()
    return df.withColumn(
        role,
        F.when(F.col(group) >= _cut(names, group, k_eval), "eval")
        .when(F.col(group) >= _cut(names, group, k_train), "heldout")
        .otherwise("train"),
    )
