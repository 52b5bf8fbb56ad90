"""Joins and names over keys of which a few may hold most rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# A key with more than one in HOT_SHARE of the rows is split: there are at most HOT_SHARE of them.
HOT_SHARE = 1_000
# names sorted by one task
NAMES_A_TASK = 100_000
_RANKS = 2**40


def look_up(rows: DataFrame, lookup: DataFrame, on: list[str], spread: list[str]) -> DataFrame:
    """Left join to a table of unique, non-null keys; rows of a hot key are dealt over copies of its entry.

    ``rows`` is read twice, so pass a written table. ``spread`` are columns that tell the rows of a key apart.
    Hot is a share of the rows, so the plan is the same at every size; the hot keys are at most a thousand,
    and only they are sent to all tasks.
    """
    counts = rows.groupBy(*on).agg(F.count("*").alias("_n"))
    total = rows.count()
    salts = F.ceil(F.col("_n") * HOT_SHARE / F.lit(max(total, 1))).cast("int")
    hot = F.broadcast(counts.where(F.col("_n") * HOT_SHARE > total).select(*on, salts.alias("_salts")))
    last = F.coalesce("_salts", F.lit(1))
    dealt = rows.join(hot, on, "left").withColumn("_salt", F.pmod(F.xxhash64(*spread), last).cast("int")).drop("_salts")
    copies = lookup.join(hot, on, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), last - 1))).drop("_salts")
    return dealt.join(copies, [*on, "_salt"], "left").drop("_salt")


def integer_names(keys: DataFrame, on: list[str], name: str, total: int) -> DataFrame:
    """A long of its own for each of ``total`` distinct keys, from 1: its range, then its place in the sorted range.

    Ranges are cut by a hash of the key, so each holds about as many keys however the keys are spread. The
    name depends on the set of keys alone, not on partitions or on a repeated task.
    """
    ranges = F.lit(-(-max(total, 1) // NAMES_A_TASK))
    place: Column = F.row_number().over(Window.partitionBy("_range").orderBy(*on))
    ranged = keys.select(*on, F.pmod(F.xxhash64(*on), ranges).alias("_range"))
    return ranged.select(*on, (F.col("_range") * F.lit(_RANKS) + place).alias(name))
