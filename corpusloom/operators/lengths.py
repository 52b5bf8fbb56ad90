"""Lengths of texts as sketches that are stored and merged, to choose a block by.

A sketch is a table of counts by length class. Classes grow by a constant factor, so any length is known within a
stated relative error however many were counted, and a few hundred classes hold any corpus. Merging is adding: sketches of
days, sources or models give the sketch of all of them, equal to one made at once.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# the middle of a class is within this share of every length in it
ERROR = 0.01


def _factor(error: float) -> float:
    return (1 + error) / (1 - error)


def length_class(length: Column, error: float = ERROR) -> Column:
    """The class of a length: class c holds lengths above factor^(c-1) and up to factor^c; lengths below 1 are in class -1."""
    return F.when(length < 1, -1).otherwise(F.ceil(F.ln(length) / math.log(_factor(error)) - 1e-9)).cast("int")


def class_length(number: Column, error: float = ERROR) -> Column:
    """The length that stands for a class."""
    factor = _factor(error)
    return F.when(number < 0, 0.0).otherwise(2 * F.pow(F.lit(factor), number) / (factor + 1))


def length_sketch(df: DataFrame, *by: str, length: str = "n_tokens", error: float = ERROR) -> DataFrame:
    """``by, class, n, total``: how many lengths fell into each class, and their sum. NULL lengths are not counted."""
    known = df.where(F.col(length).isNotNull())
    return known.groupBy(*by, length_class(F.col(length), error).alias("class")).agg(F.count("*").alias("n"), F.sum(F.col(length).cast("long")).alias("total"))


def merge_sketches(sketch: DataFrame, *by: str) -> DataFrame:
    """Sketches of one error, added up to one for each of ``by``."""
    return sketch.groupBy(*by, "class").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))


def sketch_quantiles(sketch: DataFrame, shares: Sequence[float], *by: str, error: float = ERROR) -> DataFrame:
    """``by, share, length``: a length within ``error`` of the one at the rank ceil(share * n)."""
    upto = Window.partitionBy(*by).orderBy("class").rowsBetween(Window.unboundedPreceding, 0)
    sums = sketch.select(*by, "class", F.sum("n").over(upto).alias("_upto"), F.sum("n").over(Window.partitionBy(*by)).alias("_all"))
    each = sums.withColumn("share", F.explode(F.array(*map(F.lit, shares))))
    # a share of an exact number of rows is not to be rounded up
    rank = F.greatest(F.ceil(F.col("share") * F.col("_all") - 1e-9), F.lit(1))
    reached = each.where(F.col("_upto") >= rank).groupBy(*by, "share").agg(F.min("class").alias("class"))
    return reached.select(*by, "share", class_length(F.col("class"), error).alias("length"))


def block_for(sketch: DataFrame, whole: float, *by: str, error: float = ERROR) -> DataFrame:
    """``by, block``: the smallest power of two at least as long as a share ``whole`` of the texts, within ``error``."""
    found = sketch_quantiles(sketch, [whole], *by, error=error)
    return found.select(*by, F.pow(F.lit(2), F.ceil(F.log2(F.greatest(F.col("length") * (1 - error), F.lit(1.0))))).cast("long").alias("block"))
