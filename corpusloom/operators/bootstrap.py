"""Intervals of mean scores by a Poisson bootstrap, with paired differences of two models.

In each replicate every pair counts as often as a Poisson number of mean 1 says, which is inverted from a hash of
seed, replicate and pair: both models see the same draw, any engine can repeat it, and no replicate is gathered. What
is shuffled is one partial sum for each replicate, metric and model of a task.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DIFFERENCE = "difference"
# hexadecimal digits of a draw: 52 bits, which a double holds exactly
_DIGITS = 13


def poisson_steps() -> list[float]:
    """Cumulated probabilities of 0, 1, 2, ... at mean 1, up to where a double cannot tell them from 1."""
    steps, term, total = [], math.exp(-1), 0.0
    for k in range(1, 20):
        total += term
        if total >= 1:
            break
        steps.append(total)
        term /= k
    return steps


def draw_count(replicate: Column, key: Column, seed: int) -> Column:
    """How often a pair counts in a replicate."""
    digits = F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), replicate.cast("string"), key.cast("string"))), 1, _DIGITS)
    draw = F.conv(digits, 16, 10).cast("double") / float(16**_DIGITS)
    return sum(((draw >= step).cast("int") for step in poisson_steps()), F.lit(0))


def bootstrap_means(
    rows: DataFrame, key: str = "doc_id", replicates: int = 200, seed: int = 0, models: Sequence[str] = ("original", "finetuned")
) -> DataFrame:
    """``metric, replicate`` and the mean of each model, from rows (key, model, metric, value, weight).

    Replicate 0 counts every pair once. A mean is the sum of weight times value over the sum of weights, NULL without
    weights. Rows with a NULL value or weight are left out; a NULL key is drawn like the empty text.
    """
    number = F.explode(F.sequence(F.lit(0), F.lit(replicates))).alias("replicate")
    present = rows.where(F.col("value").isNotNull() & F.col("weight").isNotNull())
    each = present.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("_key"), "model", "metric", "value", "weight", number)
    count = F.when(F.col("replicate") == 0, 1).otherwise(draw_count(F.col("replicate"), F.col("_key"), seed))
    counted = each.withColumn("_w", count * F.col("weight")).where(F.col("_w") != 0)
    sums = counted.groupBy("metric", "replicate", "model").agg(F.sum(F.col("_w") * F.col("value")).alias("_sum"), F.sum("_w").alias("_n"))
    means = sums.select("metric", "replicate", "model", F.try_divide("_sum", "_n").alias("mean"))
    return means.groupBy("metric", "replicate").pivot("model", list(models)).agg(F.first("mean"))


def intervals(
    means: DataFrame, share: float = 0.95, models: Sequence[str] = ("original", "finetuned"), exponential: Sequence[str] = ("ppl",)
) -> DataFrame:
    """``metric, model, value, low, high`` for two models and for the second less the first.

    ``value`` is that of replicate 0; the limits are the replicates at the ranks that leave half of the rest on either side, rounded outwards.
    The means of the metrics ``exponential`` are logarithms: their exponentials are compared. ``means`` has one row a replicate, so
    the ranks are of a few hundred rows whatever the pairs were.
    """
    first, second = models
    to = [F.when(F.col("metric").isin(*exponential), F.exp(m)).otherwise(F.col(m)).alias(m) for m in models]
    values = means.select("metric", "replicate", *to).withColumn(DIFFERENCE, F.col(second) - F.col(first))
    long = values.unpivot(["metric", "replicate"], [first, second, DIFFERENCE], "model", "value").where("value IS NOT NULL")
    drawn = Window.partitionBy("metric", "model")
    ranked = long.where("replicate > 0").select(
        "metric", "model", "value", F.row_number().over(drawn.orderBy("value")).alias("rank"), F.count("*").over(drawn).alias("n")
    )
    outside = (1 - share) / 2
    low = F.greatest(F.floor(F.col("n") * outside + 1e-9), F.lit(1))
    high = F.least(F.ceil(F.col("n") * (1 - outside) - 1e-9) + 1, F.col("n"))
    limits = ranked.groupBy("metric", "model").agg(
        F.max(F.when(F.col("rank") == low, F.col("value"))).alias("low"), F.max(F.when(F.col("rank") == high, F.col("value"))).alias("high")
    )
    point = long.where("replicate = 0").select("metric", "model", "value")
    return point.join(limits, ["metric", "model"], "left").select("metric", "model", "value", "low", "high")
