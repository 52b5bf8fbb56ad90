"""Mixing sources to target weights by Poisson replication.

A source's mean repetition rate is its share of the wanted volume over its present volume. Each document draws its own
number of copies: a hash of seed and id is a uniform number, and the Poisson distribution with the source's rate is inverted at it.
The draw depends on nothing else, so any task can repeat it, and a source needs no global order. Copies are then put in a global
random order by another hash.

All of it is DataFrame work. Document volumes are summed per source map-side, so a source with a third of all rows
is one row per task; the rates, one row a source, come back by a plain join whose strategy Spark chooses by size.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEED = "mix-1"
# Poisson terms with larger means underflow when started at exp(-mean): a document draws several parts of at most this mean
PART = 500.0
LOT = 10_000  # copies of a document made at once


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) from the first 52 bits of a digest of the parts; NULL counts as an empty text."""
    key = F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def rates(
    docs: DataFrame, weights: Mapping[str, float] | None = None, total: float | None = None, source: str = "source", text: str = "text"
) -> DataFrame:
    """``source, volume, rate``: UTF-8 bytes now and mean repetitions towards the weights.

    Sources that ``weights`` does not name weigh 1; a weight of 0 leaves a source out. ``total`` is the wanted volume, by default
    the present one. A source without bytes has rate 0. A NULL source is a source of its own.
    """
    volumes = docs.groupBy(F.col(source).alias("source")).agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0)).alias("volume"))
    weight = F.lit(1.0)
    for name, value in (weights or {}).items():
        weight = F.when(F.col("source") == name, float(value)).otherwise(weight)
    weighed = volumes.withColumn("weight", F.when(F.col("volume") > 0, weight).otherwise(0.0))
    sums = weighed.agg(F.sum("weight").alias("weights"), F.sum("volume").alias("all"))
    wanted = F.col("all") if total is None else F.lit(float(total))
    rate = F.when((F.col("volume") > 0) & (F.col("weights") > 0), wanted * F.col("weight") / F.col("weights") / F.col("volume"))
    # the sums are one row
    return weighed.join(F.broadcast(sums)).select("source", "volume", F.coalesce(rate, F.lit(0.0)).alias("rate"))


def _cumulated(rate: Column) -> Column:
    """Cumulated Poisson probabilities of 0, 1, 2, ... copies, far enough that the rest is below 1e-17."""
    last = F.ceil(rate + 12 * F.sqrt(rate) + 30).cast("int")
    first = F.exp(-rate)
    steps = F.aggregate(
        F.sequence(F.lit(1), last),
        F.struct(first.alias("p"), first.alias("c"), F.array(first).alias("all")),
        lambda s, k: F.struct(
            (s["p"] * rate / k).alias("p"),
            (s["c"] + s["p"] * rate / k).alias("c"),
            F.concat(s["all"], F.array(s["c"] + s["p"] * rate / k)).alias("all"),
        ),
    )
    return steps["all"]


def poisson_mix(
    docs: DataFrame,
    weights: Mapping[str, float] | None = None,
    total: float | None = None,
    seed: str = SEED,
    doc_id: str = "doc_id",
    source: str = "source",
    text: str = "text",
) -> DataFrame:
    """Each row of ``docs`` as often as it draws, in a global random order, with ``_copy`` (from 1) and ``_order`` added.

    A NULL id draws like the empty text. Repeated rows draw alike and are all replicated; rows of equal ``_order`` stand
    by their text's hash. Empty and NULL texts have no volume but draw with their source's rate. An empty table gives an empty
    result. Columns of ``docs`` keep their names; only ``_copy`` and ``_order`` must be free. A document's copies are made in lots, so
    a tiny source may be repeated any number of times.
    """
    # names of our own that no column of the table has
    mark = "_"
    while any(c.lower().startswith(f"{mark}mix_") for c in docs.columns):
        mark += "_"
    own_source, own_parts, own_steps, own_copies, own_lot, own_tie, own_row = (
        f"{mark}mix_{n}" for n in ("source", "parts", "steps", "copies", "lot", "tie", "row")
    )
    per_source = rates(docs, weights, total, source, text)
    parts = F.greatest(F.ceil(F.col("rate") / PART), F.lit(1)).cast("int")
    table = per_source.select(F.col("source").alias(own_source), parts.alias(own_parts), _cumulated(F.col("rate") / parts).alias(own_steps))
    joined = docs.join(table, F.col(source).eqNullSafe(F.col(own_source)))
    draws = F.transform(F.sequence(F.lit(1), F.col(own_parts)), lambda i: uniform(F.lit(seed), F.col(doc_id), i))
    copies = F.aggregate(draws, F.lit(0).cast("long"), lambda n, u: n + F.size(F.filter(own_steps, lambda c: c <= u)))
    copied = joined.withColumn(own_copies, copies).where(F.col(own_copies) > 0)
    lots = copied.withColumn(own_lot, F.explode(F.sequence(F.lit(1).cast("long"), F.col(own_copies), F.lit(LOT).cast("long"))))
    exploded = lots.withColumn("_copy", F.explode(F.sequence(F.col(own_lot), F.least(F.col(own_lot) + (LOT - 1), F.col(own_copies)))))
    ordered = exploded.withColumn("_order", F.md5(F.concat_ws(":", F.lit(seed), F.lit("order"), F.coalesce(F.col(doc_id).cast("string"), F.lit("")), "_copy")))
    # equal rows are told apart by their place, so that they need not stand in one range
    ties = ordered.withColumns({own_tie: F.xxhash64(text), own_row: F.monotonically_increasing_id()})
    return ties.orderBy("_order", own_tie, own_row).drop(own_source, own_parts, own_steps, own_copies, own_lot, own_tie, own_row)
