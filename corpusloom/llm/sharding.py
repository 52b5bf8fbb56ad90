"""Shards by a hierarchical weighted hash tree: region, rack, shard.

At each node a row draws a number for every child from a hash of (key, path, child), scaled by the child's weight as an
exponential draw, and descends into the smallest. A child is taken in proportion to its weight, and when the weight of one
child changes, rows move only into or out of that child: the others' draws stay as they were, and so do all draws inside
subtrees that are not touched.

Everything is DataFrame expressions. Placement shuffles nothing; only slot numbers do, and they are
counted in buckets of a shard, so that no task ever holds a whole shard.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLOT_BUCKETS = 1024  # buckets of a shard that are numbered on their own
SIZE_BASE = 8  # bytes a row takes besides its text


@dataclass(frozen=True)
class HashTree:
    """Weights of the shards, by region and rack; shards are numbered in order. A node weighs what is below it."""

    regions: tuple[tuple[tuple[float, ...], ...], ...]

    @classmethod
    def even(cls, regions: int, racks: int, shards: int) -> HashTree:
        return cls((((1.0,) * shards,) * racks,) * regions)

    def grown(self, weight: float = 1.0) -> HashTree:
        """One more shard, as a region of its own: the only subtree that is new, so rows only move into it."""
        return HashTree((*self.regions, ((weight,),)))

    @property
    def shards(self) -> int:
        return sum(len(rack) for region in self.regions for rack in region)


def _draw(key: Column, path: list[Column], weights: Column) -> Column:
    """Index of the child that a key draws below ``path``; children of weight 0 are never drawn."""
    # 53 bits, moved off zero so that the logarithm is finite
    def score(w: Column, i: Column) -> Column:
        u = (F.shiftrightunsigned(F.xxhash64(key, *path, i), 11) + F.lit(0.5)) / F.lit(float(1 << 53))
        return F.struct(F.when(w > 0, -F.ln(u) / w).otherwise(F.lit(float("inf"))).alias("s"), i.alias("i"))

    return F.array_min(F.transform(weights, score))["i"]


def _array(values) -> Column:
    return F.array(*[F.lit(float(v)) if isinstance(v, (int, float)) else v for v in values])


def shard_of(key: Column, tree: HashTree) -> Column:
    """Shard number of a key; NULL is a key like any other."""
    region_weights = _array(sum(map(sum, region)) for region in tree.regions)
    rack_weights = _array(_array(sum(rack) for rack in region) for region in tree.regions)
    shard_weights = _array(_array(_array(rack) for rack in region) for region in tree.regions)
    number, first = 0, []
    for region in tree.regions:
        firsts = []
        for rack in region:
            firsts.append(number)
            number += len(rack)
        first.append(F.array(*[F.lit(n) for n in firsts]))

    def within(values: Column, at: Column) -> Column:
        return F.get(values, at)

    def below(step, index: Column) -> Column:
        """Names an index once, so that deeper expressions do not repeat its computation."""
        return F.element_at(F.transform(F.array(index), step), 1)

    return below(
        lambda region: below(
            lambda rack: within(within(F.array(*first), region), rack)
            + _draw(key, [F.lit(3), region, rack], within(within(shard_weights, region), rack)),
            _draw(key, [F.lit(2), region], within(rack_weights, region)),
        ),
        _draw(key, [F.lit(1)], region_weights),
    )


def shard(docs: DataFrame, tree: HashTree, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard``: one row for each row of ``docs``.

    The law is ``key``: the id and the tree alone decide, so repeated rows and rows with a NULL id meet in one shard each.
    ``size`` is the text's UTF-8 bytes (NULL: none) plus 8, ``text_crc32`` that of the text (NULL: of the empty text).
    Slots number a shard's rows from 0 without gaps. ``grown_shard`` is the shard with one more.
    An empty table gives an empty result; other columns are not looked at.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")).select(
        "doc_id",
        (F.octet_length("text") + SIZE_BASE).cast("long").alias("size"),
        F.crc32(F.col("text")).alias("text_crc32"),
        F.lit("key").alias("law"),
        shard_of(F.col("doc_id"), tree).cast("int").alias("shard"),
        shard_of(F.col("doc_id"), tree.grown()).cast("int").alias("grown_shard"),
    )
    # repeated ids share a shard; what else a row holds spreads them over its buckets
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "size", "text_crc32"), F.lit(SLOT_BUCKETS)).cast("int"))
    counts = rows.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("shard", "bucket").orderBy("doc_id", "text_crc32", "size")) - 1
    numbered = rows.withColumn("inside", inside)
    # at most shards x SLOT_BUCKETS rows, whatever the corpus
    found = numbered.join(F.broadcast(offsets), ["shard", "bucket"])
    slot = (F.col("before") + F.col("inside")).cast("long").alias("slot")
    return found.select("doc_id", "size", "text_crc32", "law", "shard", slot, "grown_shard")
