"""Short examples packed into full blocks, so that training does not spend itself on padding.

Which lengths share a block is decided on the histogram of lengths, which has at most as many entries as a block
has tokens: best fit, longest first, for all examples of a length at once. The plan is a short list of block patterns and how
often each is filled; an example finds its place from its rank within its length. Ranks come from a sort by ranges.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from .vocab import ranked

_PLACES = "_length int, _from long, _to long, _each int, _first long, _offset int"


@dataclass
class _Pattern:
    """Blocks filled alike: how many, the space left, and (length, examples of it) in order."""

    blocks: int
    left: int
    parts: list[tuple[int, int]]


def best_fit(histogram: dict[int, int], block: int) -> list[_Pattern]:
    """Blocks for all lengths, longest first, each into the fullest block that still has room.

    An example put into a block makes it the fullest again, so a block takes as many of a length as fit before the next
    one does: blocks of equal space are filled together, and one at most is left with fewer.
    """
    patterns: list[_Pattern] = []
    for length in sorted(histogram, reverse=True):
        count = histogram[length]
        for pattern in sorted((p for p in patterns if p.left >= length), key=lambda p: p.left):
            if not count:
                break
            fit = pattern.left // length
            full = min(pattern.blocks, count // fit)
            rest = count - full * fit if full < pattern.blocks else 0
            for blocks, each in ((full, fit), (1 if rest else 0, rest)):
                if blocks:
                    pattern.blocks -= blocks
                    count -= blocks * each
                    patterns.append(_Pattern(blocks, pattern.left - each * length, [*pattern.parts, (length, each)]))
            if not pattern.blocks:
                patterns.remove(pattern)
        fit = block // length
        for blocks, each in ((count // fit, fit), (1 if count % fit else 0, count % fit)):
            if blocks:
                patterns.append(_Pattern(blocks, block - each * length, [(length, each)]))
        # equal patterns are one, so that their number does not grow with the lengths tried
        merged: dict[tuple, _Pattern] = {}
        for p in patterns:
            merged.setdefault((p.left, tuple(p.parts)), _Pattern(0, p.left, p.parts)).blocks += p.blocks
        patterns = list(merged.values())
    return patterns


def _places(patterns: list[_Pattern]) -> list[tuple[int, int, int, int, int, int]]:
    """For each length and pattern: the ranks that fill it, examples in a block, the first block and the first token in it."""
    rows, used, first = [], {}, 0
    for pattern in patterns:
        offset = 0
        for length, each in pattern.parts:
            begin = used.get(length, 0)
            used[length] = begin + each * pattern.blocks
            rows.append((length, begin, used[length], each, first, offset))
            offset += length * each
        first += pattern.blocks
    return rows


def pack_blocks(df: DataFrame, key: str = "doc_id", ids: str = "ids", block: int = fixed.BLOCK, pad: int = 0) -> DataFrame:
    """Id arrays dealt into blocks of exactly ``block`` ids; every id is in one block, none is cut off.

    Columns: ``block_id``, ``input_ids`` (padded on the right with ``pad``), ``segment_ids`` (from 1 by example, 0 for padding: attention
    stays inside a segment), ``position_ids`` (from 0 in each segment), ``n_tokens`` and ``members``, an array of (key, part,
    offset, length). An array longer than a block is cut into parts of a whole block and a rest. NULL and empty
    arrays need no room; NULL and repeated keys are examples like others, told apart by nothing but their place.
    """
    parts = F.ceil(F.size(ids) / block).cast("int") - 1
    pieces = (
        df.where(F.size(ids) > 0)
        .select(F.col(key).alias("_key"), F.col(ids).alias("_ids"), F.explode(F.sequence(F.lit(0), parts)).alias("_cut"))
        .withColumn("_ids", F.slice("_ids", F.col("_cut") * block + 1, F.lit(block)))
        .withColumn("_length", F.size("_ids"))
    )
    # equal keys and parts have an order of their own by their ids' hash
    order = [F.col("_length"), F.xxhash64("_key", "_cut", "_ids"), F.col("_key"), F.col("_cut")]
    placed = ranked(pieces, *order)
    spark = df.sparkSession
    # at most ``block`` rows
    histogram = {r["_length"]: r["n"] for r in placed.groupBy("_length").agg(F.count("*").alias("n")).collect()}
    begin, starts = 0, []
    for length in sorted(histogram):
        starts.append((length, begin))
        begin += histogram[length]
    plan = _places(best_fit(histogram, block))
    # both tables are bounded by the block, not by the rows
    lengths = F.broadcast(spark.createDataFrame(starts, "_length int, _start long"))
    places = F.broadcast(spark.createDataFrame(plan, _PLACES))
    own = placed.join(lengths, "_length").withColumn("_rank", F.col("rank") - F.col("_start"))
    met = own.join(places, "_length").where((F.col("_rank") >= F.col("_from")) & (F.col("_rank") < F.col("_to")))
    at = F.col("_rank") - F.col("_from")
    dealt = met.select(
        (F.col("_first") + F.floor(at / F.col("_each"))).alias("block_id"),
        (F.col("_offset") + (at % F.col("_each")).cast("int") * F.col("_length")).alias("_at"),
        "_ids",
        "_key",
        "_cut",
        "_length",
    )
    filled = dealt.groupBy("block_id").agg(F.sort_array(F.collect_list(F.struct("_at", "_length", "_cut", "_ids", "_key"))).alias("_m"))
    room = F.lit(block) - F.size("input_ids")
    segments = F.flatten(F.transform("_m", lambda m, i: F.array_repeat(i + 1, m["_length"])))
    positions = F.flatten(F.transform("_m", lambda m: F.sequence(F.lit(0), m["_length"] - 1)))
    members = F.transform(
        "_m", lambda m: F.struct(m["_key"].alias("key"), m["_cut"].alias("part"), m["_at"].alias("offset"), m["_length"].alias("length"))
    )
    return (
        filled.select("block_id", F.flatten("_m._ids").alias("input_ids"), "_m")
        .withColumn("n_tokens", F.size("input_ids"))
        .withColumn("segment_ids", F.concat(segments, F.array_repeat(F.lit(0), room)))
        .withColumn("position_ids", F.concat(positions, F.array_repeat(F.lit(0), room)))
        .withColumn("input_ids", F.concat("input_ids", F.array_repeat(F.lit(pad), room)))
        .select("block_id", "input_ids", "segment_ids", "position_ids", "n_tokens", members.alias("members"))
    )


def unpack_blocks(blocks: DataFrame, key: str = "doc_id") -> DataFrame:
    """``key, part, ids``: the examples of packed blocks, read back."""
    each = blocks.select("input_ids", F.explode("members").alias("m"))
    return each.select(F.col("m.key").alias(key), F.col("m.part").alias("part"), F.slice("input_ids", F.col("m.offset") + 1, F.col("m.length")).alias("ids"))
