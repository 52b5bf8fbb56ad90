"""Connected components of an edge table, by alternating stars on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import land
from .keyed import look_up


def components(edges: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """``node, root``: the smallest node that each node of an edge reaches (roots themselves included).

    Each round hangs all neighbours of a node under the smallest of them, first its larger ones, then its
    smaller ones; after a few rounds (logarithmic in practice) only stars are left. Rounds are written to
    the shared folder, so lineage stays short. Minima combine before the shuffle, so a node with very many
    edges is one row per task there; the joins that follow deal its edges over copies of its minimum.
    Edges with a NULL end or from a node to itself are ignored; an empty table gives an empty result.
    """
    u, v = F.col("u"), F.col("v")
    now = land(
        edges.select(F.col(left).alias("u"), F.col(right).alias("v"))
        .where(u != v)
        .select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v"))
        .distinct(),
        "edges",
    )
    state = _summary(now)
    while state[0]:
        both = now.unionByName(now.select(v.alias("u"), u.alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # from the smaller end of each edge: its larger neighbours
        large = look_up(now.select(v.alias("u"), u.alias("v")), least, ["u"], ["v"]).select(v.alias("u"), F.col("m").alias("v"))
        large = land(large, "large")
        floor = large.groupBy("u").agg(F.min("v").alias("m"))
        small = look_up(large, floor, ["u"], ["v"]).select(v.alias("u"), F.col("m").alias("v"))
        after = floor.select("u", F.col("m").alias("v")).unionByName(small).where(u != v).distinct()
        now = land(after, "stars")
        new = _summary(now)
        if new == state:
            break
        state = new
    roots = now.select(v.alias("node"), v.alias("root")).distinct()
    return now.select(u.alias("node"), v.alias("root")).unionByName(roots)


def _summary(edges: DataFrame) -> tuple:
    """Number of edges and an order-free checksum of them."""
    key = F.xxhash64("u", "v").cast("decimal(38,0)")
    return tuple(edges.agg(F.count("*"), F.sum(key)).first())
