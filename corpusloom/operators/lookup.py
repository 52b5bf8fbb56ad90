"""Looking many rows up in a smaller table whose hot keys must not gather in one task."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A key with more than one in HOT_SHARE of the rows is split, into as many groups as it holds such shares: there are
# at most HOT_SHARE hot keys, and at most twice as many groups.
HOT_SHARE = 1_000


def salted_lookup(rows: DataFrame, lookup: DataFrame, on: str, spread_by: str, counts: DataFrame | None = None) -> DataFrame:
    """Left join in which the rows of a hot key are dealt over several copies of its lookup row.

    Hot keys are found by counting ``rows``, which are read more than once then: pass a written table. Where the number of
    rows of each key is known already, ``counts`` gives it as a written table (``on``, ``_n``), and ``rows`` are read once. The
    share a group may hold does not depend on the size of the input. ``spread_by`` tells the rows of a key apart.
    """
    if counts is None:
        counts = rows.groupBy(on).agg(F.count("*").alias("_n"))
    total = counts.agg(F.sum("_n")).scalar()
    salts = F.ceil(F.col("_n") * HOT_SHARE / total).cast("int")
    hot = F.broadcast(counts.where(F.col("_n") * HOT_SHARE > total).select(on, salts.alias("_salts")))
    last = F.coalesce("_salts", F.lit(1))
    dealt = rows.join(hot, on, "left").withColumn("_salt", F.pmod(F.xxhash64(spread_by), last).cast("int")).drop("_salts")
    copies = lookup.join(hot, on, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), last - 1))).drop("_salts")
    return dealt.join(copies, [on, "_salt"], "left").drop("_salt")


def places(table: dict, words: pa.Array, missing: int) -> np.ndarray:
    """The place of each word in ``table["words"]``, ``missing`` for a word outside and for NULL.

    ``table`` is a broadcast value: a worker keeps it from task to task, so the dictionary put into it is built once a
    worker, not once a batch. Only distinct words of the batch are looked up.
    """
    if "places" not in table:
        table["places"] = {word: i for i, word in enumerate(table["words"].to_pylist())}
    known, coded = table["places"], words.dictionary_encode()
    found = np.array([*(known.get(w, missing) for w in coded.dictionary.to_pylist()), missing], np.int32)
    return found[pc.fill_null(coded.indices.cast(pa.int32()), len(found) - 1).to_numpy(zero_copy_only=False)]
