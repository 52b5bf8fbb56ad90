"""A count-based language model as tables, and document losses under it."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import fixed
from ..session import land

# A pair above one in HOT_SHARE of all counts is looked up by broadcast: there are at most that many.
HOT_SHARE = 1_000
# Pairs that a task counts at a time; nearly every pair of a text is new, so what a task holds must not follow its share of the input.
PIECE = 1 << 22


def _pairs(ids: Column) -> Column:
    """Adjacent ids of a row as an array of structs."""
    steps = F.greatest(F.size(ids) - 1, F.lit(0))
    return F.arrays_zip(F.slice(ids, F.lit(1), steps), F.slice(ids, F.lit(2), steps))


def _adjacent(lists: pa.Array) -> pa.Table:
    """``a, b`` of the adjacent elements of each list; pairs whose first element is NULL are left out."""
    lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    flat, row = lists.flatten(), np.repeat(np.arange(len(lengths)), lengths)
    first, second = flat.slice(0, max(len(flat) - 1, 0)), flat.slice(1)
    kept = pc.and_(pa.array(row[:-1] == row[1:]), first.is_valid())
    return pa.table({"a": first.filter(kept), "b": second.filter(kept)})


def _count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``a, b, n`` of a task's rows, counted whenever so many pairs have come together."""
    held, size = [], 0
    for batch in batches:
        pairs = _adjacent(batch.column(0))
        held.append(pairs)
        size += len(pairs)
        if size >= PIECE:
            yield from _counted(held)
            held, size = [], 0
    if size:
        yield from _counted(held)


def _counted(held: list[pa.Table]) -> list[pa.RecordBatch]:
    counts = pa.concat_tables(held).group_by(["a", "b"], use_threads=False).aggregate([([], "count_all")])
    # neighbours of one context pack into fewer shuffled bytes
    ordered = counts.select(["a", "b", "count_all"]).rename_columns(["a", "b", "n"]).sort_by("a")
    return ordered.to_batches(max_chunksize=1 << 16)


def fit_ngram(df: DataFrame, ids: str = "ids") -> DataFrame:
    """``a, b, n``: adjacent id pairs and how often they occur.

    Tasks count their pairs in pieces of bounded size before the shuffle, whatever the splits of the input are. The
    pieces' counts are dealt by pair and added up behind the shuffle only: a sum before it would hold all of a task's pairs again.
    """
    element = df.schema[ids].dataType.elementType
    schema = T.StructType([T.StructField("a", element), T.StructField("b", element), T.StructField("n", T.LongType())])
    pieces = df.select(ids).mapInArrow(_count_pairs, schema)
    return pieces.repartition("a", "b").groupBy("a", "b").agg(F.sum("n").alias("n"))


def merge_ngram(background: DataFrame, domain: DataFrame) -> DataFrame:
    """Counts of a background model after further training on a domain."""
    return background.unionByName(domain).groupBy("a", "b").agg(F.sum("n").alias("n"))


def document_loss(
    df: DataFrame,
    counts: DataFrame,
    vocab_size: int,
    key: str = "doc_id",
    ids: str = "ids",
    context: int = fixed.CONTEXT,
    k: float = 1.0,
    model: str | None = None,
) -> DataFrame:
    """``key, loss, n``: mean negative log-likelihood of each document cut to the context.

    Add-``k`` smoothing over ``vocab_size`` words. A document of fewer than two tokens predicts nothing
    and is left out. With ``model``, ``counts`` holds several models told apart by that column, all are
    scored in one pass, and the result has it too. Pass ``counts`` as a written table: it is read more than once.

    Pairs are counted per document first, so a document brings each of its pairs once. Pairs frequent in
    the scored documents are what would crowd one task of the join, so they are the ones split: pairs above one
    in ``HOT_SHARE`` of the scored ones, of which there are at most that many, get their counts by
    broadcast. Contexts are met with the counts, once per distinct pair, before any document is.
    """
    by = [] if model is None else [model]
    rows = df.select(key, F.slice(ids, 1, context).alias("_cut")).select(
        key, F.size("_cut").alias("n"), F.inline_outer(_pairs(F.col("_cut"))).alias("a", "b")
    )
    pairs = land(rows.where("a IS NOT NULL").groupBy(key, "n", "a", "b").agg(F.count("*").alias("tf")), "pairs")
    scored = pairs.groupBy("a", "b").agg(F.count("*").alias("_docs"))
    total = scored.agg(F.sum("_docs")).scalar()
    hot = scored.where(F.col("_docs") * HOT_SHARE >= total).select("a", "b")
    contexts = counts.groupBy(*by, "a").agg(F.sum("n").alias("n_context"))
    names = counts.select(*by).distinct() if by else None

    def likely(wanted: DataFrame) -> DataFrame:
        """``model, a, b, nll`` of distinct pairs."""
        each = wanted.join(F.broadcast(names)) if by else wanted
        met = each.join(contexts, [*by, "a"], "left").join(counts, [*by, "a", "b"], "left")
        share = (F.coalesce("n", F.lit(0)) + k) / (F.coalesce("n_context", F.lit(0)) + k * vocab_size)
        return met.select(*by, "a", "b", (-F.ln(share)).alias("nll"))

    cold = likely(scored.select("a", "b").join(F.broadcast(hot), ["a", "b"], "left_anti"))
    parts = [pairs.join(F.broadcast(likely(hot)), ["a", "b"]), pairs.join(F.broadcast(hot), ["a", "b"], "left_anti").join(cold, ["a", "b"])]
    sums = [p.select(key, "n", *by, (F.col("nll") * F.col("tf")).alias("nll"), "tf") for p in parts]
    found = sums[0].unionByName(sums[1]).groupBy(key, "n", *by)
    return found.agg((F.sum("nll") / F.sum("tf")).alias("loss")).select(key, *by, "loss", "n")


def corpus_ppl(losses: DataFrame, *by: str) -> DataFrame:
    """Perplexity from per-document losses weighted by token count; NULL when there are none.

    ``losses`` is ``loss, n`` from :func:`document_loss` or from any external model.
    """
    weighted = F.try_divide(F.sum(F.col("loss") * F.col("n")), F.sum("n"))
    return losses.groupBy(*by).agg(F.exp(weighted).alias("ppl"))
