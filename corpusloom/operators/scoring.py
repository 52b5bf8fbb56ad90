"""Token-matching precision, recall and F1 of text pairs, and their summary tables.

Both sides of a pair sit in one row, so a pair is scored where it is: Arrow batches of rows, NumPy
inside, no shuffle. Only static vectors too many to send to every task bring a join.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import land
from .lookup import places, salted_lookup

# Largest vector table sent to every task, in numbers (160 MB of floats), and in rows.
BROADCAST_FLOATS = 40_000_000
BROADCAST_VECTORS = 500_000
# Rows of one similarity block: a pair of very long texts never builds its whole matrix.
BLOCK_ROWS = 512


def _cells(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Length of every list (0 for NULL) and the row number of every element."""
    lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    return lengths, np.repeat(np.arange(len(lengths)), lengths)


def _codes(left: pa.Array, right: pa.Array) -> tuple[np.ndarray, np.ndarray, int]:
    """One integer code per distinct element over both flat arrays."""
    both = pa.chunked_array([left, right]).combine_chunks().dictionary_encode()
    codes = both.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    return codes[: len(left)], codes[len(left) :], len(both.dictionary)


HITS = ("n_cand", "n_ref", "hit_cand", "hit_ref")


@F.arrow_udf(T.StructType([T.StructField(name, T.IntegerType()) for name in HITS]))
def _overlap(cand: pa.Array, ref: pa.Array) -> pa.Array:
    """Tokens of each side and how many of them occur on the other side, for a batch of rows at once."""
    n_cand, cand_row = _cells(cand)
    n_ref, ref_row = _cells(ref)
    cand_code, ref_code, base = _codes(cand.flatten(), ref.flatten())
    cand_key = cand_row * base + cand_code
    ref_key = ref_row * base + ref_code
    hits = [
        np.bincount(rows[np.isin(keys, others)], minlength=len(cand))
        for rows, keys, others in ((cand_row, cand_key, ref_key), (ref_row, ref_key, cand_key))
    ]
    return pa.StructArray.from_arrays(
        [pa.array(x.astype(np.int32)) for x in (n_cand, n_ref, *hits)],
        names=list(HITS),
    )


def _best(
    left: np.ndarray, right: np.ndarray, left_vec: np.ndarray, right_vec: np.ndarray
) -> np.ndarray:
    """For every left token its best similarity to a right token; equal tokens have similarity 1."""
    best = np.zeros(len(left))
    for at in range(0, len(left), BLOCK_ROWS):
        part = slice(at, at + BLOCK_ROWS)
        similarity = left_vec[part] @ right_vec.T
        similarity[left[part, None] == right[None, :]] = 1.0
        best[part] = similarity.max(axis=1)
    return best


def _mean_best(
    cand: np.ndarray, n_cand: np.ndarray, cand_vec: np.ndarray,
    ref: np.ndarray, n_ref: np.ndarray, ref_vec: np.ndarray,
) -> tuple[float, float]:
    """Precision and recall of one pair from its distinct tokens, their counts and unit vectors."""
    if not len(cand) or not len(ref):
        return 0.0, 0.0
    return (
        float(np.average(_best(cand, ref, cand_vec, ref_vec), weights=n_cand)),
        float(np.average(_best(ref, cand, ref_vec, cand_vec), weights=n_ref)),
    )


def _unit(vectors: np.ndarray) -> np.ndarray:
    lengths = np.linalg.norm(vectors, axis=1, keepdims=True)
    return vectors / np.where(lengths == 0, 1.0, lengths)


def _f1(precision: Column, recall: Column) -> Column:
    return F.coalesce(F.try_divide(2 * precision * recall, precision + recall), F.lit(0.0))


def match_score(
    pairs: DataFrame,
    vectors: DataFrame | None = None,
    candidate: str = "cand_tokens",
    reference: str = "ref_tokens",
    broadcast_floats: int = BROADCAST_FLOATS,
) -> DataFrame:
    """Add ``precision``, ``recall`` and ``f1`` to pairs of token arrays.

    Precision is the mean over candidate tokens of their best similarity to a reference token, recall
    the reverse, F1 the harmonic mean. Without ``vectors`` similarity is 1 for equal tokens, else 0. With a
    table ``token, vector`` it is the cosine; a token without a vector matches only itself. An empty or NULL
    side scores 0. NULL tokens and NULL vectors count as absent, of several vectors of a token the smallest counts, and vectors of
    different widths are refused. Pairs need no key, and repeated ones stay apart.
    """
    pairs = pairs.withColumns({c: F.array_compact(c) for c in (candidate, reference)})
    if vectors is None:
        scored = pairs.withColumn("_hits", _overlap(candidate, reference))
        precision = F.coalesce(F.try_divide("_hits.hit_cand", "_hits.n_cand"), F.lit(0.0))
        recall = F.coalesce(F.try_divide("_hits.hit_ref", "_hits.n_ref"), F.lit(0.0))
        scored = scored.withColumn("precision", precision).withColumn("recall", recall).drop("_hits")
    else:
        present = vectors.where("token IS NOT NULL AND vector IS NOT NULL").groupBy("token")
        vectors = present.agg(F.min(F.col("vector").cast("array<double>")).alias("vector"))
        table = _small_table(vectors, broadcast_floats)
        if table is None:
            scored = _score_by_join(pairs, vectors, candidate, reference)
        else:
            scored = _score_in_place(pairs, table, candidate, reference)
    return scored.withColumn("f1", _f1(F.col("precision"), F.col("recall")))


def _small_table(vectors: DataFrame, floats: int) -> tuple[pa.Array, np.ndarray] | None:
    """Tokens and vectors, or None when there are too many to send to every task.

    The matrix has one more row, all zero, that stands for tokens without a vector.
    """
    widths = vectors.agg(F.min(F.size("vector")).alias("low"), F.max(F.size("vector")).alias("high")).first()
    if widths.low != widths.high:
        raise ValueError("vectors must have one width")
    width = widths.low or 1
    allowed = min(BROADCAST_VECTORS, floats // width)
    found = vectors.select("token", "vector").limit(allowed + 1).toArrow()
    if found.num_rows > allowed:
        return None
    flat = found["vector"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
    matrix = np.vstack([flat.reshape(-1, width), np.zeros((1, width), flat.dtype)])
    return found["token"].combine_chunks(), matrix


def _score_in_place(
    pairs: DataFrame, table: tuple[pa.Array, np.ndarray], candidate: str, reference: str
) -> DataFrame:
    shared = pairs.sparkSession.sparkContext.broadcast({"words": table[0], "matrix": table[1]})

    @F.arrow_udf("precision double, recall double")
    def best_match(cand: pa.Array, ref: pa.Array) -> pa.Array:
        matrix = shared.value["matrix"]
        sides = []
        flats = cand.flatten(), ref.flatten()
        codes = _codes(*flats)
        for lists, flat, code in zip((cand, ref), flats, codes):
            row = places(shared.value, flat, len(matrix) - 1)
            ends = np.cumsum(_cells(lists)[0])[:-1]
            sides.append((np.split(code, ends), np.split(row, ends)))
        scores = [
            _mean_best(*_distinct(*left, matrix), *_distinct(*right, matrix))
            for left, right in zip(zip(*sides[0]), zip(*sides[1]))
        ]
        precision, recall = zip(*scores) if scores else ((), ())
        return pa.StructArray.from_arrays(
            [pa.array(precision, pa.float64()), pa.array(recall, pa.float64())],
            names=["precision", "recall"],
        )

    scored = pairs.withColumn("_best", best_match(candidate, reference))
    return scored.select(*pairs.columns, "_best.precision", "_best.recall")


def _distinct(
    codes: np.ndarray, rows: np.ndarray, matrix: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct codes of one side, their counts and their unit vectors."""
    found, at, count = np.unique(codes, return_index=True, return_counts=True)
    return found, count, _unit(matrix[rows[at]].astype(np.float64))


def _score_by_join(pairs: DataFrame, vectors: DataFrame, candidate: str, reference: str) -> DataFrame:
    """Vectors met by a salted join on token, then pairs scored where their cells meet, many in a batch.

    Pairs are written once with a number of their own, so their identity does not hang on a caller's key.
    """
    numbered = land(pairs.withColumn("_row", F.monotonically_increasing_id()), "pairs")
    sides = [
        numbered.select("_row", F.lit(is_ref).alias("is_ref"), F.explode(column).alias("token"))
        for column, is_ref in ((candidate, False), (reference, True))
    ]
    cells = sides[0].unionByName(sides[1]).groupBy("_row", "is_ref", "token").agg(F.count("*").alias("n"))
    joined = salted_lookup(land(cells, "cells"), vectors, "token", "_row")
    # numbers are dealt by hash, so the rows of a pair stand together; a pair is no larger than its two texts
    sorted_cells = joined.repartition("_row").sortWithinPartitions("_row").select("_row", "is_ref", "token", "n", "vector")
    scores = sorted_cells.mapInArrow(_score_cells, "_row long, precision double, recall double")
    scored = numbered.join(scores, "_row", "left").drop("_row")
    return scored.fillna(0.0, ["precision", "recall"])


def _score_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Scores of pairs from their cells, sorted by pair."""
    kept = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        kept = table if kept is None else pa.concat_tables([kept, table])
        done = int(np.searchsorted(kept["_row"].to_numpy(), kept["_row"][-1].as_py())) if kept.num_rows else 0
        if done:
            yield _scored_cells(kept.slice(0, done))
            kept = kept.slice(done)
    if kept is not None and kept.num_rows:
        yield _scored_cells(kept)


def _scored_cells(cells: pa.Table) -> pa.RecordBatch:
    row, n = cells["_row"].to_numpy(), cells["n"].to_numpy()
    ref = cells["is_ref"].to_numpy().astype(bool)
    token, _, _ = _codes(cells["token"].combine_chunks(), pa.array([], pa.string()))
    vectors = cells["vector"].combine_chunks()
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    present = vectors.is_valid().to_numpy(zero_copy_only=False)
    matrix = np.zeros((len(row), len(flat) // max(int(present.sum()), 1) or 1))
    if present.any():
        matrix[present] = _unit(flat.reshape(int(present.sum()), -1).astype(np.float64))
    begins = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
    scores = []
    for s, e in zip(begins, np.r_[begins[1:], len(row)], strict=True):
        c, r = np.flatnonzero(~ref[s:e]) + s, np.flatnonzero(ref[s:e]) + s
        scores.append(_mean_best(token[c], n[c], matrix[c], token[r], n[r], matrix[r]))
    precision, recall = zip(*scores)
    return pa.RecordBatch.from_arrays(
        [pa.array(row[begins]), pa.array(precision), pa.array(recall)], names=["_row", "precision", "recall"]
    )


def mean_prf(scores: DataFrame, *by: str) -> DataFrame:
    """Mean precision, recall and F1 over pairs; the mean F1 is the mean of the pairs' F1."""
    return scores.groupBy(*by).agg(
        F.avg("precision").alias("precision"),
        F.avg("recall").alias("recall"),
        F.avg("f1").alias("f1"),
        F.count("*").alias("n"),
    )


def to_metrics(summary: DataFrame, model: str, *names: str) -> DataFrame:
    """One summary row per model to long ``metric, model, value`` rows."""
    return summary.unpivot(model, list(names), "metric", "value").select(
        "metric", F.col(model).alias("model"), "value"
    )


def compare_models(
    metrics: DataFrame, models: Sequence[str] = ("original", "finetuned")
) -> DataFrame:
    """``metric`` by model, from long ``metric, model, value`` rows."""
    return metrics.groupBy("metric").pivot("model", list(models)).agg(F.first("value"))
