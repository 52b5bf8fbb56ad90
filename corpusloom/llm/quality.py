"""Quality grades by ordinal regression on hashed text.

Ratings are grades 0 < 1 < ... < G. One weight vector over hashed features gives a document a score, and ordered thresholds
cut the score's line: ``P(grade >= g) = sigmoid(score - threshold_g)``. The weights are shared by all thresholds, so
``P(grade >= g)`` falls with ``g`` for every text, and rare grades are learnt from all others.

The model is fitted on a documented, bounded sample of rated documents, chosen by a hash of the id: Spark makes the sample's
features and screens them (a feature takes part if its frequency differs between grades by some standard errors: ``SCREEN`` for words,
of which a smaller language's are rare but pure, ``SCREEN_GRAMS`` for byte runs; the ``STRONGEST`` take part in any case, so that few
ratings teach something too), and the few screened ones, bounded by the sample, are fitted at once. Scoring reads every document once and shuffles nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import land
from . import words

WIDTH = 1 << 20  # hashed features, of which the last GRAMS are runs of three bytes
GRAMS = 1 << 15
SAMPLE = 16_384  # rated documents expected in the fit; all, if there are fewer
SCREEN = 4.0  # standard errors by which a word's frequency must differ between grades: by chance about 6 words in 100,000 do
SCREEN_GRAMS = 10.0  # the same for byte runs, which occur in most texts
STRONGEST = 2_000  # features that take part whatever their standard errors are
STRENGTH = 5.0  # total strength of a text's byte runs; each word that occurs counts 1
FIT_VALUES = 1 << 18  # feature values of a gradient step held at once
STEPS = 300
RATE = 0.1
DECAY = 1e-5
KEEP_AT = 0.4  # a document stays if its probability of the best grade is at least this


@dataclass(frozen=True)
class OrdinalModel:
    """Weights of the features that take part, and ordered thresholds, one for each grade above the lowest."""

    ids: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray


def features(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, rows, row, feature, value) of each piece: lower-cased words, and runs of three bytes by log frequency."""
    for at, data, offsets in words.pieces(texts):
        n = len(offsets) - 1
        row, hashes, _, _ = words.word_hashes(data, offsets, words.NOT_ALNUM)
        keys = np.unique(row * WIDTH + (hashes % np.uint64(WIDTH - GRAMS)).astype(np.int64))
        out = [(keys // WIDTH, keys % WIDTH, np.ones(len(keys), np.float32))]
        if len(data) >= 3:
            codes = data[:-2].astype(np.uint32) << np.uint32(16) | data[1:-1].astype(np.uint32) << np.uint32(8) | data[2:]
            codes *= np.uint32(0x9E3779B1)
            owner = np.repeat(np.arange(n), np.diff(offsets))
            whole = owner[:-2] == owner[2:]
            gram = (codes[whole] >> np.uint32(17)).astype(np.int64)
            keys, count = np.unique(owner[:-2][whole] * GRAMS + gram, return_counts=True)
            row, value = keys // GRAMS, 1 + np.log(count)
            norm = np.sqrt(np.bincount(row, value**2, minlength=n))
            out.append((row, keys % GRAMS + WIDTH - GRAMS, (STRENGTH * value / norm[row]).astype(np.float32)))
        yield at, n, *(np.concatenate(x) for x in zip(*out, strict=True))


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at, n, row, feature, value in features(batch.column(1)):
            order = np.argsort(row, kind="stable")
            ends = np.r_[0, np.cumsum(np.bincount(row, minlength=n))].astype(np.int32)
            lists = [
                pa.ListArray.from_arrays(ends, x)
                for x in (pa.array(feature[order].astype(np.int32)), pa.array(value[order]))
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, n), *lists], names=["grade", "features", "values"])


def fit_ordinal(
    docs: DataFrame, ratings: DataFrame, grade: str = "grade", doc_id: str = "doc_id", text: str = "text", sample: int = SAMPLE
) -> OrdinalModel:
    """A model of the ratings (``doc_id, grade``); a document rated twice counts with its lower grade, and
    of rows that repeat an id the smallest text counts once.

    NULL ids and grades are left out. Without ratings, or with one grade only, the model has no features and
    its thresholds lie so low that every document has the best grade.
    """
    rated = ratings.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(grade).cast("int").alias("grade"))
    rated = rated.where("doc_id IS NOT NULL AND grade IS NOT NULL").groupBy("doc_id").agg(F.min("grade").alias("grade"))
    count = rated.count()
    part = F.pmod(F.xxhash64("doc_id", F.lit(6)), F.lit(1 << 30)) < int(min(1.0, sample / max(count, 1)) * (1 << 30))
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    # the chosen ratings are about ``sample`` rows at most, so they can be sent to the tasks
    chosen = texts.join(F.broadcast(rated.where(part)), "doc_id").groupBy("doc_id").agg(F.min("grade").alias("grade"), F.min("text").alias("text"))
    chosen = chosen.select("grade", "text")
    table = land(chosen.mapInArrow(_featured, "grade int, features array<int>, values array<float>"), "features")
    totals = {r["grade"]: r["n"] for r in table.groupBy("grade").agg(F.count("*").alias("n")).collect()}
    grades = max(totals, default=0)
    if len(totals) < 2:
        return OrdinalModel(np.empty(0, np.int64), np.empty(0), np.full(max(grades, 1), -30.0))
    kept = _screened(table, totals)
    shared = docs.sparkSession.sparkContext.broadcast(kept)

    def screen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists, values = batch.column(1), batch.column(2)
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            at = np.searchsorted(shared.value, flat)
            good = shared.value[np.minimum(at, len(shared.value) - 1)] == flat if len(shared.value) else np.zeros(len(flat), bool)
            lengths = np.diff(lists.offsets.to_numpy())
            owner = np.repeat(np.arange(len(lists)), lengths)[good]
            ends = np.r_[0, np.cumsum(np.bincount(owner, minlength=len(lists)))].astype(np.int32)
            flats = (pa.array(at[good].astype(np.int32)), pa.array(values.flatten().to_numpy(zero_copy_only=False)[good]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.ListArray.from_arrays(ends, x) for x in flats]], names=["grade", "features", "values"]
            )

    found = table.mapInArrow(screen, table.schema).toArrow().combine_chunks()
    return _fit(found, kept, grades)


def _screened(table: DataFrame, totals: dict[int, int]) -> np.ndarray:
    """Sorted ids of the features whose frequency differs between grades."""
    n = sum(totals.values())
    cells = table.select("grade", F.explode("features").alias("feature")).groupBy("feature")
    counted = cells.agg(F.count("*").alias("n"), *[F.count_if(F.col("grade") >= g).alias(f"n{g}") for g in range(1, max(totals) + 1)])
    tests = []
    for g in range(1, max(totals) + 1):
        p = sum(c for x, c in totals.items() if x >= g) / n
        spread = F.sqrt(F.col("n") * p * (1 - p) * (1 - F.col("n") / n) + 1)
        tests.append(F.abs(F.col(f"n{g}") - F.col("n") * p) / spread)
    errors = F.greatest(*tests, F.lit(0.0)).alias("errors")
    tested = land(counted.select("feature", errors), "screen")
    least = F.when(F.col("feature") < WIDTH - GRAMS, SCREEN).otherwise(SCREEN_GRAMS)
    strongest = tested.orderBy(F.col("errors").desc(), "feature").limit(STRONGEST)
    either = tested.where(F.col("errors") >= least).unionByName(strongest).select("feature")
    return np.unique(either.toArrow()["feature"].to_numpy()).astype(np.int64)


def _fit(found: pa.Table, kept: np.ndarray, grades: int) -> OrdinalModel:
    """Gradient steps with per-weight scaling over the bounded, screened sample."""
    y = found["grade"].to_numpy()
    lists = found["features"].combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    values = found["values"].combine_chunks()
    values = values.chunk(0) if isinstance(values, pa.ChunkedArray) else values
    ends = lists.offsets.to_numpy()
    feature, value = lists.flatten().to_numpy(), values.flatten().to_numpy()
    # whole rows, so many at a time that the working arrays stay small whatever the sample holds
    cuts = np.searchsorted(ends, np.arange(0, int(ends[-1]), FIT_VALUES))
    cuts = np.unique(np.r_[0, cuts, len(y)])
    size = len(kept)
    x = np.r_[np.zeros(size), np.linspace(-1, 0, grades)]
    first, second = np.zeros_like(x), np.zeros_like(x)
    for step in range(1, STEPS + 1):
        gradient = np.zeros_like(x)
        for s, t in zip(cuts[:-1], cuts[1:], strict=True):
            some, part = slice(ends[s], ends[t]), y[s:t]
            row = np.repeat(np.arange(t - s), np.diff(ends[s : t + 1]))
            score = np.bincount(row, x[feature[some]] * value[some], minlength=t - s)
            error = np.zeros(t - s)
            for g in range(grades):
                e = 1 / (1 + np.exp(-np.clip(score - x[size + g], -30, 30))) - (part > g)
                error += e
                gradient[size + g] -= e.sum()
            gradient[:size] += np.bincount(feature[some], error[row] * value[some], minlength=size)
        gradient /= len(y)
        gradient[:size] += DECAY * x[:size]
        first = 0.9 * first + 0.1 * gradient
        second = 0.99 * second + 0.01 * gradient**2
        x = x - RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-6)
        x[size:] = np.sort(x[size:])
    return OrdinalModel(kept, x[:size], x[size:])


def grades(docs: DataFrame, model: OrdinalModel, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, expected_grade, p_best``: one row for each row of ``docs``.

    ``expected_grade`` is the sum of ``P(grade >= g)``, ``p_best`` that of the highest grade. A NULL or empty text has no features: it gets
    what the thresholds alone say. NULL ids stay NULL; repeated rows get equal answers; other columns are not looked at.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            expected, best = _scores(model, batch.column(1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(expected), pa.array(best)], names=["doc_id", "expected_grade", "p_best"]
            )

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "doc_id long, expected_grade double, p_best double")


def _scores(model: OrdinalModel, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    dense = np.zeros(WIDTH)
    dense[model.ids] = model.weights
    score = np.zeros(len(texts))
    for at, n, row, feature, value in features(texts):
        score[at : at + n] = np.bincount(row, dense[feature] * value, minlength=n)
    tails = 1 / (1 + np.exp(-np.clip(score[:, None] - model.thresholds[None, :], -30, 30)))
    return tails.sum(axis=1), tails[:, -1].copy()


def keep_best(docs: DataFrame, model: OrdinalModel, at_least: float = KEEP_AT, text: str = "text") -> DataFrame:
    """``docs`` without the rows whose probability of the best grade is below ``at_least``; all columns stay."""

    @F.arrow_udf("double")
    def p_best(texts: pa.Array) -> pa.Array:
        return pa.array(_scores(model, texts)[1])

    return docs.where(p_best(F.col(text)) >= at_least)


def graded_labels(labels: DataFrame) -> DataFrame:
    """``doc_id, grade`` of the labels table: 0 for toxic, 1 for poor quality, 2 for good.

    Toxic words add up without end, so the grade they lead to has to be the last: in a middle grade a document with
    many of them would be pushed past it, and their weights stay too small to be seen.
    """
    grade = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).when(F.col("quality") == 1, 2)
    return labels.select("doc_id", grade.alias("grade"))
