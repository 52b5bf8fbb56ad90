"""Product codes of vectors from per-dimension value dictionaries.

Components become integers. Vectors are written once in blocks; a block holds, for each dimension, the sorted
distinct integers of its vectors (the dictionary) and each vector's place in it. To find the nearest codebook
entries, the squared differences of every dictionary value to all entries are tabulated; the distance of a part
is then a gather and an add for each of its dimensions. Blocks are small, so their tables are, whatever the
values are; sums and counts of the entries combine in Spark.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import land
from .keyed import look_up

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
# vectors in a block: its dictionaries and tables hold at most this many values a dimension
BLOCK = 2_048
# integers are held within this bound (components of about 4 * 10^9 at the scale of 256)
LARGEST = 2**40
_LONG = 2**63 - 1

_BLOCKS = "ids array<long>, labels array<long>, labelled array<boolean>, first array<int>, dictionary array<long>, codes binary"
_SUMS = "part int, entry int, place int, n long, total decimal(38,0)"
_CODED = "vec_id long, label long, has_label boolean, code string, error decimal(38,0)"


@dataclass(frozen=True)
class Codebooks:
    """Entries by part, entry and position within the part: Python integers of any size."""

    entries: list[list[list[int]]]

    def digest(self) -> str:
        numbers = (str(x) for part in self.entries for entry in part for x in entry)
        return hashlib.sha256(",".join(numbers).encode()).hexdigest()


def _integers(vectors: np.ndarray, scale: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.clip(np.floor(vectors * scale), -LARGEST, LARGEST).astype(np.int64)


def _to_blocks(batches: Iterator[pa.RecordBatch], width: int, scale: int) -> Iterator[pa.RecordBatch]:
    schema = pa.schema(
        [
            ("ids", pa.list_(pa.int64())),
            ("labels", pa.list_(pa.int64())),
            ("labelled", pa.list_(pa.bool_())),
            ("first", pa.list_(pa.int32())),
            ("dictionary", pa.list_(pa.int64())),
            ("codes", pa.binary()),
        ]
    )
    for batch in batches:
        for begin in range(0, batch.num_rows, BLOCK):
            piece = batch.slice(begin, BLOCK)
            values = piece.column("vector").flatten().to_numpy(zero_copy_only=False)
            whole = _integers(values.reshape(piece.num_rows, width).astype(np.float64), scale)
            places, first, dictionary = np.empty((width, piece.num_rows), np.uint16), [0], []
            for d in range(width):
                known, places[d] = np.unique(whole[:, d], return_inverse=True)
                dictionary.append(known)
                first.append(first[-1] + len(known))
            labels = piece.column("label")
            row = {
                "ids": piece.column("vec_id").to_pylist(),
                "labels": labels.fill_null(0).to_pylist(),
                "labelled": labels.is_valid().to_pylist(),
                "first": first,
                "dictionary": np.concatenate(dictionary).tolist(),
                "codes": places.tobytes(),
            }
            yield pa.RecordBatch.from_pylist([row], schema)


class _Block:
    """One block in a task: nearest entries of all its vectors, part by part."""

    def __init__(self, row: dict, books: Codebooks):
        self.row = row
        self.size = len(row["ids"])
        width = len(row["first"]) - 1
        self.codes = np.frombuffer(row["codes"], np.uint16).reshape(width, self.size)
        self.books = books
        self.length = width // len(books.entries)
        self.exact = np.asarray(row["dictionary"], np.int64)
        # up to this bound the distances of whole vectors fit into 64 bits; larger values are counted in Python integers
        bound = math.isqrt(2**60 // width)
        small = np.abs(self.exact).max(initial=0) <= bound and all(abs(x) <= bound for p in books.entries for e in p for x in e)
        self.kind = np.int64 if small else object
        self.values = self.exact.astype(self.kind)

    def dictionary(self, dimension: int) -> slice:
        return slice(self.row["first"][dimension], self.row["first"][dimension + 1])

    def nearest(self, part: int) -> tuple[np.ndarray, np.ndarray]:
        """Entry (the first of equally near ones) and squared distance of every vector's part."""
        entries = np.array(self.books.entries[part], dtype=self.kind)
        distances = np.zeros((self.size, len(entries)), self.kind)
        for place in range(self.length):
            dimension = part * self.length + place
            table = (self.values[self.dictionary(dimension), None] - entries[None, :, place]) ** 2
            distances += table[self.codes[dimension]]
        best = distances.argmin(axis=1)
        return best, distances[np.arange(self.size), best]


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def _sums(batches: Iterator[pa.RecordBatch], books: Codebooks) -> Iterator[pa.RecordBatch]:
    """Count and component sums of the parts nearest to each entry, over all blocks of the task."""
    schema = pa.schema([("part", pa.int32()), ("entry", pa.int32()), ("place", pa.int32()), ("n", pa.int64()), ("total", pa.decimal128(38, 0))])
    counts: dict[tuple[int, int], int] = {}
    totals: dict[tuple[int, int, int], int] = {}
    for row in _rows(batches):
        block = _Block(row, books)
        for part, entries in enumerate(books.entries):
            best, _ = block.nearest(part)
            tally = np.bincount(best, minlength=len(entries))
            used = np.flatnonzero(tally)
            for entry in used.tolist():
                counts[part, entry] = counts.get((part, entry), 0) + int(tally[entry])
            for place in range(block.length):
                dimension = part * block.length + place
                added = np.zeros(len(entries), np.int64)
                # at most 2,048 integers of 41 bits: no overflow
                np.add.at(added, best, block.exact[block.dictionary(dimension)][block.codes[dimension]])
                for entry in used.tolist():
                    totals[part, entry, place] = totals.get((part, entry, place), 0) + int(added[entry])
    found = [{"part": p, "entry": e, "place": q, "n": counts[p, e], "total": Decimal(t)} for (p, e, q), t in totals.items()]
    if found:
        yield pa.RecordBatch.from_pylist(found, schema)


def _coded(batches: Iterator[pa.RecordBatch], books: Codebooks) -> Iterator[pa.RecordBatch]:
    for row in _rows(batches):
        block = _Block(row, books)
        codes = np.empty((block.size, len(books.entries)), np.uint8)
        error = np.zeros(block.size, block.kind)
        for part in range(len(books.entries)):
            best, distance = block.nearest(part)
            codes[:, part] = best
            error += distance
        text = codes.tobytes().hex()
        step = 2 * len(books.entries)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(row["ids"], pa.int64()),
                pa.array(row["labels"], pa.int64()),
                pa.array(row["labelled"], pa.bool_()),
                pa.array([text[i * step : (i + 1) * step] for i in range(block.size)], pa.string()),
                pa.array([Decimal(int(e)) for e in error.tolist()], pa.decimal128(38, 0)),
            ],
            names=["vec_id", "label", "has_label", "code", "error"],
        )


def _kept(vectors: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    v = F.col(vector).cast("array<double>")
    whole = F.coalesce(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))), F.lit(False))
    columns = [F.col(key).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"), v.alias("vector")]
    return vectors.where(whole & (F.size(v) > 0)).select(*columns)


def _start(kept: DataFrame, entries: int) -> list[list[float]]:
    """The vectors of the smallest ids, one an id: bounded by ``entries`` rows."""
    ids = [r.vec_id for r in kept.select("vec_id").distinct().orderBy(F.col("vec_id").asc_nulls_last()).limit(entries).collect()]
    chosen = F.col("vec_id").isin([i for i in ids if i is not None])
    if None in ids:
        chosen = chosen | F.col("vec_id").isNull()
    least = kept.where(chosen).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    return [r.vector for r in least.orderBy(F.col("vec_id").asc_nulls_last()).collect()]


def fit_codebooks(blocks: DataFrame, books: Codebooks, rounds: int) -> Codebooks:
    """Rounds of assignment and update; an entry to which no part is nearest stays."""
    for _ in range(rounds):
        found = blocks.mapInArrow(lambda batches, at=books: _sums(batches, at), _SUMS)
        merged = found.groupBy("part", "entry", "place").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
        entries = [[list(entry) for entry in part] for part in books.entries]
        # as many rows as the codebooks have numbers
        for r in merged.collect():
            entries[r.part][r.entry][r.place] = int(r.total) // r.n
        books = Codebooks(entries)
    return books


def compress(
    vectors: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
) -> DataFrame:
    """Code, squared error and codebook digest of every vector.

    Returns vec_id, code (two hex digits a part), error, label_error (error of all vectors of the label, NULL
    labels together) and codebooks_sha256. Left out are vectors that are NULL, empty or hold NULL or non-finite
    components, and vectors of another length than that of the smallest id. Codebooks start at the vectors of
    the smallest ids: of an id with several vectors at the smallest of them, a NULL id comes last; with fewer
    ids there are fewer entries. Repeated rows count as often as they occur. Integers beyond 2^40 are held at
    that bound, sums beyond a long at the largest long. An empty table gives no rows. Other columns are not read.
    A length that ``parts`` does not divide, or more than 256 entries, is an error.
    """
    if not 0 < entries <= 256:
        raise ValueError("entries must be 1 to 256")
    spark = vectors.sparkSession
    kept = _kept(vectors, key, vector, label)
    start = _start(kept, entries)
    width = len(start[0]) if start else parts
    if width % parts:
        raise ValueError(f"{parts} parts do not divide {width} components")
    length = width // parts
    same = [v for v in start if len(v) == width]
    if len(same) < len(start):
        kept = kept.where(F.size("vector") == width)
        same = _start(kept, entries)
    if not same:
        empty = "vec_id long, code string, error long, label_error long, codebooks_sha256 string"
        return spark.createDataFrame([], empty)
    whole = _integers(np.array(same, np.float64), scale).tolist()
    books = Codebooks([[v[p * length : (p + 1) * length] for v in whole] for p in range(parts)])
    blocks = land(kept.where(F.size("vector") == width).mapInArrow(lambda batches: _to_blocks(batches, width, scale), _BLOCKS), "blocks")
    books = fit_codebooks(blocks, books, rounds)
    coded = land(blocks.mapInArrow(lambda batches: _coded(batches, books), _CODED), "coded")
    largest = F.lit(_LONG).cast("decimal(38,0)")
    sums = coded.groupBy("has_label", "label").agg(F.sum("error").alias("_sum"))
    met = look_up(coded, sums, ["has_label", "label"], ["vec_id", "code"])
    return met.select(
        "vec_id",
        "code",
        F.least("error", largest).cast("long").alias("error"),
        F.least("_sum", largest).cast("long").alias("label_error"),
        F.lit(books.digest()).alias("codebooks_sha256"),
    )
