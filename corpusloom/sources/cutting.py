"""Records of quoted files cut in parallel: JSON arrays by braces, CSV by line ends.

A file is read as fragments that end at a separator (``}`` or a line end), by Spark's reader and in its splits.
Whether a separator ends a record depends on what stands before it: inside a string or not, and how deep. A
split does not know its beginning, but what it does to any beginning is a small function, one row per split:
for both states of the quotes, whether it flips them, how much deeper it goes, how low it gets and how often it
is there. The functions are composed in file order, as a scheduler holds splits anyway; then each split is read
again with its true beginning and cuts its records where it stands. Only records that cross a border of splits move.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import land

_QUOTE, _BACKSLASH, _OPEN = 34, 92, 123
_SUMMARY = "file string, at long, flips int, " + ", ".join(f"{n}{p} long" for p in (0, 1) for n in ("total", "low", "often"))
_CUT = "ordinal long, at long, whole boolean, text string"


@dataclass(frozen=True)
class Format:
    """What ends a fragment, whether depth and escapes count, and whether the first record of a file is its header."""

    separator: str
    nested: bool
    header: bool


JSON = Format("}", True, False)
CSV = Format("\n", False, True)


def _scan(values: pa.Array, form: Format) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each fragment: quotes that count, and opened braces behind an even and behind an odd number of quotes."""
    values = values.cast(pa.large_binary())
    offsets = np.frombuffer(values.buffers()[1], np.int64)[values.offset : values.offset + len(values) + 1]
    n = len(values)
    if not n or offsets[0] == offsets[-1]:
        return np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
    data = np.frombuffer(values.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    ends = offsets - offsets[0]
    quotes = np.flatnonzero(data == _QUOTE)
    if form.nested and len(quotes):
        slashes = np.flatnonzero(data == _BACKSLASH)
        if len(slashes):
            # a quote behind an odd run of backslashes is part of the text
            starts = np.r_[True, np.diff(slashes) != 1]
            run_start = slashes[np.flatnonzero(starts)][np.cumsum(starts) - 1]
            at = np.searchsorted(slashes, quotes) - 1
            touches = (at >= 0) & (slashes[np.maximum(at, 0)] == quotes - 1)
            length = np.where(touches, quotes - run_start[np.maximum(at, 0)], 0)
            quotes = quotes[length % 2 == 0]
    before = np.searchsorted(quotes, ends)
    counted = np.diff(before)
    if not form.nested:
        return counted, np.zeros(n, np.int64), np.zeros(n, np.int64)
    opened = np.flatnonzero(data == _OPEN)
    owner = np.searchsorted(ends, opened, side="right") - 1
    odd = (np.searchsorted(quotes, opened) - before[owner]) % 2 == 1
    return counted, np.bincount(owner[~odd], minlength=n), np.bincount(owner[odd], minlength=n)


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, int], int, int]]:
    """(file and split, first row, rows) of each run of rows from one split."""
    files, starts = batch.column(1).dictionary_encode().indices.to_numpy(), batch.column(2).to_numpy()
    new = np.flatnonzero(np.r_[True, (files[1:] != files[:-1]) | (starts[1:] != starts[:-1])]) if batch.num_rows else []
    for s, e in zip(new, [*new[1:], batch.num_rows]):
        yield (batch.column(1)[int(s)].as_py(), int(starts[s])), int(s), int(e - s)


class _Effect:
    """What a split does to a beginning outside (0) and inside (1) a string, but for the separator of its last fragment."""

    def __init__(self):
        self.parity = 0
        self.total, self.low, self.often = [0, 0], [1, 1], [0, 0]
        self.pending = False

    def add(self, values: pa.Array, form: Format) -> None:
        counted, even, odd = _scan(values, form)
        blank = None if form.nested else pc.is_in(values, pa.array(["", "\r"])).to_numpy(zero_copy_only=False)
        after = (self.parity + np.cumsum(counted)) % 2
        before = np.r_[self.parity, after[:-1]]
        for p in (0, 1):
            # outside under beginning p: the parity so far equals p
            opened = np.where(before == p, even, odd)
            ends = (after == p).astype(np.int64)
            if blank is not None:
                seen = (ends == 1) & ~(blank & (before == p))
                self.low[p], self.often[p] = 0, self.often[p] + int(seen.sum())
                continue
            if self.pending and self.parity == p:
                self._close(p)
            run = self.total[p] + np.cumsum(opened - ends)
            inner = run[:-1][ends[:-1] == 1]
            if len(inner):
                least = int(inner.min())
                if least < self.low[p] or not self.often[p]:
                    self.low[p], self.often[p] = least, 0
                if least == self.low[p]:
                    self.often[p] += int((inner == least).sum())
            self.total[p] = int(run[-1] + ends[-1])
        self.parity, self.pending = int(after[-1]), True

    def _close(self, p: int) -> None:
        self.total[p] -= 1
        if not self.often[p] or self.total[p] < self.low[p]:
            self.low[p], self.often[p] = self.total[p], 0
        self.often[p] += self.total[p] == self.low[p]


def _summaries(batches: Iterator[pa.RecordBatch], form: Format) -> Iterator[pa.RecordBatch]:
    found: dict[tuple[str, int], _Effect] = {}
    for batch in batches:
        for split, s, n in _runs(batch):
            found.setdefault(split, _Effect()).add(batch.column(0).slice(s, n), form)
    rows = [
        {"file": f, "at": a, "flips": e.parity, **{f"{n}{p}": getattr(e, n)[p] for p in (0, 1) for n in ("total", "low", "often")}}
        for (f, a), e in found.items()
    ]
    if rows:
        yield pa.RecordBatch.from_pylist(rows, _schema(_SUMMARY))


def _schema(ddl: str) -> pa.Schema:
    types = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_()}
    return pa.schema([(name, types[kind]) for name, kind in (c.split() for c in ddl.split(", "))])


def _beginnings(rows: list, form: Format) -> dict[tuple[str, int], tuple[int, int, int, bool]]:
    """(parity, depth, number of the next record in all files, last split of its file) of every split, by composing effects."""
    rows = sorted(rows, key=lambda r: (r.file, r.at))
    found, parity, depth, records = {}, 0, 0, 0
    for row, after in zip(rows, [*rows[1:], None]):
        last = after is None or after.file != row.file
        found[row.file, row.at] = (parity, depth, records, last)
        total, low, often = row[f"total{parity}"], row[f"low{parity}"], row[f"often{parity}"]
        ends_outside = (parity + row.flips) % 2 == 0
        if not form.nested:
            records += often
        else:
            deep = depth + total
            # a file's last fragment has a separator only if something is open
            if ends_outside and (not last or deep > 0):
                total, deep = total - 1, deep - 1
                if not often or total < low:
                    low, often = total, 0
                often += total == low
            if often and depth + low < 0:
                raise ValueError(f"{row.file} closes more than it opens")
            records += often if depth + low == 0 else 0
            depth = deep
        parity = (parity + row.flips) % 2
        if last:
            # an open quote at the end of a CSV file ends its record
            records += not form.nested and parity == 1
            parity, depth = 0, 0
    return found


def _cut(batches: Iterator[pa.RecordBatch], form: Format, begin: dict, headers: dict[str, tuple[int, int]]) -> Iterator[pa.RecordBatch]:
    schema = _schema(_CUT)
    split, held, open_, out = None, None, [], []
    parity = depth = number = 0
    here = last = False

    def record(text: str, whole: bool) -> None:
        file, at = split
        if form.header and number == headers[file][0]:
            return
        out.append((number - headers[file][1], at, whole, text))

    def take(value: str, quotes: int, even: int, odd: int, final: bool) -> None:
        nonlocal parity, depth, number, here
        outside = parity == 0
        if not form.nested and outside and value in ("", "\r") and not open_:
            return
        depth += even if outside else odd
        parity = (parity + quotes) % 2
        closed = parity == 0 and not (form.nested and final and depth <= 0)
        open_.append(value)
        if form.nested and closed:
            depth -= 1
        if closed and depth == 0 or (final and not form.nested):
            record(form.separator.join([*open_, ""]), here)
            open_.clear()
            number, here = number + 1, True

    def finish() -> None:
        nonlocal held
        if held is not None:
            take(*held, last)
        held = None
        if open_ and not last:
            record(form.separator.join([*open_, ""]), False)
        open_.clear()

    for batch in batches:
        for key, s, n in _runs(batch):
            if key != split:
                finish()
                split = key
                parity, depth, number, last = begin[key]
                here = parity == 0 and depth == 0
            values = batch.column(0).slice(s, n)
            for row in zip(values.to_pylist(), *(x.tolist() for x in _scan(values, form))):
                if held is not None:
                    take(*held, False)
                held = row
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema)
            out.clear()
    finish()
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema)


@contextmanager
def _fixed_splits(spark: SparkSession) -> Iterator[None]:
    """Both passes see the same splits, also where executors come and go in between."""
    name = "spark.sql.files.minPartitionNum"
    if spark.conf.get(name, None) is not None:
        yield
        return
    spark.conf.set(name, spark.sparkContext.defaultParallelism)
    try:
        yield
    finally:
        spark.conf.unset(name)


def cut_records(spark: SparkSession, path: str, form: Format) -> DataFrame:
    """``ordinal, text``: the records of all files by file name and place, without headers.

    The text of a JSON record ends with its brace and may begin with a comma, a bracket or spaces; that of a CSV
    record ends with a line end. What no record holds, a JSON file's last bracket, is left out.
    """
    fragments = spark.read.text(path, lineSep=form.separator).select(
        "value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_at")
    )
    with _fixed_splits(spark):
        # one row per input split
        begin = _beginnings(fragments.mapInArrow(lambda b: _summaries(b, form), _SUMMARY).collect(), form)
        headers = {}
        for (file, _), state in sorted(begin.items()):
            # the number of a file's header, and headers up to and with it
            headers.setdefault(file, (state[2], len(headers) + 1 if form.header else 0))
        cut = land(fragments.mapInArrow(lambda b: _cut(b, form, begin, headers), _CUT), "records")
    whole = cut.where("whole").select("ordinal", "text")
    parts = cut.where("NOT whole").groupBy("ordinal").agg(F.sort_array(F.collect_list(F.struct("at", "text"))).alias("parts"))
    return whole.unionByName(parts.select("ordinal", F.array_join("parts.text", "").alias("text")))
