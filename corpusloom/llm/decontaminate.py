"""Benchmark passages in documents: CGK embedding, bit-sampling LSH, exact edit distance.

Distance is edit distance over words (letters and digits, lower-cased; punctuation only separates; in scripts without spaces
between words each character is a word), and an item is found where a window of a document is at most ``EDITS`` of the item's
words away from it. An item of fewer than five words allows no edit: it is found where it stands word by word.

1. An item with ``e`` allowed edits is cut into ``e + 1`` runs of words. At least one run survives in every
   window within ``e`` edits, so places where a run occurs are the only ones that can hold the item: nothing is lost.
2. Every item-sized window that such a place allows (its start may be shifted by up to ``e`` words) is embedded
   by the CGK random walk: step ``j`` writes the current word and moves on or stays by a random bit of
   (``j``, word). Windows at a small edit distance walk together again after an edit, so most of the output is equal.
3. Each repetition has a walk of its own and samples ``BITS`` places of the output; a window and an item whose samples agree
   in any repetition are a candidate. The number of repetitions is measured on randomly edited copies of the items
   themselves, so that items at the full distance are found with probability ``RECALL``.
4. Candidates are confirmed by the exact edit distance of the item to the best-fitting part of the document there.

The benchmark is a stated query set: it is taken in blocks of at most ``BLOCK_BYTES`` of text, each met by all documents.
Documents are never shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import words

EDITS = 0.2  # share of an item's words that may be edited
MIN_WORDS = 1  # an item without any word cannot be searched
UNSPACED = r"([\p{Han}\p{Hiragana}\p{Katakana}\p{Bopomofo}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}])"
WIDE_MARKS = r"[\x{3000}-\x{3004}\x{3008}-\x{3020}\x{3030}\x{303D}\x{30FB}\x{FF01}-\x{FF0F}\x{FF1A}-\x{FF20}\x{FF3B}-\x{FF40}\x{FF5B}-\x{FF65}]"
BITS = 2  # places of the embedding that a repetition samples
RECALL = 0.999  # wanted probability of finding an item at the full distance
TRIALS = 8  # edited copies of each item by which the repetitions are measured
BLOCK_BYTES = 4 << 20  # benchmark text held by a task at once
WINDOW_WORDS = 1 << 21  # words of the windows embedded at once, and of the texts compared at once


@dataclass(frozen=True)
class Items:
    """A block of the benchmark as word hashes, with its anchors: runs of which one survives the allowed edits."""

    ids: np.ndarray
    texts: list[np.ndarray]
    anchors: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]  # length: (hash, item, offset), by hash
    repetitions: int

    @classmethod
    def of(cls, rows: list[tuple[int, str]]) -> Items:
        ids, texts = [], []
        for item, text in rows:
            found = [h for _, _, h in _words(pa.array([text], pa.string()))]
            found = np.concatenate(found) if found else np.empty(0, np.uint64)
            if len(found) >= MIN_WORDS:
                ids.append(item)
                texts.append(found)
        anchors: dict[int, list[tuple[int, int, int]]] = {}
        for i, text in enumerate(texts):
            n, pieces = len(text), allowed(len(text)) + 1
            q = n // pieces
            for offset in range(0, q * pieces, q):
                _, run = words.shingles(np.zeros(q, np.int64), text[offset : offset + q], q)
                anchors.setdefault(q, []).append((int(run[0]), i, offset))
        tables = {}
        for q, found in anchors.items():
            found.sort()
            tables[q] = (np.array([f[0] for f in found], np.uint64), *(np.array([f[x] for f in found], np.int64) for x in (1, 2)))
        return cls(np.array(ids, np.int64), texts, tables, _repetitions([t for t in texts if allowed(len(t))]))


def allowed(n: int) -> int:
    """Edits allowed in an item of ``n`` words."""
    return int(n * EDITS)


def _spaced(texts: pa.Array) -> pa.Array:
    """Large strings with spaces around each character of an unspaced script, and in place of its punctuation."""
    data = texts.buffers()[2]
    # all of them start with a byte from 0xE0
    if data is None or not (np.frombuffer(data, np.uint8) >= 0xE0).any():
        return texts
    return pc.replace_substring_regex(pc.replace_substring_regex(texts, WIDE_MARKS, " "), UNSPACED, r" \1 ")


def _words(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, row, hash) of the words of each piece of a column."""
    for at, data, offsets in words.pieces(_spaced(pc.utf8_lower(texts.cast(pa.large_string())))):
        rows, hashes, _, _ = words.word_hashes(data, offsets, words.NOT_ALNUM)
        yield at, rows, hashes


def embed(windows: np.ndarray, repetition: int, places: np.ndarray) -> np.ndarray:
    """Symbols at ``places`` of the CGK walks over windows (one a row); a finished walk writes zeros."""
    count, n = windows.shape
    padded = np.concatenate([windows, np.zeros((count, 1), np.uint64)], axis=1)
    at, here = np.zeros(count, np.int64), np.arange(count)
    out = np.zeros((count, len(places)), np.uint64)
    wanted = {int(p): i for i, p in enumerate(places)}
    for step in range(int(places.max()) + 1):
        symbol = padded[here, at]
        if step in wanted:
            out[:, wanted[step]] = symbol
        salt = np.uint64((repetition * 1_000_003 + step + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
        at = np.minimum(at + (words.mix(symbol ^ salt) & np.uint64(1)).astype(np.int64), n)
    return out


def _places(repetition: int, n: int) -> np.ndarray:
    """Sampled steps of a walk over ``n`` words; it takes about two steps a word."""
    rng = np.random.default_rng([9, repetition, n])
    return np.sort(rng.choice(2 * n, BITS, replace=False))


def _edited(text: np.ndarray, edits: int, rng: np.random.Generator) -> np.ndarray:
    """A copy cut to the item's length after random substitutions, insertions and deletions."""
    out = list(text)
    for _ in range(edits):
        at, kind = int(rng.integers(len(out))), int(rng.integers(3))
        if kind == 0:
            out[at] = np.uint64(rng.integers(1 << 62))
        elif kind == 1:
            out.insert(at, np.uint64(rng.integers(1 << 62)))
        elif len(out) > 1:
            del out[at]
    out = out[: len(text)] + [np.uint64(0)] * (len(text) - len(out))
    return np.array(out, np.uint64)


def _repetitions(texts: list[np.ndarray]) -> int:
    """Repetitions that find an item at its full distance with probability ``RECALL``."""
    if not texts:
        return 0
    rng = np.random.default_rng(90)
    by_length: dict[int, list[np.ndarray]] = {}
    for text in texts:
        by_length.setdefault(len(text), []).append(text)
    trials, agreed = 0, 0.0
    for n, group in by_length.items():
        group = group[:TRIALS]
        pairs = [(t, _edited(t, allowed(n), rng)) for t in group for _ in range(TRIALS)]
        one, two = np.stack([p[0] for p in pairs]), np.stack([p[1] for p in pairs])
        for repetition in range(8):
            places = _places(1_000 + repetition, n)
            same = (embed(one, 1_000 + repetition, places) == embed(two, 1_000 + repetition, places)).all(axis=1)
            agreed, trials = agreed + same.sum(), trials + len(same)
    rate = min(max(agreed / trials, 1 / trials), 0.999)
    return max(8, math.ceil(math.log(1 - RECALL) / math.log(1 - rate)))


def _fit(item: np.ndarray, regions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(edits, end) of the part of each region (one a row) that is nearest to the item."""
    width = regions.shape[1]
    steps = np.arange(width + 1)
    best = np.zeros((len(regions), width + 1), np.int64)
    for word in item:
        new = np.empty_like(best)
        new[:, 0] = best[:, 0] + 1
        new[:, 1:] = np.minimum(best[:, 1:] + 1, best[:, :-1] + (regions != word))
        best = np.minimum.accumulate(new - steps, axis=1) + steps
    end = best.argmin(axis=1)
    return best[np.arange(len(best)), end], end


def find(items: Items, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, item, edits): the items found in a column of texts, each once a row with its fewest edits."""
    found = [np.empty((0, 3), np.int64)]
    for at, rows, hashes in _words(texts):
        starts, item, own = [], [], []
        for q, (keys, which, offset) in items.anchors.items():
            count = len(rows) - q + 1
            if count <= 0:
                continue
            _, runs = words.shingles(np.zeros(len(rows), np.int64), hashes, q)
            lo, hi = np.searchsorted(keys, runs), np.searchsorted(keys, runs, side="right")
            places = np.flatnonzero((hi > lo) & (rows[:count] == rows[q - 1 :]))
            times = (hi - lo)[places]
            where = np.repeat(places, times)
            entry = np.repeat(lo[places] - np.r_[0, np.cumsum(times)[:-1]], times) + np.arange(times.sum())
            starts.append(where - offset[entry])
            item.append(which[entry])
            own.append(rows[where])
        if not starts:
            continue
        places = np.unique(np.stack([np.concatenate(x) for x in (item, own, starts)], axis=1), axis=0)
        for i in np.unique(places[:, 0]):
            _, own, starts = places[places[:, 0] == i].T
            if not allowed(len(items.texts[i])):  # its one run is the item
                own = np.unique(own)
                found.append(np.stack([own + at, np.full(len(own), i), np.zeros(len(own), np.int64)], axis=1))
                continue
            found.append(_confirm(items, int(i), starts, own, rows, hashes, at))
    table = np.concatenate(found)
    if not len(table):
        return table[:, 0], table[:, 1], table[:, 2]
    order = np.lexsort((table[:, 2], table[:, 1], table[:, 0]))
    table = table[order]
    first = np.r_[True, (table[1:, :2] != table[:-1, :2]).any(axis=1)]
    table = table[first]
    return table[:, 0], items.ids[table[:, 1]], table[:, 2]


def _confirm(
    items: Items, i: int, starts: np.ndarray, owner: np.ndarray, rows: np.ndarray, hashes: np.ndarray, at: int
) -> np.ndarray:
    """Rows (row, item, edits) of item ``i`` confirmed around the given starts, which belong to the rows ``owner``."""
    text = items.texts[i]
    n, e = len(text), allowed(len(text))
    before = np.searchsorted(rows, np.arange(rows[-1] + 2))  # first word of each row
    out = []
    # starts and shifts taken at once, so that the words of their windows stay within a bound however long the item is
    shifts = np.arange(-e, e + 1)
    held = max(1, min(len(shifts), WINDOW_WORDS // n))
    step = max(1, WINDOW_WORDS // (held * n))
    for s in range(0, len(starts), step):
        some, own = starts[s : s + step], owner[s : s + step]
        near = np.zeros(len(some), bool)
        for first in range(0, len(shifts), held):
            open_ = np.flatnonzero(~near)
            if not len(open_):
                break
            part = shifts[first : first + held]
            places = (some[open_, None] + part[None, :]).reshape(-1)[:, None] + np.arange(n)[None, :]
            whose = np.repeat(own[open_], len(part))
            inside = (places >= before[whose][:, None]) & (places < before[whose + 1][:, None])
            windows = np.where(inside, hashes[np.clip(places, 0, len(hashes) - 1)], np.uint64(0)).reshape(len(open_), len(part), n)
            # one agreeing window settles a start
            agreed = np.zeros(len(open_), bool)
            for repetition in range(items.repetitions):
                left = np.flatnonzero(~agreed)
                if not len(left):
                    break
                sample = _places(repetition, n)
                same = embed(windows[left].reshape(-1, n), repetition, sample) == embed(text[None, :], repetition, sample)
                agreed[left] = same.all(axis=1).reshape(len(left), -1).any(axis=1)
            near[open_[agreed]] = True
        kept = np.flatnonzero(near)
        if not len(kept):
            continue
        wide = max(1, WINDOW_WORDS // (n + 4 * e))
        for some_kept in (kept[k : k + wide] for k in range(0, len(kept), wide)):
            places = some[some_kept][:, None] + np.arange(-2 * e, n + 2 * e)[None, :]
            inside = (places >= before[own[some_kept]][:, None]) & (places < before[own[some_kept] + 1][:, None])
            edits, _ = _fit(text, np.where(inside, hashes[np.clip(places, 0, len(hashes) - 1)], np.uint64(0)))
            good = edits <= e
            out.append(np.stack([own[some_kept][good] + at, np.full(good.sum(), i), edits[good]], axis=1))
    return np.concatenate(out) if out else np.empty((0, 3), np.int64)


def blocks(benchmark: DataFrame, item_id: str = "item_id", text: str = "text") -> Iterator[Items]:
    """The benchmark in blocks of bounded size. NULL ids and NULL texts are no items."""
    rows = benchmark.select(F.col(item_id).cast("long").alias("item_id"), F.col(text).alias("text"))
    rows = rows.where("item_id IS NOT NULL AND text IS NOT NULL")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = math.ceil(size / BLOCK_BYTES)
    for part in range(parts):
        block = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part).orderBy("item_id", "text")
        items = Items.of([tuple(r) for r in block.collect()])
        if len(items.ids):
            yield items


def contamination(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, item_id, edits, item_words``: each item found in each document, with the fewest edits.

    NULL and empty texts hold no item; a NULL doc_id is reported as NULL; repeated rows are reported once each.
    Items of one to four words are found where they stand unedited; items without words are left out. An empty table on either side gives an empty result; other
    columns are not looked at, whatever their names.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    schema = "doc_id long, item_id long, edits long, item_words long"
    parts = [rows.mapInArrow(_report(items), schema) for items in blocks(benchmark)]
    if not parts:
        return docs.sparkSession.createDataFrame([], schema)
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found


def _report(items: Items):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        length = {int(i): len(t) for i, t in zip(items.ids, items.texts, strict=True)}
        for batch in batches:
            row, item, edits = find(items, batch.column(1))
            sizes = pa.array([length[int(i)] for i in item], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row)), pa.array(item), pa.array(edits), sizes],
                names=["doc_id", "item_id", "edits", "item_words"],
            )

    return run


def is_contaminated(items: Items, text: Column) -> Column:
    """True where a text holds any item of the block."""

    @F.arrow_udf("boolean")
    def flag(texts: pa.Array) -> pa.Array:
        out = np.zeros(len(texts), bool)
        out[find(items, texts)[0]] = True
        return pa.array(out)

    return flag(text)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without the rows whose text holds an item of the benchmark; all columns and other rows stay."""
    for items in blocks(benchmark):
        docs = docs.where(~is_contaminated(items, F.col(text)))
    return docs
