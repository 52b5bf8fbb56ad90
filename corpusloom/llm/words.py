"""Words and shingles of whole Arrow string columns as 64-bit hashes, computed on the column's bytes at once.

A word is a run of anything but the bytes 0x20 and 0x09-0x0D, with A-Z lower-cased. Those bytes never occur
inside a longer UTF-8 character, so working on bytes equals working on characters.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from types import ModuleType

import numpy as np
import pyarrow as pa

# Bytes of text handled at once, which bounds the working arrays of a task at some tens of megabytes.
# A single longer text is one piece of its own.
PIECE_BYTES = 1 << 21

SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
# everything in ASCII but letters and digits
NOT_ALNUM = tuple(b for b in range(128) if not chr(b).isalnum())
_BASE = np.uint64(0x9E3779B97F4A7C15)


def worker_state() -> dict:
    """What the tasks of one Python worker share. Task functions travel by value, so each task has module globals of its own."""
    return vars(sys.modules.setdefault("_corpusloom_worker", ModuleType("_corpusloom_worker"))).setdefault("kept", {})


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (splitmix64): every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _byte_codes() -> np.ndarray:
    """A pseudo-random 64-bit code for each byte; capital letters share the code of their small ones."""
    codes = mix(np.arange(1, 257, dtype=np.uint64) * _BASE)
    codes[65:91] = codes[97:123]
    return codes


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the (odd) base and of its inverse modulo 2**64, at least ``n`` of each."""
    kept = worker_state()
    if "up" not in kept or len(kept["up"]) < n:
        size = 1 << int(n - 1).bit_length() if n > 1 else 1
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        for name, base in (("up", _BASE), ("down", inverse)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            kept[name] = np.multiply.accumulate(steps)
    return kept["up"], kept["down"]


def pieces(texts: pa.Array, limit: int = PIECE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, its bytes, row offsets) of consecutive rows holding at most ``limit`` bytes, or one row."""
    texts = texts.cast(pa.large_string()).fill_null("")
    if not len(texts):
        return
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8)
    at = 0
    while at < len(texts):
        end = int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1
        end = min(max(end, at + 1), len(texts))
        yield at, data[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at]
        at = end


def word_hashes(
    data: np.ndarray, offsets: np.ndarray, between: tuple[int, ...] = SPACES
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, hash, start, end) of every word of a piece, in order; rows count from 0 within the piece.

    ``between`` are the bytes that separate words.
    """
    n = len(data)
    empty = np.empty(0, np.int64)
    if not n:
        return empty, empty.astype(np.uint64), empty, empty
    is_space = np.zeros(256, bool)
    is_space[list(between)] = True
    inside = ~is_space[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    border = offsets[:-1][offsets[:-1] < n]
    first[border] |= inside[border]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    last[border[border > 0] - 1] |= inside[border[border > 0] - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    up, down = _powers(n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_byte_codes()[data] * up[:n], out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    rows = np.searchsorted(offsets, starts, side="right") - 1
    return rows, hashes, starts, ends


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of the bytes of each span, capitals apart from small letters."""
    up, down = _powers(len(data))
    codes = mix(np.arange(1, 257, dtype=np.uint64) * _BASE)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(codes[data] * up[: len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def shingles(rows: np.ndarray, hashes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of every run of ``k`` words of a row; a row of fewer words gives its whole sequence once."""
    if not len(rows):
        return rows, hashes
    step = np.uint64(0xD6E8FEB86659FD93)
    long = max(len(rows) - k + 1, 0)
    run = np.full(long, np.uint64(k), np.uint64)
    for j in range(k):
        run = run * step + hashes[j : j + long]
    whole = rows[:long] == rows[k - 1 :][:long]
    at, values = rows[:long][whole], mix(run[whole])
    begins = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
    sizes = np.diff(np.r_[begins, len(rows)])
    short = np.flatnonzero(sizes < k)
    if len(short):
        extra = np.empty(len(short), np.uint64)
        for i, s in enumerate(short):
            value = int(sizes[s])
            for h in hashes[begins[s] : begins[s] + sizes[s]]:
                value = (value * int(step) + int(h)) & 0xFFFFFFFFFFFFFFFF
            extra[i] = value
        at, values = np.r_[at, rows[begins[short]]], np.r_[values, mix(extra)]
    return at, values


def distinct(rows: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, value) pairs, sorted by row and value."""
    order = np.lexsort((values, rows))
    rows, values = rows[order], values[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (values[1:] != values[:-1])
    return rows[new], values[new]


def shingle_sets(texts: pa.Array, k: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, number of rows, row, value) of each piece: the rows' distinct shingles, sorted."""
    for at, data, offsets in pieces(texts):
        rows, hashes, _, _ = word_hashes(data, offsets)
        rows, values = distinct(*shingles(rows, hashes, k))
        yield at, len(offsets) - 1, rows, values
