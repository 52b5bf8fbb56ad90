"""A hidden Markov language model over words.

Words fall into ``SYMBOLS`` classes by hash. A chain of ``STATES`` hidden states emits a class for each word and one for the end of the text, and
a word has a probability within its class from its count. Training counts every word of all training texts, and runs Baum-Welch: each
task adds up expected transitions and emissions of its texts, Spark sums them, and the next pass starts from the sums. A bounded
sample only gives the first pass a start that differs between states. The score of a text is exact: the scaled
forward recursion over its classes plus its words' probabilities within them.

The chain's tables are bounded and travel with the tasks. Word counts are not bounded, so they are never sent whole: texts are dealt
into blocks, each block asks for the counts of its distinct words, and gets them by a join.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import land
from . import words

STATES = 8
SYMBOLS = 1 << 14
PASSES = 2  # Baum-Welch passes over all training texts
SAMPLE_TEXTS, SAMPLE_BYTES, SAMPLE_PASSES = 512, 1 << 16, 12  # of the start; longer texts are not in the sample
TRAIN_BYTES = 1 << 22  # text that a task reads at once
HELD = 1 << 18  # tokens whose state probabilities a task holds at once
BLOCK_BYTES = 1 << 24  # text of a block
ASK_BYTES = 1 << 20  # text that a task looks for distinct words at once
CELL = 256  # classes of one row of summed counts
END = np.uint64(0x5D0C0F7E11A9B3C7)  # stands for the end of a text


@dataclass(frozen=True)
class Chain:
    """Start, transition and emission probabilities."""

    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray  # class x state


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, hash, number of tokens of each row): the words of each row of a piece, then its end."""
    rows, hashes, _, _ = words.word_hashes(data, offsets)
    n = len(offsets) - 1
    counts = np.bincount(rows, minlength=n) + 1
    out = np.full(len(rows) + n, END, np.uint64)
    out[np.arange(len(rows)) + rows] = hashes
    return np.repeat(np.arange(n), counts), out, counts


def symbol(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - int(math.log2(SYMBOLS)))).astype(np.int64)


def _by_time(symbols: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Symbols of all texts by time, longest text first: (symbols, begin of each time, texts alive then, text order)."""
    order = np.argsort(-counts, kind="stable")
    alive = np.searchsorted(-counts[order], -np.arange(counts.max()), side="left")
    begins = np.r_[0, np.cumsum(alive)]
    first = np.r_[0, np.cumsum(counts)[:-1]]
    rank = np.empty(len(counts), np.int64)
    rank[order] = np.arange(len(counts))
    time = np.arange(len(symbols)) - np.repeat(first, counts)
    out = np.empty_like(symbols)
    out[begins[time] + np.repeat(rank, counts)] = symbols
    return out, begins, alive, order


def _run(chain: Chain, seen: np.ndarray, begins: np.ndarray, alive: np.ndarray, times: range, now: np.ndarray | None, keep: bool = False):
    """The recursion over some times, from the values ``now`` before them: (last values, log scales by text, kept values, kept scales)."""
    first = begins[times.start]
    values = np.empty((begins[times.stop] - first, STATES)) if keep else None
    scales = np.empty(begins[times.stop] - first) if keep else None
    total = np.zeros(alive[times.start])
    for t in times:
        n, b = alive[t], begins[t]
        now = (np.repeat(chain.start[None, :], n, axis=0) if t == 0 else now[:n] @ chain.move) * chain.emit[seen[b : b + n]]
        scale = now.sum(axis=1)
        now /= scale[:, None]
        total[:n] += np.log(scale)
        if keep:
            values[b - first : b - first + n], scales[b - first : b - first + n] = now, scale
    return now, total, values, scales


def forward(chain: Chain, symbols: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Natural log likelihood of each text."""
    seen, begins, alive, order = _by_time(symbols, counts)
    likely = np.empty(len(counts))
    likely[order] = _run(chain, seen, begins, alive, range(len(alive)), None)[1]
    return likely


def expected(chain: Chain, symbols: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Expected starts, transitions and emissions of some texts, and their log likelihood.

    Times are taken in stretches of about ``HELD`` tokens. The forward pass keeps the values before each stretch, and those
    inside it are computed again when the backward pass reaches it, so a long text needs no table of all its values.
    """
    seen, begins, alive, _ = _by_time(symbols, counts)
    cuts = np.unique(np.r_[0, np.searchsorted(begins[:-1], np.arange(HELD, begins[-1], HELD)), len(alive)]).tolist()
    stretches = [range(s, e) for s, e in zip(cuts[:-1], cuts[1:], strict=True) if s < e]
    before, likely = [None], 0.0
    for times in stretches[:-1]:
        now, total, _, _ = _run(chain, seen, begins, alive, times, before[-1])
        before.append(now)
        likely += total.sum()
    moves, emits = np.zeros((STATES, STATES)), np.zeros((SYMBOLS, STATES))
    after = np.ones((int(alive[-1]), STATES))
    for times, entry in zip(reversed(stretches), reversed(before), strict=True):
        _, total, state, scales = _run(chain, seen, begins, alive, times, entry, keep=True)
        likely += total.sum() if times is stretches[-1] else 0.0
        first = begins[times.start]
        for t in reversed(times):
            n, b = alive[t], begins[t]
            if len(after) < n:  # texts that end here
                after = np.concatenate([after, np.ones((n - len(after), STATES))])
            state[b - first : b - first + n] *= after
            if t:
                reach = chain.emit[seen[b : b + n]] * after / scales[b - first : b - first + n, None]
                earlier = entry[:n] if t == times.start else state[begins[t - 1] - first : begins[t - 1] - first + n]
                moves += earlier.T @ reach
                after = reach @ chain.move.T
        here = seen[first : begins[times.stop]]
        for s in range(STATES):
            emits[:, s] += np.bincount(here, state[:, s], SYMBOLS)
    return state[: alive[0]].sum(axis=0), moves * chain.move, emits, float(likely)


def _updated(starts: np.ndarray, moves: np.ndarray, emits: np.ndarray, within: float = 0.01) -> Chain:
    """Probabilities from counts; every cell gets a little, so that no text has probability zero."""
    emits = emits + within
    moves, starts = moves + within, starts + within
    return Chain(starts / starts.sum(), moves / moves.sum(axis=1, keepdims=True), emits / emits.sum(axis=0))


def _first_chain() -> Chain:
    rng = np.random.default_rng(7)
    return _updated(np.ones(STATES), np.ones((STATES, STATES)) + 4 * np.eye(STATES), rng.gamma(2.0, size=(SYMBOLS, STATES)))


def _sequences(batch: pa.Array, limit: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, hashes, tokens of each row) of each piece."""
    for at, data, offsets in words.pieces(batch, limit):
        _, hashes, counts = tokens(data, offsets)
        yield at, hashes, counts


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, hashes, _ in _sequences(batch.column(0), TRAIN_BYTES):
            values, count = np.unique(hashes, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(count)], names=["token", "c"])


def _expect(chain: Chain):
    """Task function: texts to the task's summed counts, cut into cells of one row each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heads, emits = np.zeros(STATES * (STATES + 1) + 1), np.zeros((SYMBOLS, STATES))
        for batch in batches:
            for _, hashes, counts in _sequences(batch.column(0), TRAIN_BYTES):
                starts, moves, new, likely = expected(chain, symbol(hashes), counts)
                heads += np.r_[starts, moves.reshape(-1), likely]
                emits += new
        if heads[0]:
            cells = [heads.tobytes(), *[emits[i : i + CELL].tobytes() for i in range(0, SYMBOLS, CELL)]]
            yield pa.RecordBatch.from_arrays([pa.array(range(-1, len(cells) - 1), pa.int32()), pa.array(cells, pa.binary())], names=["cell", "sums"])

    return run


def _add(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = 0
    for batch in batches:
        for sums in batch.column("sums").to_pylist():
            total = total + np.frombuffer(sums)
    yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["cell", "sums"])


def fit_chain(texts: DataFrame, text: str = "text") -> Chain:
    """The chain learnt from all texts; without texts it says nothing about them."""
    count = texts.count()
    chain = _first_chain()
    if not count:
        return chain
    share = int(min(1.0, 2 * SAMPLE_TEXTS / count) * (1 << 30))
    mark = F.xxhash64(text, F.lit(7))
    some = texts.where((F.pmod(mark, F.lit(1 << 30)) <= share) & (F.octet_length(text) <= SAMPLE_BYTES))
    some = some.select(F.col(text).alias("text")).orderBy(mark, text).limit(SAMPLE_TEXTS)
    start = [s for s in _sequences(some.toArrow()["text"].combine_chunks(), 1 << 30)]
    for _ in range(SAMPLE_PASSES if start else 0):
        chain = _updated(*expected(chain, symbol(start[0][1]), start[0][2])[:3])
    for _ in range(PASSES):
        parts = texts.select(text).mapInArrow(_expect(chain), "cell int, sums binary")
        cells = parts.groupBy("cell").applyInArrow(_add, "cell int, sums binary").orderBy("cell").collect()
        heads, emits = np.frombuffer(cells[0]["sums"]), np.concatenate([np.frombuffer(c["sums"]) for c in cells[1:]])
        chain = _updated(heads[:STATES], heads[STATES:-1].reshape(STATES, STATES), emits.reshape(SYMBOLS, STATES))
    return chain


def _ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``block, token``: the distinct words of each block's part of a batch, from rows sorted by block.

    Texts are hashed in small pieces, since the working arrays are many times the text; a part still asks once.
    """
    for batch in batches:
        blocks, texts = batch.column("block").to_numpy(), batch.column("text")
        begins = np.flatnonzero(np.r_[True, blocks[1:] != blocks[:-1]]) if len(blocks) else []
        for s, e in zip(begins, np.r_[begins[1:], len(blocks)].astype(int), strict=True):
            found = [np.unique(hashes) for _, hashes, _ in _sequences(texts.slice(s, e - s), ASK_BYTES)]
            if found:
                values = np.unique(np.concatenate(found))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(values), blocks[s])), pa.array(values.view(np.int64))], names=["block", "token"])


def _score(chain: Chain, sums: np.ndarray, kinds: np.ndarray):
    """Task function: a block's texts and the counts of its words to scores."""
    n_all, v_all = int(sums.sum()), int(kinds.sum())

    def run(texts: pa.Table, counts: pa.Table) -> pa.Table:
        known, c = counts["token"].to_numpy().view(np.uint64), counts["c"].to_numpy()
        order = np.argsort(known)
        known, c = known[order], c[order]
        out = []
        for at, hashes, lengths in _sequences(texts["text"].combine_chunks(), TRAIN_BYTES):
            place = np.minimum(np.searchsorted(known, hashes), max(len(known) - 1, 0))
            seen = np.where(known[place] == hashes, c[place], 0) if len(known) else np.zeros(len(hashes), np.int64)
            kind = symbol(hashes)
            inside = np.log10((seen + 0.5) / (sums[kind] + 0.5 * (kinds[kind] + 1)))
            plain = np.log10((seen + 0.5) / (n_all + 0.5 * (v_all + 1)))
            begins = np.r_[0, np.cumsum(lengths)[:-1]]
            chained = forward(chain, kind, lengths) / math.log(10)
            part = texts.slice(at, len(lengths))
            out.append(pa.table({
                "doc_id": part["doc_id"], "held_out": part["held_out"], "n_tokens": lengths,
                "n_known": np.add.reduceat((seen > 0).astype(np.int64), begins), "train_tokens": np.full(len(lengths), n_all, np.int64),
                "base_score": np.add.reduceat(plain, begins), "score": chained + np.add.reduceat(inside, begins),
            }))
        return pa.concat_tables(out).combine_chunks()

    return run


SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def score_texts(docs: DataFrame, held_out: Column, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Scores of all texts by a model of those that ``held_out`` does not mark; one row for each row of ``docs``.

    ``base_score`` is the smoothed word-count model's, ``score`` the chain's, both log10 of the whole text with its end. A NULL text is
    empty: its one token is the end. A NULL mark counts as training. NULL ids and repeated rows are scored like others. An
    empty table gives an empty result; with nothing to learn from all words are unknown. Other columns are not looked at.
    """
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"), F.coalesce(held_out, F.lit(False)).alias("held_out")
    )
    training = rows.where("NOT held_out").select("text")
    counted = training.mapInArrow(_count_words, "token long, c long").groupBy("token").agg(F.sum("c").alias("c"))
    counts = land(counted, "words")
    shift = 64 - int(math.log2(SYMBOLS))
    kinds, sums = np.zeros(SYMBOLS), np.zeros(SYMBOLS)
    for r in counts.groupBy(F.shiftrightunsigned("token", shift).alias("s")).agg(F.count("*").alias("v"), F.sum("c").alias("n")).collect():
        kinds[r["s"]], sums[r["s"]] = r["v"], r["n"]
    chain = fit_chain(training)
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(size / BLOCK_BYTES))
    # a repeated row may be hot: its place in the scan spreads it
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("doc_id", F.monotonically_increasing_id()), F.lit(blocks))).repartition("block")
    # all columns go through, so that both readers of the dealt texts share one exchange; a block may ask twice
    asked = dealt.sortWithinPartitions("block").mapInArrow(_ask, "block long, token long")
    given = asked.join(counts, "token").select("block", "token", "c")
    return dealt.groupBy("block").cogroup(given.groupBy("block")).applyInArrow(_score(chain, sums, kinds), SCORES)
