"""Vocabularies as tables, and the passes between token arrays and id arrays.

Encoding is one lookup per token of the corpus. A vocabulary of bounded size travels to the tasks once,
as an Arrow array, and whole batches are looked up with Arrow kernels: no row per token is ever
shuffled. Of a larger one the first words travel, the most frequent ones of a learned vocabulary; what is not among
them meets the rest of the table by a join, once per block of rows, and rows move as numbers only.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import fixed
from ..functions.tokens import attention_mask, pad_block, wrap_block
from ..session import land
from .lookup import places

# Largest vocabulary sent to every task: half a million words are some tens of megabytes.
BROADCAST_WORDS = 500_000
# Neighbouring rows that look their elements up together in a larger vocabulary: a block is closed at so many rows or elements,
# and only a longer row holds more. A worker keeps one block at a time.
BLOCK_ROWS = 1 << 11
BLOCK_WORDS = 1 << 21


@dataclass(frozen=True)
class Vocab:
    """A table ``(id int, token string)`` with dense ids from 0, its size, and the ids of its reserved tokens.

    ``words`` holds the tokens in id order when there are few enough to send to every task; of a larger vocabulary
    ``head`` holds the first ones, as many as may be sent.
    """

    table: DataFrame
    size: int
    reserved: dict[str, int] = field(default_factory=dict)
    words: pa.Array | None = None
    head: pa.Array = field(default_factory=lambda: pa.array([], pa.string()))

    @classmethod
    def from_table(
        cls, table: DataFrame, reserved: Sequence[str] = fixed.BASE_TOKENS, limit: int | None = None
    ) -> Vocab:
        """Use a supplied vocabulary table; what is beyond the first ``limit`` rows will be joined, not broadcast.

        Ids must run from 0 without gaps and no token may be NULL or stand there twice.
        """
        limit = BROADCAST_WORDS if limit is None else limit
        found = table.agg(
            F.count("*").alias("n"),
            F.count_distinct("id").alias("ids"),
            F.count_distinct("token").alias("tokens"),
            F.min("id").alias("low"),
            F.max("id").alias("high"),
        ).first()
        if found.n and (found.low, found.high, found.ids) != (0, found.n - 1, found.n):
            raise ValueError("vocabulary ids must run from 0 without gaps")
        if found.tokens != found.n:
            raise ValueError("vocabulary tokens must be present and differ")
        marks = table.where(F.col("token").isin(*reserved)).collect()
        ids = {row.token: row.id for row in marks}
        if found.n > limit:
            return cls(table, found.n, ids, head=_first_words(table, limit))
        return cls(table, found.n, ids, _first_words(table, found.n))

    @property
    def unknown(self) -> int:
        return self.reserved[fixed.UNK]

    @property
    def pad(self) -> int:
        """The padding id; a vocabulary without one pads with its end mark."""
        return self.reserved.get(fixed.PAD, self.reserved.get(fixed.SEP))

    @property
    def wrap(self) -> tuple[int, int]:
        return self.reserved[fixed.CLS], self.reserved[fixed.SEP]


def _first_words(table: DataFrame, n: int) -> pa.Array:
    """The tokens of ids below ``n``, in id order."""
    first = table.where(F.col("id") < n).select("id", "token").orderBy("id")
    return first.toArrow()["token"].cast(pa.string()).combine_chunks()


def token_counts(df: DataFrame, tokens: str = "tokens") -> DataFrame:
    """``token, n`` over the corpus; combined before the shuffle, so a hot token is one row per map task."""
    return df.select(F.explode(tokens).alias("token")).groupBy("token").agg(F.count("*").alias("n"))


def ranked(rows: DataFrame, *by: Column) -> DataFrame:
    """``rows`` with ``rank`` from 0 in the order ``by``, written once.

    Rows are dealt by ranges and sorted inside them. A row's rank is its place in its range plus the sizes of the
    ranges before, of which there are as many as tasks; no task sees more than its range.
    """
    sorted_rows = rows.repartitionByRange(*by).sortWithinPartitions(*by)
    placed = land(sorted_rows.withColumn("_at", F.monotonically_increasing_id()), "ranked")
    part, place = F.shiftright("_at", 33).alias("_part"), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy(part).agg(F.count("*").alias("_n"))
    starts = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    joined = placed.withColumn("_part", part).join(F.broadcast(starts), "_part")
    return joined.withColumn("rank", F.col("_start") + place).drop("_part", "_at", "_start")


def build_vocab(
    df: DataFrame,
    tokens: str = "tokens",
    size: int | None = None,
    base: Sequence[str] = fixed.BASE_TOKENS,
    added: Sequence[str] = fixed.SPEAKER_TOKENS,
) -> Vocab:
    """All tokens by falling frequency, ties by token, between ``base`` and ``added`` reserved tokens.

    ``size`` keeps that many of the most frequent tokens. The corpus is counted once: the ranked
    tokens are written, and every later use starts from there.
    """
    spark = df.sparkSession
    counts = token_counts(df, tokens).where(~F.col("token").isin(*base, *added))
    learned = ranked(counts, F.desc("n"), F.col("token"))
    if size is not None:
        learned = learned.where(F.col("rank") < size)
    found = learned.count()
    marks = [*enumerate(base), *enumerate(added, len(base) + found)]
    rows = spark.createDataFrame(marks, "id int, token string")
    table = rows.unionByName(learned.select((F.col("rank") + len(base)).cast("int").alias("id"), "token"))
    count, ids = found + len(marks), {token: i for i, token in marks}
    if count > BROADCAST_WORDS:
        return Vocab(table, count, ids, head=_first_words(table, BROADCAST_WORDS))
    return Vocab(table, count, ids, _first_words(table, count))


def _rebuild(lists: pa.Array, values: pa.Array) -> pa.Array:
    """Lists of the same lengths over new values; NULL lists stay NULL."""
    lengths = pc.fill_null(pc.list_value_length(lists), 0)
    ends = pc.cumulative_sum(lengths.cast(pa.int32()))
    offsets = pa.concat_arrays([pa.array([0], pa.int32()), ends])
    return pa.ListArray.from_arrays(offsets, values, mask=lists.is_null())


def encode_ids(df: DataFrame, vocab: Vocab, tokens: str = "tokens", out: str = "ids", keep: bool = True) -> DataFrame:
    """Replace tokens by ids; order and length are kept.

    A token outside the vocabulary and a NULL token become the id of ``[UNK]``, a NULL array stays NULL.
    Rows need no key, and repeated ones stay apart. Without ``keep`` the tokens are left out of the result, and so
    out of what a larger vocabulary writes and moves.
    """
    unknown = vocab.unknown
    if vocab.words is None:
        shared = df.sparkSession.sparkContext.broadcast({"words": vocab.head})

        def known(words: pa.Array) -> np.ndarray:
            return places(shared.value, words, -1)

        def fill(codes: pa.Array, found: pa.Table) -> pa.Array:
            flat = codes.flatten()
            asked = _answers(flat, found, pa.int32()).fill_null(unknown).to_numpy(zero_copy_only=False)
            code = pc.fill_null(flat, 0).to_numpy(zero_copy_only=False)
            ids = code.copy()
            ids[code < 0] = asked[-1 - code[code < 0]]
            return _rebuild(codes, pc.if_else(flat.is_valid(), pa.array(ids), pa.scalar(unknown, pa.int32())))

        rest = vocab.table.where(F.col("id") >= len(vocab.head)).select(F.col("token").alias("_word"), F.col("id").alias("_value"))
        return _replace_by_join(df, tokens, known, rest, fill, T.ArrayType(T.IntegerType()), out, keep)
    shared = df.sparkSession.sparkContext.broadcast({"words": vocab.words})

    @F.arrow_udf("array<int>")
    def lookup(lists: pa.Array) -> pa.Array:
        return _rebuild(lists, pa.array(places(shared.value, lists.flatten(), unknown)))

    return _without(df.withColumn(out, lookup(F.col(tokens))), tokens, out, keep)


def decode_ids(df: DataFrame, vocab: Vocab, ids: str = "ids", out: str = "decoded", keep: bool = True) -> DataFrame:
    """Replace ids by tokens joined with spaces; reserved tokens are kept.

    An id outside the vocabulary and a NULL id become ``[UNK]``, a NULL array stays NULL. Without ``keep`` the ids
    are left out of the result.
    """
    shared = df.sparkSession.sparkContext.broadcast(vocab.head if vocab.words is None else vocab.words)
    if vocab.words is None:
        size = len(vocab.head)

        def known(asked: pa.Array) -> np.ndarray:
            inside = pc.and_(pc.greater_equal(asked, 0), pc.less(asked, size))
            return pc.if_else(inside, asked, -1).cast(pa.int32()).to_numpy(zero_copy_only=False)

        def fill(codes: pa.Array, found: pa.Table) -> pa.Array:
            flat = codes.flatten()
            words = pa.concat_arrays([shared.value, _answers(flat, found, pa.string())])
            at = pc.if_else(pc.less(flat, 0), pc.subtract(size - 1, flat), flat)
            return pc.binary_join(_rebuild(codes, pc.fill_null(words.take(at), fixed.UNK)), " ")

        rest = vocab.table.where(F.col("id") >= size).select(F.col("id").alias("_word"), F.col("token").alias("_value"))
        return _replace_by_join(df, ids, known, rest, fill, T.StringType(), out, keep)

    @F.arrow_udf("string")
    def render(lists: pa.Array) -> pa.Array:
        flat = lists.flatten()
        inside = pc.fill_null(pc.and_(pc.greater_equal(flat, 0), pc.less(flat, len(shared.value))), False)
        words = shared.value.take(pc.if_else(inside, flat, None))
        return pc.binary_join(_rebuild(lists, pc.fill_null(words, fixed.UNK)), " ")

    return _without(df.withColumn(out, render(F.col(ids))), ids, out, keep)


def _without(df: DataFrame, source: str, out: str, keep: bool) -> DataFrame:
    return df if keep or source == out else df.drop(source)


def _answers(codes: pa.Array, found: pa.Table, kind: pa.DataType) -> pa.Array:
    """What each of a block's questions found, NULL for nothing; question ``k`` has the code ``-1 - k``."""
    asked = max(0, -(pc.min(codes).as_py() or 0))
    at = np.full(asked, -1, np.int64)
    at[found["_at"].to_numpy()] = np.arange(len(found))
    return found["_value"].combine_chunks().cast(kind).take(pa.array(at, mask=at < 0))


def _cut_blocks(batches: Iterator[pa.RecordBatch], source: str, rows: int, elements: int) -> Iterator[pa.Table]:
    """A task's rows in blocks: a block is closed by the row that brings it to ``rows`` rows or ``elements`` elements."""
    held, n, size = [], 0, 0
    for batch in batches:
        lengths = pc.fill_null(pc.list_value_length(batch.column(source)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends, begin = np.cumsum(lengths), 0
        while begin < len(lengths):
            before = ends[begin - 1] if begin else 0
            end = min(begin + rows - n, int(np.searchsorted(ends, before + elements - size)) + 1, len(lengths))
            held.append(batch.slice(begin, end - begin))
            n, size, begin = n + end - begin, size + int(ends[end - 1] - before), end
            if n >= rows or size >= elements:
                yield pa.Table.from_batches(held).combine_chunks()
                held, n, size = [], 0, 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _replace_by_join(
    df: DataFrame,
    source: str,
    known: Callable[[pa.Array], np.ndarray],
    rest: DataFrame,
    fill: Callable[[pa.Array, pa.Table], pa.Array],
    kind: T.DataType,
    out: str,
    keep: bool,
) -> DataFrame:
    """Array elements looked up in the tasks where ``known`` has a code for them, else by a join with ``rest``.

    Rows are cut into blocks of neighbours and written once, with a code for each element: what ``known`` gives, or -1 - k for
    the block's k-th distinct element without one. Those elements are written beside, in the block's first row, and meet ``rest``;
    what they find goes to the rows of the block. Rows move once and as codes, no row per element of the source does, and an
    element asks once a block, so a frequent one does not crowd the join.
    """
    kept = [c for c in df.columns if c != out and (keep or c != source)]
    element = df.schema[source].dataType.elementType
    codes = [T.StructField("_codes", T.ArrayType(T.IntegerType())), T.StructField("_words", T.ArrayType(element)), T.StructField("_block", T.LongType())]
    rows, elements = BLOCK_ROWS, BLOCK_WORDS

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for part in _cut_blocks(batches, source, rows, elements):
            lists = part[source].combine_chunks()
            coded = lists.flatten().dictionary_encode()
            code = known(coded.dictionary)
            missing = np.flatnonzero(code < 0)
            code = np.where(code < 0, 0, code).astype(np.int32)
            code[missing] = -1 - np.arange(len(missing), dtype=np.int32)
            asked = coded.dictionary.take(pa.array(missing))
            offsets = np.full(len(part) + 1, len(asked), np.int32)
            offsets[0] = 0
            words = pa.ListArray.from_arrays(pa.array(offsets), asked, mask=pa.array(np.arange(len(part)) > 0))
            flat = pa.array(code).take(coded.indices)
            added = {"_codes": _rebuild(lists, flat), "_words": words, "_block": pa.array(np.full(len(part), block))}
            done = part.select(kept)
            for name, column in added.items():
                done = done.append_column(name, column)
            yield from done.to_batches()
            block += 1

    written = land(df.mapInArrow(ask, T.StructType([*(df.schema[c] for c in kept), *codes])), "rows")
    asked = written.where("_words IS NOT NULL").select(F.col("_block").alias("_asker"), F.posexplode("_words").alias("_at", "_word"))
    given = asked.join(rest, "_word").select("_asker", "_at", "_value")

    def answer(key: tuple, part: pa.Table, found: pa.Table) -> pa.Table:
        return part.select(kept).append_column("_filled", fill(part["_codes"].combine_chunks(), found))

    moved = written.drop("_words").groupBy("_block")
    # fields as read back: anything in them may be NULL
    schema = T.StructType([*(written.schema[c] for c in kept), T.StructField("_filled", kind)])
    met = moved.cogroup(given.groupBy("_asker")).applyInArrow(answer, schema)
    filled = met.withColumnRenamed("_filled", out)
    return filled.select(*[c for c in df.columns if c == out or c in kept]) if out in df.columns else filled


def to_blocks(
    df: DataFrame,
    vocab: Vocab,
    tokens: str = "tokens",
    block: int = fixed.BLOCK,
    reserve: int = 0,
    wrap: bool = False,
    mask_padding: bool = False,
) -> DataFrame:
    """Token arrays to training examples of exactly ``block - reserve`` ids.

    Adds ``input_ids``, ``attention_mask``, ``n_tokens`` and ``labels``. Labels equal the padded ids;
    ``mask_padding`` sets them to -100 on the padding instead. Tokens past the block are cut before
    the lookup, so only what is kept is encoded.
    """
    length = block - reserve
    kept = length - 2 if wrap else length
    marks = vocab.wrap if wrap else None
    cut = df.withColumn("_kept", F.slice(tokens, 1, kept)).drop(tokens)
    body = wrap_block(F.col("_ids"), length, marks)
    used = F.col("n_tokens")
    pads = F.lit(length) - used
    labels = F.concat(body, F.array_repeat(F.lit(-100), pads)) if mask_padding else F.col("input_ids")
    return (
        encode_ids(cut, vocab, "_kept", "_ids", keep=False)
        .withColumn("n_tokens", F.size("_ids") + (2 if wrap else 0))
        .withColumn("input_ids", pad_block(body, length, vocab.pad))
        .withColumn("attention_mask", attention_mask(used, length))
        .withColumn("labels", labels)
        .drop("_ids")
    )


def truncation_report(
    df: DataFrame, n_tokens: str = "n_tokens", block: int = fixed.BLOCK, reserve: int = 0, wrap: bool = False
) -> DataFrame:
    """One row: records, records that :func:`to_blocks` would cut with the same sizes, their share, and tokens lost."""
    kept = block - reserve - (2 if wrap else 0)
    over = F.col(n_tokens) > kept
    return df.agg(
        F.count("*").alias("n_docs"),
        F.count_if(over).alias("n_over"),
        F.avg(over.cast("double")).alias("share_over"),
        F.coalesce(F.sum(F.greatest(F.col(n_tokens) - kept, F.lit(0)).cast("long")), F.lit(0)).alias("tokens_lost"),
    )
