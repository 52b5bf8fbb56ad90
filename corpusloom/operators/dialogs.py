"""Conversations kept one row per turn, and the strings and prompts made from them.

A conversation may be far longer than its neighbours, so turns are first gathered in chunks of a
fixed width of turn numbers: a chunk never holds more than ``width`` turns. Per-conversation steps then
work on one row per chunk. ``turn`` must be unique inside a conversation.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import fixed
from ..functions.dialog import tagged_turn
from ..functions.tokens import token_count
from ..session import land

WIDTH = 256


def _chunk_of(turn: str, width: int) -> Column:
    """The first turn number of the chunk a turn falls in."""
    return (F.col(turn) - F.pmod(F.col(turn), F.lit(width))).alias("chunk")


def _chunks(turns: DataFrame, conv: str, turn: str, text: str, role: str | None, width: int) -> DataFrame:
    """``conv, chunk, items``: the sorted turns of each chunk."""
    item = [F.col(turn).alias("turn"), F.col(text).alias("text")]
    if role is not None:
        item.append(F.col(role).alias("role"))
    items = F.sort_array(F.collect_list(F.struct(*item))).alias("items")
    return turns.groupBy(conv, _chunk_of(turn, width)).agg(items)


def _tagged_chunks(
    turns: DataFrame, conv: str, turn: str, text: str, role: str | None, width: int
) -> DataFrame:
    """:func:`_chunks` with ``start``, the position of the first turn, and the tagged ``pieces``.

    The turns are read once: positions are running sums of the gathered chunks' sizes.
    """
    before = Window.partitionBy(conv).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.size("items")).over(before), F.lit(0)).cast("int")
    pieces = F.transform(
        "items",
        lambda item, i: tagged_turn(item["text"], F.col("start") + i, None if role is None else item["role"]),
    )
    return _chunks(turns, conv, turn, text, role, width).withColumn("start", start).withColumn("pieces", pieces)


def turns_to_dialogs(
    turns: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    text: str = "text",
    width: int = WIDTH,
) -> DataFrame:
    """One row per conversation with its utterances as an ordered array ``content``."""
    part = F.struct("chunk", F.col("items.text").alias("texts"))
    return (
        _chunks(turns, conv, turn, text, None, width)
        .groupBy(conv)
        .agg(F.sort_array(F.collect_list(part)).alias("parts"))
        .select(conv, F.flatten("parts.texts").alias("content"))
    )


def dialogs_to_turns(dialogs: DataFrame, conv: str = "conv_id", content: str = "content") -> DataFrame:
    """One row per utterance with its position in the conversation.

    A dialogue without utterances has no row here: use the arrays where it must stay (see ``dialog_examples``).
    """
    return dialogs.select(conv, F.posexplode(content).alias("turn", "text")).withColumn(
        "turn", F.col("turn").cast("long")
    )


def dialog_strings(
    turns: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    text: str = "text",
    role: str | None = None,
    width: int = WIDTH,
    first_turns: int | None = None,
) -> DataFrame:
    """The training string of every conversation, as ``out``.

    Speakers alternate by position; give ``role`` to take them from that column instead. A caller that
    only needs the string of the ``first_turns`` turns says so, and later chunks never reach the
    conversation's row.
    """
    chunks = _tagged_chunks(turns, conv, turn, text, role, width)
    if first_turns is not None:
        left = F.lit(first_turns) - F.col("start")
        chunks = chunks.where(F.col("start") < first_turns).withColumn("pieces", F.slice("pieces", F.lit(1), left))
    part = F.struct("chunk", F.array_join("pieces", "").alias("piece"))
    return (
        chunks.groupBy(conv)
        .agg(F.sort_array(F.collect_list(part)).alias("parts"))
        .select(conv, F.concat(F.lit(fixed.CLS), F.array_join("parts.piece", "")).alias("out"))
    )


def chat_prompts(
    turns: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    text: str = "text",
    role: str | None = None,
    width: int = WIDTH,
) -> DataFrame:
    """For every user turn, the whole history so far and the tag that hands over to the bot.

    User turns are the even positions, or ``role = 'user'``. The text before a chunk is built once per
    chunk; the prompts, whose total length is quadratic in the conversation by definition, are then
    emitted by chunk, so one long conversation is spread over many tasks.
    """
    before = Window.partitionBy(conv).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    if role is None:
        asks = F.transform("items", lambda _, i: (F.col("start") + i) % 2 == 0)
    else:
        asks = F.transform("items", lambda item, _: item["role"] == "user")
    chunks = _tagged_chunks(turns, conv, turn, text, role, width).select(
        conv,
        "start",
        F.array_join(F.collect_list(F.array_join("pieces", "")).over(before), "").alias("history"),
        "pieces",
        F.col("items.turn").alias("turns"),
        asks.alias("asks"),
    )
    return emit_prompts(chunks, conv, turn)


def emit_prompts(chunks: DataFrame, conv: str, turn: str, *keep: str) -> DataFrame:
    """One prompt per asking turn of chunks ``conv, start, history, pieces, turns, asks``.

    ``history`` is the tagged text before the chunk; the three arrays run over its turns. A turn whose piece is
    NULL has no part in the history and a NULL prompt.
    """
    whole = F.concat(
        F.lit(fixed.CLS),
        "history",
        F.array_join(F.slice("pieces", F.lit(1), F.col("i") + 1), ""),
        F.lit(fixed.SPEAKER_2),
    )
    prompt = F.when(F.get("pieces", F.col("i")).isNotNull(), whole)
    # only asking turns reach the generator, which copies the history for each
    places = F.filter(F.sequence(F.lit(0), F.size("turns") - 1), lambda i: F.get("asks", i))
    return (
        chunks.where(F.size("turns") > 0)
        .repartition(conv, "start")
        .select(conv, "history", "pieces", "turns", *keep, F.explode(places).alias("i"))
        .select(conv, F.get("turns", F.col("i")).alias(turn), prompt.alias("out"), *keep)
    )


@F.arrow_udf(T.ArrayType(T.IntegerType()))
def _first_kept(sizes: pa.Array, budgets: pa.Array) -> pa.Array:
    """For each turn the first one of the longest run up to it whose sizes sum up to the budget; the turn itself at least."""
    flat = sizes.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    lengths = pc.list_value_length(sizes).to_numpy(zero_copy_only=False)
    begins = np.repeat(np.r_[0, np.cumsum(lengths)[:-1]].astype(np.int64), lengths)
    budget = np.repeat(budgets.to_numpy(zero_copy_only=False), lengths)
    upto = np.r_[0, np.cumsum(flat)]
    first = np.searchsorted(upto, upto[1:] - budget, side="left")
    first = np.minimum(np.maximum(first, begins), np.arange(len(flat))) - begins
    return pa.ListArray.from_arrays(np.r_[0, np.cumsum(lengths)].astype(np.int32), pa.array(first.astype(np.int32)))


def prompts_in_context(
    turns: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    text: str = "text",
    role: str | None = None,
    context: int = fixed.CONTEXT,
    new: int = fixed.NEW_TOKENS,
    width: int = WIDTH,
) -> DataFrame:
    """:func:`chat_prompts` with as many of the latest turns as leave room for ``new`` tokens in the context.

    Columns: conv, turn, ``out``, ``n_tokens`` and ``n_left_out``, the turns before the first kept one. A turn counts its tokens
    and two marks; the opening mark and the last tag count one each. The asking turn is kept whole, however long it is. NULL texts are
    empty. ``turn`` must be unique inside a conversation.

    A turn has at least two tokens, so a prompt reaches back over a bounded number of turns. Turns are dealt by
    position into blocks of at least that many, and a block is given the block before: no conversation is gathered, none
    is sorted by one task, and the output is linear in the turns.
    """
    budget = context - new - 2
    block = max(width, budget // 2)
    kept = [F.col(conv).alias("_conv"), F.col(turn).alias("_turn"), F.col(text).alias("_text"), token_count(F.coalesce(text, F.lit(""))).alias("_n")]
    rows = turns.select(*kept, F.lit(None).cast("string").alias("_role") if role is None else F.col(role).alias("_role"))
    item = F.struct(F.col("_turn").alias("turn"), F.col("_text").alias("text"), F.col("_role").alias("role"), F.col("_n").alias("n"))
    chunks = rows.groupBy("_conv", _chunk_of("_turn", width)).agg(F.sort_array(F.collect_list(item)).alias("_items"))
    chunks = land(chunks, "chunks")
    before = Window.partitionBy("_conv").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    # sizes only: the texts stay where they are
    start = F.coalesce(F.sum(F.size("_items")).over(before), F.lit(0)).alias("_start")
    starts = chunks.select(F.col("_conv").alias("_c"), F.col("chunk").alias("_k"), start)
    known = chunks.join(starts, F.col("_conv").eqNullSafe(F.col("_c")) & F.col("chunk").eqNullSafe(F.col("_k")))
    placed = known.select("_conv", "_start", F.posexplode("_items").alias("_i", "_item"))
    placed = placed.select("_conv", (F.col("_start") + F.col("_i")).alias("_pos"), "_item")
    own = F.floor(F.col("_pos") / block)
    last = F.col("_pos") % block >= block - budget // 2
    blocks = placed.select("_conv", "_pos", "_item", F.explode(F.when(last, F.array(own, own + 1)).otherwise(F.array(own))).alias("_block"))
    gathered = blocks.groupBy("_conv", "_block").agg(F.sort_array(F.collect_list(F.struct("_pos", "_item"))).alias("_turns"))
    position = lambda t: t["_pos"]
    pieces = F.transform("_turns", lambda t: tagged_turn(t["_item"]["text"], position(t), None if role is None else t["_item"]["role"]))
    sizes = F.transform("_turns", lambda t: t["_item"]["n"] + 2)
    asks = F.transform("_turns", lambda t: (position(t) % 2 == 0) if role is None else t["_item"]["role"] == "user")
    ready = gathered.select(
        "_conv", "_block", pieces.alias("_pieces"), sizes.alias("_sizes"), asks.alias("_asks"), _first_kept(sizes, F.lit(budget)).alias("_first"), "_turns"
    )
    at = F.col("_i")
    places = F.filter(
        F.sequence(F.lit(0), F.size("_turns") - 1), lambda i: F.get("_asks", i) & (F.floor(F.get("_turns", i)["_pos"] / block) == F.col("_block"))
    )
    asked = ready.select("*", F.explode(places).alias("_i"))
    first = F.get("_first", at)
    size = at - first + 1
    whole = F.concat(F.lit(fixed.CLS), F.array_join(F.slice("_pieces", first + 1, size), ""), F.lit(fixed.SPEAKER_2))
    tokens = F.aggregate(F.slice("_sizes", first + 1, size), F.lit(2), lambda a, n: a + n)
    return asked.select(
        F.col("_conv").alias(conv),
        F.get("_turns", at)["_item"]["turn"].alias(turn),
        whole.alias("out"),
        tokens.alias("n_tokens"),
        F.get("_turns", first)["_pos"].cast("long").alias("n_left_out"),
    )
