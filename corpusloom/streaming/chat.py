"""Conversation histories kept as stream state, one prompt out per user turn."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions import fixed
from ..operators.dialogs import WIDTH, emit_prompts

# up to WIDTH new turns of a conversation and the tagged text before them
CHUNK = {
    "conv_id": "long",
    "start": "long",
    "history": "string",
    "pieces": "array<string>",
    "turns": "array<long>",
    "asks": "array<boolean>",
    "n_late": "long",
}
OUTPUT = ", ".join(f"{name} {kind}" for name, kind in CHUNK.items())
# tagged text so far, its number of turns, the highest turn seen, late turns dropped
STATE = "history string, n_turns long, last_turn long, n_late long"
FRESH = ("", 0, -1, 0)


def _advance(
    key: tuple, frames: Iterator[pd.DataFrame], state: GroupState, idle_ms: int | None
) -> Iterator[pd.DataFrame]:
    """Append this batch's turns in order; yield them in chunks with the history before each."""
    if state.hasTimedOut:
        state.remove()
        return
    # the new turns of one conversation in one micro-batch, which the stream's own rate limit bounds
    turns = pd.concat(frames).sort_values("turn", kind="stable")
    history, n_turns, last, late = state.get if state.exists else FRESH
    pieces: list[str | None] = []
    numbers: list[int] = []
    asks: list[bool] = []

    def chunk() -> pd.DataFrame:
        row = [key[0], n_turns, history, pieces, numbers, asks, late]
        return pd.DataFrame([row], columns=list(CHUNK))

    for turn, text in zip(turns["turn"].tolist(), turns["text"].tolist()):
        said = sum(p is not None for p in pieces)
        ended = text == fixed.EXIT_WORD and turn > last
        if pieces and (ended or len(pieces) == WIDTH):
            yield chunk()
            history, n_turns, said = history + "".join(p for p in pieces if p is not None), n_turns + said, 0
            pieces, numbers, asks = [], [], []
        if turn <= last:
            # a row of its own without a prompt
            late += 1
            pieces.append(None)
            asks.append(True)
        elif ended:
            # the next session starts afresh, but never with a turn from before
            history, n_turns, last = "", 0, turn
            continue
        else:
            speaker = fixed.SPEAKER_TOKENS[(n_turns + said) % 2]
            asks.append((n_turns + said) % 2 == 0)
            pieces.append(speaker + (text or "") + fixed.SEP)
            last = turn
        numbers.append(turn)
    if pieces:
        yield chunk()
    said = [p for p in pieces if p is not None]
    state.update((history + "".join(said), n_turns + len(said), last, late))
    if idle_ms is not None:
        state.setTimeoutDuration(idle_ms)


def _keep_history(idle_ms: int | None):
    """The state function; Spark passes it exactly three arguments."""

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        return _advance(key, frames, state, idle_ms)

    return step


def chat_history_stream(turns: DataFrame, idle_ms: int | None = None) -> DataFrame:
    """``conv_id, turn, out, n_late, is_late`` from a stream of ``conv_id, turn, text``.

    Speakers alternate by position. The utterance ``exit`` ends the session and is not kept. A turn not
    higher than the last one seen, also in an ended session, is late: it takes no part in the history, and comes out as
    a row of its own with a NULL prompt. ``n_late`` counts the late turns of a conversation so far. With ``idle_ms`` a
    conversation without a turn for that long (processing time) ends and frees its state; without it, states stay.

    Python only keeps the state: it passes on the new turns and the history before them. The prompts,
    each of which repeats the whole history, are written out by Spark, spread by chunk.
    """
    timeout = GroupStateTimeout.NoTimeout if idle_ms is None else GroupStateTimeout.ProcessingTimeTimeout
    chunks = (
        turns.select("conv_id", "turn", "text")
        .groupBy("conv_id")
        .applyInPandasWithState(_keep_history(idle_ms), OUTPUT, STATE, "append", timeout)
    )
    return emit_prompts(chunks, "conv_id", "turn", "n_late").withColumn("is_late", F.col("out").isNull())
