"""Chat turns put back in order as they arrive, before any history is made of them.

A turn waits in its conversation's state until all turns before it are out or can no longer be waited for. The
output is append-only, one row a turn with its place: histories and prompts are made from it by the batch operators, so
no state ever holds a history. A conversation keeps its own clock, the latest event time seen in it less
a delay: a quiet conversation is not cut short by a busy one, and what comes too late is a row, not a loss.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions import fixed

OUTPUT = "conv_id long, session long, pos long, turn long, text string, is_late boolean"
# last turn that went out, place and session of the next one, latest event time, and the waiting turns
STATE = "last_turn long, pos long, session long, latest long, turns array<long>, times array<long>, texts array<string>"
_NEVER = -(1 << 62)


def _step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState, delay_us: int, idle_ms: int | None) -> Iterator[pd.DataFrame]:
    last, pos, session, latest, turns, times, texts = state.get if state.exists else (-1, 0, 0, _NEVER, [], [], [])
    waiting = {t: (at, text) for t, at, text in zip(turns, times, texts)}
    rows = []
    if not state.hasTimedOut:
        for frame in frames:
            # a batch's turns of one conversation, which the stream's own rate limit bounds
            for turn, at, text in zip(frame["turn"].tolist(), frame["at_us"].tolist(), frame["text"].tolist()):
                latest = max(latest, at)
                if turn <= last or turn in waiting:
                    rows.append((key[0], session, None, turn, text, True))
                else:
                    waiting[turn] = (at, text)
    for turn in sorted(waiting):
        at, text = waiting[turn]
        # nothing before it is missing, its time is over, or the conversation went quiet
        if turn != last + 1 and at > latest - delay_us and not state.hasTimedOut:
            break
        del waiting[turn]
        last = turn
        if text == fixed.EXIT_WORD:
            session, pos = session + 1, 0
            continue
        rows.append((key[0], session, pos, turn, text, False))
        pos += 1
    left = sorted(waiting)
    state.update((last, pos, session, latest, left, [waiting[t][0] for t in left], [waiting[t][1] for t in left]))
    if idle_ms is not None and left:
        state.setTimeoutDuration(idle_ms)
    if rows:
        yield pd.DataFrame(rows, columns=[c.split()[0] for c in OUTPUT.split(", ")]).astype({"pos": "Int64"})


def _keep_order(delay_us: int, idle_ms: int | None):
    """The state function; Spark passes it exactly three arguments."""

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        return _step(key, frames, state, delay_us, idle_ms)

    return step


def ordered_turns_stream(turns: DataFrame, delay_seconds: float, at: str = "at", idle_ms: int | None = None) -> DataFrame:
    """``conv_id, session, pos, turn, text, is_late`` from a stream of ``conv_id, turn, text`` and an event time.

    Turns of a conversation come out in the order of their numbers, whatever order they arrive in. A turn goes out when all
    numbers before it, from 0, are out, when its event time is ``delay_seconds`` behind the latest of its conversation, or, with
    ``idle_ms``, when nothing arrived for that long (processing time). A turn that arrives after a higher one went out, or a
    second time, is late: a row of its own without a place. The utterance ``exit`` has no row; it ends a
    session, and places start at 0 again. A NULL event time counts as the earliest; NULL turns and ids are left out.

    The state of a conversation is a few numbers and the turns that wait, not its history.
    """
    timeout = GroupStateTimeout.NoTimeout if idle_ms is None else GroupStateTimeout.ProcessingTimeTimeout
    time = F.coalesce(F.unix_micros(F.col(at).cast("timestamp")), F.lit(_NEVER)).alias("at_us")
    rows = turns.where("conv_id IS NOT NULL AND turn IS NOT NULL").select("conv_id", F.col("turn").cast("long").alias("turn"), time, "text")
    return rows.groupBy("conv_id").applyInPandasWithState(_keep_order(int(delay_seconds * 1e6), idle_ms), OUTPUT, STATE, "append", timeout)
