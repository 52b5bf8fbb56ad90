"""Conversation state over several micro-batches, restart, exit and late turns."""

from __future__ import annotations

import pytest

from corpusloom.operators.dialogs import chat_prompts
from corpusloom.streaming.chat import chat_history_stream

SCHEMA = "conv_id long, turn long, text string"


SETTINGS = {
    "spark.sql.shuffle.partitions": "2",
    # a processing-time timeout would ask for one empty batch after another and never come to an end
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}


@pytest.fixture
def run(spark, tmp_path):
    source = str(tmp_path / "in")
    before = {key: spark.conf.get(key) for key in SETTINGS}
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)

    def feed(rows):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(source)

    def drain(idle_ms=None):
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(source)
        running = (
            chat_history_stream(stream, idle_ms)
            .writeStream.format("parquet")
            .option("path", str(tmp_path / "out"))
            .option("checkpointLocation", str(tmp_path / "state"))
            .trigger(availableNow=True)
            .start()
        )
        assert running.awaitTermination(60)
        rows = spark.read.parquet(str(tmp_path / "out")).collect()
        return {(r.conv_id, r.turn): (r.out, r.n_late) for r in rows}

    yield feed, drain
    for key, value in before.items():
        spark.conf.set(key, value)


def test_stream_equals_batch_over_restarts(spark, run):
    feed, drain = run
    rows = [(c, t, f"c{c} t{t}") for c in range(6) for t in range(c + 2)]
    first = [r for r in rows if r[1] < 3]
    feed(list(reversed(first)))
    drain()
    feed([r for r in rows if r[1] in (3, 4)])
    feed([r for r in rows if r[1] > 4])
    found = drain()
    batch = chat_prompts(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {k: v[0] for k, v in found.items()} == {(r.conv_id, r.turn): r.out for r in batch}


def test_exit_clears_and_late_turns_are_counted(run):
    feed, drain = run
    feed([(1, 0, "a"), (1, 1, "b")])
    assert drain() == {(1, 0): ("[CLS][speaker1]a[SEP][speaker2]", 0)}
    feed([(1, 0, "late"), (1, 2, "c")])
    assert drain()[1, 2] == ("[CLS][speaker1]a[SEP][speaker2]b[SEP][speaker1]c[SEP][speaker2]", 1)
    feed([(1, 1, "only late")])
    assert drain()[1, 1] == (None, 2)
    feed([(1, 3, "exit"), (2, 0, "exit")])
    drain()
    feed([(1, 2, "before the exit")])
    assert drain()[1, 2] in ((None, 3), ("[CLS][speaker1]a[SEP][speaker2]b[SEP][speaker1]c[SEP][speaker2]", 1))
    feed([(1, 4, "new")])
    assert drain()[1, 4] == ("[CLS][speaker1]new[SEP][speaker2]", 3)


def test_idle_sessions_end(run):
    feed, drain = run
    feed([(1, 0, "a"), (1, 1, "b")])
    drain(idle_ms=1)
    feed([(2, 0, "x")])
    drain(idle_ms=1)
    feed([(1, 2, "c")])
    assert drain(idle_ms=1)[1, 2][0] == "[CLS][speaker1]c[SEP][speaker2]"
