"""Turns put in order by the stream: shuffled, late, repeated, quiet and restarted."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from corpusloom.operators.dialogs import chat_prompts
from corpusloom.streaming.ordered import ordered_turns_stream

SCHEMA = "conv_id long, turn long, text string, at timestamp"


@pytest.fixture
def run(spark, tmp_path):
    source = str(tmp_path / "in")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")

    def feed(rows):
        df = spark.createDataFrame([(c, t, x, s) for c, t, x, s in rows], "conv_id long, turn long, text string, s long")
        df.withColumn("at", F.timestamp_seconds("s")).drop("s").coalesce(1).write.mode("append").parquet(source)

    def drain(delay):
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(source)
        writer = ordered_turns_stream(stream, delay).writeStream.format("parquet").option("path", str(tmp_path / "out"))
        query = writer.option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
        assert query.awaitTermination(120)
        return spark.read.parquet(str(tmp_path / "out"))

    yield feed, drain
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_shuffled_arrivals_give_the_batch_answer(spark, run):
    feed, drain = run
    rows = [(c, t, f"c{c} t{t}", 60 * t) for c in range(5) for t in range(3 * c + 1)]
    random.Random(1).shuffle(rows)
    for i in range(0, len(rows), 12):
        feed(rows[i : i + 12])
        if i == 12:
            drain(10**6)
    found = drain(10**6)
    assert found.where("is_late").count() == 0
    batch = chat_prompts(spark.createDataFrame([r[:3] for r in rows], "conv_id long, turn long, text string"))
    prompts = chat_prompts(found, turn="pos").select("conv_id", "pos", "out")
    assert sorted(map(tuple, prompts.collect())) == sorted(map(tuple, batch.select("conv_id", "turn", "out").collect()))


def test_late_repeated_and_missing_turns(run):
    feed, drain = run
    feed([(1, 0, "a", 0), (1, 2, "c", 20), (1, 2, "again", 20)])
    assert sorted((r.pos, r.turn, r.is_late) for r in drain(30).collect() if not r.is_late) == [(0, 0, False)]
    # turn 2 waits for turn 1 until the conversation's clock passes it; another conversation's clock does not matter
    feed([(2, 0, "x", 10_000), (1, 3, "d", 40)])
    assert {(r.conv_id, r.turn) for r in drain(30).collect() if not r.is_late} == {(1, 0), (2, 0)}
    feed([(1, 5, "f", 55)])
    feed([(1, 1, "b", 10), (1, 4, "exit", 45), (1, 6, "g", 60)])
    found = {(r.conv_id, r.turn, r.text): (r.session, r.pos, r.is_late) for r in drain(30).collect()}
    assert found == {
        (1, 0, "a"): (0, 0, False),
        (1, 2, "again"): (0, None, True),
        (1, 2, "c"): (0, 1, False),
        (1, 3, "d"): (0, 2, False),
        (2, 0, "x"): (0, 0, False),
        (1, 1, "b"): (0, None, True),
        (1, 5, "f"): (1, 0, False),
        (1, 6, "g"): (1, 1, False),
    }


def test_null_texts_times_and_numbers(run):
    feed, drain = run
    feed([(1, 0, None, None), (1, None, "x", 5), (None, 0, "x", 5), (1, 1, "", 7)])
    assert sorted((r.pos, r.turn, r.text) for r in drain(0).collect()) == [(0, 0, None), (1, 1, "")]
