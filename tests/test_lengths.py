"""Length sketches against exact quantiles, and a metric ledger with replayed batches."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from corpusloom.operators.batches import metric_summary
from corpusloom.operators.lengths import block_for, length_sketch, merge_sketches, sketch_quantiles
from corpusloom.streaming.metrics import compact, merged_summary, read_summary, summarise_stream, write_batch


@pytest.mark.parametrize("error", [0.01, 0.2])
def test_quantiles_are_within_the_error_and_merge(spark, error):
    draw = random.Random(7)
    rows = [(draw.choice("ab"), d, draw.choice([0, 1, 2, int(draw.lognormvariate(5, 2)), None])) for d in range(4) for _ in range(400)]
    df = spark.createDataFrame(rows, "source string, day int, n_tokens int")
    stored = length_sketch(df, "source", "day", error=error)
    merged, at_once = merge_sketches(stored, "source"), length_sketch(df, "source", error=error)
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, at_once.collect()))
    shares = [0.0, 0.25, 0.5, 0.9, 0.99, 1.0]
    found = {(r.source, r.share): r.length for r in sketch_quantiles(merged, shares, "source", error=error).collect()}
    for source in "ab":
        exact = sorted(n for s, _, n in rows if s == source and n is not None)
        for share in shares:
            at = exact[max(math.ceil(share * len(exact) - 1e-9), 1) - 1]
            assert abs(found[source, share] - at) <= error * at * (1 + 1e-9)
        whole = {r.source: r.block for r in block_for(merged, 0.9, "source", error=error).collect()}[source]
        assert sum(n <= whole * (1 + 2 * error) for n in exact) >= 0.9 * len(exact)
    assert length_sketch(df.where("false"), "source").count() == 0


def test_a_replayed_batch_adds_nothing(spark, tmp_path):
    draw = random.Random(2)
    rows = [(draw.choice("xy"), step // 50, step, draw.choice([None, draw.random()])) for step in range(200)]
    log = spark.createDataFrame(rows, "tag string, epoch int, step long, value double")
    source, ledger = str(tmp_path / "log"), str(tmp_path / "ledger")
    log.repartition(3, "step").write.parquet(source)
    stream = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 1).parquet(source)
    assert summarise_stream(stream, ledger, str(tmp_path / "state"), "tag", "epoch", availableNow=True).awaitTermination(120)

    def rounded(df):
        columns = ["tag", "epoch", "n", F.round("avg", 9), "min", "max", "last"]
        return sorted(map(tuple, df.select(*columns).collect()))

    last = log.where("value IS NOT NULL")
    wanted = rounded(metric_summary(last, "tag", "epoch"))
    found = rounded(read_summary(spark, ledger, "tag", "epoch"))
    assert [r for r in found if r[2]] == wanted
    # the same batch again, as after a failure between its write and its commit
    file = sorted(p for p in (tmp_path / "log").iterdir() if p.suffix == ".parquet")[0]
    step = write_batch(str(tmp_path / "again"), "tag", "epoch")
    for _ in range(2):
        step(spark.read.schema(log.schema).parquet(str(file)), 0)
    once = metric_summary(spark.read.parquet(str(file)).where("value IS NOT NULL"), "tag", "epoch")
    assert [r for r in rounded(read_summary(spark, str(tmp_path / "again"), "tag", "epoch")) if r[2]] == rounded(once)
    compact(spark, ledger, str(tmp_path / "small"), "tag", "epoch")
    assert rounded(read_summary(spark, str(tmp_path / "small"), "tag", "epoch")) == found
    assert merged_summary(spark.read.parquet(ledger).where("false"), "tag").count() == 0
