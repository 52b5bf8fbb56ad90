"""Shuffled batches, schedule and metric log."""

from __future__ import annotations

import hashlib
import math

import pytest

from corpusloom.operators import batches


@pytest.mark.parametrize(("n", "size", "digits"), [(103, 4, 3), (8, 4, 1), (3, 10, 2), (500, 7, 0)])
def test_every_epoch_covers_each_key_once(spark, n, size, digits):
    df = spark.range(n).withColumnRenamed("id", "doc_id")
    rows = batches.shuffle_batches(df, epochs=2, batch_size=size, seed=9, digits=digits).collect()
    assert len(rows) == 2 * n
    orders = []
    for epoch in range(2):
        mine = sorted((r.step, r.slot, r.doc_id) for r in rows if r.epoch == epoch)
        assert [(s, t) for s, t, _ in mine] == [(i // size, i % size) for i in range(n)]
        order = [d for _, _, d in mine]
        assert order == sorted(range(n), key=lambda d: hashlib.md5(f"9:{epoch}:{d}".encode()).hexdigest())
        orders.append(order)
    assert n < 5 or orders[0] != orders[1]


def test_schedule(spark):
    def manifest(n, epochs=1):
        return batches.shuffle_batches(spark.range(n).withColumnRenamed("id", "doc_id"), epochs=epochs, batch_size=4, seed=1)

    rows = batches.step_schedule(manifest(103, 2), lr=0.5, warmup=10).orderBy("step").collect()
    per, total = math.ceil(103 / 4), math.ceil(103 / 4) * 2
    assert len(rows) == total
    for r in rows:
        rate = r.step / 10 if r.step < 10 else (total - r.step) / (total - 10)
        assert r.lr == pytest.approx(0.5 * rate) and r.epoch == r.step // per
    short = batches.step_schedule(manifest(4), warmup=10).collect()
    assert [r.lr for r in short] == [0.0]
    assert batches.step_schedule(manifest(0)).count() == 0


def test_metric_log(spark, tmp_path):
    path = str(tmp_path / "log")
    schema = "run string, tag string, step long, value double"
    batches.append_metrics(spark.createDataFrame([("r", "loss", 2, 3.0), ("r", "loss", 0, 5.0)], schema), path)
    batches.append_metrics(spark.createDataFrame([("r", "loss", 1, 9.0), ("q", "loss", 0, 1.0)], schema), path)
    found = {r.run: r for r in batches.metric_summary(spark.read.parquet(path), "run").collect()}
    r = found["r"]
    assert (r.n, r.min, r.max, r.last) == (3, 3.0, 9.0, 3.0) and r.avg == pytest.approx(17 / 3)
