"""Records cut in parallel against whole-file readers, with splits far smaller than a record."""

from __future__ import annotations

import csv
import io
import json
import random
from contextlib import contextmanager

import pytest

from corpusloom.sources.readers import read_dialogs_json, read_json_records, read_lyrics_csv

PARTS = ["a", "{", "}", "[", "]", '"', "\\", "\\\\", '\\"', ",", "\n", "中", "😀", ":", '{"output": "x"}', " "]


@contextmanager
def splits_of(spark, size):
    names = {"spark.sql.files.maxPartitionBytes": size, "spark.sql.files.openCostInBytes": 0, "spark.sql.files.minPartitionNum": 64}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name in names:
            spark.conf.unset(name)


def noise(draw, most=12):
    return "".join(draw.choice(PARTS) for _ in range(draw.randint(0, most)))


def item(draw, deep=0):
    record = {noise(draw, 2): noise(draw) for _ in range(draw.randint(0, 2))}
    if draw.random() < 0.8:
        record["output"] = draw.choice([noise(draw), noise(draw, 60), None])
    if deep < 3 and draw.random() < 0.5:
        record["more"] = [item(draw, deep + 1) for _ in range(draw.randint(0, 2))]
    return record


@pytest.mark.parametrize("size, indent", [(48, None), (300, 2), (1 << 20, 1)])
def test_json_arrays_of_any_nesting(spark, tmp_path, size, indent):
    draw, wanted = random.Random(size), []
    for name in "abc":
        records = [item(draw) for _ in range(draw.choice([0, 1, 6]))] if name != "b" else [item(draw) for _ in range(12)]
        text = json.dumps(records, ensure_ascii=draw.random() < 0.5, indent=indent)
        (tmp_path / f"{name}.json").write_text(text + draw.choice(["", "\n", "  \n\n"]), encoding="utf-8")
        wanted += [r.get("output") for r in records]
    (tmp_path / "d.json").write_text('{"other": {"output": 1}, "output": "alone"}')
    (tmp_path / "e.json").write_text(" [ ] ")
    wanted.append("alone")
    with splits_of(spark, size):
        found = read_json_records(spark, str(tmp_path), splittable=True).orderBy("ordinal").collect()
    assert [(r.ordinal, r.output) for r in found] == list(enumerate(wanted))


def test_dialogs_and_records_longer_than_splits(spark, tmp_path):
    rows = [{"dialog_id": str(i), "document_id": "d}", "content": ["x" * 300, '"{', "\\"] * (i % 3)} for i in range(8)]
    (tmp_path / "dialogs.json").write_text(json.dumps(rows))
    with splits_of(spark, 100):
        found = read_dialogs_json(spark, str(tmp_path), splittable=True).collect()
    assert sorted((r.dialog_id, r.document_id, r.content) for r in found) == sorted((r["dialog_id"], r["document_id"], r["content"]) for r in rows)


@pytest.mark.parametrize("size, end", [(32, "\n"), (200, "\r\n")])
def test_quoted_csv(spark, tmp_path, size, end):
    draw, wanted = random.Random(size), []
    for name in ("a.csv", "b c.csv", "d.csv"):
        out = io.StringIO()
        writer = csv.writer(out, lineterminator=end)
        writer.writerow(["x", "title\nof two lines", "y", "body", "lang"])
        rows = [["l", draw.choice(["t", 'a "b"', ""]), "o", noise(draw, 30).replace("\\", "") + draw.choice(["", "\n\n", '"\n"', ","]), "en"] for _ in range(draw.choice([1, 12]))]
        writer.writerows(rows)
        text = out.getvalue()
        (tmp_path / name).write_text(text if draw.random() < 0.5 else text[: -len(end)], encoding="utf-8", newline="")
        wanted += [(r[1] or None, r[3] or None, r[4]) for r in rows]
    with splits_of(spark, size):
        found = read_lyrics_csv(spark, str(tmp_path), splittable=True).orderBy("ordinal").collect()
    assert [r.ordinal for r in found] == list(range(len(wanted)))
    assert [(r.title, r.body, r.lang) for r in found] == wanted


def test_only_border_records_are_shuffled(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"output": f"text {i}"} for i in range(600)]))
    with splits_of(spark, 4_096):
        found = read_json_records(spark, str(tmp_path), splittable=True)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert found.count() == 600
    # the one exchange is the grouping of border pieces
    assert plan.count("Exchange hashpartitioning(ordinal") == 1 and plan.count("Exchange") == 1
