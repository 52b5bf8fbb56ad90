"""Readers on files with the awkward shapes, and sinks."""

from __future__ import annotations

import csv
import json
import random

import pytest
from pyspark.sql import functions as F

from corpusloom.session import scratch_dir
from corpusloom.sources import readers, writers

CSV = (
    "ALink,SName,SLink,Lyric,language,extra\n"
    '/a,"Say ""hi""",/x,"one\n\ntwo, three",en,1\n'
    "/b,None,/x,NA,fr,1\n"
    '/c,,/x,"",,1\n'
    "\n"
    '/d,Tail,/x,"a\r\nb \\ ""q""",en,1\n'
)


@pytest.mark.parametrize("splittable", [False, True])
def test_lyrics_csv(spark, tmp_path, splittable):
    path = tmp_path / "lyrics.csv"
    path.write_bytes(CSV.encode())
    rows = readers.read_lyrics_csv(spark, str(path), splittable=splittable).orderBy("ordinal").collect()
    assert [r.ordinal for r in rows] == sorted({r.ordinal for r in rows})
    assert [(i, *r[1:]) for i, r in enumerate(rows)] == [
        (0, 'Say "hi"', "one\n\ntwo, three", "en"),
        (1, "None", "NA", "fr"),
        (2, None, None, None),
        (3, "Tail", 'a\r\nb \\ "q"', "en"),
    ]
    head = readers.preview(readers.read_lyrics_csv(spark, str(path)), 2).collect()
    assert [r.ordinal for r in head] == [0, 1]


def test_ordinals_follow_file_names_not_sizes(spark, tmp_path):
    expected = []
    for name, n in (("a", 2), ("b", 900), ("c", 1), ("d", 40)):
        titles = [f"{name}{i}" for i in range(n)]
        expected += titles
        lines = ["h0,h1,h2,h3,h4", *[f'x,{t},y,"body\n{t}",en' for t in titles]]
        (tmp_path / f"{name}.csv").write_text("\n".join(lines) + "\n")
    rows = readers.read_lyrics_csv(spark, str(tmp_path)).orderBy("ordinal").collect()
    assert [r.title for r in rows] == expected
    assert [r.ordinal for r in rows] == list(range(len(expected)))


def test_csv_cut_inside_quoted_bodies_reads_like_one_task(spark, tmp_path):
    """Splits far smaller than a body, so that most begin inside quotes."""
    rng = random.Random(1)
    for name in ("a", "b"):
        with (tmp_path / f"{name}.csv").open("w", newline="") as out:
            table = csv.writer(out, lineterminator="\n")
            table.writerow(["h0", "h1", "h2", "h3", "h4"])
            for i in range(300):
                lines = ["".join(rng.choices('ab ,"你\r', k=rng.randint(0, 60))) for _ in range(rng.randint(1, 40))]
                table.writerow(["x", f'{name} "{i}"', "y", "\n".join(["b", *lines]), rng.choice(["en", "", "fr"])])
    whole = readers.read_lyrics_csv(spark, str(tmp_path)).orderBy("ordinal").collect()
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2048")
    try:
        cut = readers.read_lyrics_csv(spark, str(tmp_path), splittable=True)
        assert cut.inputFiles() and spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 50
        found = cut.orderBy("ordinal").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(found) == 600 and found == whole


def test_ordinals_over_many_splits_of_one_file(spark, tmp_path):
    path = tmp_path / "records.json"
    path.write_text("\n".join(json.dumps({"output": f"r{i}"}) for i in range(5000)) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        rows = readers.read_json_records(spark, str(path), lines=True)
        assert rows.rdd.getNumPartitions() > 5
        found = rows.orderBy("ordinal").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [(r.ordinal, r.output) for r in found] == [(i, f"r{i}") for i in range(5000)]


def test_json_records(spark, tmp_path):
    path = tmp_path / "news.json"
    path.write_text(json.dumps([{"output": "日月"}, {"output": None}, {"other": 1}, {"output": ""}]), encoding="utf-8")
    rows = readers.read_json_records(spark, str(path)).orderBy("ordinal").collect()
    assert [r.output for r in rows] == ["日月", None, None, ""]


def test_dialogs_json(spark, tmp_path):
    dialogs = [
        {"dialog_id": "0_1", "document_id": 3, "content": ["你好", "hi", "再见"]},
        {"dialog_id": "0_2", "document_id": 4, "content": []},
    ]
    path = tmp_path / "dialogs.json"
    path.write_text(json.dumps(dialogs, ensure_ascii=False, indent=1), encoding="utf-8")
    rows = {r.dialog_id: r for r in readers.read_dialogs_json(spark, str(path)).collect()}
    assert rows["0_1"].content == ["你好", "hi", "再见"] and rows["0_2"].content == []
    assert rows["0_1"].document_id == "3"


def test_id_list_is_stripped(spark, tmp_path):
    path = tmp_path / "ids.txt"
    path.write_text("\t0_1 \n\n　0_2 \n0_1\n")
    assert sorted(r.id for r in readers.read_id_list(spark, str(path)).collect()) == ["", "0_1", "0_1", "0_2"]


def test_text_tree(spark, tmp_path):
    root = tmp_path / "songs"
    files = {
        ("SNH48_1", "爱情 日记_3"): "一 二\r\n三\r四",
        ("a+b c", "x%20y+z"): "plain",
        ("林", "e"): "\n",
        ("林", "empty"): "",
        ("_hidden", "_u"): "under",
        (".dot", ".d"): "dot",
    }
    for (artist, song), text in files.items():
        (root / artist).mkdir(parents=True, exist_ok=True)
        (root / artist / f"{song}.txt").write_bytes(text.encode())
    (root / "stray.txt").write_text("skipped")
    rows = {(r.artist, r.song): r.text for r in readers.read_text_tree(spark, str(root)).collect()}
    assert rows == {**files, ("SNH48_1", "爱情 日记_3"): "一 二\n三\n四"}


def test_text_tree_round_trip(spark, tmp_path):
    rows = [("a", "_x", "one"), ("a", "y", None), ("日", "z", "two\n")]
    df = spark.createDataFrame(rows, "artist string, song string, text string")
    root = writers.write_text_tree(df, str(tmp_path / "tree"))
    found = sorted(tuple(r) for r in readers.read_text_tree(spark, root).collect())
    assert found == sorted((a, s, t or "") for a, s, t in rows)


def test_blank_lines_number_alike_on_both_paths(spark, tmp_path):
    path = tmp_path / "lyrics.csv"
    path.write_bytes(b'l,t,o,b,g\n\n1,one,x,"a\n\nb",en\n\n\n2,two,x,c,en\n\n3,three,x,"d\n",fr\n')
    found = [sorted(tuple(r) for r in readers.read_lyrics_csv(spark, str(path), splittable=x).collect()) for x in (False, True)]
    assert found[0] == found[1]
    assert found[0] == [(0, "one", "a\n\nb", "en"), (1, "two", "c", "en"), (2, "three", "d\n", "fr")]


def test_prompts(spark, tmp_path):
    path = tmp_path / "input.txt"
    path.write_bytes("第一 段\r\n\r\n第二".encode())
    assert [tuple(r) for r in readers.read_prompts(spark, str(path)).collect()] == [("input.txt", "第一 段\n\n第二")]
    inline = readers.read_prompts(spark, ["a", "b"]).orderBy("prompt").collect()
    assert [tuple(r) for r in inline] == [("0", "a"), ("1", "b")]


def test_examples_are_kept_by_split(spark, tmp_path):
    df = spark.createDataFrame([(1, [1, 2], "train"), (2, [3, 4], "test")], "id int, input_ids array<int>, split string")
    path = str(tmp_path / "examples")
    writers.write_examples(df, path)
    back = spark.read.parquet(path)
    assert sorted((r.id, r.input_ids, r.split) for r in back.collect()) == [(1, [1, 2], "train"), (2, [3, 4], "test")]
    assert (tmp_path / "examples" / "split=train").is_dir()
    with pytest.raises(Exception, match="(?i)exists"):
        writers.write_examples(df, path)


def test_landing_evens_out_partitions(spark, tmp_path):
    path = str(tmp_path / "landed")
    writers.write_table(spark.range(100).coalesce(1), path, partitions=4)
    assert spark.read.parquet(path).agg(F.sum("id")).first()[0] == 4950
    assert len(list((tmp_path / "landed").glob("*.parquet"))) == 4


def test_scratch_is_in_the_folder_the_session_names(spark):
    assert scratch_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert scratch_dir(spark, "x") != scratch_dir(spark, "x")
