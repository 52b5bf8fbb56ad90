"""Trees of text files: names, packing, the data source and its stream."""

from __future__ import annotations

import os

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusloom.sources.names import escaped, unescaped
from corpusloom.sources.readers import read_text_tree
from corpusloom.sources.tree_source import OPEN_BYTES, load_text_tree, packed, stream_text_tree
from corpusloom.sources.writers import write_text_tree


@given(st.none() | st.text(st.characters(exclude_categories=["Cs"])), st.integers(1, 9))
def test_names_come_back(value, copy):
    name = escaped(value, copy)
    assert unescaped(name) == value and "/" not in name and name not in ("", ".", "..") and "\x00" not in name
    assert copy == 1 or name != escaped(value)


@pytest.mark.parametrize("read", [read_text_tree, load_text_tree])
def test_as_many_rows_read_as_written(spark, tmp_path, read):
    rows = [("a", "x", "1"), ("a", "x", "2"), ("a", "x", "2"), ("a", None, "3"), (None, "x", "4"), ("b/c", "d/e", "5"), ("b", "100%", "6"), ("", "", "7")]
    rows += [("..", ".", "8"), ("None", "None", "9"), ("%~", "%+2", "10"), ("_s", "中 文", "a\nb"), ("a", "x%+2", "11")]
    df = spark.createDataFrame([*rows, ("n", "null", None)], "artist string, song string, text string").repartition(3)
    found = read(spark, write_text_tree(df, str(tmp_path / "tree")), escaped=True)
    assert sorted(map(tuple, found.collect()), key=str) == sorted([*rows, ("n", "null", "")], key=str)


def test_files_are_packed_by_bytes():
    files = [(0, "a", f"{i:03}", size) for i, size in enumerate([10, 10, 5 * OPEN_BYTES, 10, 10])]
    assert [len(p.files) for p in packed(files, 3 * OPEN_BYTES)] == [2, 1, 2]
    assert packed([], 10) == []


def test_plain_trees(spark, tmp_path):
    (tmp_path / "t" / "50%25").mkdir(parents=True)
    (tmp_path / "t" / "stray.txt").write_text("no")
    (tmp_path / "t" / "50%25" / "a+b.txt").write_bytes(b"x\r\ny\rz")
    assert [tuple(r) for r in load_text_tree(spark, str(tmp_path / "t")).collect()] == [("50%25", "a+b", "x\ny\nz")]
    assert load_text_tree(spark, str(tmp_path / "t" / "50%25")).count() == 0


def test_a_stream_reads_each_file_once(spark, tmp_path):
    root = tmp_path / "in"
    out, state = str(tmp_path / "out"), str(tmp_path / "state")

    def arrive(folder, name, text, at):
        (root / folder).mkdir(parents=True, exist_ok=True)
        path = root / folder / f"{name}.txt"
        path.write_text(text)
        os.utime(path, ns=(at, at))

    def drain():
        stream = stream_text_tree(spark, str(root))
        query = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", state).trigger(availableNow=True).start()
        assert query.awaitTermination(120)
        return sorted(tuple(r) for r in spark.read.schema(stream.schema).parquet(out).collect())

    now = 1_700_000_000_000_000_000
    arrive("a", "one", "1", now)
    arrive("b", "two", "2", now + 1)
    first = [("a", "one", "1"), ("b", "two", "2")]
    assert drain() == first
    arrive("a", "three", "3", now + 1_000_000)
    arrive("c", "four", "4", now + 1_000_000)
    assert drain() == sorted([*first, ("a", "three", "3"), ("c", "four", "4")])
    assert drain() == sorted([*first, ("a", "three", "3"), ("c", "four", "4")])


def test_songs_are_read_by_many_tasks(spark, tmp_path):
    df = spark.range(40).selectExpr("'a' AS artist", "cast(id AS string) AS song", "'x' AS text")
    found = read_text_tree(spark, write_text_tree(df, str(tmp_path / "tree")))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = found.select("song", F.spark_partition_id().alias("part")).collect()
    assert len(rows) == 40 and (tasks == 1 or len({r.part for r in rows}) > 1)
