"""Golden values of the text projections."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import text as tx


def column(spark, values, expression, schema="t string"):
    """Values of an expression over one column of inputs, in order."""
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, {schema}")
    return [r.x for r in rows.select("i", expression.alias("x")).orderBy("i").collect()]


def test_title_prompt_separators_and_missing_values(spark):
    df = spark.createDataFrame([(0, "Song", "a\nb"), (1, None, "x"), (2, "None", None)], "i int, t string, b string")
    two = [r.x for r in df.orderBy("i").select(tx.title_prompt(F.col("t"), F.col("b")).alias("x")).collect()]
    one = [r.x for r in df.orderBy("i").select(tx.title_prompt(F.col("t"), F.col("b"), "\n").alias("x")).collect()]
    assert two == [
        'The lyrics of "Song":\n\na\nb',
        'The lyrics of "nan":\n\nx',
        'The lyrics of "None":\n\nnan',
    ]
    assert one[0] == 'The lyrics of "Song":\na\nb'


def test_flatten_lines_order_and_only_ascii_space(spark):
    texts = ["a\n\n\nb c", "x\ty　z", "\n", "", None, "赤道的边境 万里无云\n爱你的事情"]
    assert column(spark, texts, tx.flatten_lines(F.col("t"))) == [
        "a。。b，c",
        "x\ty　z",
        "。",
        "",
        None,
        "赤道的边境，万里无云。爱你的事情",
    ]


def test_normalize_newlines(spark):
    assert column(spark, ["a\r\nb\rc\n\r\n"], tx.normalize_newlines(F.col("t"))) == ["a\nb\nc\n\n"]


@pytest.mark.parametrize("sep", ["\n\n", "\n", "。", ".", "|", "[SEP]", "a+", "\\", "$^", "{2}"])
def test_split_is_literal_and_keeps_empty_parts(spark, sep):
    texts = [f"{sep}x{sep}{sep}y{sep}", "no separator", "", sep, sep * 3]
    assert column(spark, texts, tx.split_segments(F.col("t"), sep)) == [t.split(sep) for t in texts]


@pytest.mark.parametrize("sep", ["\n\n", "\n", "。"])
def test_last_segment_pair_restores_the_text(spark, sep):
    texts = [f"a{sep}b{sep}c", "one", f"tail{sep}", "", "\n\n\n", "x\n\n\ny"]
    pairs = column(spark, texts, tx.last_segment_pair(F.col("t"), sep))
    for text, pair in zip(texts, pairs):
        parts = text.split(sep)
        assert pair.reference == parts[-1]
        assert pair.input == sep.join(parts[:-1]) + "\n"


def test_random_cut_is_repeatable_uniform_and_whole(spark):
    texts = ["。".join(str(j) for j in range(5))] * 400 + ["single", "a。b", ""]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, t string")
    pair = tx.random_cut_pair(F.col("t"), F.col("i"), seed=3).alias("p")
    rows = df.select("i", "t", pair).orderBy("i").collect()
    again = df.repartition(5).select("i", pair).orderBy("i").collect()
    assert [r.p for r in rows] == [r.p for r in again]
    assert rows[400].p is None and rows[402].p is None
    assert (rows[401].p.input, rows[401].p.reference) == ("a。", "b")
    cuts = [r.p.n for r in rows[:400]]
    assert set(cuts) == {1, 2, 3, 4} and min(cuts.count(n) for n in set(cuts)) > 60
    for r in rows[:400]:
        assert r.p.input + r.p.reference == r.t
    other = df.select(tx.random_cut_pair(F.col("t"), F.col("i"), seed=4).alias("p")).collect()
    assert [r.p for r in other] != [r.p for r in rows]


def test_head_segments_adds_the_separator_even_with_fewer(spark):
    texts = ["。".join("abcdefghijkl"), "a。b", ""]
    assert column(spark, texts, tx.head_segments(F.col("t"))) == ["a。b。c。d。e。f。g。h。i。j。", "a。b。", "。"]


def test_strip_prompt_counts_characters(spark):
    df = spark.createDataFrame([("日月😀x", "日月😀"), ("abc", "zz"), ("ab", "abcd"), ("ab", "")], "g string, p string")
    out = df.select(tx.strip_prompt(F.col("g"), F.col("p")).alias("x")).collect()
    assert sorted(r.x for r in out) == sorted(["x", "c", "", "ab"])


def test_first_paragraph_and_strip_spaces(spark):
    texts = ["a\nb\n\nc\n\nd", "one", "\n\nx", ""]
    assert column(spark, texts, tx.first_paragraph(F.col("t"))) == [t.split("\n\n")[0] for t in texts]
    assert column(spark, ["日 月 其\t迈　 x"], tx.strip_spaces(F.col("t"))) == ["日月其\t迈　x"]
