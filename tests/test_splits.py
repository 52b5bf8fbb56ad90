"""Filters, hold-outs and membership."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import filters, splits
from corpusloom.plans.corpora import titled_lyrics
from corpusloom.sources.writers import example_count


def ids(df, column="id"):
    return sorted(r[column] for r in df.collect())


def test_language_and_nonnull(spark):
    df = spark.createDataFrame([(1, "en", "a"), (2, None, ""), (3, "fr", None)], "id int, lang string, body string")
    assert ids(filters.keep_language(df)) == [1]
    assert ids(filters.keep_nonnull(df, "body")) == [1, 2]


def test_listed_ignores_repeats_and_misses(spark):
    df = spark.createDataFrame([(i,) for i in range(6)], "id int")
    listed = spark.createDataFrame([(2,), (2,), (4,), (99,)], "id int")
    assert ids(filters.keep_listed(df, listed, "id")) == [2, 4]
    assert ids(filters.drop_listed(df, listed, "id")) == [0, 1, 3, 5]


@pytest.mark.parametrize(("rows", "k"), [(3, 5), (5, 5), (9, 5), (1, 1), (1200, 500)])
def test_tail_holdout_sizes(spark, rows, k):
    df = spark.range(rows).withColumn("id", F.col("id") * 3 + 1)
    flagged = splits.tail_holdout(df, "id", k).collect()
    tail = sorted(r.id for r in flagged)[-k:]
    assert sorted(r.id for r in flagged if r.is_test) == tail
    assert len(flagged) == rows


def test_tail_holdout_reaches_the_scan(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    plan = splits.tail_holdout(docs, "doc_id", 50).where("is_test").select("doc_id")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(doc_id), GreaterThanOrEqual(doc_id,ScalarSubquery" in text
    assert "Exchange" not in text and "Window" not in text


@pytest.mark.parametrize("groups", [4, 10, 14])
def test_group_holdout(spark, groups):
    names = [f"g{i:02d}" for i in range(groups)]
    df = spark.createDataFrame([(g, j) for g in names for j in range(3)], "g string, j int")
    roles = {r.g: r.role for r in splits.group_holdout(df, "g").distinct().collect()}
    expected = dict.fromkeys(names, "train") | dict.fromkeys(names[-10:], "heldout") | {names[-1]: "eval"}
    assert {r.g: r.role for r in splits.group_holdout(df, "g").select("g", "role").distinct().collect()} == expected
    assert roles == expected
    with pytest.raises(ValueError):
        splits.group_holdout(df, "g", 1, 2)


def test_budget_boundary(spark):
    df = spark.createDataFrame([(924,), (925,), (0,)], "n_tokens int")
    assert ids(filters.within_budget(df), "n_tokens") == [0, 924]


def test_empty_pairs_are_dropped_only_on_request(spark):
    df = spark.createDataFrame([(1, "a", "b"), (2, " \t　", "b"), (3, "a", "")], "id int, x string, y string")
    assert ids(filters.drop_empty_pairs(df, "x", "y")) == [1]


def test_tail_is_taken_before_the_language_filter(spark):
    rows = [(i, f"t{i}", f"b{i}", "en" if i % 2 else "fr") for i in range(20)]
    df = spark.createDataFrame(rows, "ordinal long, title string, body string, lang string")
    out = titled_lyrics(df, k=6).collect()
    assert sorted(r.ordinal for r in out if r.is_test) == [15, 17, 19]
    assert sorted(r.ordinal for r in out if not r.is_test) == [1, 3, 5, 7, 9, 11, 13]


def test_null_policy(spark):
    df = spark.createDataFrame(
        [(1, None, "b", "en"), (2, "t", None, "en"), (3, "t", "b", "en")],
        "ordinal long, title string, body string, lang string",
    )
    assert titled_lyrics(df, k=1).count() == 3
    assert ids(titled_lyrics(df, k=1, null_policy="drop"), "ordinal") == [3]
    with pytest.raises(ValueError):
        titled_lyrics(df, null_policy="other")


def test_example_count(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "split string")
    assert {(r.split, r.n) for r in example_count(df, "split").collect()} == {("a", 2), ("b", 1)}
    assert example_count(df).first().n == 3


@pytest.mark.parametrize("k", [0, 1, 3, 50])
def test_every_row_is_on_one_side(spark, k):
    df = spark.createDataFrame([(i if i % 4 else None, i) for i in range(20)], "doc_id long, n long")
    flagged = splits.tail_holdout(df, "doc_id", k)
    test, train = flagged.where("is_test").count(), flagged.where("NOT is_test").count()
    assert test + train == 20 and test == min(k, 15)
