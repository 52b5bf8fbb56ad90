"""Block naming against plain grouping of the normalised texts."""

from __future__ import annotations

import hashlib
import re

import pytest

from corpusloom.llm.exact_dedup import drop_exact_duplicates, exact_duplicates

LONG = "word " * 5_000
ROWS = [
    (1, "a  b"),
    (2, "a\t\nb"),
    (3, "a b "),
    (4, " a b"),
    (5, None),
    (6, ""),
    (6, ""),
    (7, "\x0b \x0c"),
    (8, " "),
    (9, "a b"),
    (10, LONG),
    (11, LONG + "\n"),
    (12, LONG.replace(" ", "\r\n")),
    (13, LONG + "x"),
    (14, "x" + LONG),
    (None, "a b"),
    (None, "only here"),
    (None, "only here"),
    (15, "e" * 64),
    (16, "e" * 128),
    (17, "e" * 65),
    (15, "another text"),
]


def plain(rows):
    body = [re.sub(r"[\x20\x09-\x0D]+", " ", text or "") for _, text in rows]
    groups = {}
    for place, text in enumerate(body):
        groups.setdefault(text, []).append(place)
    result = []
    for text, places in groups.items():
        order = sorted(places, key=lambda p: (rows[p][0] is None, rows[p][0] or 0))
        digest = hashlib.sha256(text.encode()).hexdigest()
        result += [(rows[p][0], rows[order[0]][0], len(places), p == order[0], digest) for p in places]
    return sorted(result, key=str)


@pytest.mark.parametrize("block", [7, 64, 1_024])
def test_groups_equal_plain_grouping(spark, block):
    docs = spark.createDataFrame([(*r, "c", 1) for r in ROWS], "doc_id long, text string, kept string, _name int").repartition(5)
    found = exact_duplicates(docs, block=block)
    assert found.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted(map(tuple, found.collect()), key=str) == plain(ROWS)


def test_kept_rows_keep_their_columns(spark):
    docs = spark.createDataFrame([(*r, i) for i, r in enumerate(ROWS)], "doc_id long, text string, group_size int").repartition(3)
    kept = drop_exact_duplicates(docs).collect()
    assert len(kept) == len({re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in ROWS})
    assert {r.doc_id for r in kept} >= {1, 3, 4, 5, 7, 10, 13, 14, None}


def test_empty_table(spark):
    assert exact_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_hot_group_and_native_plan(spark):
    docs = spark.range(3_000).selectExpr("id AS doc_id", "IF(id % 3 = 0, 'the same text', concat('text ', id)) AS text")
    found = exact_duplicates(docs, block=8)
    assert found.where("kept").count() == 2_001
    assert found.where("group_size = 1000 AND keep_id = 0").count() == 1_000
    plan = found._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
