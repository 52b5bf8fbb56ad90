"""Sub-words against a greedy match written with plain loops."""

from __future__ import annotations

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusloom.operators.subwords import PieceTrie, Pieces, encode_subwords, join_pieces

UNKNOWN = 1


def greedy(word, ids, longest=100):
    found, at = [], 0
    if not word or len(word) > longest:
        return [UNKNOWN]
    while at < len(word):
        for end in range(len(word), at, -1):
            piece = ("##" if at else "") + word[at:end]
            # a word that begins like a mark is no piece inside a word
            if piece in ids and (at or piece == "##" or not piece.startswith("##")):
                found.append(ids[piece])
                at = end
                break
        else:
            return [UNKNOWN]
    return found


def cut(words, ids, longest=100):
    counts, flat = PieceTrie.build(ids.items()).cut(words, UNKNOWN, longest)
    ends = counts.cumsum()
    return [flat[e - c : e].tolist() for c, e in zip(counts, ends)]


@settings(max_examples=200, deadline=None)
@given(
    st.lists(st.text("abc", min_size=1, max_size=5), max_size=12),
    st.lists(st.text("abc", min_size=1, max_size=5), max_size=12),
    st.lists(st.text("abcd", max_size=12), max_size=20),
)
def test_trie_equals_greedy_match(heads, tails, words):
    ids = {p: i + 2 for i, p in enumerate(dict.fromkeys([*heads, *("##" + t for t in tails)]))}
    assert cut(words, ids) == [greedy(w, ids) for w in words]


def test_long_failing_matches_and_wide_characters():
    ids = {"a" * 50: 2, "a": 3, "##a": 4, "##" + "a" * 49 + "b": 5, "中": 6, "##文": 7, "##😀": 8, "##": 9}
    words = ["a" * 99, "a" * 49 + "b", "a" * 101, "中文😀", "中x", "文", "", "##", "##a"]
    assert cut(words, ids) == [greedy(w, ids) for w in words]
    assert cut(["abc"], {}) == [[UNKNOWN]] and cut([], ids) == []


def test_rows_keep_order_nulls_and_lengths(spark):
    draw = random.Random(5)
    pieces = ["un", "##able", "aff", "##aff", "##a", "u", "##b", "##ble", "word"]
    ids = {p: i + 2 for i, p in enumerate(pieces)}
    table = spark.createDataFrame([(0, "[PAD]"), (1, "[UNK]"), *((i, p) for p, i in ids.items())], "id int, token string")
    words = ["unaffable", "unable", "word", "words", "[PAD]", "u", None, ""]
    rows = [(i, [draw.choice(words) for _ in range(draw.randint(0, 9))]) for i in range(50)] + [(50, None), (50, ["u"])]
    df = spark.createDataFrame(rows, "doc_id long, tokens array<string>").repartition(3)
    found = encode_subwords(df, Pieces.from_table(table)).collect()
    plain = [(k, None if t is None else [i for w in t for i in greedy(w or "", ids)]) for k, t in rows]
    assert sorted(((r.doc_id, r.ids) for r in found), key=str) == sorted(plain, key=str)
    text = spark.range(1).select(join_pieces(F.lit("un ##aff ##able word")).alias("t"))
    assert text.first().t == "unaffable word"


def test_tables_of_pieces_are_checked(spark):
    schema = "id int, token string"
    for rows in ([(1, "[UNK]"), (2, "a"), (3, "a")], [(1, "[UNK]"), (2, None)], [(2, "a")]):
        with pytest.raises(ValueError):
            Pieces.from_table(spark.createDataFrame(rows, schema))
