"""Pre-tokenisation, vocabulary, encoding and blocks."""

from __future__ import annotations

import random
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpusloom.functions import fixed
from corpusloom.functions import tokens as tk
from corpusloom.operators import vocab as vb
from corpusloom.operators.dialogs import dialog_strings
from corpusloom.plans.corpora import chat_examples, dialog_examples, lyrics_examples, news_examples, song_examples, tokenized

TEXTS = ["to be, or not to be", "", "日月 Its OK！ no", "be be be", None, "zebra　quay"]


@pytest.fixture
def rows(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string")
    return tokenized(df)


def test_pretokenize(spark, rows):
    found = [r.tokens for r in rows.orderBy("doc_id").collect()]
    assert found == [
        ["to", "be", ",", "or", "not", "to", "be"],
        [],
        ["日", "月", "its", "ok", "！", "no"],
        ["be", "be", "be"],
        None,
        ["zebra", "quay"],
    ]
    keep = spark.range(1).select(tk.pretokenize(F.lit("A𠀀b c-D"), lower=False).alias("x")).first().x
    assert keep == ["A", "𠀀", "b", "c", "-", "D"]


def test_reserved_tokens_stay_whole_and_keep_case(spark):
    text = "[CLS][speaker1]Hi [cls]你[SEP]"
    found = spark.range(1).select(tk.pretokenize(F.lit(text), True, ["[CLS]", "[SEP]", "[speaker1]"]).alias("x"))
    assert found.first().x == ["[CLS]", "[speaker1]", "hi", "[", "cls", "]", "你", "[SEP]"]


def test_token_count(rows):
    counts = rows.orderBy("doc_id").select(tk.token_count(F.col("text")).alias("n")).collect()
    assert [r.n for r in counts] == [7, 0, 6, 3, None, 2]


def test_vocabulary_order_and_reserved_ids(spark, rows):
    words = vb.build_vocab(rows, size=3)
    table = {r.id: r.token for r in words.table.collect()}
    assert table == {
        0: "[PAD]", 1: "[UNK]", 2: "[CLS]", 3: "[SEP]", 4: "be", 5: "to", 6: ",", 7: "[speaker1]", 8: "[speaker2]",
    }
    assert words.reserved == {t: i for i, t in table.items() if t.startswith("[")}
    assert (words.pad, words.unknown, words.wrap) == (0, 1, (2, 3))
    assert vb.Vocab(words.table, 9, {"[SEP]": 3, "[UNK]": 1}).pad == 3


@pytest.mark.parametrize("limit", [100, 2])
def test_encode_and_decode_by_broadcast_and_by_join(spark, rows, limit):
    learned = vb.build_vocab(rows, size=50)
    words = vb.Vocab.from_table(learned.table, [*fixed.BASE_TOKENS, *fixed.SPEAKER_TOKENS], limit)
    assert (words.words is None) == (limit == 2)
    encoded = vb.encode_ids(rows, words)
    back = vb.decode_ids(encoded, words).orderBy("doc_id").collect()
    ids = {r.token: r.id for r in learned.table.collect()}
    for r in back:
        assert r.ids == (None if r.tokens is None else [ids[t] for t in r.tokens])
        assert r.decoded == (None if r.tokens is None else " ".join(r.tokens))


@pytest.mark.parametrize("limit", [100, 2])
def test_unknown_tokens(spark, rows, limit):
    words = vb.Vocab.from_table(vb.build_vocab(rows, size=1).table, limit=limit)
    encoded = vb.encode_ids(rows, words).where("doc_id = 0")
    assert encoded.first().ids == [1, 4, 1, 1, 1, 1, 4]


@pytest.mark.parametrize("limit", [100, 2])
def test_odd_rows_mean_the_same_on_both_sides_of_the_limit(spark, rows, limit):
    words = vb.Vocab.from_table(vb.build_vocab(rows).table, limit=limit)
    odd = [(1, ["be", None]), (1, ["to"]), (None, ["zzz", "be"]), (None, []), (2, None), (1, ["be", None])]
    df = spark.createDataFrame(odd, "doc_id long, tokens array<string>")
    be, to = (next(r.id for r in words.table.collect() if r.token == t) for t in ("be", "to"))
    found = vb.encode_ids(df, words).collect()
    key = lambda x: str(x)
    assert sorted((r.ids for r in found), key=key) == sorted([[be, 1], [to], [1, be], [], None, [be, 1]], key=key)
    ids = spark.createDataFrame([(1, [be, 99_999]), (1, [-100, None, to]), (2, None), (2, [])], "doc_id long, ids array<int>")
    out = sorted((r.decoded for r in vb.decode_ids(ids, words).collect()), key=key)
    assert out == sorted(["be [UNK]", "[UNK] [UNK] to", None, ""], key=key)


@pytest.mark.parametrize("table", [[(0, "[UNK]"), (1, "a"), (2, "a")], [(0, "[UNK]"), (1, None)], [(0, "[UNK]"), (0, "a")]])
def test_repeated_or_missing_vocabulary_rows_are_refused(spark, table):
    with pytest.raises(ValueError):
        vb.Vocab.from_table(spark.createDataFrame(table, "id int, token string"))


def test_whole_vocabulary_restores_every_token(spark, rows):
    words = vb.build_vocab(rows)
    back = vb.decode_ids(vb.encode_ids(rows, words), words)
    assert all(r.decoded == (None if r.tokens is None else " ".join(r.tokens)) for r in back.collect())


def test_truncation_report_counts_what_blocks_cut(spark):
    df = spark.createDataFrame([(i, ["a"] * n) for i, n in enumerate([3, 5, 6, 7, 9])], "doc_id long, tokens array<string>")
    words = vb.build_vocab(df)
    sizes = {"block": 9, "reserve": 2, "wrap": True}
    kept = vb.to_blocks(df, words, **sizes).select(F.sum(F.col("n_tokens") - 2)).first()[0]
    report = vb.truncation_report(df.select(F.size("tokens").alias("n_tokens")), **sizes).first()
    assert report.tokens_lost == 30 - kept and report.n_over == 3


def test_supplied_vocabulary_must_be_dense(spark):
    table = spark.createDataFrame([(0, "[UNK]"), (2, "a")], "id int, token string")
    with pytest.raises(ValueError):
        vb.Vocab.from_table(table)


def test_large_learned_vocabulary_is_a_table(spark, rows, monkeypatch):
    small = vb.build_vocab(rows, size=6)
    monkeypatch.setattr(vb, "BROADCAST_WORDS", 5)
    large = vb.build_vocab(rows, size=6)
    assert large.words is None and large.reserved == small.reserved
    assert sorted(map(tuple, large.table.collect())) == sorted(map(tuple, small.table.collect()))


@pytest.mark.parametrize("size", [0, 1, 6, 7, 8, 9, 20])
@pytest.mark.parametrize("wrap", [None, (2, 3)])
def test_blocks_have_exact_length(spark, size, wrap):
    block = 8
    ids = F.array_repeat(F.lit(5), size)
    row = spark.range(1).select(tk.pad_truncate(ids, block, 0, wrap).alias("x")).first()
    kept = [5] * min(size, block - (2 if wrap else 0))
    body = [2, *kept, 3] if wrap else kept
    assert row.x == body + [0] * (block - len(body))


def test_examples_carry_mask_count_and_labels(spark, rows):
    words = vb.build_vocab(rows, size=50)
    out = vb.to_blocks(rows.where("text is not null"), words, block=7, reserve=1, wrap=True)
    for r in out.collect():
        real = min(len(TEXTS[r.doc_id].split() and tokens_of(TEXTS[r.doc_id])), 4) + 2
        assert len(r.input_ids) == len(r.attention_mask) == 6
        assert r.n_tokens == sum(r.attention_mask) == real
        assert r.labels == r.input_ids and r.input_ids[0] == 2 and r.input_ids[real - 1] == 3
    masked = vb.to_blocks(rows.where("doc_id = 3"), words, block=6, mask_padding=True).first()
    assert masked.labels == [*masked.input_ids[:3], -100, -100, -100]


def tokens_of(text):
    return [t for t in text.replace(",", " , ").replace("日", " 日 ").replace("月", " 月 ").replace("！", " ！ ").split()]


def test_truncation_report(spark):
    df = spark.createDataFrame([(10,), (12,), (5,), (11,)], "n_tokens int")
    r = vb.truncation_report(df, block=10).first()
    assert (r.n_docs, r.n_over, r.share_over, r.tokens_lost) == (4, 2, 0.5, 3)
    empty = vb.truncation_report(df.where("n_tokens < 0"), block=10).first()
    assert (empty.n_docs, empty.n_over, empty.share_over, empty.tokens_lost) == (0, 0, None, 0)


def test_counts_match_a_plain_counter(spark):
    rng = random.Random(5)
    texts = [" ".join(rng.choices("abcdefg", weights=[30, 9, 5, 3, 2, 1, 1], k=rng.randint(0, 60))) for _ in range(200)]
    df = tokenized(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string"))
    found = {r.token: r.n for r in vb.token_counts(df).collect()}
    assert found == Counter(" ".join(texts).split())


def test_dialogues_as_arrays(spark):
    rows = [("a", ["one", "two"]), ("b", []), ("c", None), ("d", ["x"])]
    df = spark.createDataFrame(rows, "dialog_id string, content array<string>")
    listed = spark.createDataFrame([("a",), ("b",), ("c",)], "dialog_id string")
    marks = [*fixed.BASE_TOKENS, *fixed.SPEAKER_TOKENS]
    words = vb.build_vocab(tokenized(df.select(F.explode("content").alias("text")), reserved=marks))
    out = {r.dialog_id: r for r in dialog_examples(df, listed, words, block=12).collect()}
    assert set(out) == {"a", "b", "c"}
    assert out["b"].input_ids == out["c"].input_ids == [2, *[0] * 9] and out["a"].n_tokens == 7


def test_corpora_end_to_end(spark):
    songs = [(i, f"t{i}", f"line one\nline {i}", "en" if i % 3 else "fr") for i in range(12)]
    lyric = spark.createDataFrame(songs, "ordinal long, title string, body string, lang string")
    words = vb.build_vocab(tokenized(lyric, "body"), size=100)
    blocks = lyrics_examples(lyric, words, block=16, k=3).collect()
    assert sorted(r.ordinal for r in blocks) == [1, 2, 4, 5, 7, 8]
    assert all(len(r.input_ids) == 16 for r in blocks)

    news = spark.createDataFrame([(0, "line one"), (1, None), (2, "")], "ordinal long, output string")
    out = {r.ordinal: r for r in news_examples(news, words, block=8).collect()}
    assert set(out) == {0, 2} and out[2].input_ids == [2, 3, 0, 0, 0, 0]

    turns = spark.createDataFrame(
        [(1, 0, "line"), (1, 1, "one"), (2, 0, "one")], "conv_id long, turn long, text string"
    )
    listed = spark.createDataFrame([(1,), (1,)], "conv_id long")
    chat = chat_examples(turns, listed, words, block=12, reserve=2).collect()
    s1, s2 = words.reserved["[speaker1]"], words.reserved["[speaker2]"]
    ids = {r.token: r.id for r in words.table.collect()}
    assert [r.input_ids for r in chat] == [[2, s1, ids["line"], 3, s2, ids["one"], 3, 0, 0, 0]]

    tree = spark.createDataFrame([(f"g{i:02d}", "s", "line one") for i in range(12)], "artist string, song string, text string")
    kept = song_examples(tree, words, block=10).collect()
    assert sorted(r.artist for r in kept) == ["g00", "g01"]
    assert kept[0].input_ids[:5] == [2, ids["line"], 1, ids["one"], 3]


def test_chat_block_of_a_long_conversation_equals_the_cut_of_its_whole_string(spark):
    """Turns past half the block are left out early; empty utterances are the shortest a turn can be."""
    rows = [(1, t, "") for t in range(600)] + [(2, t, f"word {t}") for t in range(400)] + [(3, 0, "one")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, text string").repartition(4)
    listed = spark.createDataFrame([(1,), (2,), (3,)], "conv_id long")
    marks = [*fixed.BASE_TOKENS, *fixed.SPEAKER_TOKENS]
    words = vb.build_vocab(tokenized(turns, reserved=marks), size=500)
    for block in (10, 33, 700):
        found = {r.conv_id: r.input_ids for r in chat_examples(turns, listed, words, block=block, reserve=0).collect()}
        strings = tokenized(dialog_strings(turns), "out", reserved=marks)
        whole = vb.to_blocks(strings, words, block=block).collect()
        assert found == {r.conv_id: r.input_ids for r in whole}


def test_a_larger_vocabulary_is_asked_once_a_block(spark, monkeypatch):
    """Only rows are written and only the block's distinct elements are joined, not the elements of each row."""
    monkeypatch.setattr(vb, "BLOCK_ROWS", 4)
    monkeypatch.setattr(vb, "BLOCK_WORDS", 30)
    written, land = [], vb.land
    monkeypatch.setattr(vb, "land", lambda df, label: written.append((label, df.count())) or land(df, label))
    texts = [[f"w{(i * 7 + j) % 23}" for j in range(i % 41)] for i in range(60)] + [None, [], [None, "w1", "outside"], ["w1", "w1"], ["w1", "w1"]]
    rows = [(None if i % 9 == 0 else i % 5, x, {"k": [i]}) for i, x in enumerate(texts)]
    df = spark.createDataFrame(rows, "id int, tokens array<string>, more map<string, array<int>>").coalesce(2)
    words = [(0, "[UNK]"), *((i + 1, f"w{i}") for i in range(23))]
    table = vb.Vocab.from_table(spark.createDataFrame(words, "id int, token string"), limit=0)
    ids = {w: i for i, w in words}
    encoded = vb.encode_ids(df, table)
    assert written == [("rows", len(rows))]
    assert encoded.columns == ["id", "tokens", "more", "ids"]
    expected = sorted((repr(i), repr(x), repr(m), repr(x and [ids.get(w, 0) for w in x])) for i, x, m in rows)
    assert sorted(tuple(map(repr, r)) for r in encoded.collect()) == expected
    assert vb.encode_ids(df, table, out="tokens").columns == df.columns
    back = vb.decode_ids(encoded.select("ids"), table).collect()
    assert sorted(repr(r.decoded) for r in back) == sorted(repr(x if x is None else " ".join(w if w in ids else "[UNK]" for w in x)) for x in texts)


def test_only_words_beyond_the_first_are_asked_for_and_rows_move_as_numbers(spark, monkeypatch):
    """Of a larger vocabulary the first words are looked up in the tasks; neither frequent words nor the tokens are written or joined."""
    monkeypatch.setattr(vb, "BLOCK_ROWS", 5)
    monkeypatch.setattr(vb, "BLOCK_WORDS", 40)
    texts = [[f"w{(i * 7 + j * j) % 31}" for j in range(i % 29)] for i in range(50)] + [None, [], [None, "w1", "outside"], ["w1", "w1"], ["w1", "w1"]]
    df = spark.createDataFrame([(None if i % 9 == 0 else i % 5, x) for i, x in enumerate(texts)], "id int, tokens array<string>").coalesce(2)
    learned = df.where("NOT array_contains(tokens, 'outside')")
    small = vb.build_vocab(learned)
    monkeypatch.setattr(vb, "BROADCAST_WORDS", 12)
    large = vb.build_vocab(learned)
    first = {r.token for r in small.table.where("id < 12").collect()}
    assert large.words is None and large.head.to_pylist() == small.words.to_pylist()[:12]
    written, land = [], vb.land
    monkeypatch.setattr(vb, "land", lambda df, label: written.append(land(df, label)) or written[-1])
    key = lambda r: repr(r)
    found = vb.encode_ids(df, large, keep=False)
    assert found.columns == ["id", "ids"]
    assert sorted(map(key, found.collect())) == sorted(map(key, vb.encode_ids(df, small).select("id", "ids").collect()))
    assert [c for c, kind in written[0].dtypes if "string" in kind] == ["_words"]
    asked = [w for r in written[0].where("_words IS NOT NULL").collect() for w in r._words]
    assert "outside" in asked and not first & set(asked) and len(asked) < sum(len(x or ()) for x in texts) / 2
    ids = spark.createDataFrame([(r.ids,) for r in found.collect()] + [([-1, None, 10**6, small.size, 11, 12],)], "ids array<int>")
    back, plain = (vb.decode_ids(ids, v, keep=False) for v in (large, small))
    assert back.columns == ["decoded"] and sorted(map(key, back.collect())) == sorted(map(key, plain.collect()))
    wide = ids.select(F.col("ids").cast("array<bigint>").alias("ids"))
    assert sorted(map(key, vb.decode_ids(wide, large, keep=False).collect())) == sorted(map(key, plain.collect()))


@pytest.mark.parametrize("rows, elements", [(3, 100), (100, 7), (4, 9)])
def test_blocks_of_rows_are_closed_at_their_size_over_batches(rows, elements):
    lists = [None if i % 7 == 0 else list(range(i % 6)) for i in range(40)] + [list(range(50)), [], None]
    batches = [pa.RecordBatch.from_arrays([pa.array(lists[i : i + 5], pa.list_(pa.int32()))], names=["x"]) for i in range(0, len(lists), 5)]
    parts = [p["x"].to_pylist() for p in vb._cut_blocks(iter([batches[0].slice(0, 0), *batches]), "x", rows, elements)]
    assert [x for p in parts for x in p] == lists
    sizes = [[len(x or ()) for x in p] for p in parts]
    assert all(len(s) <= rows and sum(s[:-1]) < elements for s in sizes)
    assert all(len(s) == rows or sum(s) >= elements for s in sizes[:-1])


def test_blocks_of_a_larger_vocabulary_move_no_texts(spark, monkeypatch):
    news = spark.createDataFrame([(i, f"w{i % 7} w{i % 5} said") for i in range(20)], "ordinal long, output string")
    monkeypatch.setattr(vb, "BROADCAST_WORDS", 5)
    words = vb.build_vocab(tokenized(news, "output"))
    written, land = [], vb.land
    monkeypatch.setattr(vb, "land", lambda df, label: written.append(df.columns) or land(df, label))
    plain = news_examples(news, words, block=12).drop("text")
    lean = news_examples(news, words, block=12, with_text=False)
    assert "text" in written[0] and not {"text", "_kept"} & set(written[1]) and lean.columns == plain.columns
    assert sorted(map(tuple, lean.collect())) == sorted(map(tuple, plain.collect()))
