"""Packed blocks against a plain best fit, and prompts in a context against plain loops."""

from __future__ import annotations

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusloom.functions.tokens import token_count
from corpusloom.operators.dialogs import prompts_in_context
from corpusloom.operators.packing import best_fit, pack_blocks, unpack_blocks


def plain_best_fit(lengths, block):
    left = []
    for length in sorted(lengths, reverse=True):
        fits = [i for i, room in enumerate(left) if room >= length]
        if fits:
            left[min(fits, key=lambda i: left[i])] -= length
        else:
            left.append(block - length)
    return sorted(left)


@settings(max_examples=150, deadline=None)
@given(st.integers(1, 40).flatmap(lambda block: st.tuples(st.just(block), st.lists(st.integers(1, block), max_size=120))))
def test_histogram_fit_equals_one_by_one(case):
    block, lengths = case
    patterns = best_fit({n: lengths.count(n) for n in set(lengths)}, block)
    assert sorted(p.left for p in patterns for _ in range(p.blocks)) == plain_best_fit(lengths, block)
    assert sorted(n for p in patterns for _ in range(p.blocks) for n, each in p.parts for _ in range(each)) == sorted(lengths)


@pytest.mark.parametrize("block", [4, 32])
def test_every_id_is_in_one_block(spark, block):
    draw = random.Random(block)
    rows = [(draw.choice([i, 1, None]), [draw.randint(5, 99) for _ in range(draw.choice([0, 1, 3, 7, block, 2 * block + 1]))]) for i in range(300)]
    rows += [(7, None), (8, [9] * 1_000)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, ids array<int>, rank int, _part string").repartition(5)
    blocks = pack_blocks(df, block=block, pad=0).cache()
    found = blocks.collect()
    whole = [(k, i) for k, ids in rows if ids for i in ids]
    read = unpack_blocks(blocks).collect()
    assert sorted(((r.doc_id, i) for r in read for i in r.ids), key=str) == sorted(whole, key=str)
    assert [r.ids for r in read if r.doc_id == 8] and sum(len(r.ids) for r in read if r.doc_id == 8) >= 1_000
    lengths = [n for _, ids in rows if ids for n in [block] * (len(ids) // block) + [len(ids) % block] * (len(ids) % block > 0)]
    assert sorted(block - r.n_tokens for r in found) == plain_best_fit(lengths, block)
    assert sorted(r.block_id for r in found) == list(range(len(found)))
    for r in found:
        assert len(r.input_ids) == len(r.segment_ids) == len(r.position_ids) == block
        assert all(i for i in r.input_ids[: r.n_tokens]) and not any(r.segment_ids[r.n_tokens :])
        for i, m in enumerate(r.members):
            part = slice(m.offset, m.offset + m.length)
            assert r.segment_ids[part] == [i + 1] * m.length and r.position_ids[part] == list(range(m.length))


def test_nothing_to_pack(spark):
    assert pack_blocks(spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")).count() == 0


def plain_prompts(rows, budget, role):
    found, convs = [], {}
    for conv, turn, who, text in rows:
        convs.setdefault(conv, []).append((turn, who, text or ""))
    for conv, turns in convs.items():
        turns.sort(key=lambda t: t[0])
        for p, (turn, who, _) in enumerate(turns):
            if (who != "user") if role else p % 2:
                continue
            first, used = p, len(turns[p][2].split()) + 2
            while first and used + len(turns[first - 1][2].split()) + 2 <= budget:
                first -= 1
                used += len(turns[first][2].split()) + 2
            out = "[CLS]"
            for q in range(first, p + 1):
                second = turns[q][1] == "assistant" if role else q % 2
                out += ("[speaker2]" if second else "[speaker1]") + turns[q][2] + "[SEP]"
            found.append((conv, turn, out + "[speaker2]", used + 2, first))
    return sorted(found)


@pytest.mark.parametrize("role, context, width", [(None, 30, 4), ("role", 14, 2), (None, 8, 256), ("role", 1_024, 256)])
def test_prompts_in_context_equal_plain_prompts(spark, role, context, width):
    draw = random.Random(context)
    rows = [
        (c, t * draw.choice([1, 1, 50]) + t, draw.choice(["user", "assistant", "system"]), draw.choice([None, "", "a", "b c d", "e " * 30]))
        for c, most in ((0, 90), (1, 1), (2, 13), (-3, 40))
        for t in range(0, 60 * most, 60)
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    found = prompts_in_context(df, role=role, context=context, new=4, width=width)
    assert found.columns == ["conv_id", "turn", "out", "n_tokens", "n_left_out"]
    assert sorted(map(tuple, found.collect())) == plain_prompts(rows, context - 6, role)


def test_a_long_conversation_gives_linear_output(spark):
    turns = spark.range(0, 20_000, 1, 4).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.concat(F.lit("word "), "id").alias("text"))
    found = prompts_in_context(turns).agg(F.count("*").alias("n"), F.max("n_tokens").alias("most"), F.max(token_count(F.col("out"))).alias("words")).first()
    assert found.n == 10_000 and found.most <= 1_024 - 100 and found.words < 4_000
