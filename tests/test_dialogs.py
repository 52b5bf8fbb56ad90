"""Dialogue strings, prompts and replies against plain Python on small and very uneven conversations."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from corpusloom.functions.dialog import dialog_text, extract_reply
from corpusloom.operators import dialogs

SCHEMA = "conv_id long, turn long, role string, text string"


def tagged(texts, roles=None):
    """The expected string of a list of utterances."""
    out = "[CLS]"
    for i, text in enumerate(texts):
        second = i % 2 == 1 if roles is None else roles[i] == "assistant"
        out += ("[speaker2]" if second else "[speaker1]") + text + "[SEP]"
    return out


@pytest.fixture(scope="module")
def conversations():
    """Forty short conversations and one that holds most turns, with gaps in its turn numbers."""
    rng = random.Random(11)
    made = {}
    for conv in range(40):
        roles = ["system"] * (conv % 4 == 0) + ["user", "assistant"] * 4
        n = rng.randint(1, 8)
        made[conv] = [(t, roles[t], f"c{conv} t{t} {rng.choice(['你 好', 'ok', ''])}") for t in range(n)]
    made[99] = [(t * 3 + t % 2, "user" if t % 2 == 0 else "assistant", f"u{t}") for t in range(700)]
    return made


@pytest.fixture(scope="module")
def turns(spark, conversations):
    rows = [(c, *turn) for c, conv in conversations.items() for turn in conv]
    random.Random(3).shuffle(rows)
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.mark.parametrize("width", [16, 256])
def test_dialog_strings(turns, conversations, width):
    found = {r.conv_id: r.out for r in dialogs.dialog_strings(turns, width=width).collect()}
    assert found == {c: tagged([t[2] for t in conv]) for c, conv in conversations.items()}
    by_role = {r.conv_id: r.out for r in dialogs.dialog_strings(turns, role="role", width=width).collect()}
    assert by_role == {c: tagged([t[2] for t in v], [t[1] for t in v]) for c, v in conversations.items()}


@pytest.mark.parametrize("width", [16, 256])
def test_arrays_and_round_trip(turns, conversations, width):
    arrays = dialogs.turns_to_dialogs(turns, width=width)
    assert {r.conv_id: r.content for r in arrays.collect()} == {
        c: [t[2] for t in conv] for c, conv in conversations.items()
    }
    back = sorted((r.conv_id, r.turn, r.text) for r in dialogs.dialogs_to_turns(arrays).collect())
    assert back == sorted((c, i, t[2]) for c, conv in conversations.items() for i, t in enumerate(conv))
    strings = {r.conv_id: r.out for r in arrays.select("conv_id", dialog_text(F.col("content")).alias("out")).collect()}
    assert strings == {r.conv_id: r.out for r in dialogs.dialog_strings(turns).collect()}


@pytest.mark.parametrize("width", [16, 256])
@pytest.mark.parametrize("by_role", [False, True])
def test_prompts(turns, conversations, width, by_role):
    expected = {}
    for c, conv in conversations.items():
        texts, roles = [t[2] for t in conv], [t[1] for t in conv]
        for i, (turn, role, _) in enumerate(conv):
            if (role == "user") if by_role else i % 2 == 0:
                history = tagged(texts[: i + 1], roles[: i + 1] if by_role else None)
                expected[c, turn] = history + "[speaker2]"
    found = dialogs.chat_prompts(turns, role="role" if by_role else None, width=width).collect()
    assert len(found) == len(expected)
    assert {(r.conv_id, r.turn): r.out for r in found} == expected


def test_prompts_of_a_long_conversation_are_emitted_by_chunk(turns):
    plan = dialogs.chat_prompts(turns)._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression [conv_id" in plan


def test_dialog_text_edges(spark):
    df = spark.createDataFrame([(0, []), (1, ["a"]), (2, ["a", "b", "c"])], "i int, content array<string>")
    out = [r.x for r in df.orderBy("i").select(dialog_text(F.col("content")).alias("x")).collect()]
    assert out == ["[CLS]", tagged(["a"]), tagged(["a", "b", "c"])]


def test_extract_reply(spark):
    decoded = "[CLS] [speaker1] 你 好 [SEP] [speaker2] 再 见 [speaker1] [SEP] rest"
    df = spark.createDataFrame([(n,) for n in range(5)], "n int")
    out = [r.x for r in df.orderBy("n").select(extract_reply(F.lit(decoded), F.col("n")).alias("x")).collect()]
    assert out == ["[CLS]你好", "再见", "rest", None, None]
