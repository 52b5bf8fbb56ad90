"""Burst tries against a plain trie of tuples."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest

from corpusloom.llm.prefix_trie import RESULT, conversation_trie

SCHEMA = "conv_id long, turn long, role string, text string, depth int, _n string"


def plain(rows):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role)}:{role}:{text}".encode()).hexdigest()
            own.setdefault(conv, []).append((turn is not None, turn or 0, digest, role, text))
    own = {c: [t[3:] for t in sorted(turns)] for c, turns in own.items()}
    nodes, built = {}, {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        first = c - (c % 5 if c >= 0 else -(-c % 5))
        built[c] = tuple(own.get(first, [])[:h] + turns[h:])
        for d in range(len(built[c]) + 1):
            nodes.setdefault(built[c][:d], []).append(c)
    kids, leaves, saved = {}, {}, {}
    for path, members in sorted(nodes.items(), key=lambda x: -len(x[0])):
        kids.setdefault(path, 0)
        leaves[path] = leaves.get(path, 0) or 1
        saved[path] = saved.get(path, 0) + ((len(members) - 1) * len(path[-1][1].encode()) if path else 0)
        if path:
            above = path[:-1]
            kids[above] = kids.get(above, 0) + 1
            leaves[above] = leaves.get(above, 0) + leaves[path]
            saved[above] = saved.get(above, 0) + saved[path]
    result = []
    for path, members in nodes.items():
        ends = ",".join(str(c) for c in sorted(m for m in members if built[m] == path))
        above = min(nodes[path[:-1]]) if path else None
        numbers = (min(members), len(path), above, len(members), kids[path], leaves[path], saved[path])
        result.append((*numbers, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(result, key=str)


def found(spark, rows, **sizes):
    table = spark.createDataFrame([(*r, 7, "x") for r in rows], SCHEMA).repartition(3)
    result = conversation_trie(table, **sizes)
    assert result.columns == RESULT
    return sorted(map(tuple, result.collect()), key=str)


def talk(seed, convs, most, words):
    draw = random.Random(seed)
    rows = []
    for c in range(convs):
        for t in range(draw.randint(1, most)):
            rows.append((c, draw.choice([t, t, t, None]) if seed % 2 else t, draw.choice(["user", "assistant", None]), draw.choice(words)))
    return rows


@pytest.mark.parametrize("seed, convs, most, segment, limit", [(1, 60, 12, 3, 2), (2, 80, 9, 256, 4), (3, 40, 20, 4, 1_000), (4, 50, 6, 2, 1)])
def test_nodes_equal_plain_trie(spark, seed, convs, most, segment, limit):
    rows = talk(seed, convs, most, ["a", "ä", "", None])
    rows += rows[:5]
    assert found(spark, rows, segment=segment, limit=limit) == plain(rows)


def test_awkward_conversations(spark):
    rows = [(None, 1, "user", "lost"), (-7, 0, "u", "x"), (-5, 3, "u", "x"), (-5, 3, "u", "x"), (2**63 - 1, 0, None, None), (5, None, "u", "b" * 5_000)]
    rows += [(5, None, "u", "a"), (10, 1, "", "user"), (11, 1, "user", ""), (6, 0, "u", "only"), (-(2**63), 0, "u", "x")]
    assert found(spark, rows) == plain(rows)
    assert found(spark, rows, segment=1, limit=1) == plain(rows)
    assert found(spark, []) == []


def test_copies_and_long_conversations(spark):
    same = [(c, t, "user", f"turn {t}") for c in range(0, 600) for t in range(6)]
    long = [(1_000, t % 40, "user", f"{t}") for t in range(1_500)] + [(1_005, 0, "user", "again")] * 900
    long += [(1_010, t, "user", f"{t % 3}") for t in range(700)] + [(1_020, t, "user", f"{t % 3}") for t in range(650)]
    rows = same + long
    assert found(spark, rows, segment=16, limit=8) == plain(rows)
