"""Product codes against plain Python integers."""

from __future__ import annotations

import hashlib
import math
import random

import pytest

from corpusloom.llm.vector_codes import compress

SCHEMA = "vec_id long, embedding array<double>, label int, code string, _sum int"


def plain(rows, parts, entries, rounds):
    """rows of (vec_id, vector, label), all usable."""
    whole = [[math.floor(256 * x) for x in v] for _, v, _ in rows]
    length = len(whole[0]) // parts
    cut = [[v[p * length : (p + 1) * length] for p in range(parts)] for v in whole]
    first = {}
    for (key, vector, _), pieces in zip(rows, cut):
        if key not in first or vector < first[key][0]:
            first[key] = (vector, pieces)
    order = sorted(first, key=lambda k: (k is None, k))[:entries]
    books = [[first[k][1][p] for k in order] for p in range(parts)]

    def nearest():
        found = []
        for pieces in cut:
            far = [[sum((a - b) ** 2 for a, b in zip(pieces[p], e)) for e in books[p]] for p in range(parts)]
            found.append([(min(d), d.index(min(d))) for d in far])
        return found

    for _ in range(rounds):
        chosen = nearest()
        for p in range(parts):
            for e in range(len(order)):
                mine = [cut[i][p] for i, c in enumerate(chosen) if c[p][1] == e]
                if mine:
                    books[p][e] = [sum(x) // len(mine) for x in zip(*mine)]
    chosen = nearest()
    digest = hashlib.sha256(",".join(str(x) for p in books for e in p for x in e).encode()).hexdigest()
    errors = [sum(d for d, _ in c) for c in chosen]
    labels = {}
    for (_, _, label), error in zip(rows, errors):
        labels[label] = labels.get(label, 0) + error
    return sorted(((r[0], "".join(f"{e:02x}" for _, e in c), x, labels[r[2]], digest) for r, c, x in zip(rows, chosen, errors)), key=str)


def usable(n, width, seed, spread=1.0):
    draw = random.Random(seed)
    return [(draw.choice([i, i, i // 2, None]), [draw.gauss(0, spread) for _ in range(width)], draw.choice([None, 0, 0, 0, 1, 2])) for i in range(n)]


@pytest.mark.parametrize("n, width, parts, entries, rounds", [(5, 4, 2, 8, 2), (400, 16, 4, 16, 2), (300, 6, 3, 64, 0), (64, 16, 16, 3, 1)])
def test_codes_equal_plain_codes(spark, n, width, parts, entries, rounds):
    rows = usable(n, width, n)
    rows += rows[:3]
    table = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(4)
    found = compress(table, parts=parts, entries=entries, rounds=rounds)
    assert found.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert sorted(map(tuple, found.collect()), key=str) == plain(rows, parts, entries, rounds)


def test_unusable_vectors_take_no_part(spark):
    rows = usable(50, 8, 1)
    bad = [(1, None, 1), (2, [], 1), (3, [1.0] * 7 + [None], 1), (4, [1.0] * 7 + [float("nan")], 0), (5, [float("-inf")] * 8, None), (99, [1.0] * 9, 0)]
    table = spark.createDataFrame([(*r, "x", 1) for r in rows + bad], SCHEMA)
    assert sorted(map(tuple, compress(table, parts=4, entries=8).collect()), key=str) == plain(rows, 4, 8, 2)
    assert compress(spark.createDataFrame([], SCHEMA)).count() == 0
    assert compress(spark.createDataFrame([(*b, "x", 1) for b in bad[:5]], SCHEMA)).count() == 0


def test_large_components_are_exact_and_held(spark):
    rows = usable(60, 8, 2, spread=1e6)
    table = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    assert sorted(map(tuple, compress(table, parts=4, entries=8).collect()), key=str) == plain(rows, 4, 8, 2)
    huge = spark.createDataFrame([(i, [1e300 * (-1) ** i] * 16, 0, "x", 1) for i in range(4)] + [(9, [0.0] * 16, 0, "x", 1)], SCHEMA)
    assert {r.error for r in compress(huge, entries=2).collect()} == {0, 2**63 - 1}
