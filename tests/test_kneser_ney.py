"""Smoothed n-grams against plain dictionaries, and bootstrap intervals against plain loops."""

from __future__ import annotations

import hashlib
import math
import random
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from corpusloom.operators.bootstrap import bootstrap_means, intervals, poisson_steps
from corpusloom.operators.kneser_ney import _grams, fit_kneser_ney, gram_probabilities, kneser_ney_loss
from corpusloom.operators.lookup import salted_lookup


def plain_model(texts, vocab, order):
    counts = {order: Counter()}
    for ids in texts:
        padded = [-1] * (order - 1) + (ids or [])
        for i in range(1, len(ids or [])):
            counts[order][tuple(padded[i : i + order])] += 1
    for k in range(order - 1, 0, -1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    discounts = {}
    for k, c in counts.items():
        n1, n2 = (sum(v == n for v in c.values()) for n in (1, 2))
        discounts[k] = n1 / (n1 + 2 * n2) if n1 else 0.5

    def p(gram):
        if not gram:
            return 1 / vocab
        c, d = counts[len(gram)], discounts[len(gram)]
        after = [n for g, n in c.items() if g[:-1] == gram[:-1]]
        if not after:
            return p(gram[1:])
        return max(c[gram] - d, 0) / sum(after) + d * len(after) / sum(after) * p(gram[1:])

    return p


def talk(seed, n, words):
    draw = random.Random(seed)
    return [[min(int(draw.expovariate(0.4)), words - 1) for _ in range(draw.randint(0, 12))] for _ in range(n)]


def table(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, ids array<int>").repartition(3)


@pytest.mark.parametrize("order", [1, 2, 4])
def test_probabilities_and_losses_equal_plain_ones(spark, order):
    train, test = [*talk(1, 40, 8), None], [*talk(2, 10, 9), None]
    model = fit_kneser_ney(table(spark, train), 10, order=order)
    p = plain_model(train, 10, order)
    contexts = [tuple(random.Random(i).choices(range(-1, 9), k=order - 1)) for i in range(4)] + [(-1,) * (order - 1)]
    wanted = [(list(c) + [w],) for c in set(contexts) for w in range(10)]
    found = {tuple(r.gram): r.p for r in gram_probabilities(spark.createDataFrame(wanted, "gram array<int>"), model).collect()}
    assert found == pytest.approx({tuple(g): p(tuple(g)) for (g,) in wanted})
    # what follows a context, seen or not, sums to 1
    for c in set(contexts):
        assert sum(found[(*c, w)] for w in range(10)) == pytest.approx(1)
    losses = {r.doc_id: (r.loss, r.n) for r in kneser_ney_loss(table(spark, test), model, context=6).collect()}
    plain = {}
    for i, ids in enumerate(test):
        cut = (ids or [])[:6]
        padded = [-1] * (order - 1) + cut
        each = [-math.log(p(tuple(padded[j : j + order]))) for j in range(1, len(cut))]
        if each:
            plain[i] = (pytest.approx(sum(each) / len(each)), len(cut))
    assert losses == plain


def test_nothing_to_learn_from(spark):
    model = fit_kneser_ney(table(spark, [None, [], [3]]), 20)
    assert [r.loss for r in kneser_ney_loss(table(spark, [[1, 2, 3]]), model).collect()] == [pytest.approx(math.log(20))]


def test_intervals_equal_plain_resampling(spark):
    draw = random.Random(3)
    rows = [(i, m, metric, draw.random() + (m == "finetuned") * 0.1, draw.choice([1.0, 2.0])) for i in range(60) for m in ("original", "finetuned") for metric in ("f1", "ppl")]
    odd = [(None, "original", "f1", 0.5, 1.0), (7, "original", "f1", None, 1.0), (8, "original", "f1", 0.1, None)]
    df = spark.createDataFrame(rows + odd, "doc_id long, model string, metric string, value double, weight double").repartition(4)
    steps = poisson_steps()
    assert steps[0] == pytest.approx(math.exp(-1)) and steps == sorted(steps)

    def times(r, key):
        if not r:
            return 1
        text = f"5:{r}:{'' if key is None else key}"
        u = int(hashlib.md5(text.encode()).hexdigest()[:13], 16) / 16**13
        return sum(u >= s for s in steps)

    wanted = {}
    for metric in ("f1", "ppl"):
        means = {}
        for model in ("original", "finetuned"):
            used = [r for r in rows + odd if r[1] == model and r[2] == metric and r[3] is not None and r[4] is not None]
            for r in range(51):
                w = [times(r, x[0]) * x[4] for x in used]
                mean = sum(a * x[3] for a, x in zip(w, used)) / sum(w)
                means[model, r] = math.exp(mean) if metric == "ppl" else mean
        for r in range(51):
            means["difference", r] = means["finetuned", r] - means["original", r]
        for model in ("original", "finetuned", "difference"):
            ranked = sorted(means[model, r] for r in range(1, 51))
            # 5 of 50 lie outside of 90 %: 2.5 on a side, rounded outwards
            wanted[metric, model] = pytest.approx((means[model, 0], ranked[1], ranked[48]))
    found = intervals(bootstrap_means(df, replicates=50, seed=5), share=0.9)
    assert {(r.metric, r.model): (r.value, r.low, r.high) for r in found.collect()} == wanted


def test_a_long_text_is_cut_into_grams_in_linear_time(spark):
    """Building the padded array again for each gram would copy 40 billion ids here."""
    rows = spark.range(1).select(F.transform(F.sequence(F.lit(1), F.lit(200_000)), lambda i: i % 50).alias("ids"))
    begun = time.monotonic()
    found = rows.select(F.explode(_grams(F.col("ids"), 3)).alias("gram")).agg(F.count("*").alias("n"), F.count_distinct("gram").alias("kinds"), F.max(F.size("gram")).alias("width")).first()
    # 50 kinds in the turn, and the first gram with its mark before it
    assert tuple(found) == (199_999, 51, 3)
    assert time.monotonic() - begun < 20


def test_lookup_takes_known_counts(spark):
    rows = spark.createDataFrame([(i % 3 and 1, i) for i in range(3000)], "a int, b int")
    table = spark.createDataFrame([(0, "x"), (1, "y"), (7, "z")], "a int, v string")
    known = spark.createDataFrame([(0, 1000), (1, 2000), (7, 0)], "a int, _n long")
    found = [sorted(map(tuple, salted_lookup(rows, table, "a", "b", c).collect())) for c in (None, known)]
    assert found[0] == found[1] == sorted((i % 3 and 1, i, "y" if i % 3 else "x") for i in range(3000))
