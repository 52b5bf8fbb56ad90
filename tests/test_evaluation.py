"""Losses, perplexity and match scores against plain Python."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.operators import ngram, scoring
from corpusloom.plans import evaluation

PAIRS = [
    ([], ["a"]),
    (["a"], []),
    ([], []),
    (["a", "b", "b"], ["a", "b", "b"]),
    (["a", "a", "x"], ["a", "b"]),
    (["q"], ["z"]),
    (None, ["a"]),
]


def random_pairs(n=60, longest=40):
    rng = random.Random(2)
    words = [f"w{i}" for i in range(12)]
    make = lambda: rng.choices(words, k=rng.randint(0, longest))
    return [(make(), make()) for _ in range(n)]


def frame(spark, pairs):
    rows = [(i, c, r) for i, (c, r) in enumerate(pairs)]
    return spark.createDataFrame(rows, "id long, cand_tokens array<string>, ref_tokens array<string>").repartition(3)


def brute(cand, ref, similarity):
    cand, ref = cand or [], ref or []
    if not cand or not ref:
        return 0.0, 0.0, 0.0
    p = sum(max(similarity(c, r) for r in ref) for c in cand) / len(cand)
    q = sum(max(similarity(c, r) for c in cand) for r in ref) / len(ref)
    return p, q, 2 * p * q / (p + q) if p + q else 0.0


def check(scored, pairs, similarity):
    found = {r.id: (r.precision, r.recall, r.f1) for r in scored.collect()}
    assert len(found) == len(pairs)
    for i, (cand, ref) in enumerate(pairs):
        assert found[i] == pytest.approx(brute(cand, ref, similarity), abs=1e-9), (cand, ref)


def test_exact_match(spark):
    pairs = PAIRS + random_pairs()
    check(scoring.match_score(frame(spark, pairs)), pairs, lambda a, b: float(a == b))


def test_scores_swap_when_the_sides_swap(spark):
    df = frame(spark, random_pairs())
    one = {r.id: (r.precision, r.recall) for r in scoring.match_score(df).collect()}
    swapped = scoring.match_score(df, candidate="ref_tokens", reference="cand_tokens").collect()
    assert one == {r.id: (r.recall, r.precision) for r in swapped}


@pytest.mark.parametrize("broadcast_floats", [10_000, 1])
@pytest.mark.parametrize("block_rows", [512, 3])
def test_vector_match_in_place_and_by_join(spark, monkeypatch, broadcast_floats, block_rows):
    monkeypatch.setattr(scoring, "BLOCK_ROWS", block_rows)
    rng = np.random.default_rng(4)
    # two words have no vector, one has a zero vector
    known = {f"w{i}": rng.normal(size=5) if i else np.zeros(5) for i in range(10)}
    vectors = spark.createDataFrame([(t, v.tolist()) for t, v in known.items()], "token string, vector array<float>")

    def similarity(a, b):
        if a == b:
            return 1.0
        if a not in known or b not in known:
            return 0.0
        x, y = (known[t].astype(np.float32).astype(np.float64) for t in (a, b))
        size = np.linalg.norm(x) * np.linalg.norm(y)
        return float(x @ y / size) if size else 0.0

    pairs = PAIRS + random_pairs()
    check(scoring.match_score(frame(spark, pairs), vectors, broadcast_floats=broadcast_floats), pairs, similarity)


def test_means_are_of_pairs_and_models_side_by_side(spark):
    scores = spark.createDataFrame(
        [("original", 1.0, 0.0, 0.0), ("original", 0.5, 0.5, 0.5), ("finetuned", 1.0, 1.0, 1.0)],
        "model string, precision double, recall double, f1 double",
    )
    means = scoring.mean_prf(scores, "model")
    row = means.where("model = 'original'").first()
    assert (row.precision, row.recall, row.f1, row.n) == (0.75, 0.25, 0.25, 2)
    table = scoring.compare_models(scoring.to_metrics(means, "model", "precision", "f1"))
    assert {tuple(r) for r in table.collect()} == {("precision", 0.75, 1.0), ("f1", 0.25, 1.0)}


DOCS = [[4, 5, 4, 5, 6], [4, 5], [7], [], [4, 4, 4, 4, 9, 4]]
TEST = [[4, 5, 6], [6, 4], [4], [8, 8, 8, 8], [4] * 50]


def id_rows(spark, docs):
    return spark.createDataFrame([(i, d) for i, d in enumerate(docs)], "doc_id long, ids array<int>").repartition(3)


def pair_counts(docs):
    return Counter(p for d in docs for p in zip(d, d[1:]))


def test_ngram_counts_and_merge(spark):
    counts = ngram.fit_ngram(id_rows(spark, DOCS))
    assert {(r.a, r.b): r.n for r in counts.collect()} == pair_counts(DOCS)
    merged = ngram.merge_ngram(counts, ngram.fit_ngram(id_rows(spark, TEST)))
    assert {(r.a, r.b): r.n for r in merged.collect()} == pair_counts(DOCS) + pair_counts(TEST)


@pytest.mark.parametrize("piece", [1, 3, 1 << 22])
@pytest.mark.parametrize("kind", ["int", "long"])
def test_a_task_counts_its_pairs_in_pieces(spark, monkeypatch, piece, kind):
    monkeypatch.setattr(ngram, "PIECE", piece)
    docs = [*DOCS, None, [None, 4, None, None, 5], [4, None], [None]]
    df = spark.createDataFrame([(d,) for d in docs], f"ids array<{kind}>").coalesce(1)
    found = ngram.fit_ngram(df)
    assert [f.dataType.simpleString() for f in found.schema] == [kind if kind == "int" else "bigint"] * 2 + ["bigint"]
    # a pair without a first element is none, one without a second is counted
    assert {(r.a, r.b): r.n for r in found.collect()} == pair_counts(DOCS) + Counter({(4, None): 2})
    # no count before the shuffle holds all pairs of a task
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" in plan and "Aggregate" not in plan[plan.index("Exchange") : plan.index("MapInArrow")]
    assert ngram.fit_ngram(df.limit(0)).collect() == []


@pytest.mark.parametrize("hot_share", [1_000, 1, 4])
@pytest.mark.parametrize("context", [1024, 3])
def test_document_loss(spark, monkeypatch, hot_share, context):
    monkeypatch.setattr(ngram, "HOT_SHARE", hot_share)
    counts, size, k = pair_counts(DOCS), 10, 0.5
    before = Counter()
    for (a, _), n in counts.items():
        before[a] += n
    found = ngram.document_loss(
        id_rows(spark, TEST), ngram.fit_ngram(id_rows(spark, DOCS)), size, context=context, k=k
    )
    rows = {r.doc_id: (r.loss, r.n) for r in found.collect()}
    expected = {}
    for i, doc in enumerate(TEST):
        cut = doc[:context]
        steps = list(zip(cut, cut[1:]))
        if steps:
            losses = [-math.log((counts[s] + k) / (before[s[0]] + k * size)) for s in steps]
            expected[i] = (pytest.approx(sum(losses) / len(losses)), len(cut))
    assert rows == expected


def test_perplexity_weights_by_length(spark):
    losses = spark.createDataFrame([(1.0, 2), (3.0, 6)], "loss double, n int")
    assert ngram.corpus_ppl(losses).first().ppl == pytest.approx(math.exp(20 / 8))
    assert ngram.corpus_ppl(losses.where("n > 9")).first().ppl is None


def test_paragraph_pairs_and_candidates(spark):
    long = "x " * 2000
    rows = [
        (0, "t0", "a\n\nb", "en"),
        (1, "t1", "a\n\nb\n\nc d", "en"),
        (2, "t2", f"{long}\n\nb", "en"),
        (3, "t3", "solo", "en"),
        (4, "t4", "a\n\nb", "fr"),
    ]
    df = spark.createDataFrame(rows, "ordinal long, title string, body string, lang string")
    pairs = evaluation.paragraph_pairs(df, k=4)
    found = {r.ordinal: r for r in pairs.collect()}
    assert set(found) == {1, 3}
    assert found[1].input == 'The lyrics of "t1":\n\na\n\nb\n' and found[1].reference == "c d"
    assert found[3].input == 'The lyrics of "t3":\n' and found[3].reference == "solo"
    generated = pairs.select(
        "ordinal",
        F.concat("input", F.lit("c d\n\nmore")).alias("original"),
        F.col("input").alias("finetuned"),
    )
    answers = evaluation.attach_candidates(pairs, generated, "ordinal").where("ordinal = 1").first()
    assert (answers.cand_original, answers.cand_finetuned) == ("c d", "")
    whole = evaluation.attach_candidates(pairs, generated, "ordinal", paragraph=False).where("ordinal = 1").first()
    assert whole.cand_original == "c d\n\nmore"
    scored = evaluation.score_models(evaluation.attach_candidates(pairs, generated, "ordinal"), "ordinal")
    one = {r.model: r.f1 for r in scored.where("ordinal = 1").collect()}
    assert one == {"original": 1.0, "finetuned": 0.0}


def test_cut_pairs(spark):
    rows = [(i, f"g{i % 12:02d}", f"第一 行\n\n第{i}行\n末") for i in range(24)] + [(99, "g11", "一行")]
    df = spark.createDataFrame(rows, "id long, artist string, text string")
    found = evaluation.cut_pairs(df, "id").collect()
    assert sorted(r.id for r in found) == [11, 23]
    for r in found:
        assert r.input + r.reference == f"第一，行。第{r.id}行。末" and r.n in (1, 2)
        assert r.n_tokens == len(r.input.replace(str(r.id), "#"))


@pytest.mark.parametrize("broadcast_floats", [40_000_000, 0])
def test_odd_vectors_and_pairs_mean_the_same_on_both_sides_of_the_limit(spark, broadcast_floats):
    table = [("a", [1.0, 0.0]), ("b", None), ("c", [0.8, 0.6]), ("c", [9.0, 9.0]), (None, [1.0, 1.0]), ("d", [0.0, 1.0])]
    vectors = spark.createDataFrame(table, "token string, vector array<float>")
    pairs = [(1, ["a"], ["c"]), (1, ["b"], ["b"]), (1, ["a"], ["b"]), (None, ["d", None], ["c"]), (2, None, ["a"]), (2, [], [])]
    df = spark.createDataFrame(pairs, "id long, cand_tokens array<string>, ref_tokens array<string>")
    out = scoring.match_score(df, vectors, broadcast_floats=broadcast_floats).collect()
    found = sorted(round(r.precision, 6) for r in out)
    assert found == [0.0, 0.0, 0.0, 0.6, 0.8, 1.0]
    wrong = spark.createDataFrame([("a", [1.0]), ("b", [1.0, 2.0])], "token string, vector array<float>")
    with pytest.raises(ValueError):
        scoring.match_score(df, wrong, broadcast_floats=broadcast_floats)


def test_frequent_pair_that_the_counts_lack(spark):
    """A third of the scored pairs is one that was never counted."""
    docs = [[8, 9] * 6 + [4, 5, 6] * 8 for _ in range(60)]
    counts, size = pair_counts(DOCS), 10
    found = ngram.document_loss(id_rows(spark, docs), ngram.fit_ngram(id_rows(spark, DOCS)), size)
    before = Counter()
    for (a, _), n in counts.items():
        before[a] += n
    steps = list(zip(docs[0], docs[0][1:]))
    want = sum(-math.log((counts[s] + 1) / (before[s[0]] + size)) for s in steps) / len(steps)
    assert [r.loss for r in found.collect()] == [pytest.approx(want)] * 60


def test_two_models_in_one_pass(spark):
    one, two = ngram.fit_ngram(id_rows(spark, DOCS)), ngram.fit_ngram(id_rows(spark, TEST))
    both = one.withColumn("model", F.lit("x")).unionByName(two.withColumn("model", F.lit("y")))
    found = {(r.model, r.doc_id): r.loss for r in ngram.document_loss(id_rows(spark, TEST), both, 10, model="model").collect()}
    for name, counts in (("x", one), ("y", two)):
        for r in ngram.document_loss(id_rows(spark, TEST), counts, 10).collect():
            assert found.pop((name, r.doc_id)) == pytest.approx(r.loss)
    assert not found


def test_pairs_without_an_answer_stay(spark):
    pairs = spark.createDataFrame([(1, "in ", "a b"), (2, "in ", "c")], "doc_id long, input string, reference string")
    generated = spark.createDataFrame([(1, "in a b", "in a")], "doc_id long, original string, finetuned string")
    scored = evaluation.score_models(evaluation.attach_candidates(pairs, generated, "doc_id"), "doc_id")
    found = {(r.doc_id, r.model): r.f1 for r in scored.collect()}
    assert found == {(1, "original"): 1.0, (1, "finetuned"): pytest.approx(2 / 3), (2, "original"): 0.0, (2, "finetuned"): 0.0}
