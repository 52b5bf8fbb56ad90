"""Physical properties the operators promise."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import functions as F

from corpusloom.functions.tokens import pretokenize
from corpusloom.operators import scoring, vocab
from corpusloom.plans.catalog import QUERIES
from corpusloom.plans.corpora import titled_lyrics, tokenized
from corpusloom.plans.tables import lyrics, texts
from corpusloom.session import land, scratch


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_tokens_are_computed_once_under_filters_and_generators(spark, sf_small):
    rows = texts(spark, sf_small).transform(tokenized)
    counted = vocab.token_counts(rows.where(F.size("tokens") > 3))
    assert physical(counted).count("regexp_replace") == 1


def test_encoding_and_exact_scores_do_not_shuffle(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text")
    rows = tokenized(docs)
    words = vocab.build_vocab(rows, size=50)
    assert "Exchange" not in physical(vocab.to_blocks(rows, words, wrap=True))
    none = F.array().cast("array<string>")
    pairs = docs.select("doc_id", pretokenize(F.col("text")).alias("cand_tokens"), none.alias("ref_tokens"))
    assert "Exchange" not in physical(scoring.match_score(pairs))


def test_test_split_prunes_at_the_scan(spark, sf_small):
    rows = titled_lyrics(lyrics(spark, sf_small), "doc_id", k=20).where("is_test").select("text")
    plan = physical(rows)
    assert "EqualTo(lang,en)" in plan and "GreaterThanOrEqual(doc_id,ScalarSubquery" in plan
    assert "n_chars" not in plan


def test_no_query_deals_rows_round_robin(spark, sf_small):
    for name in ("split_summary", "k2_token_count", "e4_pairs", "e5_match_documents"):
        assert "RoundRobin" not in physical(QUERIES[name](spark, sf_small))


def test_scratch_tables_go_with_their_block(spark):
    with scratch(spark):
        table = land(spark.range(5), "kept")
        path = table.inputFiles()[0]
        assert table.count() == 5
    assert not Path(path.removeprefix("file://")).exists()
    assert land(spark.range(5), "kept").count() == 5


def test_prompts_read_the_turns_once(spark, sf_small):
    plan = physical(QUERIES["c3_prompts"](spark, sf_small))
    assert plan.count("Exchange hashpartitioning") <= 4 and plan.count("FileScan") == 1
