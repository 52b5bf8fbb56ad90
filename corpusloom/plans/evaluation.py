"""Evaluation pairs, candidates joined to them, and the two measures per model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.text import first_paragraph, flatten_lines, last_segment_pair, random_cut_pair, strip_prompt
from ..functions.tokens import pretokenize, token_count
from ..operators.filters import within_budget
from ..operators.scoring import BROADCAST_FLOATS, match_score
from ..operators.splits import group_holdout
from ..session import once
from .corpora import titled_lyrics

MODELS = ("original", "finetuned")


def _in_budget(rows: DataFrame, new: int, context: int) -> DataFrame:
    """Count input tokens once, keep what leaves room for ``new`` more."""
    counted = once(rows, "n_tokens", token_count(F.col("input")))
    return within_budget(counted, "n_tokens", new, context)


def paragraph_pairs(
    df: DataFrame,
    order: str = "ordinal",
    title: str = "title",
    body: str = "body",
    lang: str = "en",
    k: int = fixed.TEST_ROWS,
    sep: str = fixed.PARAGRAPH,
    new: int = fixed.NEW_TOKENS,
    context: int = fixed.CONTEXT,
) -> DataFrame:
    """``order, input, reference, n_tokens`` of the test rows: everything but the last segment, and it."""
    rows = titled_lyrics(df, order, title, body, lang, k, sep).where(F.col("is_test"))
    pair = last_segment_pair(F.col("text"), sep).alias("pair")
    return _in_budget(rows.select(order, pair).select(order, "pair.*"), new, context)


def cut_pairs(
    df: DataFrame,
    key: str,
    group: str = "artist",
    text: str = "text",
    k_train: int = fixed.HELD_OUT_GROUPS,
    k_eval: int = fixed.EVALUATED_GROUPS,
    seed: int = 0,
    new: int = fixed.NEW_TOKENS,
    context: int = fixed.CONTEXT,
) -> DataFrame:
    """``key, n, input, reference, n_tokens`` of the evaluated groups, flattened and cut at random."""
    rows = group_holdout(df, group, k_train, k_eval).where(F.col("role") == "eval")
    flat = flatten_lines(F.col(text))
    pair = random_cut_pair(flat, F.col(key), seed=seed).alias("pair")
    cut = rows.select(key, pair).where(F.col("pair").isNotNull()).select(key, "pair.*")
    return _in_budget(cut, new, context)


def attach_candidates(
    pairs: DataFrame,
    generated: DataFrame,
    key: str,
    models: Sequence[str] = MODELS,
    paragraph: bool = True,
) -> DataFrame:
    """Join generated texts by key and turn each model's column into ``cand_<model>``.

    The prompt is cut off the front; with ``paragraph`` only the text before the first blank line stays.
    A pair without an answer stays, with a NULL candidate, which scores 0.
    """
    rows = pairs.join(generated.select(key, *models), key, "left")
    for model in models:
        answer = strip_prompt(F.col(model), F.col("input"))
        rows = rows.withColumn(f"cand_{model}", first_paragraph(answer) if paragraph else answer)
    return rows.drop(*models)


def score_models(
    pairs: DataFrame,
    key: str,
    models: Sequence[str] = MODELS,
    vectors: DataFrame | None = None,
    broadcast_floats: int = BROADCAST_FLOATS,
) -> DataFrame:
    """``key, model, precision, recall, f1`` for every pair and model."""
    answers = F.explode(
        F.array(*[F.struct(F.lit(m).alias("model"), F.col(f"cand_{m}").alias("cand")) for m in models])
    )
    rows = pairs.select(key, pretokenize(F.col("reference")).alias("ref_tokens"), answers.alias("answer")).select(
        key,
        "answer.model",
        "ref_tokens",
        pretokenize(F.col("answer.cand")).alias("cand_tokens"),
    )
    scored = match_score(rows, vectors, broadcast_floats=broadcast_floats)
    return scored.select(key, "model", "precision", "recall", "f1")
