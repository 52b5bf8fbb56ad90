"""The four training corpora and the split report, as chains of operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.dialog import dialog_text
from ..functions.text import flatten_lines, title_prompt
from ..functions.tokens import pretokenize
from ..operators.dialogs import dialog_strings
from ..operators.filters import keep_language, keep_listed, keep_nonnull
from ..operators.splits import group_holdout, tail_holdout
from ..operators.vocab import Vocab, to_blocks
from ..session import once


def titled_lyrics(
    df: DataFrame,
    order: str = "ordinal",
    title: str = "title",
    body: str = "body",
    lang: str = "en",
    k: int = fixed.TEST_ROWS,
    sep: str = fixed.PARAGRAPH,
    null_policy: str = "literal",
) -> DataFrame:
    """Flag the tail as test, keep one language, write title and body as ``text``.

    The tail is taken before the language filter, so the test side has fewer than ``k`` rows. With
    ``null_policy="drop"`` rows without title or body go; ``"literal"`` writes them as ``nan``.
    """
    kept = tail_holdout(df, order, k).transform(keep_language, lang)
    if null_policy == "drop":
        kept = kept.transform(keep_nonnull, title).transform(keep_nonnull, body)
    elif null_policy != "literal":
        raise ValueError("null_policy is 'literal' or 'drop'")
    return kept.withColumn("text", title_prompt(F.col(title), F.col(body), sep))


def tokenized(df: DataFrame, text: str = "text", lower: bool = True, reserved=()) -> DataFrame:
    """Add ``tokens``, computed once."""
    return once(df, "tokens", pretokenize(F.col(text), lower, reserved))


def _tokens(rows: DataFrame, with_text: bool) -> DataFrame:
    found = tokenized(rows)
    return found if with_text else found.drop("text")


def lyrics_examples(
    df: DataFrame, vocab: Vocab, order: str = "ordinal", block: int = fixed.BLOCK, with_text: bool = True, **options
) -> DataFrame:
    """Titled lyrics of the training side, as blocks; without ``with_text`` a larger vocabulary moves no texts."""
    rows = titled_lyrics(df, order, **options).where(~F.col("is_test"))
    return to_blocks(_tokens(rows.select(order, "text"), with_text), vocab, block=block)


def news_examples(
    df: DataFrame,
    vocab: Vocab,
    field: str = "output",
    key: str = "ordinal",
    block: int = fixed.BLOCK,
    reserve: int = fixed.MARKS,
    with_text: bool = True,
) -> DataFrame:
    """News bodies that are present, wrapped in opening and closing marks.

    The block is first shortened by ``reserve`` for the marks, and the marks then stand inside it.
    """
    rows = keep_nonnull(df, field).select(key, F.col(field).alias("text"))
    return to_blocks(_tokens(rows, with_text), vocab, block=block, reserve=reserve, wrap=True)


def chat_examples(
    turns: DataFrame,
    ids: DataFrame,
    vocab: Vocab,
    conv: str = "conv_id",
    block: int = fixed.BLOCK,
    reserve: int = fixed.MARKS,
    role: str | None = None,
) -> DataFrame:
    """Listed conversations as speaker-tagged strings, in blocks.

    ``reserve`` shortens the block by the marks a tokenizer would add, though none are added here. Every
    turn is at least two tokens, its tag and its end mark, so turns past half the block are cut off
    in any case and a very long conversation is never gathered whole.
    """
    strings = dialog_strings(keep_listed(turns, ids, conv), conv, role=role, first_turns=block // 2 + 1)
    marks = [*fixed.BASE_TOKENS, *fixed.SPEAKER_TOKENS]
    return to_blocks(tokenized(strings, "out", reserved=marks), vocab, block=block, reserve=reserve)


def dialog_examples(
    dialogs: DataFrame,
    ids: DataFrame,
    vocab: Vocab,
    key: str = "dialog_id",
    content: str = "content",
    block: int = fixed.BLOCK,
    reserve: int = fixed.MARKS,
) -> DataFrame:
    """Listed dialogues given as arrays of utterances, in blocks as by :func:`chat_examples`, without a shuffle.

    A dialogue without utterances is its opening mark alone.
    """
    listed = keep_listed(dialogs, ids, key)
    # every utterance is at least two tokens, so later ones are cut off in any case
    first = F.slice(F.coalesce(F.col(content), F.array()), 1, block // 2 + 1)
    strings = listed.select(key, dialog_text(first).alias("out"))
    marks = [*fixed.BASE_TOKENS, *fixed.SPEAKER_TOKENS]
    return to_blocks(tokenized(strings, "out", reserved=marks), vocab, block=block, reserve=reserve)


def song_examples(
    df: DataFrame,
    vocab: Vocab,
    group: str = "artist",
    key: str = "song",
    text: str = "text",
    block: int = fixed.BLOCK,
    reserve: int = fixed.MARKS,
    k_train: int = fixed.HELD_OUT_GROUPS,
    k_eval: int = fixed.EVALUATED_GROUPS,
    with_text: bool = True,
) -> DataFrame:
    """Flattened songs of the training groups, wrapped, in blocks shortened by ``reserve`` as for news."""
    rows = group_holdout(df, group, k_train, k_eval).where(F.col("role") == "train")
    song_id = F.concat_ws("/", group, key).alias("song_id")
    flat = rows.select(group, key, song_id, flatten_lines(F.col(text)).alias("text"))
    return to_blocks(_tokens(flat, with_text), vocab, block=block, reserve=reserve, wrap=True)


def split_report(df: DataFrame, order: str, title: str, body: str, k: int = fixed.TEST_ROWS) -> DataFrame:
    """Usable training and test examples and their tokens."""
    rows = titled_lyrics(df, order, title, body, k=k).select("is_test", "text").transform(tokenized)
    split = F.when(F.col("is_test"), "test").otherwise("train")
    return rows.groupBy(split.alias("split")).agg(
        F.count("*").alias("n"), F.sum(F.size("tokens").cast("long")).alias("n_tokens")
    )
