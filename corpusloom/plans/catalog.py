"""One query per operator over the test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import fixed, text as tx
from ..functions.dialog import extract_reply
from ..functions.tokens import pretokenize, token_count
from ..operators import batches, bootstrap, dialogs, filters, kneser_ney, lengths, ngram, packing, scoring, splits, subwords, vocab
from ..session import land, once, scratch_dir
from ..sources import readers, tree_source, writers
from ..streaming import metrics
from ..streaming.chat import chat_history_stream
from ..streaming.ordered import ordered_turns_stream
from . import evaluation
from .corpora import (
    chat_examples,
    dialog_examples,
    lyrics_examples,
    news_examples,
    song_examples,
    split_report,
    titled_lyrics,
    tokenized,
)
from .tables import load, lyrics, texts

SEED = 7
LINE = fixed.LINE
# rows of one JSON array file or of one text file written for the reader queries
ARRAY_ROWS = 100

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# --- sources and sinks ----------------------------------------------------------------------------


def _lyrics_files(spark, folder):
    """Documents written as quoted multi-line CSV, in document order over the files."""
    path = scratch_dir(spark, "lyrics-csv")
    rows = load(spark, folder, "documents").select(
        F.lit("a").alias("link"),
        F.col("source").alias("title"),
        F.lit("b").alias("other"),
        "text",
        "lang",
        "doc_id",
    )
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id").drop("doc_id")
    ordered.write.csv(
        path, header=True, quote='"', escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    )
    return path


@query
def s1_lyrics_csv(spark, folder):
    return readers.read_lyrics_csv(spark, _lyrics_files(spark, folder))


@query
def s1_lyrics_csv_parallel(spark, folder):
    return readers.read_lyrics_csv(spark, _lyrics_files(spark, folder), splittable=True)


@query
def s2_preview(spark, folder):
    docs = load(spark, folder, "documents").select("doc_id", "lang", "source")
    return readers.preview(docs, 5, "doc_id")


def _write_arrays(rows: DataFrame, order: str, path: str) -> None:
    """JSON array files of up to ARRAY_ROWS neighbouring objects each, built group by group."""
    group = F.floor(F.col(order) / ARRAY_ROWS).alias("file")
    record = F.struct(*[c for c in rows.columns if c != order])
    arrays = rows.groupBy(group).agg(F.sort_array(F.collect_list(F.struct(order, record.alias("r")))).alias("x"))
    # files in the order of their rows
    arrays = arrays.repartitionByRange("file").sortWithinPartitions("file")
    lines = arrays.select(F.to_json("x.r").alias("value"))
    lines.write.option("maxRecordsPerFile", 1).text(path)


def _records(spark, folder, splittable=False):
    path = scratch_dir(spark, "records-json")
    rows = load(spark, folder, "documents").select("doc_id", F.col("text").alias("output"), "lang")
    _write_arrays(rows, "doc_id", path)
    return readers.read_json_records(spark, path, splittable=splittable)


@query
def s3_json_records(spark, folder):
    return _records(spark, folder).select("ordinal", "output")


@query
def s3_json_records_parallel(spark, folder):
    return _records(spark, folder, splittable=True).select("ordinal", "output")


def _dialogs(spark, folder, splittable=False):
    path = scratch_dir(spark, "dialogs-json")
    rows = dialogs.turns_to_dialogs(load(spark, folder, "conversations")).select(
        "conv_id",
        F.col("conv_id").cast("string").alias("dialog_id"),
        F.concat(F.lit("d"), "conv_id").alias("document_id"),
        "content",
    )
    _write_arrays(rows, "conv_id", path)
    return readers.read_dialogs_json(spark, path, splittable=splittable)


@query
def s4_dialogs_json(spark, folder):
    found = _dialogs(spark, folder)
    return found.select("dialog_id", "document_id", F.posexplode("content").alias("turn", "text"))


@query
def s4_dialogs_json_parallel(spark, folder):
    found = _dialogs(spark, folder, splittable=True)
    return found.select("dialog_id", "document_id", F.posexplode("content").alias("turn", "text"))


@query
def s5_id_list(spark, folder):
    path = scratch_dir(spark, "id-list")
    ids = load(spark, folder, "labels").where(F.col("quality") == 1)
    ids.select(F.concat(F.lit("\t"), "doc_id", F.lit(" ")).alias("value")).write.text(path)
    return readers.read_id_list(spark, path)


def _songs(spark, folder, read=readers.read_text_tree):
    """Documents written one per file under a folder per source, and read back."""
    path = scratch_dir(spark, "song-tree")
    rows = load(spark, folder, "documents").select(
        F.col("source").alias("artist"), F.col("doc_id").cast("string").alias("song"), "text"
    )
    return read(spark, writers.write_text_tree(rows, path), escaped=True)


@query
def s6_text_tree(spark, folder):
    return _songs(spark, folder)


@query
def s6_text_tree_source(spark, folder):
    return _songs(spark, folder, tree_source.load_text_tree)


@query
def s7_prompts(spark, folder):
    path = scratch_dir(spark, "prompts")
    load(spark, folder, "benchmark").select("text").write.option("maxRecordsPerFile", 1).text(path)
    return readers.read_prompts(spark, f"{path}/*.txt").select("text")


@query
def s8_write_examples(spark, folder):
    path = scratch_dir(spark, "examples")
    rows = titled_lyrics(lyrics(spark, folder), "doc_id")
    split = F.when(F.col("is_test"), "test").otherwise("train").alias("split")
    writers.write_examples(rows.select("doc_id", "text", split), path)
    return spark.read.parquet(path).select("doc_id", "split", "text")


@query
def s9_example_count(spark, folder):
    rows = splits.tail_holdout(load(spark, folder, "documents"), "doc_id").transform(filters.keep_language, "en")
    split = F.when(F.col("is_test"), "test").otherwise("train")
    return writers.example_count(rows.withColumn("split", split), "split")


# --- filters and splits ---------------------------------------------------------------------------


@query
def f1_language(spark, folder):
    return filters.keep_language(load(spark, folder, "documents"), "en").select("doc_id", "lang")


@query
def f2_nonnull(spark, folder):
    return filters.keep_nonnull(load(spark, folder, "documents"), "text").select("doc_id", "lang")


def _listed(spark, folder):
    return load(spark, folder, "labels").where(F.col("quality") == 1)


@query
def f3_listed(spark, folder):
    return filters.keep_listed(load(spark, folder, "documents"), _listed(spark, folder), "doc_id").select("doc_id")


@query
def f3_unlisted(spark, folder):
    return filters.drop_listed(load(spark, folder, "documents"), _listed(spark, folder), "doc_id").select("doc_id")


@query
def f4_tail_holdout(spark, folder):
    return splits.tail_holdout(load(spark, folder, "documents"), "doc_id").select("doc_id", "is_test")


@query
def f5_group_holdout(spark, folder):
    return splits.group_holdout(load(spark, folder, "documents"), "source").select("doc_id", "role")


@query
def f6_budget(spark, folder):
    counted = once(texts(spark, folder), "n_tokens", token_count(F.col("text")))
    return filters.within_budget(counted).select("doc_id", "n_tokens")


@query
def f7_drop_empty(spark, folder):
    return filters.drop_empty_pairs(load(spark, folder, "documents"), "text", "source").select("doc_id", "lang")


# --- text projections -----------------------------------------------------------------------------


@query
def t1_prompt(spark, folder):
    out = tx.title_prompt(F.col("source"), F.col("text"))
    return load(spark, folder, "documents").select("doc_id", out.alias("out"))


@query
def t2_flatten(spark, folder):
    return load(spark, folder, "documents").select("doc_id", tx.flatten_lines(F.col("text")).alias("out"))


@query
def t3_newlines(spark, folder):
    """Line ends of the documents turned into carriage returns of both kinds, then normalised."""
    mixed = F.concat(F.replace("text", F.lit("\n"), F.lit("\r\n")), F.lit("\r"))
    return load(spark, folder, "documents").select("doc_id", tx.normalize_newlines(mixed).alias("out"))


@query
def t4_segments(spark, folder):
    parts = tx.split_segments(F.col("text"), LINE)
    return load(spark, folder, "documents").select("doc_id", F.posexplode(parts).alias("pos", "segment"))


@query
def t5_last_segment(spark, folder):
    pair = tx.last_segment_pair(F.col("text"), LINE).alias("pair")
    return load(spark, folder, "documents").select("doc_id", pair).select("doc_id", "pair.input", "pair.reference")


@query
def t6_random_cut(spark, folder):
    pair = tx.random_cut_pair(F.col("text"), F.col("doc_id"), LINE, SEED).alias("pair")
    rows = load(spark, folder, "documents").select("doc_id", pair)
    return rows.where(F.col("pair").isNotNull()).select("doc_id", "pair.n", "pair.input", "pair.reference")


@query
def t7_head(spark, folder):
    return load(spark, folder, "documents").select("doc_id", tx.head_segments(F.col("text"), LINE).alias("input"))


def _generated(spark, folder):
    """Input of each document, and a stand-in for generated text: input, reference, blank line, input."""
    pair = tx.last_segment_pair(F.col("text"), LINE).alias("p")
    rows = load(spark, folder, "documents").select("doc_id", pair).select("doc_id", "p.input", "p.reference")
    return rows.withColumn("generated", F.concat("input", "reference", F.lit("\n\n"), "input"))


@query
def t8_strip_prompt(spark, folder):
    out = tx.strip_prompt(F.col("generated"), F.col("input"))
    return _generated(spark, folder).select("doc_id", out.alias("out"))


@query
def t9_first_paragraph(spark, folder):
    answer = tx.strip_prompt(F.col("generated"), F.col("input"))
    return _generated(spark, folder).select("doc_id", tx.first_paragraph(answer).alias("out"))


@query
def t10_strip_spaces(spark, folder):
    return load(spark, folder, "documents").select("doc_id", tx.strip_spaces(F.col("text")).alias("out"))


# --- dialogues ------------------------------------------------------------------------------------


@query
def c1_dialog(spark, folder):
    return dialogs.dialog_strings(load(spark, folder, "conversations"))


@query
def c2_dialogs(spark, folder):
    rows = dialogs.turns_to_dialogs(load(spark, folder, "conversations"))
    return rows.select("conv_id", F.size("content").cast("long").alias("n"), F.array_join("content", "|").alias("out"))


@query
def c2_round_trip(spark, folder):
    return dialogs.dialogs_to_turns(dialogs.turns_to_dialogs(load(spark, folder, "conversations")))


@query
def c3_prompts(spark, folder):
    return dialogs.chat_prompts(load(spark, folder, "conversations"))


@query
def c3_prompts_by_role(spark, folder):
    return dialogs.chat_prompts(load(spark, folder, "conversations"), role="role")


@query
def c3_prompts_in_context(spark, folder):
    """Prompts cut to a context of 200 tokens, which about half of the conversations outgrow."""
    return dialogs.prompts_in_context(load(spark, folder, "conversations"), context=200)


@query
def c4_reply(spark, folder):
    """Each turn with its successor as a decoded exchange; the reply is the part after one end mark."""
    turns = load(spark, folder, "conversations")
    after = turns.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("next"))
    second = F.concat(F.lit(fixed.SPEAKER_2), "next", F.lit(fixed.SEP))
    decoded = F.concat(
        F.lit(fixed.CLS + fixed.SPEAKER_1), "text", F.lit(fixed.SEP), F.coalesce(second, F.lit(""))
    )
    rows = turns.join(after, ["conv_id", "turn"], "left")
    return rows.select("conv_id", "turn", extract_reply(decoded, F.lit(1)).alias("out"))


@query
def c5_history_stream(spark, folder):
    """Conversations replayed as a stream, turn files in order, and the emitted prompts."""
    source, sink, state = (scratch_dir(spark, f"chat-{part}") for part in ("turns", "prompts", "state"))
    turns = load(spark, folder, "conversations").select("conv_id", "turn", "text")
    # the openings of all conversations are written first, then what follows; a conversation's part is in one file,
    # and files are read oldest first, so its turns arrive in order over several batches
    for low, high in ((0, 2), (2, 4), (4, 1 << 62)):
        part = turns.where(F.col("turn").between(low, high - 1))
        part.repartition("conv_id").write.mode("append").parquet(source)
    stream = spark.readStream.schema(turns.schema).option("maxFilesPerTrigger", 4).parquet(source)
    running = (
        chat_history_stream(stream)
        .writeStream.format("parquet")
        .option("path", sink)
        .option("checkpointLocation", state)
        .trigger(availableNow=True)
        .start()
    )
    running.awaitTermination()
    return spark.read.parquet(sink).select("conv_id", "turn", "out", "n_late")


@query
def c5_ordered_stream(spark, folder):
    """Turns that arrive out of order over several batches, put in order by the stream, and the prompts of the result."""
    source, sink, state = (scratch_dir(spark, f"ordered-{part}") for part in ("turns", "out", "state"))
    turns = load(spark, folder, "conversations").select("conv_id", "turn", "text", F.timestamp_seconds(F.col("turn") * 60).alias("at"))
    for part in range(3):
        turns.where(F.pmod(F.xxhash64("conv_id", "turn"), F.lit(3)) == part).write.mode("append").parquet(source)
    stream = spark.readStream.schema(turns.schema).option("maxFilesPerTrigger", 2).parquet(source)
    running = (
        ordered_turns_stream(stream, delay_seconds=86_400)
        .writeStream.format("parquet")
        .option("path", sink)
        .option("checkpointLocation", state)
        .trigger(availableNow=True)
        .start()
    )
    running.awaitTermination()
    return dialogs.chat_prompts(spark.read.parquet(sink).where("NOT is_late"), turn="pos").withColumnRenamed("pos", "turn")


# --- tokens and blocks ----------------------------------------------------------------------------


@query
def k1_tokens(spark, folder):
    tokens = pretokenize(F.col("text"))
    return texts(spark, folder).select("doc_id", F.posexplode(tokens).alias("pos", "token"))


@query
def k2_token_count(spark, folder):
    return texts(spark, folder).select("doc_id", token_count(F.col("text")).alias("n_tokens"))


def _document_vocab(spark, folder):
    # the texts stay behind: a larger vocabulary moves whole rows
    rows = texts(spark, folder).transform(tokenized).drop("text")
    return rows, vocab.build_vocab(rows)


@query
def k3_vocab(spark, folder):
    return _document_vocab(spark, folder)[1].table


def _joined(ids: str):
    return F.array_join(F.transform(ids, lambda i: i.cast("string")), " ")


@query
def k4_ids(spark, folder):
    rows, words = _document_vocab(spark, folder)
    return vocab.encode_ids(rows, words, keep=False).select("doc_id", _joined("ids").alias("out"))


@query
def k5_block(spark, folder):
    rows, words = _document_vocab(spark, folder)
    blocks = vocab.to_blocks(rows, words, reserve=fixed.MARKS, wrap=True)
    return blocks.select(
        "doc_id",
        "n_tokens",
        _joined("input_ids").alias("out"),
        F.aggregate("attention_mask", F.lit(0), lambda a, x: a + x).alias("n_mask"),
    )


@query
def k5_packed(spark, folder):
    """Documents packed into full blocks and read back: every id once, in its place."""
    rows, words = _document_vocab(spark, folder)
    blocks = packing.pack_blocks(vocab.encode_ids(rows, words, keep=False).select("doc_id", "ids"), pad=words.pad)
    parts = packing.unpack_blocks(blocks).groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("part", "ids"))).alias("parts"))
    return parts.select("doc_id", F.size("parts").alias("n_parts"), _joined(F.flatten("parts.ids")).alias("out"))


@query
def k5_chat_block(spark, folder):
    """Every listed conversation as a speaker-tagged block, without a second pair of marks."""
    turns = load(spark, folder, "conversations")
    marks = [*fixed.BASE_TOKENS, *fixed.SPEAKER_TOKENS]
    words = vocab.build_vocab(tokenized(turns, reserved=marks))
    listed = _listed(spark, folder).select(F.col("doc_id").alias("conv_id"))
    blocks = chat_examples(turns, listed, words)
    return blocks.select("conv_id", "n_tokens", _joined("input_ids").alias("out"))


def _block_columns(blocks: DataFrame, key: str) -> DataFrame:
    mask = F.aggregate("attention_mask", F.lit(0), lambda a, x: a + x).alias("n_mask")
    return blocks.select(key, "n_tokens", _joined("input_ids").alias("out"), mask, _joined("labels").alias("labels"))


@query
def lyrics_corpus(spark, folder):
    """CSV to blocks: the training side of the English songs, with titles."""
    rows = land(readers.read_lyrics_csv(spark, _lyrics_files(spark, folder)), "lyrics")
    train = titled_lyrics(rows).where("NOT is_test")
    return _block_columns(lyrics_examples(rows, vocab.build_vocab(train.transform(tokenized)), with_text=False), "ordinal")


@query
def news_corpus(spark, folder):
    """JSON records to blocks."""
    rows = land(_records(spark, folder), "news")
    words = vocab.build_vocab(tokenized(filters.keep_nonnull(rows, "output"), "output"))
    return _block_columns(news_examples(rows, words, with_text=False), "ordinal")


@query
def song_corpus(spark, folder):
    """A tree of text files to blocks: the songs of the training artists, each on one line."""
    rows = land(_songs(spark, folder), "songs")
    flat = rows.select(tx.flatten_lines(F.col("text")).alias("text"))
    return _block_columns(song_examples(rows, vocab.build_vocab(tokenized(flat)), with_text=False), "song_id")


@query
def chat_corpus(spark, folder):
    """JSON dialogues and an id file to blocks, without a second pair of marks."""
    rows = land(_dialogs(spark, folder), "dialogs")
    path = scratch_dir(spark, "chat-ids")
    _listed(spark, folder).select(F.concat(F.lit(" "), "doc_id", F.lit("\t")).alias("value")).write.text(path)
    ids = readers.read_id_list(spark, path, "dialog_id")
    marks = [*fixed.BASE_TOKENS, *fixed.SPEAKER_TOKENS]
    said = rows.select(F.explode("content").alias("text"))
    return _block_columns(dialog_examples(rows, ids, vocab.build_vocab(tokenized(said, reserved=marks))), "dialog_id")


def _piece_table(words: vocab.Vocab, size: int = 1_500):
    """A supplied table of pieces: the most frequent words, their beginnings of 1 to 3 and, inside a word, their endings of 1 to 4 letters."""
    frequent = words.table.where(F.col("id").between(len(fixed.BASE_TOKENS), len(fixed.BASE_TOKENS) + size - 1))
    heads = [F.substring("token", 1, n) for n in (1, 2, 3)]
    tails = [F.concat(F.lit(subwords.INSIDE), F.right(F.col("token"), F.lit(n))) for n in (1, 2, 3, 4)]
    # a few thousand rows at most, whatever the corpus
    pieces = frequent.select(F.explode(F.array("token", *heads, *tails)).alias("token")).distinct()
    place = F.row_number().over(Window.orderBy("token")) + (len(fixed.BASE_TOKENS) - 1)
    marks = words.table.where(F.col("id") < len(fixed.BASE_TOKENS))
    return marks.unionByName(pieces.select(place.alias("id"), "token"))


@query
def k4_subwords(spark, folder):
    """Documents as sub-word ids, the longest piece first."""
    rows, words = _document_vocab(spark, folder)
    pieces = subwords.Pieces.from_table(_piece_table(words))
    return subwords.encode_subwords(rows, pieces).select("doc_id", _joined("ids").alias("out"))


@query
def k4_ids_joined(spark, folder):
    rows, words = _document_vocab(spark, folder)
    words = vocab.Vocab.from_table(land(words.table, "vocab"), limit=0)
    return vocab.encode_ids(rows, words, keep=False).select("doc_id", _joined("ids").alias("out"))


@query
def k6_decode_joined(spark, folder):
    rows, words = _document_vocab(spark, folder)
    large = vocab.Vocab.from_table(land(words.table, "vocab"), limit=0)
    decoded = vocab.decode_ids(vocab.encode_ids(rows, words, keep=False).select("doc_id", "ids"), large, out="out", keep=False)
    return decoded.select("doc_id", "out")


@query
def k6_decode(spark, folder):
    rows, words = _document_vocab(spark, folder)
    decoded = vocab.decode_ids(vocab.encode_ids(rows, words, keep=False).select("doc_id", "ids"), words, out="out", keep=False)
    return decoded.select("doc_id", "out")


@query
def k7_truncation(spark, folder):
    counted = texts(spark, folder).select(token_count(F.col("text")).alias("n_tokens"))
    report = vocab.truncation_report(counted, reserve=fixed.MARKS, wrap=True)
    return report.withColumn("share_over", F.round("share_over", 6))


@query
def k7_length_sketch(spark, folder):
    """Quantiles of the documents' lengths by source, from stored sketches by source and language, and the block that holds 95 % whole."""
    docs = load(spark, folder, "documents").select("source", "lang", token_count(F.col("text")).alias("n_tokens"))
    stored = land(lengths.length_sketch(docs, "source", "lang"), "sketches")
    merged = lengths.merge_sketches(stored, "source")
    found = lengths.sketch_quantiles(merged, [0.5, 0.9, 0.99], "source").groupBy("source").pivot("share", [0.5, 0.9, 0.99]).agg(F.first("length"))
    named = found.select("source", *[F.round(F.col(f"`{s}`"), 6).alias(n) for s, n in ((0.5, "p50"), (0.9, "p90"), (0.99, "p99"))])
    return named.join(lengths.block_for(merged, 0.95, "source"), "source")


# --- batches --------------------------------------------------------------------------------------


@query
def b1_batches(spark, folder):
    return batches.shuffle_batches(load(spark, folder, "documents"), epochs=3, batch_size=4, seed=SEED)


@query
def b2_schedule(spark, folder):
    rows = batches.step_schedule(b1_batches(spark, folder))
    return rows.withColumn("lr", F.round("lr", 12))


@query
def b3_metric_summary(spark, folder):
    """The event stream as a metric log: type is the tag, id the step, a thousand steps an epoch."""
    log = load(spark, folder, "events").select(
        F.col("event_type").alias("tag"),
        F.floor(F.col("event_id") / 1000).alias("epoch"),
        F.col("event_id").alias("step"),
        "value",
    )
    return batches.metric_summary(log, "tag", "epoch").withColumn("avg", F.round("avg", 6))


@query
def b3_metric_stream(spark, folder):
    """The event log arriving in batches, summed up in a ledger."""
    source, ledger, state = (scratch_dir(spark, f"metrics-{part}") for part in ("log", "ledger", "state"))
    log = load(spark, folder, "events").select(
        F.col("event_type").alias("tag"), F.floor(F.col("event_id") / 1000).alias("epoch"), F.col("event_id").alias("step"), "value"
    )
    log.repartition(4, "step").write.parquet(source)
    stream = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 1).parquet(source)
    metrics.summarise_stream(stream, ledger, state, "tag", "epoch", availableNow=True).awaitTermination()
    return metrics.read_summary(spark, ledger, "tag", "epoch").withColumn("avg", F.round("avg", 6))


# --- evaluation -----------------------------------------------------------------------------------


def _encoded_lyrics(spark, folder):
    """English titled documents as ids over the vocabulary of the training side."""
    rows = titled_lyrics(lyrics(spark, folder), "doc_id", sep=LINE).select("doc_id", "is_test", "text")
    rows = rows.transform(tokenized).drop("text")
    words = vocab.build_vocab(rows.where(~F.col("is_test")), added=())
    return vocab.encode_ids(rows, words, keep=False).select("doc_id", "is_test", "ids"), words


def _models(spark, folder):
    """Test documents, vocabulary size, and the counts of a background and of an adapted model.

    Ids are kept as a table: both models and the losses start from them, not from the texts.
    """
    rows, words = _encoded_lyrics(spark, folder)
    rows = land(rows, "ids")
    passages = load(spark, folder, "benchmark").transform(tokenized)
    background = land(ngram.fit_ngram(vocab.encode_ids(passages, words, keep=False)), "background")
    domain = ngram.fit_ngram(rows.where(~F.col("is_test")))
    adapted = land(ngram.merge_ngram(background, domain), "adapted")
    return rows.where(F.col("is_test")), words.size, {"original": background, "finetuned": adapted}


@query
def e1_bigrams(spark, folder):
    rows, _ = _encoded_lyrics(spark, folder)
    return ngram.fit_ngram(rows.where(~F.col("is_test")))


@query
def e2_loss(spark, folder):
    rows, size, models = _models(spark, folder)
    losses = ngram.document_loss(rows, models["finetuned"], size)
    return losses.withColumn("loss", F.round("loss", 6))


def _smoothed(spark, folder):
    """Test documents, and the trigram model of the training side."""
    rows, words = _encoded_lyrics(spark, folder)
    rows = land(rows, "ids")
    return rows.where("is_test"), kneser_ney.fit_kneser_ney(rows.where("NOT is_test"), words.size, order=3)


@query
def e1_kneser_ney(spark, folder):
    grams = _smoothed(spark, folder)[1].grams[3]
    return grams.select(_joined("gram").alias("gram"), F.round("p", 9).alias("p"))


@query
def e2_loss_kneser_ney(spark, folder):
    rows, model = _smoothed(spark, folder)
    return kneser_ney.kneser_ney_loss(rows, model).withColumn("loss", F.round("loss", 6))


def _losses(spark, folder):
    rows, size, models = _models(spark, folder)
    both = [counts.select(F.lit(model).alias("model"), "a", "b", "n") for model, counts in models.items()]
    return ngram.document_loss(rows, both[0].unionByName(both[1]), size, model="model")


def _perplexities(spark, folder):
    return ngram.corpus_ppl(_losses(spark, folder), "model")


@query
def e3_ppl(spark, folder):
    return _perplexities(spark, folder).withColumn("ppl", F.round("ppl", 6))


def _candidates(spark, folder):
    """English test pairs with two stand-in models: one repeats the opening line, one the line before."""
    pairs = evaluation.paragraph_pairs(lyrics(spark, folder), "doc_id", sep=LINE)
    lines = F.split("input", LINE)
    tail = F.concat(F.lit(fixed.PARAGRAPH), "input")
    generated = pairs.select(
        "doc_id",
        F.concat("input", F.get(lines, F.lit(1)), tail).alias("original"),
        F.concat("input", F.element_at(lines, -2), tail).alias("finetuned"),
    )
    return evaluation.attach_candidates(pairs, generated, "doc_id")


@query
def e4_pairs(spark, folder):
    return _candidates(spark, folder).select("doc_id", "input", "reference", "cand_original", "cand_finetuned")


@query
def e4_cut_pairs(spark, folder):
    docs = load(spark, folder, "documents")
    pairs = evaluation.cut_pairs(docs, "doc_id", "source", seed=SEED)
    return pairs.select("doc_id", "n", "input", "reference", "n_tokens")


def _rounded(df: DataFrame) -> DataFrame:
    for name in ("precision", "recall", "f1"):
        df = df.withColumn(name, F.round(name, 6))
    return df


@query
def e5_match(spark, folder):
    return _rounded(evaluation.score_models(_candidates(spark, folder), "doc_id"))


@query
def e5_match_documents(spark, folder):
    """Whole documents: the last line is scored against everything before it."""
    pair = tx.last_segment_pair(F.col("text"), LINE).alias("p")
    rows = texts(spark, folder).select("doc_id", pair).select(
        "doc_id",
        pretokenize(F.col("p.input")).alias("cand_tokens"),
        pretokenize(F.col("p.reference")).alias("ref_tokens"),
    )
    scored = scoring.match_score(rows).select("doc_id", "precision", "recall", "f1")
    return _rounded(scored)


def _token_vectors(spark, folder):
    """The most frequent tokens, each with the embedding of its id."""
    _, words = _document_vocab(spark, folder)
    vectors = load(spark, folder, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    return words.table.join(vectors, "id").select("token", "vector")


@query
def e5_match_vectors(spark, folder):
    vectors = _token_vectors(spark, folder)
    return _rounded(evaluation.score_models(_candidates(spark, folder), "doc_id", vectors=vectors))


@query
def e5_match_vectors_joined(spark, folder):
    vectors = _token_vectors(spark, folder)
    scored = evaluation.score_models(_candidates(spark, folder), "doc_id", vectors=vectors, broadcast_floats=0)
    return _rounded(scored)


@query
def e6_mean(spark, folder):
    return _rounded(scoring.mean_prf(evaluation.score_models(_candidates(spark, folder), "doc_id"), "model"))


@query
def e7_compare(spark, folder):
    means = scoring.mean_prf(evaluation.score_models(_candidates(spark, folder), "doc_id"), "model")
    scores = scoring.to_metrics(means, "model", "precision", "recall", "f1")
    ppl = scoring.to_metrics(_perplexities(spark, folder), "model", "ppl")
    table = scoring.compare_models(scores.unionByName(ppl))
    return table.select("metric", *[F.round(m, 6).alias(m) for m in evaluation.MODELS])


@query
def e7_intervals(spark, folder):
    """Both models and their difference, with 95 % intervals over 200 replicates of the pairs."""
    scores = evaluation.score_models(_candidates(spark, folder), "doc_id")
    one = F.lit(1.0).alias("weight")
    rows = scores.unpivot(["doc_id", "model"], ["precision", "recall", "f1"], "metric", "value").select("*", one)
    loss = _losses(spark, folder).select("doc_id", "model", F.lit("ppl").alias("metric"), F.col("loss").alias("value"), F.col("n").cast("double").alias("weight"))
    means = bootstrap.bootstrap_means(rows.unionByName(loss), replicates=200, seed=SEED)
    return bootstrap.intervals(means).select("metric", "model", *[F.round(c, 6).alias(c) for c in ("value", "low", "high")])


@query
def split_summary(spark, folder):
    return split_report(lyrics(spark, folder), "doc_id", "title", "body")
