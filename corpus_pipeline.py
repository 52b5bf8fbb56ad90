"""From raw documents to token files: five stages, each a function of (spark, docs, sf_dir).

Every stage takes NULLs in any column, empty texts, repeated rows and tables without rows, which give results without rows;
what it does with them is in its docstring. Columns beside those of documents pass through all stages but the last.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.llm import decontaminate, mixing, near_dedup, quality, token_files
from corpusloom.llm.queries import TOKENIZER, table
from corpusloom.session import land, scratch_dir

DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality model does not reject.

    A NULL or empty text has no features and is judged by the thresholds alone; repeated rows are judged alike. Without
    ratings, or with one grade only, nothing is rejected.
    """
    model = quality.fit_ordinal(docs, quality.graded_labels(table(spark, sf_dir, "labels")))
    return quality.keep_best(docs, model)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity 0.8.

    The smallest id stays, once where rows repeat it. Texts without words are copies of nothing, and rows without an id all stay.
    """
    return near_dedup.drop_near_duplicates(docs, k=5, share=80)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark.

    NULL and empty texts hold none, NULL and empty items are in no document; repeated rows are judged alike.
    """
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources brought to equal weight by whole copies of documents, in random order.

    A NULL source is a source like others, one without bytes goes. Repeated rows and NULL ids draw like any id.
    """
    return mixing.poisson_mix(docs).select(*docs.columns)


def tokenized(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files in a random order of all copies, and what they hold by document.

    NULL and empty texts are an end id alone; rows without an id are told apart by their texts.
    """
    # copies of a document are told apart by number, so that they do not stand together; rows without an id are many documents
    shown = F.xxhash64("text")
    copy = F.row_number().over(Window.partitionBy("doc_id", shown).orderBy("doc_id"))
    name = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("text "), shown))
    order = F.md5(F.concat_ws(":", F.lit(mixing.SEED), F.lit("order"), name, "_copy"))
    files = token_files.write_tokens(
        docs.withColumn("_copy", copy), scratch_dir(spark, "tokens"), public_tokenizers.path(TOKENIZER), order_by=[order, F.col("_copy")]
    )
    return token_files.read_tokens(files)


STAGES = [
    ("quality classifier", good_quality),
    ("MinHash near-dedup", one_of_each),
    ("benchmark decontamination", without_benchmark),
    ("mixing sources to target weights", mixed),
    ("token-ID / binary output", tokenized),
]

# the model, the sketches and the tokenizer are beyond SQL; tests hold the stages after the first against plain loops,
# and the first against ratings that it was not fitted on
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages one after another, each result written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = land(stage(spark, docs, sf_dir), name.split()[0])
    return STAGES[-1][1](spark, docs, sf_dir)
