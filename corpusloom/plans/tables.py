"""The test tables, as the shapes the operators expect."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def lyrics(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as a lyrics table: the document id is the ordinal, the source the title."""
    docs = load(spark, folder, "documents")
    return docs.select("doc_id", F.col("source").alias("title"), F.col("text").alias("body"), "lang")


def texts(spark: SparkSession, folder: str) -> DataFrame:
    return load(spark, folder, "documents").select("doc_id", "text")
