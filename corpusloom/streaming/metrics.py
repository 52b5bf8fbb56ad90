"""A metric log summed up as it arrives, with a ledger of batches so that a replayed one adds nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery


def partial_summary(metrics: DataFrame, *by: str) -> DataFrame:
    """Summary rows that can be added up: count, sum, extremes, and the last value with its step."""
    # of several values at a step the largest is the last; a step without a value has none
    last = F.max(F.when(F.col("value").isNotNull(), F.struct("step", "value"))).alias("last")
    return metrics.groupBy(*by).agg(
        F.count("value").alias("n"), F.sum("value").alias("total"), F.min("value").alias("min"), F.max("value").alias("max"), last
    )


def merged_summary(parts: DataFrame, *by: str) -> DataFrame:
    """``by, n, avg, min, max, last`` from summary rows, as ``batches.metric_summary`` gives it."""
    found = parts.groupBy(*by).agg(
        F.sum("n").alias("n"), F.sum("total").alias("total"), F.min("min").alias("min"), F.max("max").alias("max"), F.max("last").alias("last")
    )
    return found.select(*by, "n", F.try_divide("total", "n").alias("avg"), "min", "max", F.col("last.value").alias("last"))


def write_batch(path: str, *by: str):
    """The step for one batch: its summary goes to the ledger's folder of its number, in place of an earlier try of the same batch."""

    def step(batch: DataFrame, number: int) -> None:
        partial_summary(batch, *by).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return step


def summarise_stream(metrics: DataFrame, path: str, checkpoint: str, *by: str, **trigger) -> StreamingQuery:
    """Sum a stream of metric rows (``by``, step, value) up into the ledger at ``path``; returns the running query.

    A batch that is tried again after a failure replaces what it wrote, so each row counts once. The
    ledger has one small folder a batch: :func:`read_summary` adds them up, :func:`compact` makes them one.
    """
    return metrics.writeStream.foreachBatch(write_batch(path, *by)).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def read_summary(spark: SparkSession, path: str, *by: str) -> DataFrame:
    """The summary of all batches in the ledger."""
    return merged_summary(spark.read.parquet(path).drop("batch"), *by)


def compact(spark: SparkSession, path: str, into: str, *by: str) -> None:
    """The ledger as one table of summary rows that can still be added up; run it on a ledger that is not being written."""
    parts = spark.read.parquet(path)
    sums = parts.groupBy(*by).agg(
        F.sum("n").alias("n"), F.sum("total").alias("total"), F.min("min").alias("min"), F.max("max").alias("max"), F.max("last").alias("last")
    )
    sums.write.mode("overwrite").parquet(f"{into}/batch=-1")
