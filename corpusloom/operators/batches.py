"""Batch manifest, step schedule and metric log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import fixed


def shuffle_batches(
    df: DataFrame,
    epochs: int = 1,
    batch_size: int = 4,
    seed: int = 0,
    key: str = "doc_id",
    digits: int = 3,
) -> DataFrame:
    """``epoch, step, slot, key``: a fresh repeatable order per epoch, dealt into batches.

    Only the key travels, never the example. The order is that of an MD5 of seed, epoch and key. Its
    first hex ``digits`` name a bucket, rows are ranked inside their bucket, and a running sum over the
    16^digits bucket counts turns that into a global rank. Keys must be unique. The last batch may be short.
    """
    draw = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("epoch").cast("string"), F.col(key).cast("string")))
    rows = (
        df.select(key, F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))).alias("epoch"))
        .withColumn("_draw", draw)
        .withColumn("_bucket", F.substring("_draw", 1, digits))
    )
    earlier = Window.partitionBy("epoch").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        rows.groupBy("epoch", "_bucket")
        .agg(F.count("*").alias("_n"))
        .select("epoch", "_bucket", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"))
    )
    inside = F.row_number().over(Window.partitionBy("epoch", "_bucket").orderBy("_draw", key)) - 1
    return (
        rows.withColumn("_inside", inside)
        .join(offsets, ["epoch", "_bucket"])
        .withColumn("_rank", F.col("_offset") + F.col("_inside"))
        .select(
            "epoch",
            F.expr(f"_rank div {batch_size}").alias("step"),
            (F.col("_rank") % batch_size).cast("int").alias("slot"),
            key,
        )
    )


def step_schedule(manifest: DataFrame, lr: float = fixed.LEARNING_RATE, warmup: int = fixed.WARMUP_STEPS) -> DataFrame:
    """``step, epoch, lr`` of every step of a batch manifest: linear warm-up, then linear decay to zero after the last step.

    Steps are numbered through all epochs. The sizes of the epochs are read off the manifest's own rows; an
    empty manifest has no step.
    """
    steps = manifest.select("epoch", "step").distinct()
    sizes = steps.groupBy("epoch").agg((F.max("step") + 1).alias("_n"))
    before = Window.orderBy("epoch").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("epoch", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    total = F.broadcast(sizes.agg(F.sum("_n").alias("_total")))
    # one row an epoch
    rows = steps.join(F.broadcast(starts), "epoch").join(total).withColumn("step", F.col("_start") + F.col("step"))
    step = F.col("step")
    rising = step / max(1, warmup)
    falling = F.greatest(F.lit(0.0), (F.col("_total") - step) / F.greatest(F.lit(1), F.col("_total") - warmup))
    return rows.select("step", "epoch", (F.when(step < warmup, rising).otherwise(falling) * lr).alias("lr"))


def append_metrics(metrics: DataFrame, path: str) -> None:
    """Append ``run, tag, step, value`` rows to a metric log."""
    metrics.select("run", "tag", "step", "value").write.mode("append").parquet(path)


def metric_summary(metrics: DataFrame, *by: str) -> DataFrame:
    """Count, mean, extremes and last value per group; the last is the one of the highest step."""
    return metrics.groupBy(*by).agg(
        F.count("value").alias("n"),
        F.avg("value").alias("avg"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        F.max_by("value", "step").alias("last"),
    )
