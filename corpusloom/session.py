"""Session set-up, scratch locations, and borders that keep costly steps from being repeated."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Token arrays cross to Python in Arrow batches; Spark bounds a batch in bytes, and rows bound it once more:
# 1,000 documents of 20,000 words are about 160 MB.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    # a hold-out of more than a million rows sorts with spill instead of on the driver's heap
    "spark.sql.execution.topKSortFallbackThreshold": "1000000",
}
# folders made inside a ``scratch`` block
_MADE: ContextVar[list[str] | None] = ContextVar("made", default=None)


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    """Apply the engine's settings to a session builder."""
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder for intermediate tables, in the shared place the cluster names.

    The place is ``spark.checkpoint.dir``. Only a local-mode session without that setting gets a
    temporary folder of its own machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        base = tempfile.mkdtemp(prefix="corpusloom-")
    path = f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    if (made := _MADE.get()) is not None:
        made.append(path)
    return path


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Delete a folder that :func:`scratch_dir` gave, when nothing reads it any more."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Intermediate tables made inside the block go when it ends; results must be written or fetched by then."""
    made = _MADE.set([])
    try:
        yield
    finally:
        folders = _MADE.get()
        _MADE.reset(made)
        for path in folders:
            drop_scratch(spark, path)


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a costly column that later filters and steps read without computing it again.

    A projected expression is copied into every filter and generator above it, and those filters sink
    below exchanges to the scan. A one-element generator is the border they do not cross.
    """
    kept = [c for c in df.columns if c != name]
    return df.select(*kept, F.explode_outer(F.array(value)).alias(name))


def land(df: DataFrame, label: str) -> DataFrame:
    """Write a result that several later steps read, and read it back.

    The copy sits in the shared scratch folder, so its lineage ends there and a lost executor costs
    only the tasks it was running.
    """
    path = scratch_dir(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
