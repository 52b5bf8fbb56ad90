"""Sinks and example counts."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .names import escaped

ROWS_PER_FILE = 1_000_000


def write_table(df: DataFrame, path: str, partitions: int | None = None, mode: str = "errorifexists") -> None:
    """Land a dataset as Parquet. ``partitions`` evens out what an unsplittable source left in few tasks."""
    even = df if partitions is None else df.repartition(partitions)
    even.write.mode(mode).option("maxRecordsPerFile", ROWS_PER_FILE).parquet(path)


def write_examples(df: DataFrame, path: str, by: str = "split", mode: str = "errorifexists") -> None:
    """Keep an example set as Parquet, one folder per value of ``by``.

    Rows are written where they are: a split is as large as the data, so it is never gathered first.
    """
    df.write.mode(mode).option("maxRecordsPerFile", ROWS_PER_FILE).partitionBy(by).parquet(path)


def example_count(df: DataFrame, *by: str) -> DataFrame:
    """Number of examples, over all or per group."""
    return df.groupBy(*by).agg(F.count("*").alias("n"))


def write_text_tree(df: DataFrame, root: str, group: str = "artist", name: str = "song", text: str = "text") -> str:
    """One UTF-8 file ``root/<group>/<name>.txt`` for each row, written by the tasks; returns ``root``.

    ``root`` is a folder that all executors reach. Names are escaped (see ``names.escaped``), NULL and empty ones too, and of rows that
    share group and name the second, third, ... carry their number, ordered by text: as many files as rows,
    and the readers with ``escaped=True`` give the same rows back. A NULL text is an empty file. A repeated task writes the same files again.
    """

    def run(batches):
        from pyarrow import fs

        system, place = fs.FileSystem.from_uri(root)
        made = set()
        for batch in batches:
            for row in batch.to_pylist():
                folder = f"{place}/{escaped(row['group'])}"
                if folder not in made:
                    system.create_dir(folder, recursive=True)
                    made.add(folder)
                with system.open_output_stream(f"{folder}/{escaped(row['name'], row['copy'])}.txt") as out:
                    out.write((row["text"] or "").encode())
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["n"])

    columns = [F.col(c).cast("string").alias(n) for c, n in ((group, "group"), (name, "name"), (text, "text"))]
    copy = F.row_number().over(Window.partitionBy("group", "name").orderBy("text"))
    df.select(*columns).withColumn("copy", copy).mapInArrow(run, "n long").agg(F.sum("n")).collect()
    return root
