"""Readers for lyrics tables, record and dialogue files, id lists, song trees and prompts.

Spark reads a quoted multi-line CSV file or a JSON array with one task; ``splittable=True`` cuts them in parallel
(see ``cutting``). Read such inputs once and land the result with ``write_table``.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import normalize_newlines
from .cutting import CSV, JSON, cut_records
from .names import unescaped


def _numbered(df: DataFrame) -> DataFrame:
    """Add ``ordinal``: 0.. in order of file name, then place in the file.

    Rows of one input split carry consecutive ids, so a split's rows are counted, the counts of the
    earlier splits are summed (one row per split), and no data row is sorted. Spark decides by the size of
    that table how it meets the rows.
    """
    tagged = df.select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_at"),
        F.monotonically_increasing_id().alias("_row"),
    )
    earlier = Window.orderBy("_file", "_at").rowsBetween(Window.unboundedPreceding, -1)
    splits = (
        tagged.groupBy("_file", "_at")
        .agg(F.count("*").alias("_n"), F.min("_row").alias("_first"))
        .select("_file", "_at", "_first", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    )
    ordinal = (F.col("_start") + F.col("_row") - F.col("_first")).alias("ordinal")
    return tagged.join(splits, ["_file", "_at"]).select(ordinal, *df.columns)


def _split_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """``ordinal`` and fields of quoted multi-line CSV files with headers, read in parallel."""
    text = F.regexp_replace("text", r"\r?\n$", "")
    fields = F.from_csv("_text", F.lit(schema), {"quote": '"', "escape": '"', "multiLine": "true"})
    filled = cut_records(spark, path, CSV).select("ordinal", text.alias("_text")).where(F.col("_text") != "")
    return filled.select("ordinal", fields.alias("_fields")).select("ordinal", "_fields.*")


def _split_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """``ordinal`` and fields of the objects of JSON arrays, read in parallel."""
    bare = F.regexp_replace("text", r"^[\s,\[\x{FEFF}]+", "")
    fields = F.from_json(bare, F.lit(schema)).alias("_fields")
    return cut_records(spark, path, JSON).select("ordinal", fields).select("ordinal", "_fields.*")


def read_lyrics_csv(
    spark: SparkSession,
    path: str,
    title_at: int = 1,
    body_at: int = 3,
    lang_at: int = 4,
    splittable: bool = False,
) -> DataFrame:
    """``ordinal, title, body, lang`` from a CSV with a header and quoted multi-line bodies.

    Columns are found by position. An empty field is missing; the words ``NA`` and ``None`` are text.
    ``ordinal`` follows file name and place in the file. A file is read by one task, unless
    ``splittable`` says that every quote in it follows the quoting rule (quoted fields, doubled quotes
    inside); then a file of any size is read in parallel.
    """
    width = max(title_at, body_at, lang_at) + 1
    schema = ", ".join(f"c{i} string" for i in range(width))
    if splittable:
        rows = _split_csv(spark, path, schema)
    else:
        raw = spark.read.schema(schema).csv(
            path, header=True, multiLine=True, quote='"', escape='"', encoding="UTF-8"
        )
        rows = _numbered(raw)
    places = {"title": title_at, "body": body_at, "lang": lang_at}
    fields = [F.nullif(F.col(f"c{at}"), F.lit("")).alias(name) for name, at in places.items()]
    return rows.select("ordinal", *fields)


def preview(df: DataFrame, n: int = 5, order: str = "ordinal") -> DataFrame:
    """The first ``n`` rows, as a distributed top-k."""
    return df.orderBy(order).limit(n)


def read_json_records(
    spark: SparkSession, path: str, field: str = "output", lines: bool = False, splittable: bool = False
) -> DataFrame:
    """``ordinal`` and one field of every object; a missing field is NULL.

    Files hold JSON arrays of objects; ``lines=True`` reads one object per line, which splits. An array's file is read by
    one task, unless ``splittable`` says that the files are well formed; then a file of any size is read in parallel.
    """
    if splittable and not lines:
        return _split_json(spark, path, f"`{field}` string")
    schema = T.StructType([T.StructField(field, T.StringType())])
    return _numbered(spark.read.schema(schema).json(path, multiLine=not lines, encoding="UTF-8"))


def read_dialogs_json(spark: SparkSession, path: str, lines: bool = False, splittable: bool = False) -> DataFrame:
    """``dialog_id, document_id, content`` with the utterances as an array; files as in :func:`read_json_records`."""
    schema = "dialog_id string, document_id string, content array<string>"
    if splittable and not lines:
        return _split_json(spark, path, schema).drop("ordinal")
    return spark.read.schema(schema).json(path, multiLine=not lines, encoding="UTF-8")


def read_id_list(spark: SparkSession, path: str, name: str = "id") -> DataFrame:
    """One id per line, without surrounding white space of any kind."""
    bare = F.regexp_replace("value", r"(?U)^\s+|\s+$", "")
    return spark.read.text(path).select(bare.alias(name))


def _path_part(index: int) -> Column:
    """A decoded component of the file path, counted from the end."""
    decoded = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    return F.element_at(F.split(decoded, "/"), index)


def _list_songs(root: str):
    """Task function: folder names to the paths of their files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        system, place = fs.FileSystem.from_uri(root)
        for batch in batches:
            for artist in batch.column(0).to_pylist():
                files = system.get_file_info(fs.FileSelector(f"{place}/{artist}"))
                names = [f.base_name for f in files if f.is_file]
                for at in range(0, len(names), 10_000):
                    part = names[at : at + 10_000]
                    yield pa.RecordBatch.from_arrays([pa.array([artist] * len(part), pa.string()), pa.array(part, pa.string())], names=["artist", "name"])

    return run


def _read_songs(root: str, escaped: bool):
    """Task function: files to their texts, in batches of bounded size; ``escaped`` names become values again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        system, place = fs.FileSystem.from_uri(root)

        def packed(rows):
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.string()) for i in range(3)], names=["artist", "name", "value"])

        for batch in batches:
            rows, size = [], 0
            for row in batch.to_pylist():
                with system.open_input_stream(f"{place}/{row['artist']}/{row['name']}") as file:
                    text = file.readall().decode("utf-8", "replace")
                names = row["artist"], row["name"]
                rows.append((*((unescaped(names[0]), unescaped(names[1].removesuffix(".txt"))) if escaped else names), text))
                size += len(text)
                if size > 8 << 20:
                    yield packed(rows)
                    rows, size = [], 0
            if rows:
                yield packed(rows)

    return run


def read_text_tree(spark: SparkSession, root: str, escaped: bool = False) -> DataFrame:
    """``artist, song, text`` from ``root/<artist>/<song>.txt``; files directly under the root are skipped.

    ``escaped`` says that ``write_text_tree`` made the names. For a partition by bytes see ``tree_source``.

    Every file is read, also empty ones and those whose names begin with ``_`` or ``.``, which Spark's own
    listing hides. The driver lists the artists; their songs are listed and read by the tasks.
    """
    from pyarrow import fs

    root = root.rstrip("/")
    system, place = fs.FileSystem.from_uri(root)
    artists = [f.base_name for f in system.get_file_info(fs.FileSelector(place)) if not f.is_file]
    names = spark.createDataFrame([(a,) for a in sorted(artists)], "artist string").repartition("artist")
    files = names.mapInArrow(_list_songs(root), "artist string, name string")
    # a song is dealt by its own name, so that an artist with very many is read by many tasks; their number is given, since
    # names are short and Spark would otherwise join them into one task, which read all texts
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    read = files.repartition(tasks, "artist", "name").mapInArrow(_read_songs(root, escaped), "artist string, name string, value string")
    song = F.col("name") if escaped else F.regexp_replace("name", r"\.txt$", "")
    return read.select("artist", song.alias("song"), normalize_newlines(F.col("value")).alias("text"))


def read_prompts(spark: SparkSession, source: str | list[str]) -> DataFrame:
    """``prompt, text``: one row per file of a path, or per string of a list."""
    if isinstance(source, str):
        return spark.read.text(source, wholetext=True).select(
            _path_part(-1).alias("prompt"), normalize_newlines(F.col("value")).alias("text")
        )
    rows = [(str(i), text) for i, text in enumerate(source)]
    return spark.createDataFrame(rows, "prompt string, text string")
