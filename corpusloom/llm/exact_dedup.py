"""Exact duplicates by deterministic block naming: integer names for blocks, then for pairs of names, up to one a document.

The normalised text is cut into blocks of a fixed number of bytes. Distinct blocks are sorted into integer
names; then adjacent names of a document are paired and each distinct pair gets a name of its own, level by
level, until one name is left. Two documents have the same (level, name) if and only if their texts are equal:
names never stand for two different blocks or pairs.

Blocks are told apart by two 64-bit marks, so that only the step that finds the distinct blocks moves text.
That the marks name the blocks without collision is checked against the blocks themselves: every mark must
have exactly one block among all distinct (mark, block) rows. If one has two, marks of the next seed are taken.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import land, once
from .keyed import integer_names, look_up

BLOCK = 1_024
# seeds tried for the marks; with 10^12 distinct blocks one seed fails with a chance of about 10^-15
SEEDS = 4
# runs to shorten to one space: single spaces are left as they are
_RUNS = r"[\x20\x09-\x0D]{2,}|[\x09-\x0D]"
_MARKS = ["m1", "m2"]


def normalised(text: Column) -> Column:
    """Each run of spaces, tabs and line breaks as one space; NULL as the empty text."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), _RUNS, " ")


def _blocks(body: Column, block: int) -> Column:
    """The bytes in blocks; the empty text is one empty block."""
    last = F.greatest(F.ceil(F.length(body) / block), F.lit(1)).cast("int") - 1
    return F.transform(F.sequence(F.lit(0), last), lambda i: F.substring(body, i * block + 1, F.lit(block)))


def _marks(piece: Column, seed: int) -> Column:
    return F.struct(*(F.xxhash64(F.lit(2 * seed + i), piece).alias(m) for i, m in enumerate(_MARKS)))


def _marked(bodies: DataFrame, block: int) -> tuple[DataFrame, DataFrame]:
    """Rows with the marks of their blocks, and all distinct marks, for a seed under which no two blocks share one."""
    for seed in range(SEEDS):
        pieces = bodies.select(F.explode(_blocks(F.col("_body"), block)).alias("_block"))
        distinct = pieces.select(_marks(F.col("_block"), seed).alias("_m"), "_block").select("_m.*", "_block").distinct()
        known = land(distinct.groupBy(*_MARKS).agg(F.count("*").alias("_blocks")), "blocks")
        if known.where("_blocks > 1").isEmpty():
            marks = F.transform(_blocks(F.col("_body"), block), lambda b: _marks(b, seed))
            return bodies.withColumn("_marks", marks).drop("_body"), known.select(*_MARKS)
    raise ValueError("no seed tells all blocks apart")


def _renamed(rows: DataFrame, keys: list[str], known: DataFrame | None = None) -> DataFrame:
    """Replace the key columns of the pieces by one integer name."""
    distinct = known if known is not None else land(rows.select(*keys).distinct(), "pairs")
    names = integer_names(distinct, keys, "_name", distinct.count())
    return look_up(rows, names, keys, ["_row", "_place"]).drop(*keys)


def _identities(marked: DataFrame, known: DataFrame) -> DataFrame:
    """(_row, _level, _name): one identity for each document."""
    pieces = marked.select("_row", F.size("_marks").alias("_size"), F.posexplode("_marks").alias("_place", "_m"))
    pieces = land(_renamed(pieces.select("_row", "_size", "_place", "_m.*"), _MARKS, known), "names")
    done, level = None, 0
    while True:
        ended = pieces.where("_size = 1").select("_row", F.lit(level).alias("_level"), "_name")
        done = ended if done is None else done.unionByName(ended)
        pieces = pieces.where("_size > 1")
        if pieces.isEmpty():
            return done
        level += 1
        side = F.col("_place") % 2
        paired = pieces.groupBy("_row", F.floor(F.col("_place") / 2).cast("int").alias("_place")).agg(
            F.ceil(F.first("_size") / 2).cast("int").alias("_size"),
            F.max(F.when(side == 0, F.col("_name"))).alias("_left"),
            # names start at 1: 0 says that there is no right neighbour
            F.coalesce(F.max(F.when(side == 1, F.col("_name"))), F.lit(0)).alias("_right"),
        )
        pieces = land(_renamed(land(paired, "paired"), ["_left", "_right"]), "names")


def _grouped(docs: DataFrame, key: str, text: str, block: int) -> DataFrame:
    """(_row, key, text_sha256, keep_id, group_size, kept) for rows numbered by ``_row``."""
    bodies = once(docs.select("_row", key, text), "_body", normalised(F.col(text)).cast("binary"))
    marked, known = _marked(bodies.select("_row", F.col(key).alias("_key"), "_body", F.sha2("_body", 256).alias("text_sha256")), block)
    marked = land(marked, "marked")
    named = land(_identities(marked.select("_row", "_marks"), known), "identities")
    rows = land(named.join(marked.drop("_marks"), "_row"), "identified")
    # NULL ids come last, equal ids in the order of the rows
    first = F.min(F.struct(F.col("_key").isNull().alias("none"), F.col("_key").alias("key"), F.col("_row").alias("row")))
    groups = rows.groupBy("_level", "_name").agg(F.count("*").alias("group_size"), first.alias("_first"))
    met = look_up(rows, groups, ["_level", "_name"], ["_row"])
    return met.select(
        "_row",
        F.col("_key").alias(key),
        F.col("_first.key").alias("keep_id"),
        "group_size",
        (F.col("_row") == F.col("_first.row")).alias("kept"),
        "text_sha256",
    )


def _numbered(docs: DataFrame, columns: list[str]) -> DataFrame:
    """Rows with a number that later passes see again: scans are numbered by file and place, other input is written first."""
    return docs.select(F.monotonically_increasing_id().alias("_row"), *columns)


def exact_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", block: int = BLOCK) -> DataFrame:
    """The group of every document under equality of its normalised text.

    Returns one row per row of ``docs``: key, keep_id (key of the row that stays), group_size, kept, text_sha256.
    The row with the smallest key stays; of rows that share it one stays, and a NULL key stays only where all
    keys of the group are NULL. A NULL text is the empty text, whose documents are one group. An empty table
    gives no rows. Other columns are not read, whatever their names.
    """
    return _grouped(_numbered(docs, [F.col(key), F.col(text)]), key, text, block).drop("_row")


def drop_exact_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", block: int = BLOCK) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns (a column ``_row`` is not allowed); rules as in :func:`exact_duplicates`."""
    numbered = land(_numbered(docs, docs.columns), "numbered")
    kept = _grouped(numbered, key, text, block).where("kept").select("_row")
    return numbered.join(kept, "_row", "left_semi").drop("_row")
