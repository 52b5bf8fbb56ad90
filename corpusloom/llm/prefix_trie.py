"""Prefix trie of conversations, built as a burst trie.

A conversation is a string of turn ids of equal width, so sorting strings sorts conversations turn by turn. Equal
conversations are counted before anything else. A container holds the suffixes under one trie head. A container
of more than ``LIMIT`` distinct suffixes bursts: the turns that all its members share become a chain of nodes
below the head, and the members move to one new container for each next turn id. A round bursts all oversized
containers at once; what remains is sorted and swept into nodes, one container after another. The chains above
the containers are summed up from the last round to the first.

Conversations longer than ``SEGMENT`` turns are cut. Each later segment is a member of a trie of its own, known by
all turns before it, so that no conversation has to fit into one row or task. What such a trie adds to the
subtrees above it is summed along its smallest member, once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from ..session import land
from .keyed import look_up

SEGMENT, LIMIT = 256, 1_024
# conversation c starts with turns of conversation c - c % FAMILY, at most MOST_HEAD - 1 of them
FAMILY, MOST_HEAD = 5, 9
# a turn id: the digest of role and text in 32 hexadecimal digits, then the bytes of the text in 8
_DIGEST, _ID = 32, 40
_COPIES = 10_000
_IDS_A_STRING = 4_096
_NO_ENDS = hashlib.sha256(b"").hexdigest()

_OUT = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
    "ends_sha256 string, _box string, _from string, _trie string"
)
_ARROW_OUT = pa.schema([(c.split()[0], pa.string() if c.endswith("string") else pa.int64()) for c in _OUT.split(", ")])
RESULT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def head_turns(conv: Column) -> Column:
    """How many turns a conversation takes from the first of its family."""
    return (F.crc32(conv.cast("string").cast("binary")) % MOST_HEAD).cast("int")


def _turn_id(role: Column, text: Column) -> Column:
    # the length of the role tells where it ends
    digest = F.md5(F.concat_ws(":", F.length(role).cast("string"), role, text).cast("binary"))
    return F.concat(digest, F.lpad(F.hex(F.octet_length(text)), _ID - _DIGEST, "0"))


def placed_turns(turns: DataFrame, chunk: int = SEGMENT) -> DataFrame:
    """(conv_id, _at, _turn): turn ids with their places from 0, by turn number (NULL first), then turn id.

    Equal rows are counted before they move. A place is the rank in a chunk of turn numbers plus the rows of all
    chunks before; a crowded chunk is cut again by turn number and start of the id, so that neither a long
    conversation nor one turn number with many texts is sorted by one task.
    """
    conv, turn = F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn")
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    slim = turns.where(F.col("conv_id").isNotNull()).select(conv, turn, _turn_id(role, text).alias("_turn"))
    # NULL first: a chunk of its own below all others
    box = F.coalesce(F.floor(F.col("turn") / chunk).cast("decimal(20,0)"), F.lit(str(-(10**19))).cast("decimal(20,0)"))
    counted = land(slim.groupBy("conv_id", "turn", "_turn").agg(F.count("*").alias("_n")).withColumn("_chunk", box), "turns")
    crowded = land(counted.groupBy("conv_id", "_chunk").agg(F.count("*").alias("_c")).where(F.col("_c") > 8 * chunk), "crowded")
    fine = F.lit("")
    if not crowded.isEmpty():
        counted = look_up(counted, crowded, ["conv_id", "_chunk"], ["_turn"])
        number = F.lpad((F.coalesce(F.col("turn"), F.lit(0)).cast("decimal(20,0)") + F.lit(str(2**63)).cast("decimal(20,0)")).cast("string"), 21, "0")
        fine = F.when(F.col("_c").isNotNull(), F.concat(number, F.substring("_turn", 1, 3))).otherwise("")
    counted = counted.withColumn("_fine", fine)
    boxes = counted.groupBy("conv_id", "_chunk", "_fine").agg(F.sum("_n").alias("_rows"))
    earlier = Window.partitionBy("conv_id").orderBy("_chunk", "_fine").rowsBetween(Window.unboundedPreceding, -1)
    boxes = boxes.withColumn("_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0))).drop("_rows")
    inside = Window.partitionBy("conv_id", "_chunk", "_fine").orderBy(F.col("turn").asc_nulls_first(), "_turn")
    ranked = counted.withColumn("_upto", F.sum("_n").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    start = (F.col("_before") + F.col("_upto") - F.col("_n")).alias("_start")
    met = ranked.join(boxes, ["conv_id", "_chunk", "_fine"]).select("conv_id", "_turn", "_n", start)
    lots = met.withColumn("_lot", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1, F.lit(_COPIES).cast("long"))))
    last = F.least(F.col("_lot") + _COPIES, F.col("_n")) - 1
    places = F.sequence(F.col("_start") + F.col("_lot"), F.col("_start") + last)
    return lots.select("conv_id", F.explode(places).alias("_at"), "_turn")


def rebuilt(turns: DataFrame, chunk: int = SEGMENT) -> tuple[DataFrame, DataFrame]:
    """Turns of the rebuilt conversations (conv_id, _at, _turn, _total), and all conversations with their ``_total``."""
    placed = land(placed_turns(turns, chunk), "placed")
    lengths = land(placed.groupBy("conv_id").agg(F.count("*").alias("_own")), "lengths")
    first = F.col("conv_id") - F.col("conv_id") % FAMILY
    head = head_turns(F.col("conv_id"))
    families = lengths.where(F.col("conv_id") % FAMILY == 0).select(F.col("conv_id").alias("_first"), F.col("_own").alias("_theirs"))
    taken = F.least(head.cast("long"), F.coalesce("_theirs", F.lit(0)))
    rest = F.greatest(F.col("_own") - head, F.lit(0))
    convs = lengths.withColumn("_first", first).join(families, "_first", "left")
    convs = land(convs.select("conv_id", taken.alias("_taken"), (taken + rest).alias("_total")), "conversations")
    own = look_up(placed.where(F.col("_at") >= head), convs, ["conv_id"], ["_at"])
    own = own.select("conv_id", (F.col("_at") - head + F.col("_taken")).alias("_at"), "_turn", "_total")
    heads = placed.where((F.col("conv_id") % FAMILY == 0) & (F.col("_at") < MOST_HEAD - 1))
    steps = F.array(*(F.try_add(F.col("conv_id"), F.lit(i).cast("long")) for i in range(1 - FAMILY, FAMILY)))
    members = heads.select(F.col("conv_id").alias("_first"), "_at", "_turn", F.explode(steps).alias("conv_id"))
    members = members.where((first == F.col("_first")) & (F.col("_at") < head))
    given = members.join(convs, "conv_id").select("conv_id", "_at", "_turn", "_total")
    return own.unionByName(given), convs.select("conv_id", "_total")


def _segments(turns: DataFrame, convs: DataFrame, segment: int) -> DataFrame:
    """(conv_id, _seg, _total, _path): at most ``segment`` turn ids in one string; a conversation without turns has an empty one."""
    cut = turns.groupBy("conv_id", F.floor(F.col("_at") / segment).alias("_seg"))
    held = cut.agg(F.max("_total").alias("_total"), F.sort_array(F.collect_list(F.struct("_at", "_turn"))).alias("_turns"))
    path = F.array_join(F.transform("_turns", lambda t: t["_turn"]), "").alias("_path")
    empty = convs.where("_total = 0").select("conv_id", F.lit(0).cast("long").alias("_seg"), "_total", F.lit("").alias("_path"))
    return held.select("conv_id", "_seg", "_total", path).unionByName(empty)


def _with_tries(segments: DataFrame, segment: int) -> DataFrame:
    """Add ``_trie``, which names all turns before the segment, and ``_next``, that of the segment after it (NULL: the last one)."""
    long = segments.where(F.col("_total") > segment)
    short = segments.where(F.col("_total") <= segment).withColumns({"_trie": F.lit(""), "_next": F.lit(None).cast("string")})
    marks = [F.xxhash64(F.lit(i), "_seg", "_path").cast("decimal(38,0)").alias(f"_m{i}") for i in range(2)]
    upto = Window.partitionBy("conv_id").orderBy("_seg").rowsBetween(Window.unboundedPreceding, 0)
    sums = [F.sum(f"_m{i}").over(upto) for i in range(2)]
    ended = long.select("conv_id", "_seg", *marks)
    named = ended.select("conv_id", "_seg", F.concat_ws(":", F.col("_seg") + 1, *(s.cast("string") for s in sums)).alias("_next"))
    before = named.select("conv_id", (F.col("_seg") + 1).alias("_seg"), F.col("_next").alias("_trie"))
    goes_on = (F.col("_seg") + 1) * segment < F.col("_total")
    both = long.join(named, ["conv_id", "_seg"]).join(before, ["conv_id", "_seg"], "left")
    both = both.withColumns({"_trie": F.coalesce("_trie", F.lit("")), "_next": F.when(goes_on, F.col("_next"))})
    return short.unionByName(both.select(short.columns))


def _joined_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of at most ``_IDS_A_STRING`` sorted ids of one key as one string."""
    schema = pa.schema([("_key", pa.string()), ("_first", pa.int64()), ("_ids", pa.string())])
    key, ids = None, []

    def run():
        return pa.RecordBatch.from_pylist([{"_key": key, "_first": ids[0], "_ids": ",".join(map(str, ids))}], schema)

    done = []
    for batch in batches:
        for k, conv in zip(batch.column("_key").to_pylist(), batch.column("conv_id").to_pylist()):
            if ids and (k != key or len(ids) == _IDS_A_STRING):
                done.append(run())
                ids = []
            key = k
            ids.append(conv)
            if len(done) == 256:
                yield from pa.Table.from_batches(done).combine_chunks().to_batches()
                done = []
    if ids:
        done.append(run())
    if done:
        yield from pa.Table.from_batches(done).combine_chunks().to_batches()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each key's strings, which come in order; one state is held."""
    schema = pa.schema([("_key", pa.string()), ("_sha", pa.string())])
    key, state = None, None
    for batch in batches:
        found = []
        for k, ids in zip(batch.column("_key").to_pylist(), batch.column("_ids").to_pylist()):
            if k == key:
                state.update(b"," + ids.encode())
                continue
            if state is not None:
                found.append({"_key": key, "_sha": state.hexdigest()})
            key, state = k, hashlib.sha256(ids.encode())
        if found:
            yield pa.RecordBatch.from_pylist(found, schema)
    if state is not None:
        yield pa.RecordBatch.from_pylist([{"_key": key, "_sha": state.hexdigest()}], schema)


def _end_digests(members: DataFrame) -> DataFrame:
    """(_key, _sha) over the conversations that end at each key, ids ascending.

    Ids are sorted by ranges of (key, id) and joined to strings there, so a crowded key is cut over many tasks; one task then
    runs through a key's strings.
    """
    ended = members.where(F.col("_next").isNull()).select("_key", "conv_id")
    ranged = ended.repartitionByRange("_key", "conv_id").sortWithinPartitions("_key", "conv_id")
    strings = ranged.mapInArrow(_joined_ids, "_key string, _first long, _ids string")
    return strings.repartition("_key").sortWithinPartitions("_key", "_first").mapInArrow(_digests, "_key string, _sha string")


@F.pandas_udf(IntegerType())
def _shared(low: pd.Series, high: pd.Series) -> pd.Series:
    """Number of turn ids at which two paths begin alike."""

    def common(a: str, b: str) -> int:
        least, most = 0, min(len(a), len(b)) // _ID
        while least < most:
            middle = (least + most + 1) // 2
            if a[: middle * _ID] == b[: middle * _ID]:
                least = middle
            else:
                most = middle - 1
        return least

    return pd.Series([common(a, b) for a, b in zip(low, high)], dtype="int32")


def _size(path: str, depth: int) -> int:
    """Bytes of the text of the turn at ``depth`` (the root has none)."""
    return int(path[depth * _ID - (_ID - _DIGEST) : depth * _ID], 16) if depth else 0


class _Node:
    __slots__ = ("conv", "n", "kids", "leaves", "saved", "goes_on", "sha", "rows", "size")

    def __init__(self, size: int):
        self.conv, self.n, self.kids, self.leaves, self.saved = None, 0, 0, 0, 0
        self.goes_on, self.sha, self.rows, self.size = False, _NO_ENDS, [], size


def _sweep(batches: Iterator[pa.RecordBatch], segment: int) -> Iterator[pa.RecordBatch]:
    """Nodes of containers whose entries come sorted by (_box, _path); only one container is held."""
    box, stack, path, base, at = None, [], "", 0, {}
    out: list[tuple] = []

    def close(depth: int) -> None:
        while len(stack) > depth:
            node = stack.pop()
            saved = node.saved + (node.n - 1) * node.size
            leaves = node.leaves if node.kids or node.goes_on else 1
            place = base + len(stack)
            top = not stack
            below = node.conv
            if top and at["_from"] is None and at["_trie"]:
                # the node above another segment's trie is part of the segment before
                below = at["_up"]
            out.extend((*row[:2], below, *row[3:]) for row in node.rows)
            marks = (at["_box"], at["_from"], at["_trie"]) if top else (None, None, None)
            row = (node.conv, at["_seg"] * segment + place, at["_up"], node.n, node.kids, leaves, saved, node.sha, *marks)
            if top:
                out.append(row)
            else:
                above = stack[-1]
                above.conv = node.conv if above.conv is None else min(above.conv, node.conv)
                above.n += node.n
                above.kids += 1
                above.leaves += leaves
                above.saved += saved
                above.rows.append(row)

    def full() -> pa.RecordBatch:
        columns = [pa.array(c, t) for c, t in zip(zip(*out), _ARROW_OUT.types)]
        out.clear()
        return pa.RecordBatch.from_arrays(columns, schema=_ARROW_OUT)

    for batch in batches:
        for entry in batch.to_pylist():
            depth = len(entry["_path"]) // _ID
            if entry["_box"] != box:
                close(0)
                box, at, base, path = entry["_box"], entry, entry["_depth"], entry["_path"]
                stack.append(_Node(_size(path, base)))
            else:
                same, most = base, min(depth, len(path) // _ID)
                while same < most and path[same * _ID : (same + 1) * _ID] == entry["_path"][same * _ID : (same + 1) * _ID]:
                    same += 1
                close(same - base + 1)
                path = entry["_path"]
            stack.extend(_Node(_size(path, d)) for d in range(base + len(stack), depth + 1))
            node = stack[-1]
            node.conv = entry["conv_id"] if node.conv is None else min(node.conv, entry["conv_id"])
            node.n += entry["_n"]
            node.sha = entry["_sha"] or _NO_ENDS
            node.goes_on = entry["_next"] is not None
            node.kids += entry["_kids"]
            node.leaves += entry["_leaves"]
            node.saved += entry["_saved"]
        if len(out) >= 10_000:
            yield full()
    close(0)
    if out:
        yield full()


def _chain(batches: Iterator[pa.RecordBatch], segment: int) -> Iterator[pa.RecordBatch]:
    """Nodes between the head of a burst container and the turn at which its members part."""
    for batch in batches:
        out = []
        for burst in batch.to_pylist():
            saved = burst["_saved"]
            for depth in range(burst["_shared"], burst["_depth"] - 1, -1):
                saved += (burst["_n"] - 1) * _size(burst["_low"], depth)
                last, top = depth == burst["_shared"], depth == burst["_depth"]
                # the node above another segment's trie is no part of the chain: its first node hangs below ``_up``
                foreign = burst["_from"] is None and burst["_trie"] and depth == burst["_depth"] + 1
                marks = (burst["_box"], burst["_from"], burst["_trie"]) if top else (None, None, None)
                parent = burst["_up"] if top or foreign else burst["conv_id"]
                sha = burst["_sha"] if last and burst["_sha"] else _NO_ENDS
                kids = burst["_kids"] if last else 1
                out.append((burst["conv_id"], burst["_seg"] * segment + depth, parent, burst["_n"], kids, burst["_leaves"], saved, sha, *marks))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), _ARROW_OUT.types)], schema=_ARROW_OUT)


def _box_of(path: Column) -> Column:
    return F.md5(F.concat_ws("/", "_trie", path).cast("binary"))


def _burst_and_sweep(entries: DataFrame, segment: int, limit: int) -> DataFrame:
    """All nodes below and at the heads of the tries of ``entries``; rows with ``_box`` are tops of containers."""
    none = F.lit(None).cast("string")
    active = entries.withColumns({"_depth": F.lit(0), "_from": none, "_box": _box_of(F.lit(""))})
    small, bursts = None, []
    while True:
        stats = active.groupBy("_box").agg(
            F.count("*").alias("_entries"),
            F.min("_path").alias("_low"),
            F.max("_path").alias("_high"),
            F.min("conv_id").alias("conv_id"),
            F.sum("_n").alias("_n"),
            *(F.min(c).alias(c) for c in ("_depth", "_from", "_up", "_trie", "_seg")),
        )
        big = stats.where(F.col("_entries") > limit).withColumn("_shared", _shared("_low", "_high"))
        big = land(big, "burst")
        if big.isEmpty():
            small = active if small is None else small.unionByName(active)
            break
        # children of the top of a later segment's trie hang below a node of the segment before
        foreign = F.col("_from").isNull() & (F.col("_trie") != "") & (F.col("_shared") == 0)
        parents = big.select("_box", "_shared", F.when(foreign, F.col("_up")).otherwise(F.col("conv_id")).alias("_above"))
        moved = land(look_up(active, parents, ["_box"], ["_path"]), "moved")
        kept = moved.where("_shared IS NULL").select(active.columns)
        small = kept if small is None else small.unionByName(kept)
        length = F.length("_path") / _ID
        # an entry that ends where its container parts gives its digest to that node
        ends = moved.where(length == F.col("_shared")).select("_box", "_sha")
        bursts.append(big.join(ends, "_box", "left"))
        further = moved.where(length > F.col("_shared"))
        depth = F.col("_shared") + 1
        step = {"_depth": depth, "_from": F.col("_box"), "_up": F.col("_above"), "_box": _box_of(F.substring(F.col("_path"), F.lit(1), depth * _ID))}
        active = further.withColumns(step).select(active.columns)
    ordered = small.repartition("_box").sortWithinPartitions("_box", "_path")
    nodes = land(ordered.mapInArrow(lambda batches: _sweep(batches, segment), _OUT), "swept")
    tops = nodes.where("_box IS NOT NULL")
    for burst in reversed(bursts):
        below = tops.where("_from IS NOT NULL").groupBy(F.col("_from").alias("_box"))
        below = below.agg(F.count("*").alias("_kids"), F.sum("n_leaves").alias("_leaves"), F.sum("saved_tokens").alias("_saved"))
        chain = land(burst.join(below, "_box").mapInArrow(lambda batches: _chain(batches, segment), _OUT), "chain")
        nodes = nodes.unionByName(chain)
        tops = tops.unionByName(chain.where("_box IS NOT NULL"))
    return nodes


def _carried(members: DataFrame, nodes: DataFrame) -> DataFrame:
    """For each later segment's trie: its children, and leaves and saved bytes of everything below its top, later segments included."""
    tops = nodes.where("_box IS NOT NULL AND _from IS NULL AND _trie <> ''")
    tops = tops.select("_trie", F.col("conv_id").alias("_owner"), F.col("n_children").alias("_kids"), "n_leaves", "saved_tokens")
    later = land(look_up(members.where("_seg > 0").select("conv_id", "_seg", "_trie"), tops, ["_trie"], ["conv_id"]), "later")
    mine = F.col("conv_id") == F.col("_owner")
    after = Window.partitionBy("conv_id").orderBy(F.col("_seg").desc()).rowsBetween(Window.unboundedPreceding, 0)
    sums = [F.sum(F.when(mine, F.col(c)).otherwise(0)).over(after).alias(n) for c, n in (("n_leaves", "_leaves"), ("saved_tokens", "_saved"))]
    along = later.select("_trie", "_kids", *sums)
    return along.groupBy(F.col("_trie").alias("_next")).agg(F.max("_kids").alias("_kids"), F.sum("_leaves").alias("_leaves"), F.sum("_saved").alias("_saved"))


def conversation_trie(turns: DataFrame, segment: int = SEGMENT, limit: int = LIMIT) -> DataFrame:
    """One row for each node of the prefix trie over the rebuilt conversations of ``turns`` (conv_id, turn, role, text).

    Every conversation c takes its first h turns from conversation c - c % 5 (h: crc32 of its id modulo 9; all
    if there are fewer, none if there is no such conversation) and goes on with its own turns after the first h.
    Turns are ordered by number, NULL first, and within a number by the digest of role and text; repeated rows are
    turns of their own. A NULL role or text is empty. Rows without a conversation id are left out. A conversation without
    turns is a member of the root. An empty table has no nodes. Other columns are not read.

    Columns: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens (UTF-8 bytes of texts
    that a member's first place in the trie saves the others, over the subtree), ends_sha256 (ids that end here).
    """
    rows, convs = rebuilt(turns.select("conv_id", "turn", "role", "text"), segment)
    segments = land(_segments(rows, convs, segment), "segments")
    key = F.md5(F.concat_ws("/", "_trie", "_path").cast("binary"))
    members = land(_with_tries(segments, segment).withColumn("_key", key), "members")
    counted = members.groupBy("_trie", "_seg", "_path", "_key").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("_n"), F.max("_next").alias("_next"))
    entries = counted.join(_end_digests(members), "_key", "left").drop("_key")
    zero = {"_up": F.lit(None).cast("long"), **{c: F.lit(0).cast("long") for c in ("_kids", "_leaves", "_saved")}}
    entries = land(entries.withColumns(zero), "entries")
    later = entries.where("_seg > 0")
    if not later.isEmpty():
        extra = _carried(members, _burst_and_sweep(later, segment, limit))
        above = entries.where("_next IS NOT NULL").select(F.col("_next").alias("_trie"), F.col("conv_id").alias("_up"))
        plain = [c for c in entries.columns if c not in ("_up", "_kids", "_leaves", "_saved")]
        entries = look_up(entries.select(plain), above, ["_trie"], ["_path"])
        going_on = entries.where("_next IS NOT NULL").join(extra, "_next")
        ending = entries.where("_next IS NULL").withColumns({c: F.lit(0).cast("long") for c in ("_kids", "_leaves", "_saved")})
        entries = land(ending.unionByName(going_on), "linked")
    nodes = _burst_and_sweep(entries, segment, limit)
    return nodes.where("NOT coalesce(_box IS NOT NULL AND _from IS NULL AND _trie <> '', false)").select(RESULT)
