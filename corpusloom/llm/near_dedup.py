"""MinHash near-duplicates by an LSH forest.

Every distinct shingle set gets a MinHash signature. The forest is a number of orders of the sets, each by
another arrangement of the signature; sets that agree on the first ``DEPTH`` values of an order share a
region of it. A region is sorted by the ``DEEPER`` values that follow, and a set meets the ``NEIGHBOURS`` sets before it and
after it, which have the longest common prefixes; a region of at most ``NEIGHBOURS + 1`` sets is met in full.
However large a region, the work in it is linear. In a crowd of unlinked sets a pair may stand further apart in every order: the
chance of that was simulated (see the README), not bounded. Meetings whose signatures agree enough make clusters, and
inside clusters links are confirmed on whole sets, so the forest only decides who is compared.

Clusters of at most ``BLOCK`` sets are compared in full. Larger ones go through three passes: blocks first; then a few sets that
stand for what each block joined, against those of the largest groups; then every set outside the cluster's
largest group so far against all blocks, so that no link that changes a group is left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import land
from . import words
from .graph import components
from .keyed import look_up

K = 128  # MinHash values of a signature
ORDERS = 24  # sorted orders of the forest
DEPTH = 4  # leading values that make a region: a pair at 0.8 shares none with probability 3e-6
DEEPER = 16  # further values, a byte of each, by which a region is sorted
NEIGHBOURS = 32  # sets before it that a set meets in its region
SIMILAR = 0.6  # estimated similarity that makes a meeting a candidate: 0.8 less 5 standard errors
BLOCK = 256  # sets of a cluster compared at once
COLUMNS = 1 << 14  # shingles of a block compared at once
STAND_INS = 4  # sets that stand for a group of a block in the second pass

SIGNED = "doc_id long, n_shingles long, f1 long, f2 long, bits binary, regions array<long>, deep array<binary>"


def _arrangements() -> np.ndarray:
    """For each order the signature positions it looks at, first to last."""
    rng = np.random.default_rng(80)
    return np.stack([rng.permutation(K)[: DEPTH + DEEPER] for _ in range(ORDERS)])


def _signatures(k: int):
    """Task function: texts to set sizes, 128-bit fingerprints, signature bytes and places in the forest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rng = np.random.default_rng(8)
        salts = rng.integers(0, 1 << 32, K, dtype=np.uint32)
        odds = rng.integers(0, 1 << 31, K, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
        orders = _arrangements()
        for batch in batches:
            ids = batch.column(0)
            for at, n, rows, values in words.shingle_sets(batch.column(1), k):
                sizes = np.bincount(rows, minlength=n)
                filled = np.flatnonzero(sizes)
                begins = np.r_[0, np.cumsum(sizes[filled])][:-1].astype(np.int64)
                prints = np.zeros((2, n), np.uint64)
                sig = np.zeros((n, K), np.uint32)
                if len(filled):
                    for i, salt in enumerate((0x1234567, 0x89ABCDEF)):
                        prints[i, filled] = np.add.reduceat(words.mix(values ^ np.uint64(salt)), begins)
                    short = (values >> np.uint64(32)).astype(np.uint32)
                    for i in range(K):
                        x = (short ^ salts[i]) * odds[i]
                        x ^= x >> np.uint32(16)
                        x *= np.uint32(0x85EBCA6B)
                        x ^= x >> np.uint32(13)
                        sig[filled, i] = np.minimum.reduceat(x, begins)
                regions = np.empty((n, ORDERS), np.uint64)
                deep = np.empty((n, ORDERS, DEEPER), np.uint8)
                for o, places in enumerate(orders):
                    key = np.full(n, o + 1, np.uint64)
                    for p in places[:DEPTH]:
                        key = words.mix(key + sig[:, p])
                    regions[:, o] = key
                    deep[:, o] = sig[:, places[DEPTH:]] & np.uint32(0xFF)
                missing = pa.array(sizes == 0)
                low = (sig & np.uint32(0xFF)).astype(np.uint8)
                flat = pa.FixedSizeBinaryArray.from_buffers(pa.binary(DEEPER), n * ORDERS, [None, pa.py_buffer(deep.tobytes())])
                ends = np.arange(0, n * ORDERS + 1, ORDERS, dtype=np.int32)
                lists = [pa.ListArray.from_arrays(ends, x) for x in (regions.reshape(-1).view(np.int64), flat.cast(pa.binary()))]
                bits = pa.array([row.tobytes() for row in low], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(at, n), pa.array(sizes.astype(np.int64)), pa.array(prints[0].view(np.int64)),
                     pa.array(prints[1].view(np.int64))]
                    + [pa.compute.if_else(missing, pa.scalar(None, x.type), x) for x in (bits, *lists)],
                    names=["doc_id", "n_shingles", "f1", "f2", "bits", "regions", "deep"],
                )

    return run


def shingle_signatures(docs: DataFrame, k: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Size, fingerprint and signature of each text's set of ``k``-word shingles, one row per document."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(_signatures(k), SIGNED)


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by region and deeper values: edges that join all rows that reach each other by near pairs of ``NEIGHBOURS``."""
    carry = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = table if carry is None else pa.concat_tables([carry, table])
        if not table.num_rows:
            continue
        region, rep = (table[c].to_numpy() for c in ("region", "rep"))
        bits = np.frombuffer(b"".join(table["bits"].to_pylist()), np.uint8).reshape(len(rep), K)
        begins = np.flatnonzero(np.r_[True, region[1:] != region[:-1]])
        first = np.repeat(begins, np.diff(np.r_[begins, len(region)]))
        here = np.arange(len(region))
        a, b = [], []
        for back in range(1, NEIGHBOURS + 1):
            right = here[here - back >= first]
            for at in range(0, len(right), 65536):
                y = right[at : at + 65536]
                agree = (bits[y - back] == bits[y]).mean(axis=1)
                # two different values agree in a byte by chance once in 256
                y = y[(agree - 1 / 256) / (1 - 1 / 256) >= SIMILAR]
                a.append(y - back)
                b.append(y)
        if a:
            # only who reaches whom counts: each row and the one before it of its group, so edges stay linear and no row is a hub
            root = _roots(len(region), np.concatenate(a), np.concatenate(b))
            order = np.argsort(root, kind="stable")
            same = root[order[1:]] == root[order[:-1]]
            x, y = rep[order[:-1][same]], rep[order[1:][same]]
            x, y = x[x != y], y[x != y]
            pairs = np.unique(np.stack([np.minimum(x, y), np.maximum(x, y)]), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], names=["a", "b"])
        # the next batch may go on with the last region
        carry = table.slice(max(len(rep) - NEIGHBOURS, int(first[-1])))


def candidate_pairs(sets: DataFrame) -> DataFrame:
    """Distinct pairs ``a < b`` that join all sets which meet in the forest with signatures that agree enough."""
    rows = sets.select("rep", F.posexplode("regions").alias("tree", "region"))
    shared = rows.groupBy("region").agg(F.count("*").alias("n")).where("n > 1").select("region")
    meeting = (
        rows.join(shared, "region", "left_semi")
        .join(sets.select("rep", "bits", "deep"), "rep")
        .select("region", F.element_at("deep", F.col("tree") + 1).alias("deep"), "rep", "bits")
    )
    # dealt by ranges of the whole sort key, so that one region can fill many tasks; what a border cuts is met
    # in the other orders
    parts = sets.sparkSession.conf.get("spark.sql.shuffle.partitions")
    sorted_rows = meeting.repartitionByRange(int(parts), "region", "deep", "rep").sortWithinPartitions("region", "deep", "rep")
    return sorted_rows.mapInArrow(_meet, "a long, b long").distinct()


def linked(rows: np.ndarray, values: np.ndarray, n: int, share: int, left: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Pairs ``i < j`` of ``n`` sets, given as sorted (row, value), with ``100 * common >= share * union``.

    With ``left``, only pairs of one of the first ``left`` sets and one of the others.
    """
    sizes = np.bincount(rows, minlength=n).astype(np.int64)
    _, column, count = np.unique(values, return_inverse=True, return_counts=True)
    shared = count[column] > 1
    number = np.cumsum(count > 1) - 1
    at, column = rows[shared], number[column[shared]]
    order = np.argsort(column, kind="stable")
    at, column = at[order], column[order]
    edge = n if left is None else left
    common = np.zeros((edge, n if left is None else n - left), np.float64)
    for c in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        lo, hi = np.searchsorted(column, [c, c + COLUMNS])
        there = np.zeros((n, min(COLUMNS, int(column[-1]) + 1 - c)), np.float32)
        there[at[lo:hi], column[lo:hi] - c] = 1
        common += there[:edge] @ (there if left is None else there[left:]).T
    common = common.astype(np.int64)
    one, two = sizes[:edge, None], sizes[None, :] if left is None else sizes[None, left:]
    hit = (100 * common >= share * (one + two - common)) & (common > 0)
    i, j = np.nonzero(hit)
    j = j if left is None else j + left
    return (i, j) if left is not None else (i[i < j], j[i < j])


def _roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest index reachable from each of ``n`` indexes."""
    root = np.arange(n)
    while len(i):
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, root[i], low)
        np.minimum.at(new, root[j], low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    return root


def _compare(k: int, share: int):
    """Task function: rows ``job, side, rep, text`` sorted by job to the edges that its links make.

    A job without side 1 compares all its rows with each other; otherwise the others with those of side 1.
    """

    def solve(rep: np.ndarray, side: np.ndarray, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        order = np.argsort(side, kind="stable")
        rep, side, texts = rep[order], side[order], texts.take(pa.array(order))
        parts = [(rows + at, values) for at, _, rows, values in words.shingle_sets(texts, k)]
        rows, values = (np.concatenate([p[x] for p in parts]) for x in (0, 1))
        two = int((side == 1).sum())
        i, j = linked(rows, values, len(rep), share, len(rep) - two if two else None)
        if not two:  # groups are all that counts: one edge for each set is enough
            root = _roots(len(rep), i, j)
            i, j = root[root != np.arange(len(rep))], np.flatnonzero(root != np.arange(len(rep)))
        return rep[i], rep[j]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = None
        for batch in _and_end(batches):
            if batch is not None:
                table = pa.Table.from_batches([batch]).combine_chunks()
                kept = table if kept is None else pa.concat_tables([kept, table])
            if kept is None or not kept.num_rows:
                continue
            job = kept["job"].to_numpy()
            begins = np.flatnonzero(np.r_[True, job[1:] != job[:-1]])
            ends = np.r_[begins[1:], len(job)]
            done = len(begins) if batch is None else len(begins) - 1
            edges = []
            for s, e in zip(begins[:done], ends[:done], strict=True):
                part = kept.slice(s, e - s)
                edges.append(solve(part["rep"].to_numpy(), part["side"].to_numpy(), part["text"].combine_chunks()))
            if edges:
                a, b = (np.concatenate([x[c] for x in edges]) for c in (0, 1))
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])
            kept = kept.slice(begins[-1]) if batch is not None else None

    return run


def _and_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


def _links(jobs: DataFrame, k: int, share: int) -> DataFrame:
    """Edges ``a, b`` of the comparisons in ``jobs`` (``job, side, rep, text``), whose groups are bounded."""
    rows = jobs.select(F.xxhash64("job").alias("job"), F.col("side").cast("int").alias("side"), "rep", "text")
    return rows.repartition("job").sortWithinPartitions("job", "side", "rep").mapInArrow(_compare(k, share), "a long, b long")


def _large_links(members: DataFrame, k: int, share: int) -> DataFrame:
    """Links inside clusters of more than ``BLOCK`` sets; ``members`` has ``rep, root, block, text``."""
    zero = F.lit(0).alias("side")
    first = land(_links(members.select(F.concat_ws("/", "root", "block").alias("job"), zero, "rep", "text"), k, share), "links")
    # a block's links are one from each set to the first of its group
    heads = first.select(F.col("a").alias("group"), F.col("b").alias("rep"))
    named = members.join(heads, "rep", "left").withColumn("group", F.coalesce("group", "rep"))
    grouped = land(named.select("root", "block", "rep", "group"), "groups")

    # second pass: a few sets of each group, in lots, each lot together with sets of the cluster's largest groups
    sizes = grouped.groupBy("root", "group").agg(F.count("*").alias("n"))
    spot = Window.partitionBy("group").orderBy(F.xxhash64("rep"), "rep")
    few = grouped.withColumn("spot", F.row_number().over(spot)).where(F.col("spot") <= STAND_INS).join(sizes, ["root", "group"])
    few = land(few.select("root", "rep", "group", "n", "spot"), "stand-ins")
    first_of = Window.partitionBy("root").orderBy(F.desc("n"), "group", "spot")
    pivots = few.withColumn("at", F.row_number().over(first_of)).where(F.col("at") <= BLOCK).select("root", "rep")
    counts = few.groupBy("root").agg(F.ceil(F.count("*") / BLOCK).alias("lots"))
    lots = few.join(counts, "root").select("root", "rep", F.pmod(F.xxhash64("rep"), F.col("lots")).alias("lot"), zero)
    shown = pivots.join(counts, "root").select("root", "rep", F.explode(F.sequence(F.lit(0).cast("long"), F.col("lots") - 1)).alias("lot"), F.lit(-1).alias("side"))
    # a pivot is in its own lot already
    both = lots.join(pivots, ["root", "rep"], "left_anti").unionByName(shown)
    job = F.concat_ws("/", F.lit("few"), "root", "lot").alias("job")
    second = land(_links(both.join(members.select("rep", "text"), "rep").select(job, "side", "rep", "text"), k, share), "links")

    # third pass: sets outside their cluster's largest group so far, against all blocks of the cluster
    heads = second.groupBy(F.col("b").alias("rep")).agg(F.min("a").alias("head"))
    label = few.join(heads, "rep", "left").groupBy("root", "group", "n").agg(F.min(F.coalesce("head", "rep")).alias("label"))
    label = land(label, "labels")
    volume = label.groupBy("root", "label").agg(F.sum("n").alias("n"))
    main = volume.groupBy("root").agg(F.max_by("label", F.struct("n", -F.col("label"))).alias("main"))
    strays = label.join(main, "root").where("label != main").select("root", "group", "n")
    counts = strays.groupBy("root").agg(F.ceil(F.sum("n") / BLOCK).alias("lots"))
    outside = grouped.join(strays.drop("n"), ["root", "group"]).join(counts, "root")
    outside = outside.select("root", "rep", F.pmod(F.xxhash64("rep", F.lit(3)), F.col("lots")).alias("lot"))
    jobs = counts.select("root", F.explode(F.sequence(F.lit(0).cast("long"), F.col("lots") - 1)).alias("lot"))
    jobs = jobs.join(members.select("root", "block").distinct(), "root")
    job = F.concat_ws("/", F.lit("out"), "root", "lot", "block").alias("job")
    one = outside.join(members.select("rep", "text"), "rep").join(jobs, ["root", "lot"]).select(job, zero, "rep", "text")
    two = members.join(jobs, ["root", "block"]).select(job, F.lit(1).alias("side"), "rep", "text")
    return first.unionByName(second).unionByName(_links(one.unionByName(two), k, share))


def near_duplicates(docs: DataFrame, k: int = 5, share: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, kept``: one row for each row of ``docs``.

    Two documents are linked when ``100 * common >= share * union`` of their sets of distinct ``k``-word shingles
    (fewer words: the whole sequence as one shingle). ``component_id`` is the smallest doc_id a document reaches;
    ``kept`` says that this is its own.

    A NULL or empty text and one without words has no shingles and is linked with nothing. A NULL doc_id cannot
    name a group: such a row is linked with nothing, has a NULL ``component_id`` and is kept. Repeated rows are
    linked like other copies and have the same answer each. An empty table gives an empty result; other columns
    are not looked at, whatever their names.
    """
    signed = land(shingle_signatures(docs, k, doc_id, text), "signatures")
    usable = signed.where("n_shingles > 0 AND doc_id IS NOT NULL")
    # equal sets are one set from here on; the smallest doc_id stands for it
    named = usable.groupBy("f1", "f2", "n_shingles").agg(F.min("doc_id").alias("rep"))
    named = land(named, "sets")
    # a repeated doc_id may name two sets: they are one document and their links meet in it
    key = ["f1", "f2", "n_shingles"]
    sets = look_up(usable, named, key, ["doc_id"]).where(F.col("doc_id") == F.col("rep"))
    sets = sets.select("rep", "bits", "regions", "deep").dropDuplicates(["rep", "bits"])
    pairs = land(candidate_pairs(sets), "meetings")
    clusters = land(components(pairs).withColumnRenamed("node", "rep"), "clusters")
    sizes = clusters.groupBy("root").agg(F.count("*").alias("size"))
    texts = docs.select(F.col(doc_id).cast("long").alias("rep"), F.col(text).alias("text"))
    if not signed.groupBy("doc_id").count().where("doc_id IS NOT NULL AND count > 1").isEmpty():
        # rows that repeat an id and a text are one row before they move
        texts = texts.groupBy("rep", F.xxhash64("text").alias("h1"), F.xxhash64("text", F.lit(1)).alias("h2")).agg(F.min("text").alias("text"))
        texts = texts.select("rep", "text")
    # one plan at every size: clusters grow with the corpus, so they are never sent whole
    members = look_up(clusters, sizes, ["root"], ["rep"]).join(texts.hint("merge"), "rep")
    members = members.withColumn("block", F.pmod(F.xxhash64("rep"), F.ceil(F.col("size") / BLOCK)))
    members = land(members, "members")
    small = members.where(F.col("size") <= BLOCK)
    edges = _links(small.select(F.col("root").alias("job"), F.lit(0).alias("side"), "rep", "text"), k, share)
    large = land(members.where(F.col("size") > BLOCK).select("root", "rep", "block", "text"), "large")
    if not large.isEmpty():
        edges = edges.unionByName(_large_links(large, k, share))
    groups = components(edges).withColumnRenamed("node", "rep")
    answer = named.join(groups, "rep", "left").select("f1", "f2", "n_shingles", F.coalesce("root", "rep").alias("component_id"))
    slim = signed.select("doc_id", *key)
    rows = look_up(slim.where("n_shingles > 0"), answer, key, ["doc_id"])
    rows = rows.unionByName(slim.where("n_shingles = 0").withColumn("component_id", F.lit(None).cast("long")))
    own = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    rows = rows.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), own).alias("component_id"))
    return rows.withColumn("kept", F.coalesce(F.col("component_id") == F.col("doc_id"), F.lit(True)))


def drop_near_duplicates(docs: DataFrame, k: int = 5, share: int = 80) -> DataFrame:
    """``docs`` without the documents that are not kept; of repeated rows one stays. Rows keep all columns."""
    kept = near_duplicates(docs, k, share).where("kept AND doc_id IS NOT NULL").select("doc_id")
    stay = docs.join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return stay.select(*docs.columns).unionByName(docs.where("doc_id IS NULL"))
