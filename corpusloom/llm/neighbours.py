"""Approximate nearest neighbours by learned partitions.

On a bounded sample: the exact neighbour graph, a balanced partition of it (halved along its widest directions, then
refined by moving vectors to where most of their neighbours are, within a capacity), and a linear softmax classifier that learns
a vector's part. The classifier then puts every vector into one part, and routes a query to its most probable parts; how
many is the least number that finds ``RECALL`` of the true neighbours inside the sample.

Parts are reranked exactly, in bounded chunks of vectors and lots of queries, so a crowded part is many jobs. Of equal vectors only as many as a
result can hold are compared; the others could never be among the nearest, as ties go to the smaller id.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import land

SAMPLE = 8_192  # vectors expected in the fit; all, if there are fewer
PER_PART = 4_096  # vectors a part should hold
LEAST_PARTS, MOST_PARTS = 8, 256
NEIGHBOURS = 10  # of a vector in the graph
SLACK = 1.1  # a part of the sample may be so many times the mean
RECALL = 0.97  # of true neighbours inside the sample that routing must reach
CHUNK, LOT = 2_048, 512  # vectors and queries of a job


@dataclass(frozen=True)
class Router:
    """Linear classifier over unit vectors, and the number of parts a query visits."""

    weights: np.ndarray
    bias: np.ndarray
    visits: int

    def scores(self, vectors: np.ndarray) -> np.ndarray:
        return _unit(vectors) @ self.weights + self.bias


def _unit(vectors: np.ndarray) -> np.ndarray:
    # scaled first, so that neither very large nor very small components overflow
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def _graph(unit: np.ndarray, k: int) -> np.ndarray:
    """Indexes of the ``k`` nearest others of every vector, nearest first."""
    out = np.empty((len(unit), k), np.int64)
    for at in range(0, len(unit), 1024):
        near = unit[at : at + 1024] @ unit.T
        near[np.arange(len(near)), np.arange(at, at + len(near))] = -np.inf
        top = np.argpartition(-near, k - 1, axis=1)[:, :k]
        order = np.argsort(-np.take_along_axis(near, top, 1), axis=1, kind="stable")
        out[at : at + 1024] = np.take_along_axis(top, order, 1)
    return out


def _balanced(unit: np.ndarray, graph: np.ndarray, parts: int) -> np.ndarray:
    """Part of every vector: few graph edges are cut and no part is much larger than the mean."""
    part = np.zeros(len(unit), np.int64)

    def halve(rows: np.ndarray, first: int, count: int) -> None:
        if count == 1:
            part[rows] = first
            return
        centred = unit[rows] - unit[rows].mean(axis=0)
        _, axes = np.linalg.eigh(centred.T @ centred)
        order = rows[np.argsort(centred @ axes[:, -1], kind="stable")]
        left = count // 2
        cut = len(rows) * left // count
        halve(order[:cut], first, left)
        halve(order[cut:], first + left, count - left)

    halve(np.arange(len(unit)), 0, parts)
    capacity = math.ceil(SLACK * len(unit) / parts)
    for _ in range(20):
        votes = np.zeros((len(unit), parts), np.int64)
        np.add.at(votes, (np.repeat(np.arange(len(unit)), graph.shape[1]), part[graph].reshape(-1)), 1)
        best = votes.argmax(axis=1)
        rows = np.arange(len(unit))
        gain = votes[rows, best] - votes[rows, part]
        sizes, moved = np.bincount(part, minlength=parts), 0
        for i in np.argsort(-gain, kind="stable"):
            if gain[i] <= 0:
                break
            if sizes[best[i]] < capacity:
                sizes[part[i]] -= 1
                sizes[best[i]] += 1
                part[i] = best[i]
                moved += 1
        if moved < len(unit) // 200:
            break
    return part


def _classifier(unit: np.ndarray, part: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Softmax regression by scaled gradient steps over the whole sample."""
    x = np.c_[unit, np.ones(len(unit))]
    w, first, second = (np.zeros((x.shape[1], parts)) for _ in range(3))
    target = np.eye(parts)[part]
    for step in range(1, 201):
        z = x @ w
        p = np.exp(z - z.max(axis=1, keepdims=True))
        g = x.T @ (p / p.sum(axis=1, keepdims=True) - target) / len(x)
        first, second = 0.9 * first + 0.1 * g, 0.99 * second + 0.01 * g * g
        w -= 0.3 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return w[:-1], w[-1]


def fit_router(vectors: np.ndarray, parts: int, recall: float = RECALL) -> Router:
    """A router learnt from a sample of vectors, none of them zero."""
    unit = _unit(vectors)
    parts = max(1, min(parts, len(unit) // 4))
    if parts == 1:
        return Router(np.zeros((vectors.shape[1], 1)), np.zeros(1), 1)
    graph = _graph(unit, min(NEIGHBOURS, len(unit) - 1))
    weights, bias = _classifier(unit, _balanced(unit, graph, parts), parts)
    order = np.argsort(-(unit @ weights + bias), axis=1, kind="stable")
    place = np.argsort(order, axis=1)  # at which visit a vector meets a part
    own = order[:, 0]
    needed = np.take_along_axis(place, own[graph[:, :5]], axis=1)
    share = np.cumsum(np.bincount(needed.reshape(-1), minlength=parts)) / needed.size
    return Router(weights, bias, int(np.searchsorted(share, recall)) + 1)


def usable(vector: Column) -> Column:
    """Neither NULL nor empty nor zero, and without NULL or non-finite components."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(vector, lambda x: x != 0)


def _packed(batches: Iterator[pa.RecordBatch], router: Router, visits: int) -> Iterator[pa.RecordBatch]:
    """``vec_id, parts, v``: the most probable parts, and the vector's doubles as bytes."""
    for batch in batches:
        if not batch.num_rows:
            continue
        x = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(batch.num_rows, -1)
        order = np.argsort(-router.scores(x), axis=1, kind="stable")[:, :visits].astype(np.int32)
        parts = pa.ListArray.from_arrays(np.arange(0, order.size + 1, order.shape[1], dtype=np.int32), order.reshape(-1))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), parts, pa.array([row.tobytes() for row in x], pa.binary())], names=["vec_id", "parts", "v"]
        )


def _nearest(top: int):
    """Task function: rows ``job, side, vec_id, v`` sorted by job (side 0: vectors, 1: queries) to each query's nearest."""

    def solve(rows: pa.Table) -> pa.RecordBatch:
        side, ids = rows["side"].to_numpy(), rows["vec_id"].to_numpy()
        x = np.frombuffer(b"".join(rows["v"].to_pylist()), np.float64).reshape(len(ids), -1)
        norms = np.sqrt((x * x).sum(axis=1))
        q, c = np.flatnonzero(side == 1), np.flatnonzero(side == 0)
        out = ([], [], [])
        if len(q) and len(c):
            near = (x[q] / norms[q, None]) @ (x[c] / norms[c, None]).T
            near[ids[q][:, None] == ids[c][None, :]] = -np.inf
            kth = min(top, len(c)) - 1
            floor = -np.partition(-near, kth, axis=1)[:, kth]
            for i in range(len(q)):
                # the blocked product only shortlists: scores are computed alike wherever a vector stands
                some = c[(near[i] >= floor[i] - 1e-9) & (near[i] > -np.inf)]
                score = (x[some] * x[q[i]]).sum(axis=1) / (norms[some] * norms[q[i]])
                best = np.lexsort((ids[some], -score))[:top]
                out[0].append(np.full(len(best), ids[q[i]]))
                out[1].append(ids[some][best])
                out[2].append(score[best])
        columns = [np.concatenate(o) if o else np.empty(0, t) for o, t in zip(out, (np.int64, np.int64, np.float64), strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(o) for o in columns], names=["query_id", "vec_id", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            kept = table if kept is None else pa.concat_tables([kept, table])
            job = kept["job"].to_numpy()
            begins = np.flatnonzero(np.r_[True, job[1:] != job[:-1]]) if len(job) else np.empty(0, int)
            for s, e in zip(begins[:-1], begins[1:], strict=True):
                yield solve(kept.slice(s, e - s))
            kept = kept.slice(begins[-1]) if len(begins) else kept
        if kept is not None and kept.num_rows:
            yield solve(kept)

    return run


def nearest(
    vectors: DataFrame, is_query: Column, top: int = 5, vec_id: str = "vec_id", vector: str = "embedding", recall: float = RECALL
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``top`` vectors of largest cosine found for each query, itself left out.

    Queries are the rows of ``vectors`` where ``is_query`` holds. NULL ids, NULL or zero vectors and those with NULL or non-finite
    components take no part, nor do vectors of another length than the most frequent one. A repeated id with equal
    vectors counts once. Ties go to the smaller id. An empty table gives an empty result; other columns are not looked at.
    """
    spark = vectors.sparkSession
    schema = "query_id long, rank int, vec_id long, score double"
    rows = vectors.select(
        F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"), is_query.alias("is_query")
    ).where(F.col("vec_id").isNotNull() & usable(F.col("v")))
    lengths = rows.groupBy(F.size("v").alias("length")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "length").first()
    if lengths is None:
        return spark.createDataFrame([], schema)
    rows = rows.where(F.size("v") == lengths["length"])
    # equal vectors: the smallest ids are enough, one more than a result holds as a query leaves itself out
    same = Window.partitionBy("h1", "h2").orderBy("vec_id")
    hashed = rows.select("vec_id", "v", F.xxhash64("v").alias("h1"), F.hash("v").alias("h2"))
    few = hashed.withColumn("spot", F.dense_rank().over(same)).where(F.col("spot") <= top + 1).dropDuplicates(["h1", "h2", "vec_id"])
    few = land(few.select("vec_id", "v"), "vectors")
    count = few.count()
    share = int(min(1.0, SAMPLE / count) * (1 << 30))
    chosen = few.where(F.pmod(F.xxhash64("vec_id", F.lit(2)), F.lit(1 << 30)) <= share).orderBy("vec_id").select("v").toArrow()
    sample = chosen["v"].combine_chunks()
    sample = np.unique(sample.flatten().to_numpy(zero_copy_only=False).reshape(len(chosen), -1), axis=0)
    router = fit_router(sample, min(max(math.ceil(count / PER_PART), LEAST_PARTS), MOST_PARTS), recall)
    packed = "vec_id long, parts array<int>, v binary"
    stored = few.mapInArrow(lambda batches: _packed(batches, router, 1), packed).select("vec_id", F.col("parts")[0].alias("part"), "v")
    stored = land(stored, "parts")
    asked = rows.where("is_query").select("vec_id", "v").dropDuplicates(["vec_id"])
    asked = land(asked.mapInArrow(lambda batches: _packed(batches, router, router.visits), packed).select("vec_id", F.explode("parts").alias("part"), "v"), "queries")
    # one row a part: at most MOST_PARTS
    chunks = stored.groupBy("part").agg(F.ceil(F.count("*") / CHUNK).alias("chunks"))
    lots = asked.groupBy("part").agg(F.ceil(F.count("*") / LOT).alias("lots"))
    plan = F.broadcast(chunks.join(lots, "part"))

    def spread(number: Column) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), number - 1))

    def hashed_to(number: Column) -> Column:
        return F.pmod(F.xxhash64("vec_id"), number)

    left = stored.join(plan, "part").withColumn("chunk", hashed_to(F.col("chunks"))).withColumn("lot", spread(F.col("lots")))
    right = asked.join(plan, "part").withColumn("lot", hashed_to(F.col("lots"))).withColumn("chunk", spread(F.col("chunks")))
    job = F.xxhash64("part", "chunk", "lot").alias("job")
    jobs = left.select(job, F.lit(0).alias("side"), "vec_id", "v").unionByName(right.select(job, F.lit(1).alias("side"), "vec_id", "v"))
    found = jobs.repartition("job").sortWithinPartitions("job").mapInArrow(_nearest(top), "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.distinct().select("query_id", rank.cast("int").alias("rank"), "vec_id", "score").where(F.col("rank") <= top)
