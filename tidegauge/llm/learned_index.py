"""Approximate nearest neighbours by learned partitions.

A neighbour graph of a sample is cut into balanced parts; a small classifier learns from it
which parts hold a vector's neighbours. Every vector is stored under its most probable part,
every query visits its several most probable parts, and what it meets there is ranked exactly.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.llm.common import stored

#: Vectors that the partition is learned from; all vectors are indexed.
SAMPLE = 8192
#: Parts: one per so many sampled vectors, a power of two up to PARTS.
PER_PART, PARTS = 256, 32
NEIGHBOURS = 16
#: Recall on sampled queries that sets the number of parts visited.
AIM = 0.95
#: Candidates and queries that one task compares.
CANDIDATE_BLOCK, QUERY_BLOCK = 20_000, 2_000


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """Rows of the k nearest other rows by inner product."""
    out = np.empty((len(x), k), dtype=np.int64)
    for at in range(0, len(x), 1024):
        near = x[at:at + 1024] @ x.T
        near[np.arange(len(near)), at + np.arange(len(near))] = -np.inf
        out[at:at + 1024] = np.argpartition(-near, k - 1, axis=1)[:, :k]
    return out


def _bisect(edges: np.ndarray, n: int, rng) -> np.ndarray:
    """Halves of n nodes with few edges between: smooth a random vector over the graph, cut at the median, exchange."""
    a, b = edges
    degree = np.bincount(a, minlength=n) + np.bincount(b, minlength=n) + 1.0
    v = rng.standard_normal(n)
    for _ in range(60):
        v -= (v * degree).sum() / degree.sum()
        v = (v + np.bincount(a, v[b], n) + np.bincount(b, v[a], n)) / degree
        v /= np.abs(v).max() or 1.0
    side = np.zeros(n, dtype=bool)
    side[np.argsort(v, kind="stable")[n // 2:]] = True
    for _ in range(20):  # exchange the nodes that gain most, as many from either half
        cross = (side[a] != side[b]) * 2.0 - 1.0
        gain = np.bincount(a, cross, n) + np.bincount(b, cross, n)
        one, two = np.flatnonzero(side), np.flatnonzero(~side)
        one, two = one[np.argsort(-gain[one])], two[np.argsort(-gain[two])]
        m = min(len(one), len(two))
        take = np.flatnonzero(gain[one[:m]] + gain[two[:m]] > 0)[:max(1, n // 50)]
        if not len(take):
            break
        before = (side[a] != side[b]).sum()
        side[one[take]], side[two[take]] = False, True
        if (side[a] != side[b]).sum() >= before:
            side[one[take]], side[two[take]] = True, False
            break
    return side


def balanced_parts(graph: np.ndarray, parts: int, seed: int = 7) -> np.ndarray:
    """A part for each node, all parts of equal size up to one; parts is a power of two."""
    rng = np.random.default_rng(seed)
    label = np.zeros(len(graph), dtype=np.int64)
    a, b = np.repeat(np.arange(len(graph)), graph.shape[1]), graph.reshape(-1)
    count = 1
    while count < parts:
        for part in range(count):
            nodes = np.flatnonzero(label == part)
            number = np.full(len(graph), -1)
            number[nodes] = np.arange(len(nodes))
            inside = (number[a] >= 0) & (number[b] >= 0)
            side = _bisect((number[a[inside]], number[b[inside]]), len(nodes), rng)
            label[nodes[side]] += count
        count *= 2
    return label


@dataclass
class Router:
    """Two-layer classifier from a vector to parts."""

    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray
    visits: int = 1

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.maximum(x @ self.w1 + self.b1, 0) @ self.w2 + self.b2


def _train_router(x: np.ndarray, target: np.ndarray, hidden: int = 128, epochs: int = 20, seed: int = 7) -> Router:
    rng = np.random.default_rng(seed)
    d, parts = x.shape[1], target.shape[1]
    p = [rng.standard_normal((d, hidden)) * np.sqrt(2 / d), np.zeros(hidden), rng.standard_normal((hidden, parts)) * np.sqrt(1 / hidden), np.zeros(parts)]
    m, s, t = [np.zeros_like(q) for q in p], [np.zeros_like(q) for q in p], 0
    for epoch in range(epochs):
        order = rng.permutation(len(x))
        rate = 3e-3 * (1 - epoch / epochs) + 1e-4
        for at in range(0, len(x), 256):
            i = order[at:at + 256]
            h = np.maximum(x[i] @ p[0] + p[1], 0)
            z = h @ p[2] + p[3]
            q = np.exp(z - z.max(axis=1, keepdims=True))
            dz = (q / q.sum(axis=1, keepdims=True) - target[i]) / len(i)
            dh = (dz @ p[2].T) * (h > 0)
            t += 1
            for k, g in enumerate((x[i].T @ dh, dh.sum(0), h.T @ dz, dz.sum(0))):
                m[k] = 0.9 * m[k] + 0.1 * g
                s[k] = 0.999 * s[k] + 0.001 * g * g
                p[k] -= rate * (m[k] / (1 - 0.9**t)) / (np.sqrt(s[k] / (1 - 0.999**t)) + 1e-8)
    return Router(*p)


def learn(sample: np.ndarray, aim: float = AIM) -> Router:
    """Router of a sample, with the number of visits that reaches `aim` on queries it was not trained on."""
    x = sample.astype(np.float64)
    held = np.arange(len(x)) % 8 == 7 if len(x) >= 8 else np.zeros(len(x), dtype=bool)
    base = x[~held]
    parts = 1
    while parts < PARTS and parts * 2 * PER_PART <= len(base):
        parts *= 2
    if parts == 1:
        d = x.shape[1] if x.ndim == 2 else 0
        return Router(np.zeros((d, 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1))
    graph = neighbour_graph(base, min(NEIGHBOURS, len(base) - 1))
    label = balanced_parts(graph, parts)
    target = np.zeros((len(base), parts))
    for k in range(graph.shape[1]):
        target[np.arange(len(base)), label[graph[:, k]]] += 1
    target[np.arange(len(base)), label] += 4  # the own part, so that vectors are stored where they lie
    router = _train_router(base, target / target.sum(axis=1, keepdims=True))
    place = router.logits(base).argmax(axis=1)
    near = np.argpartition(-(x[held] @ base.T), 19, axis=1)[:, :20]
    rank = np.argsort(np.argsort(-router.logits(x[held]), axis=1), axis=1)
    visit = np.take_along_axis(rank, place[near], axis=1)
    router.visits = next((t for t in range(1, parts) if (visit < t).mean() >= aim), parts)
    return router


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v) of vectors of the commonest length that are not NULL or zero and hold finite numbers only."""
    v = F.col(f"`{vector_col}`").cast("array<double>")
    good = F.size(v) > 0
    good &= ~F.exists(v, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf"))) & F.exists(v, lambda e: e != 0)
    out = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.when(good, v).alias("v")).filter("id is not null and v is not null")
    lengths = out.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    return out.filter(F.size("v") == (lengths[0]["d"] if lengths else 0))


def _matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(column.flatten()).reshape(len(column), -1)


def _route(shared, visits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                logits = shared.value.logits(_matrix(batch.column(1)))
                best = np.argsort(-logits, axis=1, kind="stable")[:, :visits]
                take = np.repeat(np.arange(batch.num_rows), best.shape[1])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(best.reshape(-1).astype(np.int32)), *(c.take(pa.array(take)) for c in batch.columns)], names=["part", "id", "v"])

    return run


def _compare(k: int):
    """The k best of a block of candidates for each query of a block."""

    def best(key, left: pa.Table, right: pa.Table) -> pa.Table:
        found: list[tuple[np.ndarray, ...]] = []
        if left.num_rows and right.num_rows:
            ids, x = np.asarray(left["id"].combine_chunks()), _matrix(left["v"])
            names, q = np.asarray(right["id"].combine_chunks()), _matrix(right["v"])
            # equal vectors are compared once; of each, the k + 1 smallest ids can count
            _, one, kind = np.unique(x.view(np.dtype((np.void, x.dtype.itemsize * x.shape[1]))).reshape(-1), return_index=True, return_inverse=True)
            order = np.lexsort((ids, kind))
            first = np.searchsorted(kind[order], np.arange(len(one)))
            distinct = x[one]
            for at in range(0, len(q), 128):
                some = q[at:at + 128]
                near = some @ distinct.T
                m = min(k + 1, near.shape[1])
                least = np.partition(near, near.shape[1] - m, axis=1)[:, near.shape[1] - m]
                row, col = np.nonzero(near >= least[:, None] - 1e-9 * np.maximum(1, np.abs(least[:, None])))
                width = np.minimum(np.diff(np.append(first, len(order)))[col], k + 1)
                pick = np.repeat(first[col], width) + np.arange(width.sum()) - np.repeat(np.cumsum(width) - width, width)
                row, pick = np.repeat(row, width), order[pick]
                other = ids[pick] != names[at + row]
                row, pick = row[other], pick[other]
                score = np.einsum("ij,ij->i", some[row], x[pick])
                rank = np.lexsort((ids[pick], -score, row))
                row, pick, score = row[rank], pick[rank], score[rank]
                keep = np.arange(len(row)) - np.searchsorted(row, row) < k
                found.append((names[at + row[keep]], ids[pick[keep]], score[keep]))
        columns = [np.concatenate(c) for c in zip(*found, strict=True)] or [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        return pa.table({"query_id": pa.array(columns[0], pa.int64()), "vec_id": pa.array(columns[1], pa.int64()), "score": pa.array(columns[2], pa.float64())})

    return best


def nearest(vectors: DataFrame, queries: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
            k: int = 20, sample: int = SAMPLE) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest rows of vectors found for each row of queries.

    Nearness is the inner product in double precision; a row of the query's own id does not
    count; ties go to the smaller id. The router is learned on the driver from the `sample`
    rows of smallest id hash; all rows are indexed. Parts are cut into blocks by id hash so that a
    part of any size is many tasks, and only k rows per query and block leave a task.

    Vectors that are NULL, zero, of another length than the commonest, or that hold NULL or
    non-finite numbers take no part, nor do rows without id. Repeated (id, vector) rows count once.
    No vectors: an empty result.
    """
    spark = vectors.sparkSession
    base = stored(usable(vectors, id_col, vector_col).dropDuplicates(), "vectors")
    asked = base.join(queries.select(F.col(f"`{id_col}`").cast("long").alias("id")).distinct(), "id", "left_semi")
    drawn = base.orderBy(F.xxhash64("id"), "id").limit(sample).select("v").toArrow()
    router = learn(_matrix(drawn["v"]) if drawn.num_rows else np.zeros((0, 1)))
    shared = spark.sparkContext.broadcast(router)
    index = stored(base.mapInArrow(_route(shared, 1), "part int, id long, v array<double>"), "index")
    visits = stored(asked.mapInArrow(_route(shared, router.visits), "part int, id long, v array<double>"), "visits")
    parts = router.b2.shape[0]

    def blocks(df: DataFrame, size: int):
        held = {r["part"]: r["count"] for r in df.groupBy("part").count().collect()}  # one row per part
        return F.array(*[F.lit(max(1, -(-held.get(p, 0) // size))) for p in range(parts)])[F.col("part")]

    c_blocks, q_blocks = blocks(index, CANDIDATE_BLOCK), blocks(visits, QUERY_BLOCK)
    here = index.withColumn("c", F.pmod(F.xxhash64("id"), c_blocks).cast("int")).withColumn("q", F.explode(F.sequence(F.lit(0), q_blocks - 1)))
    there = visits.withColumn("q", F.pmod(F.xxhash64("id"), q_blocks).cast("int")).withColumn("c", F.explode(F.sequence(F.lit(0), c_blocks - 1)))
    found = here.groupBy("part", "c", "q").cogroup(there.groupBy("part", "c", "q")).applyInArrow(
        _compare(k), "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
