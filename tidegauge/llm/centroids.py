"""Centroid clustering of integer vectors; the nearest centroid is found by the threshold algorithm.

The centroids' values are sorted once per dimension. From a vector's own value each of these
lists is walked outward; a centroid met for the first time gets its exact distance. Where the
walk stands in all lists, the squared frontier distances sum to a bound below which no unmet
centroid can lie, so the walk ends when that sum strictly exceeds the best exact distance.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.llm.common import ROW, packed, stored, unpacked

#: Components may not exceed this (after scaling), so that squared distances fit in a long.
LARGEST = 2**27
#: Vectors of a block that one numpy pass walks.
BLOCK = 1024


def threshold_nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid (ties: the smaller) and squared distance for each row of x, in exact integers."""
    k, d = centroids.shape
    order = np.argsort(centroids, axis=0, kind="stable")
    lists = np.take_along_axis(centroids, order, axis=0)
    dim = np.arange(d)
    who, best = np.zeros(len(x), dtype=np.int32), np.zeros(len(x), dtype=np.int64)
    live = np.arange(len(x))
    high = np.stack([np.searchsorted(lists[:, j], x[:, j], "right") for j in range(d)], axis=1)
    low = high - 1
    best[:], who[:] = np.iinfo(np.int64).max, k
    met = np.zeros((len(x), k), dtype=bool)
    while len(live):
        v, lo, hi = x[live], low[live], high[live]
        down, up = lo >= 0, hi < k
        lo_at, hi_at = np.maximum(lo, 0), np.minimum(hi, k - 1)
        below, above = v - lists[lo_at, dim], lists[hi_at, dim] - v
        down &= ~up | (below <= above)
        gap = np.where(down, below, above)
        seen = met[live]
        new = np.zeros_like(seen)
        new[np.arange(len(live))[:, None], np.where(down, order[lo_at, dim], order[hi_at, dim])] = True
        new &= ~seen
        row, number = np.nonzero(new)
        away = v[row] - centroids[number]
        exact = np.full(seen.shape, np.iinfo(np.int64).max)
        exact[row, number] = np.einsum("ij,ij->i", away, away)
        first = exact.argmin(axis=1)
        value = exact[np.arange(len(live)), first]
        closer = (value < best[live]) | ((value == best[live]) & (first < who[live]))
        best[live[closer]], who[live[closer]] = value[closer], first[closer]
        met[live] = seen | new
        low[live], high[live] = lo - down, hi + ~down
        frontier = np.einsum("ij,ij->i", gap, gap)
        live = live[~((frontier > best[live]) | met[live].all(axis=1))]
    return who, best


def integer_vectors(vector: Column, dims: int, scale: int) -> Column:
    """floor(scale * component) as array<long>; NULL for other lengths and for NULL or non-finite components.

    A component beyond LARGEST fails the job: its distances could not be told exactly in a long.
    """
    v = vector.cast("array<double>")
    whole = ~F.exists(v, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    far = F.raise_error(F.lit(f"a component times {scale} exceeds {LARGEST}")).cast("bigint")
    return F.when((F.size(v) == dims) & whole, F.transform(
        v, lambda e: F.when(F.abs(e * scale) > LARGEST, far).otherwise(F.floor(e * scale))))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(-1, dims)


def _partial_sums(shared, dims: int):
    """One row per non-empty cluster of a task: number, count, componentwise sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centroids = shared.value
        count, sums = np.zeros(len(centroids), np.int64), np.zeros((len(centroids), dims), np.int64)
        for batch in batches:
            x = _matrix(batch.column(0), dims)
            for at in range(0, len(x), BLOCK):
                part = x[at:at + BLOCK]
                who, _ = threshold_nearest(part, centroids)
                np.add.at(sums, who, part)
                count += np.bincount(who, minlength=len(centroids))
        some = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([
            pa.array(some.astype(np.int32)), pa.array(count[some]), pa.array(list(sums[some]), pa.list_(pa.int64()))],
            names=["cluster", "n", "sums"])

    return run


def _assign(shared, dims: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1), dims)
            blocks = [threshold_nearest(x[at:at + BLOCK], shared.value) for at in range(0, len(x), BLOCK)]
            if blocks:
                who, best = (np.concatenate(c) for c in zip(*blocks, strict=True))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(who), pa.array(best)], names=[ROW, "cluster", "distance"])

    return run


def cluster(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 40,
            rounds: int = 5, dims: int = 64, scale: int = 256, prefix: str = "2:") -> DataFrame:
    """Adds cluster, distance, cluster_inertia, inertia and centroid (array<long>) to the vectors that are kept.

    Kept are vectors of `dims` components, none NULL or non-finite, as integers floor(scale *
    component). The first centroids are the k kept rows of smallest sha256 of prefix and id
    (then of smallest vector; rows without id last), fewer if fewer are kept. Every round
    assigns all rows and moves each centroid that has rows to the floor of their mean. Every
    row is assigned anew at the end; repeated rows count as often as they stand.

    Each round is a narrow pass; a task sends one row per cluster, which are summed by
    cluster, so k x dims numbers reach the driver whatever the table's size, and as many are
    broadcast. Copies of one vector meet in no single task. Columns of vectors with the names
    of new ones are replaced. No kept vectors: an empty result.
    """
    spark = vectors.sparkSession
    held = packed(vectors).withColumn("x", integer_vectors(F.col(ROW).getField(vector_col), dims, scale)).filter(F.col("x").isNotNull())
    base = stored(held, "integer-vectors")
    digest = F.sha2(F.concat(F.lit(prefix), F.col(ROW).getField(id_col).cast("string")), 256)
    drawn = base.select(digest.alias("h"), "x").orderBy(F.asc_nulls_last("h"), "x").limit(k).collect()
    centroids = np.array([r["x"] for r in drawn], dtype=np.int64).reshape(-1, dims)
    for _ in range(rounds if len(drawn) else 0):
        parts = base.select("x").mapInArrow(_partial_sums(spark.sparkContext.broadcast(centroids), dims), "cluster int, n long, sums array<long>")
        moved = parts.groupBy("cluster").agg(F.sum("n").alias("n"), F.array(*[F.sum(F.col("sums")[j]) for j in range(dims)]).alias("sums")).collect()
        centroids = centroids.copy()
        for r in moved:  # k rows at most
            centroids[r["cluster"]] = [s // r["n"] for s in r["sums"]]
    schema = T.StructType([base.schema[ROW], T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())])
    done = stored(base.select(ROW, "x").mapInArrow(_assign(spark.sparkContext.broadcast(centroids), dims), schema), "assigned")
    inertia = {r["cluster"]: r["s"] for r in done.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    facts = spark.createDataFrame(
        [(c, s, sum(inertia.values()), centroids[c].tolist()) for c, s in inertia.items()],
        "_c int, cluster_inertia long, inertia long, centroid array<long>")
    out = done.join(F.broadcast(facts), F.col("cluster") == F.col("_c"))  # k rows at most
    return unpacked(out, vectors.columns, {c: F.col(c) for c in ("cluster", "distance", "cluster_inertia", "inertia", "centroid")})
