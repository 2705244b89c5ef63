"""A stored cosine index: vectors by cell of a clustering, searched cell by cell."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

#: Vectors that the cells are learned from, vectors a cell should hold, and most cells.
SAMPLE, PER_CELL, CELLS = 50_000, 500, 4096
#: Rows that one task compares: of a cell, and of the queries that visit it.
BLOCK_ROWS, BLOCK_QUERIES = 20_000, 2_000


def unit_vectors(df: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, v) with v of length 1; NULL and zero vectors and vectors with NULL or non-finite entries are left out."""
    v = F.col(vector).cast("array<double>")
    norm = F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + x * x))
    rows = df.select(F.col(key).alias("id"), v.alias("v"), norm.alias("n"))
    good = (F.col("n") > 0) & (F.col("n") < float("inf"))
    return rows.filter(F.col("v").isNotNull() & good).select("id", F.transform("v", lambda x: x / F.col("n")).alias("v"))


def _matrix(column: pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(column.flatten()).reshape(len(column), -1)


def _nearest_cells(shared, probes: int | None):
    """Each row once for every cell it belongs to or visits, by cosine with the centroids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centroids = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            near = _matrix(batch.column(1)) @ centroids.T
            best = np.argsort(-near, axis=1, kind="stable")[:, :probes]
            take = pa.array(np.repeat(np.arange(batch.num_rows), best.shape[1]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(best.reshape(-1).astype(np.int32)), *(c.take(take) for c in batch.columns)], names=["cell", "id", "v"])

    return run


def _best(k: int):
    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        found = []
        if left.num_rows and right.num_rows:
            ids, x = np.asarray(left["id"].combine_chunks()), _matrix(left["v"])
            names, q = np.asarray(right["id"].combine_chunks()), _matrix(right["v"])
            order = np.argsort(ids, kind="stable")
            ids, x = ids[order], x[order]
            for at in range(0, len(q), 256):
                # equal vectors must tie, whatever the order of the sums
                near = np.round(q[at:at + 256] @ x.T, 12)
                top = np.argsort(-near, axis=1, kind="stable")[:, :k]
                found.append((np.repeat(names[at:at + 256], top.shape[1]), ids[top.reshape(-1)], np.take_along_axis(near, top, 1).reshape(-1)))
        columns = [np.concatenate(c) for c in zip(*found, strict=True)] or [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        return pa.table({n: pa.array(c, t) for n, c, t in zip(("query_id", "id", "score"), columns, (pa.int64(), pa.int64(), pa.float64()), strict=True)})

    return run


@dataclass(frozen=True)
class CellIndex:
    """Below ``path``: ``centroids``, and ``vectors/cell=N`` with the unit vectors nearest to centroid N."""

    spark: SparkSession
    path: str

    def build(self, df: DataFrame, key: str, vector: str, cells: int | None = None, sample: int = SAMPLE) -> "CellIndex":
        """Learns the cells from the ``sample`` rows of smallest id hash and stores every vector.

        Cells grow with the table, one for PER_CELL vectors, up to CELLS.  Ids are longs.
        """
        rows = unit_vectors(df, key, vector).persist(StorageLevel.MEMORY_AND_DISK)
        n = rows.count()
        drawn = rows.orderBy(F.xxhash64("id"), "id").limit(sample).select(array_to_vector("v").alias("features"))
        wanted = max(1, min(cells or n // PER_CELL, CELLS, n))
        if wanted > 1:
            centres = np.array(KMeans(k=wanted, seed=11, maxIter=8, distanceMeasure="cosine", initSteps=2).fit(drawn).clusterCenters())
        else:
            first = rows.select("v").first()
            centres = np.array([first["v"]] if first else np.zeros((0, 1)))
        self.spark.createDataFrame([(i, c.tolist()) for i, c in enumerate(centres)], "cell int, v array<double>").write.parquet(f"{self.path}/centroids")
        if len(centres):
            shared = self.spark.sparkContext.broadcast(centres)  # CELLS vectors at most
            placed = rows.mapInArrow(_nearest_cells(shared, 1), "cell int, id long, v array<double>")
            placed.hint("rebalance", F.col("cell")).write.partitionBy("cell").parquet(f"{self.path}/vectors")
        rows.unpersist()
        return self

    def search(self, queries: DataFrame, key: str, vector: str, k: int, probes: int | None = None) -> DataFrame:
        """query_id, id, score: the k nearest by cosine in each query's ``probes`` nearest cells;
        without ``probes`` in all cells, which is exact.  Ties go to the smaller id.

        Queries meet vectors by an equi-join on (cell, blocks): a cell of any size is many
        tasks, and k rows per query and block leave a task.
        """
        known = self.spark.read.parquet(f"{self.path}/centroids").orderBy("cell").collect()  # CELLS rows at most
        if not known:
            return self.spark.createDataFrame([], "query_id long, id long, score double")
        shared = self.spark.sparkContext.broadcast(np.array([r["v"] for r in known]))
        vectors = self.spark.read.parquet(f"{self.path}/vectors")
        asked = unit_vectors(queries, key, vector).mapInArrow(_nearest_cells(shared, probes), "cell int, id long, v array<double>")

        def blocks(df: DataFrame, size: int):
            counts = {r["cell"]: -(-r["count"] // size) for r in df.groupBy("cell").count().collect()}  # one row a cell
            return F.array(*(F.lit(counts.get(c, 1)) for c in range(len(known))))[F.col("cell")]

        n_rows, n_queries = blocks(vectors, BLOCK_ROWS), blocks(asked, BLOCK_QUERIES)
        here = vectors.withColumn("b", F.pmod(F.xxhash64("id"), n_rows).cast("int")).withColumn("q", F.explode(F.sequence(F.lit(0), n_queries - 1)))
        there = asked.withColumn("q", F.pmod(F.xxhash64("id"), n_queries).cast("int")).withColumn("b", F.explode(F.sequence(F.lit(0), n_rows - 1)))
        on = ["cell", "b", "q"]
        found = here.select("id", "v", *on).groupBy(*on).cogroup(there.select("id", "v", *on).groupBy(*on)).applyInArrow(
            _best(k), "query_id long, id long, score double")
        ranked = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "id")
        return found.withColumn("_r", F.row_number().over(ranked)).filter(F.col("_r") <= k).drop("_r")
