"""Embedding whitening by Golub-Kahan-Lanczos bidiagonalisation of the centred distinct vectors.

With X the centred rows, every step multiplies by X and by its transpose in one distributed
pass. A left Lanczos vector has as many entries as X has rows; it is X p for a short vector p,
so only p and X'X p, of the vectors' length, are kept on the driver, and the left vectors are
made orthogonal to all earlier ones through them. The bidiagonal matrix is small; its singular
values and vectors give deviations and components.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.llm.common import ROW, packed, stored, unpacked

#: Singular values below this share of the largest count as zero.
ZERO = 1e-10
#: Whole entries lie below this (after scaling and shifting).
LARGEST = 2**52

Product = Callable[[np.ndarray], tuple[np.ndarray, float]]


def bidiagonalise(product: Product, d: int, seed: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """Right Lanczos vectors (columns) and the upper bidiagonal matrix of X, after all d steps.

    product(p) gives X'X p and the squared length of X p. Both sequences are made orthogonal
    to all their earlier vectors, twice where that takes much away. Where the Krylov space is
    exhausted (equal or zero singular values) the walk goes on from a new orthogonal vector.
    """
    rng = np.random.default_rng(seed)
    right, bidiagonal = np.zeros((d, d)), np.zeros((d, d))
    short, back = np.zeros((d, d)), np.zeros((d, d))  # p and X'X p of the left vectors
    largest, beta = 0.0, 0.0

    def orthogonal(w: np.ndarray, j: int) -> np.ndarray:
        for _ in range(2):
            w = w - right[:, :j] @ (right[:, :j].T @ w)
        return w

    v = rng.standard_normal(d)
    v /= np.linalg.norm(v)
    for j in range(d):
        right[:, j] = v
        p = v - beta * short[:, j - 1] if j else v.copy()
        z, square = product(p)
        for again in range(2):
            shared = short[:, :j].T @ z
            much = shared @ shared > 1e-2 * square
            p, z, square = p - short[:, :j] @ shared, z - back[:, :j] @ shared, max(square - shared @ shared, 0.0)
            if not much or again:
                break
            z, square = product(p)
        alpha = np.sqrt(square)
        largest = max(largest, alpha)
        if alpha > ZERO * largest:
            short[:, j], back[:, j], bidiagonal[j, j] = p / alpha, z / alpha, alpha
        if j + 1 < d:
            w = orthogonal(back[:, j] - bidiagonal[j, j] * v, j + 1)
            beta = np.linalg.norm(w)
            if beta <= ZERO * largest:
                beta, w = 0.0, orthogonal(rng.standard_normal(d), j + 1)
            bidiagonal[j, j + 1] = beta
            v = w / np.linalg.norm(w)
    return right, bidiagonal


@dataclass
class Whitening:
    n: int
    floor: np.ndarray  # floor(S / n) of the sums S
    rest: np.ndarray  # S mod n
    components: np.ndarray  # unit vectors, as columns
    deviations: np.ndarray  # square roots of their variances
    explained: np.ndarray

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.floor) - self.rest / self.n

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.components / self.deviations

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Sum of (n x - S)^2, exact; None where it does not fit in a long."""
        away = x - self.floor
        most = (int(np.abs(away).max(initial=0)) + 1) * self.n
        if most * most * max(1, x.shape[1]) >= 2**63:
            away = away.astype(object)
        off = away * self.n - self.rest
        return [int(s) if s < 2**63 else None for s in (off * off).sum(axis=1)]


def whole_vectors(vector: Column, scale: int, shift: int) -> Column:
    """floor(scale * entry) + shift as array<long>; NULL where the vector is NULL or holds NULL or non-finite entries."""
    v = vector.cast("array<double>")
    whole = ~F.exists(v, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    far = F.raise_error(F.lit(f"an entry times {scale} exceeds {LARGEST}")).cast("bigint")
    return F.when(whole, F.transform(
        v, lambda e: F.when(F.abs(e * scale) > LARGEST, far).otherwise(F.floor(e * scale) + shift)))


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(-1, d)


def _total(fit: DataFrame, d: int, width: int, kind: str, per_block: Callable[[np.ndarray], np.ndarray]) -> list:
    """Sum over all rows of what per_block adds up; a task sends one row of `width` numbers, summed in one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width, np.int64 if kind == "long" else np.float64)
        for batch in batches:
            total += per_block(_matrix(batch.column(0), d))
        yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(pa.int64() if kind == "long" else pa.float64()))], names=["t"])

    sums = fit.mapInArrow(run, f"t array<{kind}>").agg(*[F.sum(F.col("t")[i]).alias(f"t{i}") for i in range(width)])
    return [t or 0 for t in sums.first()]


def learn_whitening(fit: DataFrame, d: int, components: int = 16) -> Whitening:
    """Whitening of the rows of fit (one array<long> of length d each, all different): d + 2 passes.

    What reaches the driver in a pass is one row of d + 2 numbers; the driver keeps four
    matrices of d x d. Components whose deviation is below ZERO times the largest are left out.
    """
    sums = _total(fit, d, d + 1, "long", lambda x: np.append(x.sum(axis=0), len(x)))
    n = int(sums[d])
    model = Whitening(n, np.array([int(s) // max(n, 1) for s in sums[:d]], np.int64), np.array([int(s) % max(n, 1) for s in sums[:d]], np.int64),
                      np.zeros((d, 0)), np.zeros(0), np.zeros(0))
    if n == 0 or d == 0:
        return model
    trace = _total(fit, d, 1, "double", lambda x: np.array([np.square(model.centred(x)).sum()]))[0]

    def product(p: np.ndarray) -> tuple[np.ndarray, float]:
        def block(x: np.ndarray) -> np.ndarray:
            rows = model.centred(x)
            left = rows @ p
            return np.append(left @ rows, left @ left)

        total = np.array(_total(fit, d, d + 1, "double", block))
        return total[:d], float(total[d])

    right, bidiagonal = bidiagonalise(product, d)
    _, sizes, turned = np.linalg.svd(bidiagonal)
    k = min(components, int((sizes > ZERO * sizes[0]).sum())) if sizes[0] > 0 else 0
    model.components, model.deviations = right @ turned[:k].T, sizes[:k] / np.sqrt(n)
    model.explained = np.square(sizes[:k]) / trace if trace else np.zeros(0)
    return model


def identity_error(fit: DataFrame, d: int, model: Whitening) -> float:
    """Largest absolute entry of the whitened rows' covariance minus the identity; 0 without components."""
    k = len(model.deviations)
    if not k:
        return 0.0

    def products(x: np.ndarray) -> np.ndarray:
        y = model.whitened(x)
        return (y.T @ y).reshape(-1)

    total = _total(fit, d, k * k, "double", products)
    return float(np.abs(np.array(total).reshape(k, k) / model.n - np.eye(k)).max())


def _apply(shared, d: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1), d)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(shared.value.deviation(x), pa.int64()),
                pa.array(list(shared.value.whitened(x)), pa.list_(pa.float64()))], names=[ROW, "deviation", "whitened"])

    return run


def whiten(vectors: DataFrame, vector_col: str = "embedding", components: int = 16, scale: int = 64, shift: int = 1_000_000) -> DataFrame:
    """Adds n, deviation, whitened and explained (arrays, one value a component) and identity_error.

    Entries become x = floor(scale * entry) + shift. The fit list holds each different x vector
    once (n of them, sums S); covariances are over it, divisor n. whitened is (x - S / n) on the
    unit components, largest variance first, over their deviations. deviation is the sum of
    (n x - S)^2, NULL where that exceeds a long.

    Rows whose vector is NULL or holds NULL or non-finite entries are left out, as are rows of
    another length than the commonest (of equally common ones the shorter). Repeated rows stay,
    each with the same values. Fewer components than asked for stand where the vectors are
    shorter or the variance in fewer directions is not zero; none for one vector (empty
    arrays). Columns of vectors with the names of new ones are replaced. Empty table: empty result.
    """
    spark = vectors.sparkSession
    held = packed(vectors).withColumn("x", whole_vectors(F.col(ROW).getField(vector_col), scale, shift)).filter(F.col("x").isNotNull())
    base = stored(held, "whole-vectors")
    lengths = base.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    d = lengths[0]["d"] if lengths else 0
    base = base.filter(F.size("x") == d)
    fit = stored(base.select("x").distinct(), "fit-list")
    model = learn_whitening(fit, d, components)
    error = identity_error(fit, d, model)
    schema = T.StructType([base.schema[ROW], T.StructField("deviation", T.LongType()), T.StructField("whitened", T.ArrayType(T.DoubleType()))])
    out = base.select(ROW, "x").mapInArrow(_apply(spark.sparkContext.broadcast(model), d), schema)
    return unpacked(out, vectors.columns, {
        "n": F.lit(model.n).cast("long"), "deviation": F.col("deviation"), "whitened": F.col("whitened"),
        "explained": F.array(*[F.lit(float(e)) for e in model.explained]).cast("array<double>"), "identity_error": F.lit(error)})
