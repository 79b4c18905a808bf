"""Leading eigenvectors of a symmetric matrix of samples that stays in Spark.

The matrix is written as square blocks; a product with a thin matrix is one job over them. A block Krylov space, started at random
and orthogonalised as it grows, is restarted from its best vectors until the residuals are small. The driver holds thin matrices
only, of n x (DEPTH x width), never n x n.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lociframe.operators.lineage import kept

#: Samples of a block, vectors sought beside the wanted ones, and blocks of the Krylov space before it is restarted.
BLOCK, SPARE, DEPTH = 512, 8, 6


class Square:
    """A symmetric matrix from `pairs` (sample_i, sample_j, value), one row or both for each pair; pairs without a row, and NaN, are 0.
    samples: (sample_id, n), numbered from 0."""

    def __init__(self, pairs: DataFrame, samples: DataFrame, transform: Callable[[np.ndarray], np.ndarray] = lambda x: x):
        self.spark, self.n = pairs.sparkSession, samples.count()
        i, j = F.col("i"), F.col("j")
        a = samples.select(F.col("sample_id").alias("sample_i"), F.col("n").cast("int").alias("i"))
        b = samples.select(F.col("sample_id").alias("sample_j"), F.col("n").cast("int").alias("j"))
        cells = pairs.where("value is not null and not isnan(value)").join(a, "sample_i").join(b, "sample_j").select(F.greatest(i, j).alias("i"), F.least(i, j).alias("j"), "value")

        def pack(key: tuple, rows: pa.Table) -> pa.Table:
            block = np.zeros((BLOCK, BLOCK))
            block[rows.column("i").to_numpy() % BLOCK, rows.column("j").to_numpy() % BLOCK] = transform(rows.column("value").to_numpy())
            return pa.table({"p": key[0:1], "q": key[1:2], "payload": pa.array([block.tobytes()], pa.binary())})

        lower = cells.groupBy((i / BLOCK).cast("int").alias("p"), (j / BLOCK).cast("int").alias("q")).applyInArrow(pack, "p int, q int, payload binary")
        self.blocks = kept(lower, "square")

    def times(self, x: np.ndarray) -> np.ndarray:
        """The product with a thin matrix, one row block of the result for each of the matrix."""
        sent = self.spark.sparkContext.broadcast(x)
        n, width = x.shape

        def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                out: dict[int, np.ndarray] = {}
                for p, q, payload in zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True):
                    a = np.frombuffer(payload).reshape(BLOCK, BLOCK)
                    rows, cols = (slice(b * BLOCK, min(n, (b + 1) * BLOCK)) for b in (p, q))
                    a = a[: rows.stop - rows.start, : cols.stop - cols.start]
                    if p == q:
                        a = np.tril(a) + np.tril(a, -1).T
                    else:
                        out[q] = out.get(q, 0.0) + a.T @ sent.value[rows]
                    out[p] = out.get(p, 0.0) + a @ sent.value[cols]
                yield pa.RecordBatch.from_arrays([pa.array(list(out), pa.int32()), pa.array([v.tobytes() for v in out.values()], pa.binary())], names=["p", "payload"])

        def add(key: tuple, rows: pa.Table) -> pa.Table:
            total = sum(np.frombuffer(b) for b in rows.column("payload").to_pylist())
            return pa.table({"p": key[0:1], "payload": pa.array([total.tobytes()], pa.binary())})

        found = self.blocks.mapInArrow(multiply, "p int, payload binary").groupBy("p").applyInArrow(add, "p int, payload binary").toArrow()
        out = np.zeros((n, width))
        for p, payload in zip(found.column("p").to_pylist(), found.column("payload").to_pylist(), strict=True):
            out[p * BLOCK : (p + 1) * BLOCK] = np.frombuffer(payload).reshape(-1, width)
        sent.destroy()
        return out


def orthogonal(x: np.ndarray, against: np.ndarray) -> np.ndarray:
    """An orthonormal base of x's columns, as far as they are not in the space of `against`."""
    for _ in range(2):
        x = x - against @ (against.T @ x)
        x, r = np.linalg.qr(x)
        size = np.abs(np.diag(r))
        x = x[:, size > 1e-10 * max(size.max(initial=0), 1e-300)]
    return x


def leading(times: Callable[[np.ndarray], np.ndarray], n: int, k: int, tolerance: float = 1e-9, restarts: int = 40, seed: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """(values, vectors) of the k largest eigenvalues of a symmetric matrix that is known by its products. Raises if the residuals are
    not below `tolerance` of the largest value after `restarts`."""
    width = min(n, k + SPARE)
    base = orthogonal(np.random.default_rng(seed).standard_normal((n, width)), np.zeros((n, 0)))
    image = times(base)
    for _ in range(restarts):
        last = base.shape[1]
        for _ in range(DEPTH - 1):
            new = orthogonal(image[:, -last:], base)
            if not new.shape[1]:
                break
            last = new.shape[1]
            base, image = np.hstack([base, new]), np.hstack([image, times(new)])
            if base.shape[1] >= n:
                break
        small = base.T @ image
        values, turn = np.linalg.eigh((small + small.T) / 2)
        order = np.argsort(values)[::-1]
        values, turn = values[order], turn[:, order]
        vectors = base @ turn[:, :k]
        residual = np.sqrt(((image @ turn[:, :k] - vectors * values[:k]) ** 2).sum(0))
        if (residual <= tolerance * max(np.abs(values).max(), 1e-300)).all() or base.shape[1] >= n:
            return values[:k], vectors
        best = turn[:, : 2 * width]
        base, image = base @ best, image @ best
        # what the residuals of the best span comes next
        extra = orthogonal(image[:, :width] - base[:, :width] * values[:width], base)
        if extra.shape[1]:
            base, image = np.hstack([base, extra]), np.hstack([image, times(extra)])
    raise RuntimeError(f"the eigenvectors have not settled after {restarts} restarts")


def centred(square: Square) -> Callable[[np.ndarray], np.ndarray]:
    """Products with -J D2 J / 2 of a square of squared distances, J taking column means off."""
    middle = lambda x: x - x.mean(0)
    return lambda x: -0.5 * middle(square.times(middle(x)))


def as_frames(spark: SparkSession, samples: DataFrame, values: np.ndarray, vectors: np.ndarray) -> tuple[DataFrame, DataFrame]:
    """(sample_id, component, value), signs such that the largest entry of a vector is positive; (component, eigenvalue)."""
    vectors = vectors * np.where(vectors[np.abs(vectors).argmax(0), np.arange(vectors.shape[1])] < 0, -1, 1) if vectors.size else vectors
    n, k = vectors.shape
    rows = pa.table({"n": pa.array(np.repeat(np.arange(n), k).astype(np.int32)), "component": pa.array(np.tile(np.arange(1, k + 1), n).astype(np.int32)), "value": pa.array(vectors.ravel())})
    named = spark.createDataFrame(rows).join(samples.select("sample_id", F.col("n").cast("int").alias("n")), "n").select("sample_id", "component", "value")
    return named, spark.createDataFrame([(i + 1, float(v)) for i, v in enumerate(values)], "component int, eigenvalue double")
