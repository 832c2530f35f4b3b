"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation of the centred rows.

The matrix C has a row per distinct vector, taken about the mean. A step multiplies C by a right vector
and the transposed C by the left vector that this gives, in one pass: each task forms its part of the
left vector from its rows and adds up its part of the transposed product. Left vectors are as long as
the table; they are never stored, but held as the combination of columns of C that makes them. Every new left
and right vector is made orthogonal to all earlier ones. After as many steps as there are dimensions the
bidiagonal matrix has the singular values of C, and its small decomposition on the driver turns the
right vectors into components. What reaches the driver per pass are a few rows with a sum per dimension.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mirrorflow.llm.batches import bounded_batches
from mirrorflow.llm.sums import matrix, table_sums
from mirrorflow.sources.scratch import materialise

SCALE, SHIFT = 64, 1_000_000
BREAKDOWN = 1e-10  # of the Frobenius norm: less counts as zero
_LIMIT = 1 << 62


@dataclass(frozen=True)
class Whitening:
    """``n`` distinct vectors with sums ``total``, components as columns, their variances ``e``
    in falling order, the trace of the covariance, and the error of the whitened covariance."""

    n: int
    total: np.ndarray
    components: np.ndarray
    e: np.ndarray
    trace: float
    identity_error: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        return centred(x, self.n, self.total)

    def project(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ (self.components / np.sqrt(self.e))


def centred(x: np.ndarray, n: int, total: np.ndarray) -> np.ndarray:
    """Rows about the mean; integers are subtracted before anything is rounded, where they fit."""
    if n * int(np.abs(x).max(initial=0)) < _LIMIT:
        return (x * n - total) / n
    return x - total / n


def _sums(vectors: DataFrame, length: int, part: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    return table_sums(vectors.select("x"), length, lambda batch: part(matrix(batch.column(0))))


def bidiagonalise(
    product: Callable[[np.ndarray], tuple[float, np.ndarray]], dimensions: int, scale: float, seed: int = 7
) -> tuple[np.ndarray, np.ndarray]:
    """Right vectors V (as columns) and the upper bidiagonal B with C V = U B.

    ``product`` gives the squared length of C c and the transposed C times C c. With w the combination
    that makes a left vector u = C w, the inner products of C c with all earlier left vectors follow
    from that transposed product. Where a step ends in nothing, a fresh orthogonal vector goes on.
    """
    rng = np.random.default_rng(seed)
    v, b = np.zeros((dimensions, dimensions)), np.zeros((dimensions, dimensions))
    w, back = np.zeros((dimensions, dimensions)), np.zeros((dimensions, dimensions))

    def orthogonal(x: np.ndarray, j: int) -> np.ndarray:
        for _ in range(2):
            x = x - v[:, :j] @ (v[:, :j].T @ x)
        return x

    following = rng.standard_normal(dimensions)
    beta = 0.0
    for j in range(dimensions):
        v[:, j] = following / np.linalg.norm(following)
        if j:
            b[j - 1, j] = beta
        c = v[:, j] - (beta * w[:, j - 1] if j else 0.0)
        squared, turned = product(c)
        # full reorthogonalisation against the earlier left vectors
        h = w[:, :j].T @ turned
        c, turned = c - w[:, :j] @ h, turned - back[:, :j] @ h
        alpha = np.sqrt(max(squared - float(h @ h), 0.0))
        beta, following = 0.0, np.zeros(dimensions)
        if alpha > BREAKDOWN * scale:
            b[j, j], w[:, j], back[:, j] = alpha, c / alpha, turned / alpha
            following = orthogonal(back[:, j] - alpha * v[:, j], j + 1)
            beta = float(np.linalg.norm(following))
        if j + 1 < dimensions and beta <= BREAKDOWN * scale:
            beta, following = 0.0, orthogonal(rng.standard_normal(dimensions), j + 1)
    return v, b


def fit_whitening(vectors: DataFrame, components: int = 16) -> Whitening | None:
    """From a table of distinct long vectors ``x`` of one length; None if there are none.

    Takes a pass per dimension and three more. Components without variance are left out, so
    there are fewer than asked for where the rank is lower.
    """
    first = vectors.select(F.size("x").alias("d")).first()
    if first is None:
        return None
    d = first["d"]
    exact = vectors.agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(F.get("x", F.lit(i))).alias(f"s{i}") for i in range(d)]
    ).first()
    n, total = exact["n"], np.array([exact[f"s{i}"] for i in range(d)], np.int64)

    def trace_part(x: np.ndarray) -> np.ndarray:
        return np.array([np.square(centred(x, n, total)).sum()])

    frobenius = float(_sums(vectors, 1, trace_part)[0])
    if not frobenius > 0:
        return None

    def product(c: np.ndarray) -> tuple[float, np.ndarray]:
        def part(x: np.ndarray) -> np.ndarray:
            rows = centred(x, n, total)
            left = rows @ c
            return np.concatenate([[left @ left], rows.T @ left])

        found = _sums(vectors, 1 + d, part)
        return float(found[0]), found[1:]

    v, b = bidiagonalise(product, d, frobenius**0.5)
    _, sigma, right = np.linalg.svd(b)
    kept = int((sigma[:components] > 10 * BREAKDOWN * sigma[0]).sum())
    basis = v @ right[:kept].T
    e = sigma[:kept] ** 2 / n
    made = Whitening(n, total, basis, e, frobenius / n, 0.0)

    def gram(x: np.ndarray) -> np.ndarray:
        z = made.project(x)
        return (z.T @ z).ravel()

    error = np.abs(_sums(vectors, kept * kept, gram).reshape(kept, kept) / n - np.eye(kept)).max()
    return Whitening(n, total, basis, e, frobenius / n, float(error))


def _usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & finite, F.lit(False))


def quantised(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``vec_id`` and ``x``, the vector in whole steps of 1 / 64 about ``SHIFT``, of the usable rows.

    Rows whose vector is null, empty or holds a null or a number that is not finite are left out, and so
    are vectors of another length than most (of equally frequent lengths the greater counts).
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    rows = rows.filter(_usable(F.col("v")))
    x = F.transform("v", lambda c: F.floor(c * SCALE).cast("long") + SHIFT)
    rows = materialise(rows.select("vec_id", x.alias("x")), "whitening_rows")
    sizes = rows.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    most = sizes.orderBy(F.desc("n"), F.desc("d")).first()
    return rows if most is None else rows.filter(F.size("x") == most["d"])


def whitened(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 16
) -> DataFrame:
    """A row per usable vector and component: ``vec_id``, ``component`` (from 1), ``n``, ``deviation``
    (decimal, exact), ``whitened``, ``explained`` and ``identity_error``.

    The covariance is that of the distinct vectors. A null id stays null, repeated rows are rows of their own,
    other columns are not looked at. Vectors that are all alike have no component, so they give no rows; neither
    does an empty table.
    """
    bounded_batches(vectors.sparkSession)
    rows = quantised(vectors, id_col, vector_col)
    distinct = materialise(rows.select("x").distinct(), "whitening_fit")
    model = fit_whitening(distinct, components)
    columns = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    schema = "vec_id long, component int, n long, deviation string, whitened double, explained double, identity_error double"
    if model is None:
        return vectors.sparkSession.createDataFrame([], schema).withColumn(
            "deviation", F.col("deviation").cast("decimal(38,0)")
        )
    k = len(model.e)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix(batch.column("x"))
            size = len(x)
            z = model.project(x)
            own = batch.column("vec_id").take(pa.array(np.repeat(np.arange(size), k)))
            arrays = [
                own,
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), size)),
                pa.array(np.full(size * k, model.n, np.int64)),
                pa.array(_deviations(x, model), pa.string()).take(pa.array(np.repeat(np.arange(size), k))),
                pa.array(z.ravel()),
                pa.array(np.tile(model.e / model.trace, size)),
                pa.array(np.full(size * k, model.identity_error)),
            ]
            yield pa.record_batch(arrays, names=columns)

    out = rows.select("vec_id", "x").mapInArrow(run, schema)
    return out.withColumn("deviation", F.col("deviation").cast("decimal(38,0)")).select(*columns)


def _deviations(x: np.ndarray, model: Whitening) -> list[str]:
    """Exact sums of squares of n x - S; in whole numbers of any size where 64 bits might not do."""
    most = model.n * int(np.abs(x).max(initial=0)) + int(np.abs(model.total).max())
    if most < 1 << 63:
        gap = x * model.n - model.total
        if int(np.abs(gap).max(initial=0)) ** 2 * x.shape[1] < 1 << 63:
            return [str(v) for v in np.square(gap).sum(axis=1)]
        gap = gap.astype(object)
    else:
        gap = x.astype(object) * model.n - model.total.astype(object)
    return [str(v) for v in np.square(gap).sum(axis=1)]
