"""Whitening of embeddings from an exact integer scatter.

1. Each entry becomes an integer x = floor(scale * c) + offset. Tasks take a shift from all x and add up the shifted sums S and
   cross-products of their vectors: by blocks, as a product of float matrices where every partial sum is below 2**53 and so exact, and
   with Python integers for the rows where one could be larger. Numbers leave a task as digits, which Spark adds up.
2. The driver gets d * (d + 1) / 2 + d numbers. It forms n * X'X - S S' in integers of any size, where the shift cancels out, and
   only then turns that over n * n into floats: each entry of the covariance is the nearest double.
   ``eigh`` decomposes it.
3. A second pass projects n * x - S, exact until it is divided, on the first components. Its rows are written; sums over
   them give the covariance of the result.

Memory of a task: a block of vectors and d * d numbers. No vector is shuffled.

Edge cases: vectors that are null or hold null or non-finite entries have no row and no weight; where lengths differ, entries that a shorter
vector lacks count as c = 0 (so x = offset), an empty vector's too; more than ``MOST_DIMS`` components are an error; components whose
eigenvalue is zero to double precision can't be whitened and are left out, so equal vectors, or a single one, give no row, like an empty
table; ties and repeated rows count as often as they are there; null ids are ids; deviations beyond 2**63 - 1 show
as that number; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicework.llm.common import bounded_batches, materialize, table
from sluicework.llm.vectors import LONG_MAX, SUM_SCHEMA, add_up, blocks, digits, exact_floors, floors, matrix, whole

SCALE, OFFSET, COMPONENTS = 1024, 100_000, 8
#: The driver holds a matrix of so many rows and columns at most.
MOST_DIMS = 2048
#: Shifted entries below this have products whose sums over a block are exact as floats.
_MOST = 1 << 20


class Fit(NamedTuple):
    """What the scatter gives: n, the sums of x - shift, eigenvalues by falling size, unit eigenvectors as columns, the covariance's trace."""

    n: int
    shift: int
    sums: list[int]
    eigenvalues: np.ndarray
    vectors: np.ndarray
    trace: float


class Whitening(NamedTuple):
    """The fit, and rows of id, deviation and whitened (an array, one number for each component kept)."""

    fit: Fit
    rows: DataFrame
    identity_error: float


def _shifted(column: pa.ChunkedArray, dims: int, scale: int, by: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """A block's floor(scale * c) + by, and their rows: those that 64 bits hold easily, then any others."""
    x = matrix(column, dims)
    y, small = floors(x, scale, _MOST)
    if abs(by) < _MOST and small.any():
        yield y[small] + by, np.flatnonzero(small)
        x, rest = x[~small], np.flatnonzero(~small)
    else:
        rest = np.arange(len(x))
    if len(rest):
        yield exact_floors(x, scale) + by, rest


def cross_products(y: np.ndarray) -> np.ndarray:
    """Y'Y in exact integers: by floats where all partial sums are whole numbers below 2**53, else as they are."""
    if y.dtype == object:
        return y.T.dot(y)
    out, most = np.zeros((y.shape[1], y.shape[1]), np.int64), max(int(np.abs(y).max(initial=0)), 1)
    step = max((1 << 53) // (most * most), 1)
    for at in range(0, len(y), step):
        part = y[at : at + step].astype(np.float64)
        out += (part.T @ part).astype(np.int64)
    return out


def _scatter(dims: int, scale: int, by: int):
    """A task's sums: key 0 is n, then the dims sums, then the cross-products of the upper triangle by rows."""
    upper = np.triu_indices(dims)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, products = 0, np.zeros(dims, object), np.zeros(len(upper[0]), object)
        for block in blocks(batches):
            n += block.num_rows
            for y, _ in _shifted(block.column("vector"), dims, scale, by):
                sums += y.sum(axis=0).astype(object)
                products += cross_products(y)[upper].astype(object)
        yield digits(enumerate([n, *sums.tolist(), *products.tolist()]))

    return run


def fit(vectors: DataFrame, dims: int, scale: int = SCALE, offset: int = OFFSET, shift: int = OFFSET) -> Fit | None:
    """The covariance of the column ``vector``'s integers and its eigenvectors; nothing without vectors. No ``shift`` changes the result."""
    total = add_up(vectors.select("vector").mapInArrow(_scatter(dims, scale, offset - shift), SUM_SCHEMA))
    n = total.get(0, 0)
    if not n:
        return None
    sums = [total.get(1 + i, 0) for i in range(dims)]
    covariance = np.zeros((dims, dims))
    for at, (i, j) in enumerate(zip(*np.triu_indices(dims), strict=True), 1 + dims):
        covariance[i, j] = covariance[j, i] = (n * total.get(at, 0) - sums[i] * sums[j]) / (n * n)
    e, v = np.linalg.eigh(covariance)
    e, v = e[::-1], v[:, ::-1]
    v = v * np.where(np.take_along_axis(v, np.abs(v).argmax(axis=0)[None, :], 0) < 0, -1.0, 1.0)
    return Fit(n, shift, sums, e, v, float(np.trace(covariance)))


def _projector(found: Fit, kept: int, scale: int, by: int):
    n, sums, dims = found.n, found.sums, len(found.sums)
    weights = found.vectors[:, :kept] / np.sqrt(found.eigenvalues[:kept])
    squares, absolute = sum(s * s for s in sums), sum(map(abs, sums))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            whitened, deviation = np.empty((block.num_rows, kept)), np.empty(block.num_rows, np.int64)
            for y, rows in _shifted(block.column("vector"), dims, scale, by):
                most = int(np.abs(y).max(initial=0)) + 1
                fits = y.dtype != object and max(n * most + absolute, most * absolute, dims * most * most) < 1 << 62
                x, s = (y, np.array(sums, np.int64)) if fits else (y.astype(object), np.array(sums, object))
                whitened[rows] = ((n * x - s) / n).astype(np.float64) @ weights
                own, both = (x * x).sum(axis=1), (x * s).sum(axis=1)
                deviation[rows] = [min(n * n * a - 2 * n * b + squares, LONG_MAX) for a, b in zip(own.tolist(), both.tolist(), strict=True)]
            made = pa.FixedSizeListArray.from_arrays(pa.array(whitened.ravel()), kept).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([block.column("id").combine_chunks(), pa.array(deviation), made], names=["id", "deviation", "whitened"])

    return run


def whiten(vectors: DataFrame, components: int = COMPONENTS, scale: int = SCALE, offset: int = OFFSET, id_col: str = "vec_id", vector_col: str = "embedding") -> Whitening | None:
    """Project all whole vectors on their first principal components, each with variance one; nothing where no component varies."""
    bounded_batches(vectors.sparkSession)
    whole_rows = vectors.where(whole(vector_col)).select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"))
    dims = whole_rows.agg(F.max(F.size("vector"))).first()[0] or 0
    if dims > MOST_DIMS:
        raise ValueError(f"vectors have up to {dims} components, more than {MOST_DIMS}")
    found = fit(whole_rows, dims, scale, offset) if dims else None
    kept = 0 if found is None else int((found.eigenvalues[:components] > dims * np.finfo(float).eps * abs(found.eigenvalues[0])).sum())
    if not kept:
        return None
    rows = materialize(whole_rows.mapInArrow(_projector(found, kept, scale, offset - found.shift), "id long, deviation long, whitened array<double>"), "whitened")
    pairs = [(i, j) for i in range(kept) for j in range(i, kept)]
    w = [F.col("whitened")[i] for i in range(kept)]
    sums = rows.agg(*(F.sum(x) for x in w), *(F.sum(w[i] * w[j]) for i, j in pairs)).first()
    error = max(abs(sums[kept + at] / found.n - sums[i] / found.n * (sums[j] / found.n) - (i == j)) for at, (i, j) in enumerate(pairs))
    return Whitening(found, rows.withColumnRenamed("id", id_col), error)


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All whole embeddings by component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    done = whiten(table(spark, sf_dir, "embeddings"))
    if done is None:
        return spark.createDataFrame([], "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")
    explained = F.array(*(F.lit(float(e / done.fit.trace)) for e in done.fit.eigenvalues[:COMPONENTS]))
    rows = done.rows.select("vec_id", "deviation", F.posexplode("whitened").alias("place", "whitened"))
    return rows.select("vec_id", (F.col("place") + 1).cast("int").alias("component"), F.lit(done.fit.n).cast("long").alias("n"), "deviation", "whitened", explained[F.col("place")].alias("explained"), F.lit(done.identity_error).alias("identity_error"))
