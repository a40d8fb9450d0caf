"""Rows of vectors as exact integers, and sums of them that no size of number can round."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Vectors that a task computes with at a time.
BLOCK_ROWS = 8192
#: Rows of an exact sum: which number, which digit of it (base 2**32) and the digit's sum, with the number's sign.
SUM_SCHEMA = "key long, digit int, value long"
LONG_MAX = (1 << 63) - 1
_DIGIT = 32


def whole(vector: str) -> Column:
    """Whether a column of vectors has one, with neither null nor non-finite entries."""
    return F.col(vector).isNotNull() & F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))


def blocks(batches: Iterable[pa.RecordBatch], rows: int = BLOCK_ROWS) -> Iterator[pa.Table]:
    """Arrow batches put together until there are about so many rows."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= rows:
            yield pa.Table.from_batches(held).combine_chunks()
            held = []
    if any(b.num_rows for b in held):
        yield pa.Table.from_batches(held).combine_chunks()


def matrix(column: pa.ChunkedArray, dims: int) -> np.ndarray:
    """Vectors as rows of doubles; what a shorter vector lacks is 0."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    sizes = np.diff(lists.offsets.to_numpy())
    if (sizes == dims).all():
        return flat.reshape(len(sizes), dims)
    out = np.zeros((len(sizes), dims))
    out[np.arange(dims) < sizes[:, None]] = flat
    return out


def floors(x: np.ndarray, scale: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """floor(scale * x) as 64-bit integers where a row's are all below ``most``, and which rows those are.

    The scale is a power of two, so that the product rounds nothing. The other rows are 0; ``exact_floors`` has them.
    """
    with np.errstate(over="ignore"):
        y = np.floor(x * scale)
    small = (np.abs(y) < most).all(axis=1)
    return np.where(small[:, None], y, 0).astype(np.int64), small


def exact_floors(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) as Python integers, of any size."""
    out = np.empty(x.shape, object)
    out[...] = [[int(v) * scale if abs(v) >= 2.0**53 else int(np.floor(v * scale)) for v in row] for row in x.tolist()]
    return out


def digits(sums: Iterable[tuple[int, int]]) -> pa.RecordBatch:
    """Numbers by key as rows of SUM_SCHEMA: digits that Spark can add up as longs, over two thousand million rows at least."""
    key, digit, value = [], [], []
    for k, total in sums:
        sign, rest, at = (-1 if total < 0 else 1), abs(int(total)), 0
        while rest:
            if low := rest & ((1 << _DIGIT) - 1):
                key.append(k)
                digit.append(at)
                value.append(sign * low)
            rest >>= _DIGIT
            at += 1
    return pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), pa.array(digit, pa.int32()), pa.array(value, pa.int64())], names=["key", "digit", "value"])


def add_up(sums: DataFrame) -> dict[int, int]:
    """The exact totals of rows of SUM_SCHEMA by key; their keys are bounded, and so is what comes to the driver."""
    out: dict[int, int] = {}
    for r in sums.groupBy("key", "digit").agg(F.sum("value").alias("value")).collect():
        out[r.key] = out.get(r.key, 0) + (r.value << _DIGIT * r.digit)
    return out
