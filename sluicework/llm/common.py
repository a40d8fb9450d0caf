"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicework.storage import few_tasks, intermediates, materialize, shared_dir

__all__ = ["bounded_batches", "few_tasks", "intermediates", "materialize", "mix", "powers", "row_order", "shared_dir", "shingles", "table", "text_or_empty", "word_hashes"]

#: Rows and bytes of one Arrow batch that an operator hands to Python. Texts can be long, so they are small.
BATCH_ROWS, BATCH_BYTES = 512, 4 << 20

#: A word of a text: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

_MASK = (1 << 64) - 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the tables in ``sf_dir``, read by Spark."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession) -> None:
    """Keep Arrow batches small, so that a task holds few texts at a time.

    Spark reads this setting when a frame runs, which may be after the operator has returned it; so it is the same
    for all operators, and stays set in the session.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def text_or_empty(name: str) -> Column:
    """A text column where a null text counts as an empty one."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def row_order(df: DataFrame) -> Column:
    """An order of rows by all their columns; rows that are equal in it are alike."""
    return F.to_json(F.struct(*[df[c] for c in df.columns]), {"ignoreNullFields": "false"})


# --- hashing of words, many texts at a time -------------------------------------------------

#: Bytes of texts that are hashed at a time, but for a longer text.
HASHED_BYTES = 1 << 19
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser of splitmix: spreads each input bit over the output."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    out = np.full(max(n, 1), np.uint64(base & _MASK))
    out[0] = 1
    return np.multiply.accumulate(out)[:n]


_TABLES: dict[str, np.ndarray] = {}


def _powers_upto(name: str, base: int, n: int) -> np.ndarray:
    have = _TABLES.get(name)
    if have is None or len(have) < n:
        have = _TABLES[name] = powers(base, max(n, 1 << 16))
    return have[:n]


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of UTF-8 texts, in order, and the number of words of each text.

    The hash of a word is a polynomial over its bytes, taken from prefix sums modulo 2**64,
    so there is no Python loop over words. Some ten numbers are held for each byte, so texts are taken about
    ``HASHED_BYTES`` at a time.
    """
    upto = np.cumsum([len(t) for t in texts]) // HASHED_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(upto)) + 1).tolist(), len(texts)]
    found = [_word_hashes(texts[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    return np.concatenate([w for w, _ in found]), np.concatenate([c for _, c in found])


def _word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    joined = b"\n".join(texts)
    raw = np.frombuffer(joined, np.uint8)
    n = len(raw)
    if not n:
        return np.empty(0, np.uint64), np.zeros(len(texts), np.int64)
    inside = ~_SPACE[raw]
    edge = np.diff(inside.astype(np.int8), prepend=0, append=0)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    bounds = np.cumsum([len(t) + 1 for t in texts])
    counts = np.diff(np.searchsorted(start, bounds), prepend=0)
    if not len(start):
        return np.empty(0, np.uint64), counts
    up, down = _powers_upto("up", _BASE, n + 1), _powers_upto("down", _INVERSE, n + 1)
    prefix = np.empty(n + 1, np.uint64)
    prefix[0] = 0
    np.cumsum(_BYTE[raw] * down[:n], out=prefix[1:])
    return mix((prefix[end] - prefix[start]) * up[start] + (end - start).astype(np.uint64)), counts


def shingles(words: np.ndarray, counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the ``size``-word windows of each text, and how many each text has.

    A text with fewer words has one window of all its words; a text without words has none.
    """
    n, counts = len(words), counts.astype(np.int64)
    per = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    if not n:
        return np.empty(0, np.uint64), per
    first = np.cumsum(counts) - counts
    doc = np.repeat(np.arange(len(counts)), per)
    at = np.arange(len(doc)) - np.repeat(np.cumsum(per) - per, per) + first[doc]
    length = np.minimum(counts, size)[doc]
    out = np.zeros(len(at), np.uint64)
    for k in range(size):
        step = words[np.minimum(at + k, n - 1)]
        out = np.where(k < length, mix(out * np.uint64(_BASE) + step), out)
    return out, per

