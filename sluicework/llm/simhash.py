"""Near copies by SimHash: fingerprints within a few bits of one another, compared exactly in tiles.

1. A fingerprint has a bit for each bit that is set in over half of the XXH64 hashes of a text's word shingles.
2. Equal fingerprints are one class. Classes are dealt into tiles of one population count each (how many bits are set), of
   about ``TILE`` classes at most; a count that has more of them is cut by a hash. Two fingerprints within r bits have
   population counts within r, so only tiles of such counts meet; each pair of tiles is a unit of work of bounded size.
3. In a unit the tiles are cut by the population counts of the fingerprint's four quarters. Parts whose counts differ by more than r in
   total are passed over, and the others are compared by exclusive or and bit counts. A unit keeps a spanning
   forest of the links it finds and emits at most a row per class, never the pairs.
4. Components of all units' links are the groups.

Every pair of classes is in exactly one unit or is excluded by its counts, so the result is exact. What is compared grows with the square of
the number of classes, divided by some 20 for random bits by the quarters' counts; what is shuffled is 17 bytes a class for
each tile within reach (7, and more where a count needs several tiles).

Edge cases: a text with fewer words than a shingle has one shingle of all its words; a text without words (null or empty too) has the
fingerprint zero, which links like any other; ties (half of the hashes) leave a bit 0; repeated rows have one class; a null id has a row, and
counts for its component's least id only where there is no other; long texts are hashed some thousands of shingles at a time;
an empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicework.llm.common import bounded_batches, materialize, table
from sluicework.operators.components import components

SHINGLE, RADIUS, HASH_SEED = 3, 3, 42
#: A tile has about so many classes at most.
TILE = 16384
#: Shingles that are hashed at a time, and fingerprints that are compared at a time.
_HASHED, _COMPARED = 8192, 1 << 20
_BITS = 64


def fingerprint(text: bytes, size: int = SHINGLE, seed: int = HASH_SEED) -> int:
    """The SimHash of UTF-8 text: its words are runs of anything but ASCII white space, A-Z in lower case."""
    words = text.lower().split()
    if not words:
        return 0
    joined, ends = b" ".join(words), np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    size = min(size, len(words))
    first, last = starts[: len(words) - size + 1], ends[size - 1 :]
    set_bits, of = np.zeros(_BITS, np.int64), xxhash.xxh64_intdigest
    for at in range(0, len(first), _HASHED):
        pieces = zip(first[at : at + _HASHED].tolist(), last[at : at + _HASHED].tolist(), strict=True)
        hashes = np.array([of(joined[a:b], seed) for a, b in pieces], "<u8")
        set_bits += np.unpackbits(hashes.view(np.uint8), bitorder="little").reshape(-1, _BITS).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * set_bits > len(first), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE) -> DataFrame:
    """A row per document: doc_id and fp, the fingerprint's 64 bits as a long."""
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t.as_buffer().to_pybytes() if t.is_valid else b"", size) for t in batch.column(1)], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], names=["doc_id", "fp"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, "doc_id long, fp long")


class _Forest:
    """Least indices of the components of links that come in bulk."""

    def __init__(self, n: int):
        self.label, self.linked, self.held, self.n_held = np.arange(n), np.zeros(n, bool), [], 0

    def add(self, x: np.ndarray, y: np.ndarray) -> None:
        self.held.append((x, y))
        self.n_held += len(x)
        if self.n_held > _COMPARED:
            self.settle()

    def settle(self) -> None:
        if not self.held:
            return
        x, y = (np.concatenate(z) for z in zip(*self.held, strict=True))
        self.held, self.n_held = [], 0
        self.linked[x] = self.linked[y] = True
        label = self.label
        while (label[x] != label[y]).any():
            low, high = np.minimum(label[x], label[y]), np.maximum(label[x], label[y])
            np.minimum.at(label, high, low)
            while (label != label[label]).any():
                label = label[label]
        self.label = label


def _parts(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """An order of fingerprints by the population counts of their quarters, those counts by part, and where each part ends."""
    counts = np.bitwise_count(np.ascontiguousarray(fps).view(np.uint16).reshape(len(fps), 4)).astype(np.int16)
    order = np.lexsort(counts.T)
    found, starts = np.unique(counts[order][:, ::-1], axis=0, return_index=True)
    return order, found[:, ::-1], np.append(starts, len(fps))


def linked(left: np.ndarray, right: np.ndarray | None, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Links within ``left``, or between it and ``right`` where that is given: which of all (left, then right) have one, and the least index each hangs on."""
    n = len(left)
    forest = _Forest(n + (0 if right is None else len(right)))
    order_a, counts_a, ends_a = _parts(left)
    order_b, counts_b, ends_b = (order_a, counts_a, ends_a) if right is None else _parts(right)
    a_fps, b_fps = left[order_a], (left if right is None else right)[order_b]
    order_b = order_b + (0 if right is None else n)
    for part, counts in enumerate(counts_a):
        near = np.flatnonzero(np.abs(counts_b - counts).sum(axis=1) <= radius)
        near = near[near >= part] if right is None else near
        if not len(near):
            continue
        there = np.concatenate([np.arange(ends_b[k], ends_b[k + 1]) for k in near.tolist()])
        step = max(_COMPARED // len(there), 1)
        for at in range(ends_a[part], ends_a[part + 1], step):
            here = np.arange(at, min(at + step, ends_a[part + 1]))
            x, y = np.nonzero(np.bitwise_count(a_fps[here][:, None] ^ b_fps[there][None, :]) <= radius)
            x, y = order_a[here[x]], order_b[there[y]]
            if len(x) and right is None:
                x, y = x[x != y], y[x != y]
            if len(x):
                forest.add(x, y)
    forest.settle()
    return forest.linked, forest.label


def _compare(radius: int):
    """For rows sorted by unit: a row per linked class, with the class of the unit that it hangs on."""

    def of(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(held)
        fps, side = rows.column("fp").to_numpy().view(np.uint64), rows.column("side").to_numpy()
        fps, side = fps[np.argsort(side, kind="stable")], np.sort(side)
        within = rows.column("within")[0].as_py()
        n = int((side == 0).sum())
        hit, label = linked(fps, None, radius) if within else linked(fps[:n], fps[n:], radius) if 0 < n < len(fps) else (np.zeros(len(fps), bool), np.arange(len(fps)))
        hit &= label != np.arange(len(fps))
        signed = fps.view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(signed[hit]), pa.array(signed[label[hit]])], names=["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # rows of the last unit so far
        last = None
        for batch in batches:
            unit = batch.column("unit").to_numpy()
            starts = [0, *(np.flatnonzero(np.diff(unit)) + 1).tolist(), len(unit)]
            for a, b in zip(starts[:-1], starts[1:], strict=True):
                if a == b:
                    continue
                if held and unit[a] != last:
                    yield of(held)
                    held = []
                held.append(batch.slice(a, b - a))
                last = unit[a]
        if held:
            yield of(held)

    return run


def units(classes: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """From classes (fp): unit, side, within and fp. Each pair of classes that their counts don't exclude shares exactly one unit.

    There are 65 population counts, so the table of tiles for each is bounded; a count's tiles are numbered from 0.
    """
    spark = classes.sparkSession
    count = F.bit_count("fp").cast("int")
    sizes = {r["count"]: r["n"] for r in classes.groupBy(count.alias("count")).agg(F.count("*").alias("n")).collect()}
    tiles = {c: -(-n // tile) for c, n in sizes.items()}
    near = [(c, k, o, m) for c, k in tiles.items() for o, m in tiles.items() if abs(c - o) <= radius]
    reach = spark.createDataFrame(near, "count int, tiles int, other int, other_tiles int")
    rows = classes.select("fp", count.alias("count")).join(F.broadcast(reach), "count")
    own = F.col("count").cast("long") * (1 << 24) + F.pmod(F.xxhash64("fp"), F.col("tiles"))
    rows = rows.select("fp", own.alias("own"), F.col("other").cast("long").alias("other"), F.explode(F.sequence(F.lit(0), F.col("other_tiles") - 1)).alias("at"))
    far = F.col("other") * (1 << 24) + F.col("at")
    return rows.select((F.least("own", far) * (1 << 31) + F.greatest("own", far)).alias("unit"), (F.col("own") > far).cast("int").alias("side"), (F.col("own") == far).alias("within"), "fp")


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """A row per document: doc_id, fp, and component_id, the least id that links reach."""
    found = materialize(fingerprints(docs, id_col, text_col, size), "fingerprints")
    classes = materialize(found.groupBy("fp").agg(F.min("doc_id").alias("least")), "classes")
    dealt = units(classes.select("fp"), radius, tile).repartition("unit").sortWithinPartitions("unit")
    links = materialize(dealt.mapInArrow(_compare(radius), "u long, v long"), "links")
    groups = components(links).select(F.col("node").alias("fp"), F.col("component").alias("root"))
    named = classes.join(groups, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    named = materialize(named, "named")
    first = materialize(named.groupBy("root").agg(F.min("least").alias("component_id")), "first")
    info = materialize(named.join(first, "root").select("fp", "component_id"), "info")
    return found.join(info, "fp").select("doc_id", "fp", "component_id")


def hex_digits(fp: str) -> Column:
    """The 16 lower-case hexadecimal digits of a long's bits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents: doc_id, fingerprint, component_id."""
    return near_copies(table(spark, sf_dir, "documents")).select("doc_id", hex_digits("fp").alias("fingerprint"), "component_id")
