"""Joins that Spark has no operator for: by interval, as of a date, pairs within a group, similarity."""

from __future__ import annotations

import contextlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType, DoubleType, StructField, StructType

from sluicework.storage import TASK_BYTES, intermediates, materialize


def interval_join(a: DataFrame, b: DataFrame, keys: list[str], a_ts: str, b_ts: str, seconds: int) -> DataFrame:
    """Pairs with equal keys and times at most ``seconds`` apart, whole seconds; the columns of ``b`` get the prefix ``b_``.

    Both sides are dealt by key and time slot, and ``b`` takes part in the slots next to its own too, so a
    hot key is spread over its slots and only near rows meet.
    """
    slot = lambda c: F.floor(F.unix_micros(F.col(c).cast("timestamp")) / (seconds * 1_000_000 + 1_000_000))
    left = a.withColumn("slot__", slot(a_ts))
    right = b.select([F.col(c).alias(f"b_{c}") for c in b.columns])
    right = right.withColumn("slot__", F.explode(F.transform(F.array(*map(F.lit, (-1, 0, 1))), lambda k: slot(f"b_{b_ts}") + k)))
    on = [F.col(k).eqNullSafe(F.col(f"b_{k}")) & F.col(k).isNotNull() for k in keys]
    near = F.abs(F.timestamp_diff("SECOND", F.col(a_ts), F.col(f"b_{b_ts}"))) <= seconds
    return left.join(right, [left["slot__"] == right["slot__"], *on, near]).drop("slot__")


def as_of(df: DataFrame, when: str, history: DataFrame, keys: list[str], effective: str, columns: list[str], seconds: int = 86400) -> DataFrame:
    """``columns`` of the latest history row per key that is effective at ``when``; null where there is none.

    One union and one window instead of a range join: history rows and rows to look up are sorted together,
    within slots of ``seconds``, so that a hot key is spread over its slots. A slot that is looked up starts
    with what the slots before it leave behind: the latest row of each slot is aggregated map-side, and only these
    are sorted by key alone. Of rows effective at one time the greatest by ``columns`` counts; a null
    ``effective`` is before all times, and a null ``when`` sees such rows only.
    """
    slot = lambda c: F.floor(F.unix_micros(F.col(c).cast("timestamp")) / (seconds * 1_000_000))
    h = history.select(*keys, slot(effective).alias("slot__"), F.col(effective).alias("at__"), F.struct(effective, *columns).alias("found__"), F.lit(1).alias("side__"))
    found, row = h.schema["found__"].dataType, F.struct(*df.columns)
    d = df.select(*keys, slot(when).alias("slot__"), F.col(when).alias("at__"), F.lit(None).cast(found).alias("found__"), F.lit(2).alias("side__"), row.alias("row__"))
    # found__ begins with the time, so the latest is the greatest
    slots = h.select(*keys, "slot__", "found__", F.lit(False).alias("asked__")).unionByName(d.select(*keys, "slot__", "found__", F.lit(True).alias("asked__")))
    slots = slots.groupBy(*keys, "slot__").agg(F.max("found__").alias("found__"), F.bool_or("asked__").alias("asked__"))
    earlier = Window.partitionBy(*keys).orderBy(F.col("slot__").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    carried = slots.withColumn("found__", F.max("found__").over(earlier)).where("asked__ and found__ is not null")
    carried = carried.select(*keys, "slot__", F.lit(None).cast(h.schema["at__"].dataType).alias("at__"), "found__", F.lit(0).alias("side__"))
    both = h.unionByName(carried).withColumn("row__", F.lit(None).cast(d.schema["row__"].dataType)).unionByName(d)
    w = Window.partitionBy(*keys, "slot__").orderBy(F.col("at__").asc_nulls_first(), "side__").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = both.withColumn("found__", F.max("found__").over(w)).where("side__ = 2")
    return out.select("row__.*", *(F.col(f"found__.{c}").alias(f"{c}_as_of") for c in columns))


def pairs_within(df: DataFrame, group: str, node: list[str], least: int = 2, most: int = 50) -> DataFrame:
    """Undirected pairs (a < b) of the distinct nodes of each group whose size is within the bounds."""
    nodes = df.select(group, F.struct(*node).alias("node")).distinct()
    sized = nodes.join(nodes.groupBy(group).agg(F.count("*").alias("size")).where(F.col("size").between(least, most)), group)
    a, b = sized.select(group, F.col("node").alias("a")), sized.select(F.col(group).alias("g__"), F.col("node").alias("b"))
    return a.join(b, (F.col(group) == F.col("g__")) & (F.col("a") < F.col("b"))).drop("g__")


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two arrays; null if either has no length."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    return F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


#: Items of up to so many bytes of vectors go to every task; beyond that both sides are dealt out in parts of about this size.
PART_BYTES = 16 << 20


def nearest(df: DataFrame, id_col: str, vector: str, items: DataFrame, item: str, item_vector: str, part_bytes: int = PART_BYTES) -> DataFrame:
    """id_col, best, score: the item whose vector has the greatest cosine, rounded to nine digits, to each row's; of ties the least item.

    ``items`` is the query set of any size. Up to ``part_bytes`` of vectors it is sent to the tasks, and the rows stay where they are. Beyond, rows
    and items are each dealt by hash into parts of about that size, and a task scores one part of rows against one of items; the best over parts is
    kept: one plan, whatever the number of items. Rows of one id count as one. Items without a name or a vector of some length are
    none; rows without one, or of another length than the items', have null best and score.
    """
    known = items.where(F.col(item).isNotNull() & F.col(item_vector).isNotNull()).select(F.col(item).alias("item"), F.col(item_vector).cast("array<double>").alias("v"))
    known = materialize(known.distinct(), "items")
    rows = df.select(F.col(id_col).alias("id"), F.col(vector).cast("array<double>").alias("v"))
    kind = known.schema["item"].dataType
    schema = StructType([rows.schema["id"], StructField("best", kind), StructField("score", DoubleType())])
    parts = _parts(known, "item", part_bytes)
    if parts == 1:
        scored = rows.mapInArrow(_scorer(sorted(((r["item"], r["v"]) for r in known.collect()), key=lambda x: x[0]), kind), schema)
    else:
        rows = materialize(rows.distinct(), "rows")  # one row may be most of them, and would be one part
        many = _parts(rows, "id", part_bytes)
        part = lambda n, *c: F.pmod(F.xxhash64(*c), F.lit(n)).cast("int")
        every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
        left = rows.withColumn("rows_part", part(many, "id", "v")).withColumn("items_part", every(parts))
        right = known.withColumn("items_part", part(parts, "item", "v")).withColumn("rows_part", every(many))
        scored = left.groupBy("rows_part", "items_part").cogroup(right.groupBy("rows_part", "items_part")).applyInArrow(_part_scorer(kind), schema)
        scored = scored.unionByName(rows.select("id", F.lit(None).cast(kind).alias("best"), F.lit(None).cast("double").alias("score")))
    # greatest score first, then the least item
    top = F.min(F.when(F.col("score").isNotNull(), F.struct((-F.col("score")).alias("minus"), "best")))
    return scored.groupBy("id").agg(top.alias("top")).select(F.col("id").alias(id_col), "top.best", (-F.col("top.minus")).alias("score"))


def _parts(vectors: DataFrame, name: str, part_bytes: int) -> int:
    """The number of parts of about ``part_bytes`` that the vectors and their names make."""
    bytes_ = F.greatest(F.size("v"), F.lit(0)).cast("long") * 8 + F.coalesce(F.octet_length(F.col(name).cast("string")), F.lit(0)) + 16
    size = vectors.agg(F.sum(bytes_)).first()[0] or 0
    return max(1, -(-size // part_bytes))


def _scorer(known: list[tuple[object, list]], kind: DataType) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function of Arrow batches of id and vectors: the nearest of the known items, which are in ascending order, or nulls."""
    names, units = _units(known)
    kind = to_arrow_type(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield from _best(batch.column(0), batch.column(1).to_pylist(), names, units, kind).to_batches()

    return run


def _part_scorer(kind: DataType) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """A function of a part of rows (id, v) and a part of items (item, v)."""
    kind = to_arrow_type(kind)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        names, units = _units(sorted(zip(right["item"].to_pylist(), right["v"].to_pylist(), strict=True), key=lambda x: x[0]))
        step = 1000  # a thousand rows at a time meet the items
        slices = [left.slice(k, step) for k in range(0, left.num_rows, step)] or [left]
        return pa.concat_tables([_best(t["id"], t["v"].to_pylist(), names, units, kind) for t in slices])

    return run


def _units(known: list[tuple[object, list]]) -> tuple[dict[int, list], dict[int, np.ndarray]]:
    """Names and a matrix of unit vectors per length of vector, in the order given; vectors without a finite length are left out."""
    names, rows = defaultdict(list), defaultdict(list)
    for name, v in known:
        v = np.array(v, float)  # a null component becomes nan
        norm = np.sqrt(v @ v)
        if norm > 0 and np.isfinite(norm):
            names[len(v)].append(name)
            rows[len(v)].append(v / norm)
    return names, {length: np.array(r) for length, r in rows.items()}


def _best(ids: pa.Array | pa.ChunkedArray, vectors: list, names: dict[int, list], units: dict[int, np.ndarray], kind: pa.DataType) -> pa.Table:
    """id, best, score of each vector among the items of its length; of ties the first."""
    best, score = [None] * len(vectors), [None] * len(vectors)
    for length, matrix in units.items():
        at = [k for k, v in enumerate(vectors) if v is not None and len(v) == length]
        if not at:
            continue
        mine = np.array([[np.nan if x is None else x for x in vectors[k]] for k in at], float)
        norms = np.sqrt((mine * mine).sum(axis=1))
        with np.errstate(divide="ignore", invalid="ignore"):
            cosines = np.round((mine @ matrix.T) / norms[:, None], 9)
        for k, row in zip(at, cosines, strict=True):
            if np.isfinite(row).all():
                j = int(row.argmax())
                best[k], score[k] = names[length][j], float(row[j])
    return pa.table({"id": ids, "best": pa.array(best, kind), "score": pa.array(score, pa.float64())})


def group_similarity(df: DataFrame, item: str, vector: str, group: str) -> DataFrame:
    """item, group, similarity: the mean cosine of each item to the other members of its group.

    The mean over others is the dot product with the group's sum of unit vectors, less one, by their
    number: sums per group and place of the vector, no pairs.
    """
    norm = F.sqrt(F.aggregate(vector, F.lit(0.0), lambda s, v: s + v.cast("double") * v.cast("double")))
    unit = df.select(F.col(item), F.col(group), F.transform(vector, lambda v: v.cast("double") / norm).alias("unit"))
    sums = unit.select(group, F.posexplode("unit").alias("i", "x")).groupBy(group, "i").agg(F.sum("x").alias("x"))
    whole = sums.groupBy(group).agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda p: p["x"]).alias("total"))
    n = unit.groupBy(group).agg(F.count("*").alias("n"))
    dot = F.aggregate(F.zip_with("unit", "total", lambda p, q: p * q), F.lit(0.0), lambda s, v: s + v)
    return unit.join(whole, group).join(n, group).where("n > 1").select(item, group, ((dot - 1) / (F.col("n") - 1)).alias("similarity"))


#: Pairs of unlike items that a part of ``most_overlap`` has on average, at most, and that a task holds before it sums them up.
PART_PAIRS = 4 << 20
#: Entries of lists that ``most_overlap`` may send at once, however few the lists have: about half a gigabyte.
SENT_AT_ONCE = 256 << 20
#: Bytes of a batch of packed lists, entries of lists that are packed together, and pairs that are made together.
_BATCH_BYTES, _PACKED, _MADE = 4 << 20, 1 << 20, 1 << 20


def most_overlap(df: DataFrame, item: str, value: str, most: int, part_pairs: int = PART_PAIRS, held: int = PART_PAIRS, sent_at_once: int = SENT_AT_ONCE) -> DataFrame:
    """a, b, shared, place: for each item the ``most`` others that it shares most distinct values with; of ties the lesser item. Items are integers.

    A value's items are sent as one list to each part of the items that has some of them, and pairs are made and counted there: so what is
    shuffled is a list for a part and not a row for a pair, and all pairs of an item meet in one task. Parts are ranges of items of about the same
    load, so that items that go together, as they often lie together, are sent once; they are as many as the pairs ask for, counted as often as they meet but
    no more than all items with all. Lists are sent as differences in as few bytes as these need. Parts take turns: in one turn lists of four
    times the entries that there are, or ``sent_at_once``, are sent and counted, and nothing of that stays on disk but its result.
    """
    spark = df.sparkSession
    schema = "a long, b long, shared long, place int"
    with intermediates(spark), _small_reads(spark):
        rows = df.select(F.col(item).cast("long").alias("a"), F.col(value).alias("v")).where("a IS NOT NULL AND v IS NOT NULL")
        lists = materialize(rows.groupBy("v").agg(F.array_sort(F.collect_set("a")).alias("items")).where(F.size("items") > 1).select("items"), "lists")
        loads = lists.select(F.explode("items").alias("a"), F.size("items").alias("n")).groupBy("a").agg(F.sum("n").alias("pairs"), F.count("*").alias("entries"))
        loads = materialize(loads, "loads")
        items, pairs, entries, low, high = loads.agg(F.count("*"), F.sum("pairs"), F.sum("entries"), F.min("a"), F.max("a")).first()
        if not items:
            return spark.createDataFrame([], schema)
        bounds = _bounds(loads, items, pairs, max(1, -(-min(pairs, items * items) // part_pairs), -(-pairs // (16 * part_pairs))))
        parts = len(bounds) + 1
        sent = lists.mapInArrow(_entries_sent(bounds), "n long").agg(F.sum("n")).first()[0]
        # a turn has some 64 parts at least, for that many tasks
        turns = max(1, min(-(-sent // max(4 * entries, sent_at_once)), parts // 64))
        done = []
        for turn in range(turns):
            packed = lists.mapInArrow(_packer(bounds, low, turns, turn), "part int, n long, lengths binary, items binary")
            packed = packed.repartitionById(min(-(-parts // turns), 20_000), F.floor(F.col("part") / turns).cast("int"))
            done.append(materialize(packed.mapInArrow(_overlaps(bounds, low, high, most, held), schema), "overlaps", keep=True))
    return reduce(DataFrame.unionByName, done)


@contextlib.contextmanager
def _small_reads(spark: SparkSession) -> Iterator[None]:
    """Within it tasks read files in parts of ``TASK_BYTES`` at most, as what a task groups or sends is many times that, and Arrow batches are small. Smaller settings are kept."""
    most = {"spark.sql.files.maxPartitionBytes": TASK_BYTES, "spark.sql.execution.arrow.maxBytesPerBatch": _BATCH_BYTES}
    before = {key: spark.conf.get(key, None) for key in most}
    as_bytes = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    try:
        for key, size in most.items():
            spark.conf.set(key, str(size if before[key] is None else min(size, as_bytes(before[key]))))
        yield
    finally:
        for key, was in before.items():
            if was is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, was)


def _bounds(loads: DataFrame, items: int, pairs: int, parts: int) -> np.ndarray:
    """The least items of all parts but the first. An item counts as one and by its share of the pairs, so no part has much more than others but by one item."""
    if parts == 1:
        return np.empty(0, np.int64)
    times = F.least(F.ceil(F.col("pairs") * (4 * items / pairs)), F.lit(min(1 << 20, 10 * items // parts + 1))).cast("int")  # beyond two parts' it is all one
    shares = loads.select(F.explode(F.array_repeat("a", times)).alias("a"))
    found = shares.agg(F.percentile_approx("a", [k / parts for k in range(1, parts)], 20 * parts + 10_000)).first()[0]
    return np.unique(np.array(found, np.int64))


def _lists(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """All items and the lengths of the lists of a batch."""
    return batch.column(0).flatten().to_numpy(), batch.column(0).value_lengths().to_numpy().astype(np.int64)


def _places(flat: np.ndarray, lengths: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """List and part of each part that a list has items of. Lists are in ascending order, so a part's items stand together."""
    part = np.searchsorted(bounds, flat, "right")
    first = np.r_[True, part[1:] != part[:-1]]
    first[np.cumsum(lengths) - lengths] = True
    return np.repeat(np.arange(len(lengths)), lengths)[first], part[first]


def _entries_sent(bounds: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function of Arrow batches of lists: the entries that go to parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                flat, lengths = _lists(batch)
                yield pa.record_batch([pa.array([int(lengths[_places(flat, lengths, bounds)[0]].sum())], pa.int64())], ["n"])

    return run


def _pack(x: np.ndarray) -> bytes:
    """Unsigned numbers in as few bytes as the greatest needs: all lowest bytes, then the next, as high ones are mostly zero and compress well."""
    width = max(1, (int(x.max()).bit_length() + 7) // 8)
    return x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def _unpack(packed: bytes, n: int) -> np.ndarray:
    """The ``n`` numbers that were packed."""
    out = np.zeros((n, 8), np.uint8)
    width = len(packed) // n
    out[:, :width] = np.frombuffer(packed, np.uint8).reshape(width, n).T
    return out.view("<u8").ravel()


def _packer(bounds: np.ndarray, low: int, turns: int, turn: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function of Arrow batches of lists: for each part whose turn it is the lists that have some of its items, packed together."""

    def rows(flat: np.ndarray, lengths: np.ndarray) -> Iterator[tuple[int, int, bytes, bytes]]:
        which, part = _places(flat, lengths, bounds)
        mine = np.flatnonzero(part % turns == turn)
        mine = mine[np.argsort(part[mine], kind="stable")]
        which, part = which[mine], part[mine]
        starts = np.cumsum(lengths) - lengths
        # differences from the item before, or from the least of all; unsigned, so that they wrap and come back whatever the range
        steps = np.diff(flat.view(np.uint64), prepend=np.uint64(0))
        steps[starts] = flat[starts].view(np.uint64) - np.int64(low).view(np.uint64)
        cuts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]]) if len(part) else []
        for begin, end in zip(cuts, [*cuts[1:], len(part)], strict=True):
            n = lengths[which[begin:end]]
            at = np.repeat(starts[which[begin:end]] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            yield int(part[begin]), len(n), _pack(n), _pack(steps[at])

    def batch(out: list[tuple[int, int, bytes, bytes]]) -> pa.RecordBatch:
        kinds = {"part": pa.int32(), "n": pa.int64(), "lengths": pa.binary(), "items": pa.binary()}
        return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds.values(), strict=True)], list(kinds))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, size = [], 0
        for row in (row for lists in _gathered(batches) for row in rows(*lists)):
            out.append(row)
            size += len(row[2]) + len(row[3])
            if size > _BATCH_BYTES:
                yield batch(out)
                out, size = [], 0
        if out:
            yield batch(out)

    return run


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The items and lengths of lists, of as many batches as have about ``_PACKED`` items."""
    kept, size = [], 0
    for batch in batches:
        if batch.num_rows:
            kept.append(_lists(batch))
            size += len(kept[-1][0])
            if size >= _PACKED:
                yield tuple(map(np.concatenate, zip(*kept, strict=True)))
                kept, size = [], 0
    if kept:
        yield tuple(map(np.concatenate, zip(*kept, strict=True)))


def _overlaps(bounds: np.ndarray, low: int, high: int, most: int, held: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function of Arrow batches of part and packed lists of items: the greatest overlaps of the items of each part that comes."""
    span = high - low + 1

    def counted(a: np.ndarray, b: np.ndarray, have: tuple[np.ndarray, ...]) -> tuple[np.ndarray, ...]:
        """Each pair once with its count, in ascending order, of pairs and of those counted before."""
        every = np.concatenate([a, have[0], b, have[1]])
        if span * span < 1 << 63:
            wide, names, every = span, None, every - low
        else:  # two items don't fit in one number, but two places among these items do
            names, every = np.unique(every, return_inverse=True)
            wide = len(names)
        keys = every[: len(every) // 2] * wide + every[len(every) // 2 :]
        new = np.sort(keys[: len(a)])
        first = np.flatnonzero(np.r_[True, new[1:] != new[:-1]])
        n, new = np.diff(np.r_[first, len(new)]), new[first]
        if len(have[0]):
            new, n = np.concatenate([keys[len(a) :], new]), np.concatenate([have[2], n])
            order = np.argsort(new, kind="stable")
            new, n = new[order], n[order]
            first = np.flatnonzero(np.r_[True, new[1:] != new[:-1]])
            new, n = new[first], np.add.reduceat(n, first)
        a, b = np.divmod(new, wide)
        return (a + low, b + low, n) if names is None else (names[a], names[b], n)

    def greatest(a: np.ndarray, b: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        starts, last = np.flatnonzero(np.r_[True, a[1:] != a[:-1]]), len(a) - 1
        rank = n * len(a) + (last - np.arange(len(a)))  # the greater count, then the lesser item
        for place in range(1, most + 1):
            best = np.maximum.reduceat(rank, starts)
            at = last - best[best >= 0] % len(a)
            if not len(at):
                return
            out = pa.record_batch([pa.array(a[at]), pa.array(b[at]), pa.array(n[at]), pa.array(np.full(len(at), place, np.int32))], ["a", "b", "shared", "place"])
            yield from (out.slice(k, 10_000) for k in range(0, out.num_rows, 10_000))
            rank[at] = -1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have, kept, size, limit = (np.empty(0, np.int64),) * 3, [], 0, held
        for a, b in (pair for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True) for pair in _pairs(row, bounds, low)):
            kept.append((a, b))
            size += len(a)
            if size > limit:
                have, kept, size = counted(*map(np.concatenate, zip(*kept, strict=True)), have), [], 0
                limit = max(held, len(have[0]))
        if size:
            have = counted(*map(np.concatenate, zip(*kept, strict=True)), have)
        if len(have[0]):
            yield from greatest(*have)

    return run


def _pairs(row: tuple[int, int, bytes, bytes], bounds: np.ndarray, low: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The pairs of a part's items with the others of each list, some at a time."""
    part, n, lengths, steps = row
    lengths = _unpack(lengths, n).astype(np.int64)
    steps = _unpack(steps, int(lengths.sum()))
    starts = np.cumsum(lengths) - lengths
    sums = np.cumsum(steps)
    flat = (sums - np.repeat(sums[starts] - steps[starts], lengths) + np.int64(low).view(np.uint64)).view(np.int64)
    mine = np.flatnonzero(np.searchsorted(bounds, flat, "right") == part)
    which = np.repeat(np.arange(n), lengths)[mine]
    per, cut = lengths[which], 0
    sums = np.cumsum(per)
    while cut < len(mine):  # own items, as many as make about so many pairs, or one
        upto = max(cut + 1, int(np.searchsorted(sums, sums[cut] - per[cut] + _MADE, "right")))
        times = per[cut:upto]
        at = np.repeat(starts[which[cut:upto]] - (np.cumsum(times) - times), times) + np.arange(times.sum())
        a, b = np.repeat(flat[mine[cut:upto]], times), flat[at]
        yield a[a != b], b[a != b]
        cut = upto
