"""N-gram Jaccard self-join by MinHash banding.

1. Each text becomes the set of its five-word shingles (64-bit hashes), a 128-bit digest of that set
   and band hashes of a MinHash signature. Texts with one digest are one class: all copies link.
2. Classes are shuffled on band hashes. Buckets of more than one class are the units of verification; buckets that
   hold the very same classes, as those of two near copies mostly do, are one unit.
3. In a unit, pairs of classes are verified on full shingle sets. A unit is cut into blocks of bounded size, and
   each pair of blocks goes to one task. Each class comes with the units it is in, and a pair that is together in several is
   verified in the least of them only. A task counts each class's links and keeps a spanning forest of them; it
   doesn't emit the pairs. Texts that only a chain of buckets joins are never compared. A class goes to units once, however
   many rows have its id and text; a unit of many unlike classes sends each of their sets once for each of its blocks, so
   what is shuffled for it grows with the square of its classes, by their number over ``BLOCK_CLASSES``.
4. Components of the verified links are the groups of near copies.

Bands and rows: the most rows per band for which a pair at the threshold shares a band with the
target recall, within a limit on hashes. Sizes of what is shuffled: a row of 24 bytes per class and
band, the texts of classes in units, and their sets once for each unit and block.

Edge cases: texts with fewer than five words have one shingle of all their words; a text without
words (null or empty too) has no link and a class of its own; ties and repeated rows are copies; null
ids are ids; long texts take part with all their shingles; an empty table gives no row; other columns
are ignored by ``near_duplicates`` and kept by ``keep_one``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluicework.llm.common import bounded_batches, few_tasks, materialize, mix, row_order, shingles, table, word_hashes
from sluicework.operators.components import components

SHINGLE = 5
THRESHOLD = 0.8
RECALL = 0.9995
MOST_HASHES = 160
#: A block of a component holds about so many shingles and classes at most.
BLOCK_SHINGLES, BLOCK_CLASSES = 2_000_000, 1024
TILE, COLUMNS = 256, 8192


def choose_bands(threshold: float, recall: float = RECALL, most: int = MOST_HASHES) -> tuple[int, int]:
    """(bands, rows): the most rows for which bands * rows <= most reach the recall at the threshold; an error if none do."""
    found = None
    for rows in range(1, most + 1):
        hit = threshold**rows
        bands = 1 if hit >= recall else math.ceil(math.log1p(-recall) / math.log1p(-hit))
        if bands * rows > most:
            break
        found = (bands, rows)
    if found is None:
        raise ValueError(f"{most} hashes can't find pairs at {threshold} with recall {recall}")
    return found


def shingle_sets(texts: list[bytes], size: int = SHINGLE) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    words, counts = word_hashes(texts)
    grams, per = shingles(words, counts, size)
    ends = np.cumsum(per)
    return [np.unique(grams[e - n : e]) for e, n in zip(ends.tolist(), per.tolist(), strict=True)]


def set_digest(grams: np.ndarray) -> bytes:
    """128 bits that don't depend on order: two sums of independent mixes."""
    a, b = mix(grams), mix(grams ^ np.uint64(0xD6E8FEB86659FD93))
    return np.array([a.sum(dtype=np.uint64), b.sum(dtype=np.uint64)], "<u8").tobytes()


def signer(bands: int, rows: int):
    """A function from a shingle set to its band hashes."""
    rng = np.random.default_rng(97)
    flip = rng.integers(0, 1 << 32, bands * rows, dtype=np.uint32)
    times = rng.integers(0, 1 << 31, bands * rows, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    number = mix(np.arange(1, bands + 1, dtype=np.uint64))

    def sign(grams: np.ndarray) -> np.ndarray:
        x = (grams >> np.uint64(32)).astype(np.uint32)
        least = np.full(bands * rows, 0xFFFFFFFF, np.uint32)
        for a in range(0, len(x), 1024):
            np.minimum(least, ((x[a : a + 1024, None] ^ flip) * times).min(axis=0), out=least)
        out = number.copy()
        for column in least.reshape(bands, rows).T:
            out = mix(out ^ column.astype(np.uint64)) + np.uint64(0x9E3779B97F4A7C15)
        return out.view(np.int64)

    return sign


def signatures(docs: DataFrame, id_col: str, text_col: str, bands: int, rows: int, size: int) -> DataFrame:
    """doc_id, th (hash of the text), digest (null without words), n (shingles), bands."""
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sign = signer(bands, rows)
        for batch in batches:
            sets = shingle_sets([(t or "").encode() for t in batch.column(2).to_pylist()], size)
            digests = [set_digest(g) if len(g) else None for g in sets]
            keys = [sign(g) if len(g) else None for g in sets]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(digests, pa.binary()), pa.array([len(g) for g in sets], pa.int64()), pa.array(keys, pa.list_(pa.int64()))], names=["doc_id", "th", "digest", "n", "bands"])

    rows_ = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(text_col)).alias("th"), F.col(text_col).cast("string").alias("text"))
    return rows_.mapInArrow(run, "doc_id long, th long, digest binary, n long, bands array<long>")


def _intersections(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """How many column numbers each of ``a`` shares with each of ``b``, by products of 0/1 matrices, a strip of columns at a time."""
    both = np.intersect1d(np.concatenate(a), np.concatenate(b))
    out = np.zeros((len(a), len(b)), np.float32)
    for at in range(0, len(both), COLUMNS):
        strip = both[at : at + COLUMNS]
        ms = []
        for sets in (a, b):
            m = np.zeros((len(sets), len(strip)), np.float32)
            flat = np.concatenate(sets)
            row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
            col = np.minimum(np.searchsorted(strip, flat), len(strip) - 1)
            hit = strip[col] == flat
            m[row[hit], col[hit]] = 1.0
            ms.append(m)
        out += ms[0] @ ms[1].T
    return out


def _together(units: list[np.ndarray], unit: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which pairs of ``a`` and ``b`` are in a lesser unit together, too."""
    below = [[set(units[k][units[k] < unit].tolist()) for k in x] for x in (a, b)]
    both = set().union(*below[0]) & set().union(*below[1])
    out = np.zeros((len(a), len(b)), bool)
    for u in both:
        out |= np.array([u in x for x in below[0]])[:, None] & np.array([u in x for x in below[1]])[None, :]
        if out.all():
            break
    return out


def verify(sets: list[np.ndarray], copies: np.ndarray, side: np.ndarray, within: bool, threshold: float, units: list[np.ndarray] | None = None, unit: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of sets with at least the threshold, ``within`` side 0, or between sides 0 and 1; none if a side is empty.

    Pairs that are together in one of their ``units`` below ``unit`` are left to that one. Returns each set's links,
    weighted by the copies of its partners, and the least index of its component.
    Sets are compared in tiles ordered by size; tiles whose sizes differ too much are passed over.
    """
    order = np.argsort([len(s) for s in sets], kind="stable")
    links, label = np.zeros(len(sets), np.int64), np.arange(len(sets))
    parts = [order[side[order] == x] for x in (0, 1)]
    left, right = (parts[0], parts[0]) if within else (parts[0], parts[1])
    for i in range(0, len(left), TILE):
        a = left[i : i + TILE]
        for j in range(0, len(right), TILE):
            b = right[j : j + TILE]
            if left is right and j < i:
                continue
            if len(sets[a[-1]]) < threshold * len(sets[b[0]]) or len(sets[b[-1]]) < threshold * len(sets[a[0]]):
                continue
            mine = np.ones((len(a), len(b)), bool) if units is None else ~_together(units, unit, a, b)
            if left is right and i == j:
                mine = np.triu(mine, 1)
            rows, columns = np.flatnonzero(mine.any(axis=1)), np.flatnonzero(mine.any(axis=0))
            if not len(rows):
                continue
            a_, b_, mine = a[rows], b[columns], mine[np.ix_(rows, columns)]
            shared = _intersections([sets[k] for k in a_], [sets[k] for k in b_]).astype(np.int64)
            sizes = np.array([len(sets[k]) for k in a_])[:, None] + np.array([len(sets[k]) for k in b_])[None, :]
            # shared / (sizes - shared) >= threshold, in whole thousandths
            x, y = np.nonzero(mine & (1000 * shared >= round(1000 * threshold) * (sizes - shared)))
            x, y = a_[x], b_[y]
            np.add.at(links, x, copies[y])
            np.add.at(links, y, copies[x])
            while (label[x] != label[y]).any():
                low, high = np.minimum(label[x], label[y]), np.maximum(label[x], label[y])
                np.minimum.at(label, high, low)
                while (label != label[label]).any():
                    label = label[label]
    return links, label


def _verify_units(threshold: float):
    """For rows sorted by (unit, i, j): a row per linked class with its links there and the least class it hangs on."""

    def of(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.drop_duplicates("digest").sort_values("digest")  # so that the tasks hang a class on the same ones
        sets = [np.frombuffer(g, np.uint64) for g in rows["grams"]]
        _, number = np.unique(np.concatenate(sets), return_inverse=True)
        ends = np.cumsum([len(s) for s in sets])
        sets = [np.sort(number[e - len(s) : e]) for e, s in zip(ends, sets, strict=True)]
        i, j, unit = (int(rows[c].iloc[0]) for c in ("i", "j", "unit"))
        links, label = verify(sets, rows["copies"].to_numpy(), (rows["block"] != i).to_numpy().astype(int), i == j, threshold, [np.asarray(u, np.int64) for u in rows["units"]], unit)
        digests = rows["digest"].to_numpy()
        return pd.DataFrame({"digest": digests, "links": links, "root": digests[label]})[links > 0]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []  # rows of the last key so far
        last = None
        for rows in batches:
            key = list(zip(rows["unit"], rows["i"], rows["j"], strict=True))
            starts = [k for k in range(len(key)) if k == 0 or key[k] != key[k - 1]]
            for a, b in zip(starts, [*starts[1:], len(key)], strict=True):
                if held and key[a] != last:
                    yield of(pd.concat(held, ignore_index=True))
                    held = []
                held.append(rows.iloc[a:b])
                last = key[a]
        if held:
            yield of(pd.concat(held, ignore_index=True))

    return run


def unit_members(classes: DataFrame, block: tuple[int, int]) -> DataFrame:
    """From classes (digest, n, bands), digest and own: the units that each class is in, and into how many blocks they are cut."""
    members = classes.select("digest", "n", F.explode("bands").alias("key"))
    name = (F.xxhash64("digest").cast("decimal(38,0)"), F.xxhash64(F.lit(1), "digest").cast("decimal(38,0)"))
    buckets = members.groupBy("key").agg(F.count("*").alias("k"), F.sum("n").alias("n"), *(F.sum(x).alias(f"s{i}") for i, x in enumerate(name))).where("k > 1")
    blocks = F.greatest(F.ceil(F.col("n") / block[0]), F.ceil(F.col("k") / block[1])).cast("int")
    kept = materialize(buckets.groupBy("k", "n", "s0", "s1").agg(F.min("key").alias("unit")).select("unit", blocks.alias("blocks")), "units")
    return members.join(kept, F.col("key") == F.col("unit")).groupBy("digest").agg(F.collect_list(F.struct("unit", "blocks")).alias("own"))


def linked_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, size: int = SHINGLE, recall: float = RECALL, block: tuple[int, int] = (BLOCK_SHINGLES, BLOCK_CLASSES)) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The documents' signatures, their classes, and what was verified: a row per linked class and pair of blocks with its links there and the least digest it hangs on."""
    spark = docs.sparkSession
    bands, rows = choose_bands(threshold, recall)
    signed = materialize(signatures(docs, id_col, text_col, bands, rows, size), "signatures")
    classes = signed.where("digest is not null").groupBy("digest").agg(F.min(F.struct("doc_id", "th")).alias("rep"), F.count("*").alias("copies"), F.first("n").alias("n"), F.first("bands").alias("bands"))
    classes = materialize(few_tasks(classes, signed.count()), "classes")
    own = unit_members(classes, block)
    need = own.join(classes.select("digest", "rep", "copies"), "digest").select("digest", "copies", "own", F.col("rep.doc_id").alias("rep_id"), F.col("rep.th").alias("rep_th"))
    texts = docs.select(F.col(id_col).cast("long").alias("rep_id"), F.xxhash64(F.col(text_col)).alias("rep_th"), F.col(text_col).cast("string").alias("text"))
    # a sort-merge join at any size: its rows come by (rep_id, rep_th), so rows that are alike come one after the other
    need_text = texts.join(need.hint("merge"), texts["rep_id"].eqNullSafe(need["rep_id"]) & (texts["rep_th"] == need["rep_th"])).select("digest", "copies", "own", "text")

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for rows_ in batches:
            digests = rows_.column(0).to_pylist()
            first = [d != before for d, before in zip(digests, [last, *digests], strict=False)]
            if not digests or not any(first):
                continue
            last, rows_ = digests[-1], rows_.filter(pa.array(first))  # of a class that has many rows of one id and text, one in each task
            sets = shingle_sets([t.encode() for t in rows_.column(3).to_pylist()], size)
            yield pa.RecordBatch.from_arrays([*rows_.columns[:3], pa.array([s.tobytes() for s in sets], pa.binary())], names=["digest", "copies", "own", "grams"])

    with_sets = need_text.mapInArrow(grams, "digest binary, copies long, own array<struct<unit:long,blocks:int>>, grams binary")
    spread = with_sets.select("digest", "copies", F.col("own.unit").alias("units"), F.explode("own").alias("of"), "grams").select("digest", "copies", "units", "of.unit", "of.blocks", F.pmod(F.xxhash64("digest"), F.col("of.blocks")).cast("int").alias("block"), "grams")
    other = spread.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    units = other.select("unit", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "digest", "copies", "block", "units", "grams")
    units = units.repartition("unit", "i", "j").sortWithinPartitions("unit", "i", "j")
    return signed, classes, materialize(units.mapInPandas(_verify_units(threshold), "digest binary, links long, root binary"), "links")


def linked_groups(classes: DataFrame, found: DataFrame) -> DataFrame:
    """From classes and what was verified: digest, root and rep of the classes that have a link; those of a group have one root."""
    groups = components(found.select(F.col("digest").alias("u"), F.col("root").alias("v"))).select(F.col("node").alias("digest"), F.col("component").alias("root"))
    return materialize(few_tasks(groups.join(classes.select("digest", "rep"), "digest"), found.count()), "groups")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """A row per document: doc_id, th, class_id and class_th (id and text hash of the group's least document), n_links, n_copies."""
    signed, classes, found = linked_classes(docs, id_col, text_col, **options)
    groups = linked_groups(classes, found).join(found.groupBy("digest").agg(F.sum("links").alias("links")), "digest")
    first = materialize(groups.groupBy("root").agg(F.min("rep").alias("first")), "firsts")
    linked = groups.join(first, "root").select("digest", "links", "first")
    info = classes.select("digest", "rep", "copies").join(linked, "digest", "left")
    info = materialize(info.select("digest", "copies", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("first", "rep").alias("first")), "info")
    out = signed.select("doc_id", "th", "digest").join(info, "digest", "left")
    own = F.struct("doc_id", "th")
    first = F.coalesce("first", own)
    return out.select("doc_id", "th", first["doc_id"].alias("class_id"), first["th"].alias("class_th"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("copies", F.lit(1)).cast("long").alias("n_copies"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` without near copies: of each group the document with the least id (then text hash), once."""
    signed, classes, found = linked_classes(docs, id_col, text_col, **options)
    groups = linked_groups(classes, found)
    least = classes.join(groups, "digest", "left_anti").select("rep.*").union(groups.groupBy("root").agg(F.min("rep").alias("rep")).select("rep.*"))
    kept = least.union(signed.where("digest is null").select("doc_id", "th"))
    kept = materialize(few_tasks(kept.toDF("kept_id__", "kept_th__"), signed.count()), "kept")
    key, th = F.col(id_col).cast("long"), F.xxhash64(F.col(text_col))
    out = docs.join(kept, key.eqNullSafe(F.col("kept_id__")) & (th == F.col("kept_th__")), "left_semi")
    if signed.where("digest is not null").groupBy("doc_id", "th").count().where("count > 1").limit(1).count():
        wordy = F.col(text_col).rlike(r"[^\x20\x09-\x0D]")
        place = Window.partitionBy(key, th).orderBy(row_order(docs))
        out = out.withColumn("kept_n__", F.when(wordy, F.row_number().over(place)).otherwise(1)).where("kept_n__ = 1")
    return out.select([docs[c] for c in docs.columns])


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents: doc_id, class_id (least doc_id among those linked with it), n_links, n_copies."""
    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links", "n_copies")


#: All pairs by shared shingles.
OP9_SQL = r"""
WITH RECURSIVE words AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
grams AS (SELECT DISTINCT doc_id, CASE WHEN len(w) >= 5 THEN w[i:i + 4] ELSE w END AS g FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 4, 1))) AS i FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT a, b, k = x.n AND k = y.n AS same FROM pairs JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id WHERE 1000 * k >= 800 * (x.n + y.n - k)),
both_ways AS (SELECT a AS u, b AS v, same FROM links UNION ALL SELECT b, a, same FROM links),
reach(u, root) AS (SELECT doc_id, doc_id FROM documents UNION SELECT v, root FROM reach JOIN both_ways USING (u)),
counts AS (SELECT u, count(*) AS n_links, 1 + count(*) FILTER (same) AS n_copies FROM both_ways GROUP BY u)
SELECT r.u AS doc_id, min(root) AS class_id, coalesce(any_value(n_links), 0) AS n_links, coalesce(any_value(n_copies), 1) AS n_copies FROM reach r LEFT JOIN counts USING (u) GROUP BY r.u
"""
