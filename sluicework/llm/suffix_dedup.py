"""Exact removal of repeated byte strings, by a depth-limited radix sort of suffixes.

A byte goes if a ``WINDOW``-byte string that covers it also starts earlier, in a smaller document or
further up in the same one. Suffixes are only told apart by their first ``WINDOW`` bytes, and the
sort goes from coarse digits to fine ones; suffixes that are alone with their digits leave after
each pass, so most never reach the next.

Digit 1, the anchor: of the ``GRAM``-byte grams in a suffix's first ``WINDOW`` bytes, the one with the
    least hash. It depends on those bytes alone, so equal windows share it, and suffixes that follow
    one another mostly do too: such a run is one row (a segment), some 30 suffixes long. The digit is that
    hash, which only deals out the work: suffixes that share it by chance are told apart by what follows.
Digit 2, the segment's bytes, as their 128-bit BLAKE2b digest: of segments that are equal, all but the first go whole.
Digits 3 to 15, the window's bytes, eight at a time: the first ones of segments that share an anchor but
    differ are sorted window by window, and windows that are alone leave after each digit; groups that are left are
    the repeated windows, byte by byte.

Passes 1 and 2 are one shuffle and sort by (anchor, segment); a task reads it as a stream, and each
batch drops its own repeats before it is shuffled. The last passes fetch the bytes of the differing
segments and sort by anchor in chunks; an anchor with more than ``HOT`` such segments is shuffled by
its windows' BLAKE2b digests instead, so no group has to fit in one task.

The anchor of a passage that many documents hold would be one key of the first shuffle too. Such anchors are looked for
in some ``SAMPLED`` documents first, and their segments are dealt out by (anchor, digest). That list decides where rows
go and nothing else: equal segments meet either way, and all segments of a listed anchor count as differing.

Edge cases: a null text is empty; texts shorter than a window stay whole; a null id is the least;
rows with one id are ordered by a hash of the text; rows that are equal in both are one document,
and none of them repeats another; long texts are cut into pieces that overlap; an empty table gives
no row; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from sluicework.llm.common import bounded_batches, materialize, mix, powers, table, text_or_empty

WINDOW = 100
GRAM = 24
#: Bytes that are hashed at a time; places within them take 20 bits.
PIECE = 900_000
#: Differing segments that are sorted at a time, and differing segments of one anchor that a task sorts in memory.
NARROW_ROWS, HOT = 16384, 50_000
#: Documents in which common anchors are looked for; one that this share of them has is common; at most this many are listed.
SAMPLED, COMMON, LISTED = 5000, 1 / 500, 100_000
#: Marks a span whose segment is dealt by (anchor, digest).
_SPREAD = 1 << 62
_BASE = 0x2545F4914F6CDD1D
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE = np.random.default_rng(31).integers(1, 1 << 63, 256, dtype=np.uint64)
_UP = powers(_BASE, PIECE + 4 * WINDOW)
_DOWN = powers(_INVERSE, PIECE + 4 * WINDOW)
_ROW = "key long, digest long, more long, doc long, rank int, span long, gone boolean"


def pack(low: np.ndarray, high: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    """First and last window start of a segment and its anchor's place, as one number in order of the first."""
    return (low.astype(np.int64) << 14) | ((high - low).astype(np.int64) << 7) | (anchor - low).astype(np.int64)


def unpack(span: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    low = span >> 14
    return low, low + ((span >> 7) & 127), low + (span & 127)


def _prefix(raw: np.ndarray) -> np.ndarray:
    out = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_BYTE[raw] * _DOWN[: len(raw)], out=out[1:])
    return out


def _hashes(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the bytes from start to end."""
    return mix((prefix[end] - prefix[start]) * _UP[start] + (end - start).astype(np.uint64))


def _digests(data: bytes, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """128-bit digests of the bytes from start to end, as two numbers each."""
    found = [blake2b(data[a:b], digest_size=16).digest() for a, b in zip(start.tolist(), end.tolist(), strict=True)]
    return np.frombuffer(b"".join(found), "<i8").reshape(-1, 2)


def segments(raw: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of some texts' joined bytes (at most PIECE and a window): key, the two halves of the digest, text number, low, high, anchor."""
    ends = np.cumsum(lengths)
    starts = ends - lengths
    if len(raw) < WINDOW:
        return tuple(np.empty(0, np.int64) for _ in range(7))
    prefix, n = _prefix(raw), len(raw) - GRAM + 1
    grams = _hashes(prefix, np.arange(n), np.arange(n) + GRAM)
    # hash above, place below: the least is the first of the least hash
    least, width, wide = (grams >> np.uint64(20) << np.uint64(20)) | np.arange(n, dtype=np.uint64), 1, WINDOW - GRAM + 1
    while 2 * width <= wide:
        least, width = np.minimum(least[:-width], least[width:]), 2 * width
    if width < wide:
        least = np.minimum(least[: len(least) - (wide - width)], least[wide - width :])
    anchor = (least & np.uint64((1 << 20) - 1)).astype(np.int64)
    text = np.repeat(np.arange(len(lengths)), lengths)[: len(anchor)]
    inside = np.arange(len(anchor)) + WINDOW <= ends[text]
    new = np.r_[True, (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])]
    low = np.flatnonzero(new & inside)
    stop = np.flatnonzero(np.r_[new[1:] | ~inside[1:], True] & inside)
    high = stop[np.searchsorted(stop, low)]
    digest = _digests(raw.tobytes(), low, high + WINDOW)
    base = starts[text[low]]
    return grams[anchor[low]].view(np.int64), digest[:, 0], digest[:, 1], text[low], low - base, high - base, anchor[low] - base


def pieces(texts: list[bytes]) -> Iterator[tuple[list[int], list[int], np.ndarray, np.ndarray]]:
    """(text numbers, offsets in them, joined bytes, lengths) of at most PIECE bytes and a window."""
    numbers, offsets, parts, size = [], [], [], 0
    for number, data in enumerate(texts):
        for at in range(0, max(len(data), 1), PIECE):
            part = data[at : at + PIECE + WINDOW - 1]
            if parts and size + len(part) > PIECE:
                yield numbers, offsets, np.frombuffer(b"".join(parts), np.uint8), np.array(list(map(len, parts)))
                numbers, offsets, parts, size = [], [], [], 0
            numbers.append(number)
            offsets.append(at)
            parts.append(part)
            size += len(part)
    if parts:
        yield numbers, offsets, np.frombuffer(b"".join(parts), np.uint8), np.array(list(map(len, parts)))


def _scan(batches: Iterator[pa.RecordBatch], common: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
    """doc, rank, text to segments; those that equal an earlier one of the batch are gone already.

    The keys of those at a ``common`` anchor are mixed with their digests, and their spans are marked.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        doc, rank = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False)
        found = []
        for numbers, offsets, raw, lengths in pieces([t.encode() for t in batch.column(2).to_pylist()]):
            key, digest, more, text, low, high, anchor = segments(raw, lengths)
            at = np.array(offsets)[text]
            found.append((key, digest, more, np.array(numbers)[text], pack(low + at, high + at, anchor + at)))
        key, digest, more, number, span = (np.concatenate(x) for x in zip(*found, strict=True))
        docs, ranks = doc[number], rank[number]
        order = np.lexsort([span, ranks, docs, more, digest, key])
        key, digest, more, docs, ranks, span = key[order], digest[order], more[order], docs[order], ranks[order], span[order]
        gone = np.r_[False, (key[1:] == key[:-1]) & (digest[1:] == digest[:-1]) & (more[1:] == more[:-1])] if len(key) else np.empty(0, bool)
        if common is not None and len(common):
            spread = ~gone & np.isin(key, common)
            key, span = np.where(spread, _mixed(key, digest), key), np.where(spread, span | _SPREAD, span)
        # what is gone needs no sort: any key deals it out
        key = np.where(gone, mix(docs.view(np.uint64) ^ span.view(np.uint64)).view(np.int64), key)
        yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(np.where(gone, 0, digest)), pa.array(np.where(gone, 0, more)), pa.array(docs), pa.array(ranks, pa.int32()), pa.array(span), pa.array(gone)], names=["key", "digest", "more", "doc", "rank", "span", "gone"])


def _mixed(key: np.ndarray, digest: np.ndarray) -> np.ndarray:
    """A key with its digest mixed in; the same again takes it out."""
    return key ^ mix(digest.view(np.uint64)).view(np.int64)


def _plain(batch: pa.RecordBatch) -> pa.RecordBatch:
    """The batch with the keys and spans of spread segments as they were."""
    key, digest, span = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1, 5))
    spread = (span & _SPREAD) != 0
    if not spread.any():
        return batch
    key, span = np.where(spread, _mixed(key, digest), key), np.where(spread, span & ~_SPREAD, span)
    return batch.set_column(0, "key", pa.array(key)).set_column(5, "span", pa.array(span))


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (gone, key, digest, more, doc, rank, span): keeps what is gone, and the first of segments that differ at one anchor.

    Segments of a common anchor are spread over tasks, so the first of each count as differing.
    """
    last: tuple[int, int, int] | None = None  # key and digest of the row before
    held: pa.RecordBatch | None = None  # the first row of the last segment
    out_already = False  # held has gone out as differing from the one before it

    for batch in batches:
        flag = batch.column(6).to_numpy(zero_copy_only=False)
        if flag.any():
            yield batch.filter(pa.array(flag))
            batch = batch.filter(pa.array(~flag))
        if not batch.num_rows:
            continue
        key, digest, more = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
        new = np.r_[last != (key[0], digest[0], more[0]), (key[1:] != key[:-1]) | (digest[1:] != digest[:-1]) | (more[1:] != more[:-1])]
        last = (key[-1], digest[-1], more[-1])
        later = batch.filter(pa.array(~new))
        yield _plain(later.set_column(6, "gone", pa.array(np.ones(later.num_rows, bool))))
        heads = batch.filter(pa.array(new))
        if not heads.num_rows:
            continue
        if held is not None:
            heads = pa.Table.from_batches([held, heads]).combine_chunks().to_batches()[0]
        k = heads.column(0).to_numpy(zero_copy_only=False)
        as_before = np.r_[False, k[1:] == k[:-1]]
        differs = as_before | np.r_[as_before[1:], False] | ((heads.column(5).to_numpy(zero_copy_only=False) & _SPREAD) != 0)
        tail = bool(differs[-1]) or (len(k) == 1 and out_already)
        differs[0] &= not (held is not None and out_already)
        yield _plain(heads.filter(pa.array(differs)))
        held, out_already = heads.slice(heads.num_rows - 1), tail


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc, rank, text and its differing segments (keys, spans), to a row per segment with its bytes."""
    for batch in batches:
        keys, docs, ranks, spans, parts = [], [], [], [], []
        for doc, rank, text, found in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            data = text.encode()
            for x in found:
                low, high, _ = unpack(np.int64(x["span"]))
                keys.append(x["key"])
                docs.append(doc)
                ranks.append(rank)
                spans.append(x["span"])
                parts.append(data[low : high + WINDOW])
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(docs, pa.int64()), pa.array(ranks, pa.int32()), pa.array(spans, pa.int64()), pa.array(parts, pa.binary())], names=["key", "doc", "rank", "span", "part"])


def _windows(part: pa.Array, span: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """Of segments: their bytes one after another; for each window its place there, the segment's number and its start in the text."""
    sizes = pc.binary_length(part).to_numpy(zero_copy_only=False).astype(np.int64)
    own = sizes - WINDOW + 1
    row = np.repeat(np.arange(len(sizes)), own)
    inner = np.arange(len(row)) - np.repeat(np.cumsum(own) - own, own)
    return b"".join(part.to_pylist()), inner + np.repeat(np.cumsum(sizes) - sizes, own), row, unpack(span)[0][row] + inner


def repeated_windows(data: bytes, at: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Numbers of the windows (bytes from ``at`` on) that equal one before them in their group, by a radix sort of eight bytes a digit.

    Windows that are alone with their digits leave after each pass.
    """
    raw, left, group = np.frombuffer(data, np.uint8), np.arange(len(at)), group.copy()
    eight = np.zeros(max(len(raw) - 7, 0), np.uint64)
    for i in range(8):
        eight |= raw[i : len(raw) - 7 + i].astype(np.uint64) << np.uint64(56 - 8 * i)
    for depth in [*range(0, WINDOW - 8, 8), WINDOW - 8]:
        digit = eight[at[left] + depth]
        order = np.lexsort([digit, group[left]])
        left, digit = left[order], digit[order]
        own = group[left]
        number = np.cumsum(np.r_[True, (own[1:] != own[:-1]) | (digit[1:] != digit[:-1])][: len(left)]) - 1
        many = np.bincount(number, minlength=1)[number] > 1
        left = left[many]
        group[left] = number[many]
        if not len(left):
            return left
    own = group[left]
    return np.sort(left[np.r_[False, own[1:] == own[:-1]]])


def _runs(row: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of successive window starts within a row: row, first start, last start."""
    if not len(row):
        return row, start, start
    new = np.r_[True, (row[1:] != row[:-1]) | (start[1:] != start[:-1] + 1)]
    return row[new], start[new], start[np.r_[np.flatnonzero(new)[1:] - 1, len(row) - 1]]


def _sort_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments sorted by (key, doc, rank, span): the runs of windows that also start earlier."""
    held: list[pa.RecordBatch] = []

    def judge(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(parts).combine_chunks()
        key, doc, rank, span = (rows.column(i).to_numpy() for i in range(4))
        part = rows.column(4).chunk(0) if rows.num_rows else pa.array([], pa.binary())
        data, at, row, start = _windows(part, span)
        again = repeated_windows(data, at, np.cumsum(np.r_[False, key[1:] != key[:-1]][: len(key)])[row])  # rows are in order of document within each key
        again = again[np.lexsort([start[again], row[again]])]
        row, low, high = _runs(row[again], start[again])
        return pa.RecordBatch.from_arrays([pa.array(doc[row]), pa.array(rank[row], pa.int32()), pa.array(low), pa.array(high)], names=["doc", "rank", "low", "high"])

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        if sum(b.num_rows for b in held) < NARROW_ROWS:
            continue
        rows = pa.Table.from_batches(held).combine_chunks()
        key = rows.column(0).to_numpy()
        cut = int(np.searchsorted(key, key[-1]))  # the last key may go on
        if cut:
            yield judge(rows.slice(0, cut).to_batches())
        held = rows.slice(cut).to_batches()
    if held:
        yield judge(held)


def _each_window(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        doc, rank, span = (batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2, 3))
        data, at, row, start = _windows(batch.column(4), span)
        digest = _digests(data, at, at + WINDOW)
        yield pa.RecordBatch.from_arrays([pa.array(digest[:, 0]), pa.array(digest[:, 1]), pa.array(doc[row]), pa.array(rank[row], pa.int32()), pa.array(start)], names=["digest", "more", "doc", "rank", "low"])


def _ordered(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """doc (the id, null as the least), rank (of the text among those of one id) and text; and the same without rows that repeat another."""
    doc = F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63)))
    rows = docs.select(doc.alias("doc"), text_or_empty(text_col).alias("text"))
    ids = materialize(rows.groupBy("doc").count().where("count > 1").select("doc"), "ids")
    if not ids.limit(1).count():
        rows = rows.select("doc", F.lit(0).alias("rank"), "text")
        return rows, rows
    th = F.xxhash64("text").alias("th")
    ranks = rows.join(ids, "doc", "left_semi").select("doc", th).distinct().withColumn("rank", F.row_number().over(W.partitionBy("doc").orderBy("th")))
    ranks = materialize(ranks, "ranks")
    rows = rows.withColumn("th", F.xxhash64("text")).join(ranks, ["doc", "th"], "left").select("doc", F.coalesce("rank", F.lit(0)).alias("rank"), "text")
    return rows, rows.dropDuplicates(["doc", "rank"])


def common_anchors(rows: DataFrame, sampled: int = SAMPLED) -> np.ndarray:
    """Keys of anchors that many of some ``sampled`` documents have, chosen by a hash of their ids over the whole table."""
    every = max(1, rows.count() // sampled)
    some = rows.where(F.pmod(F.xxhash64("doc", "rank"), F.lit(every)) == 0)
    per = some.mapInArrow(_sampled_keys, "key long").groupBy("key").count()
    top = per.where(F.col("count") > max(8, int(sampled * COMMON))).orderBy(F.col("count").desc(), "key").limit(LISTED)
    return np.array([r["key"] for r in top.select("key").collect()], np.int64)


def _sampled_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc, rank, text to the distinct keys of each document's segments."""
    for batch in batches:
        for text in batch.column(2).to_pylist():
            keys = [segments(raw, lengths)[0] for _, _, raw, lengths in pieces([text.encode()])]
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(np.concatenate(keys)))], names=["key"])


def dealt(rows: DataFrame, common: np.ndarray) -> DataFrame:
    """The segments of rows, as they go to the first shuffle: by key."""
    return rows.mapInArrow(lambda batches: _scan(batches, common), _ROW)


def repeated_spans(rows: DataFrame, hot: int = HOT, sampled: int = SAMPLED) -> DataFrame:
    """From doc, rank (a key together) and text: doc, rank, low, high, where all windows that start from low to high also start earlier."""
    spark = rows.sparkSession
    bounded_batches(spark)
    found = dealt(rows, common_anchors(rows, sampled))
    found = found.repartition("key").sortWithinPartitions("gone", "key", "digest", "more", "doc", "rank", "span")
    judged = materialize(found.mapInArrow(_judge, _ROW), "judged")
    low, width = F.shiftright("span", 14), F.shiftright("span", 7).bitwiseAND(F.lit(127))
    whole = judged.where("gone").select("doc", "rank", low.alias("low"), (low + width).alias("high"))
    differing = judged.where("not gone")
    per = differing.groupBy("doc", "rank").agg(F.collect_list(F.struct("key", "span")).alias("found"))
    parts = rows.join(per, ["doc", "rank"]).select("doc", "rank", "text", "found").mapInArrow(_contexts, "key long, doc long, rank int, span long, part binary")
    parts = materialize(parts, "parts")
    crowded = materialize(differing.groupBy("key").count().where(F.col("count") > hot).select("key"), "crowded")
    windows = "doc long, rank int, low long, high long"
    if not crowded.limit(1).count():
        fine = parts.repartition("key").sortWithinPartitions("key", "doc", "rank", "span").mapInArrow(_sort_windows, windows)
        return whole.unionByName(materialize(fine, "fine"))
    fine = parts.join(crowded, "key", "left_anti").repartition("key").sortWithinPartitions("key", "doc", "rank", "span").mapInArrow(_sort_windows, windows)
    each = parts.join(crowded, "key", "left_semi").mapInArrow(_each_window, "digest long, more long, doc long, rank int, low long")
    first = materialize(each.groupBy("digest", "more").agg(F.min(F.struct("doc", "rank", "low")).alias("first"), F.count("*").alias("n")).where("n > 1"), "first")
    later = each.join(first, ["digest", "more"]).where(F.struct("doc", "rank", "low") != F.col("first")).select("doc", "rank", "low", F.col("low").alias("high"))
    return whole.unionByName(materialize(fine.unionByName(later), "fine"))


def _remove(data: bytes, spans: list[tuple[int, int]]) -> tuple[list[tuple[int, int]], bytes]:
    """The maximal runs of bytes that windows starting in ``spans`` cover, and the other bytes."""
    runs: list[tuple[int, int]] = []
    for low, high in sorted(spans):
        if runs and low <= runs[-1][1]:
            runs[-1] = (runs[-1][0], max(runs[-1][1], high + WINDOW))
        else:
            runs.append((low, high + WINDOW))
    kept, at = [], 0
    for a, b in runs:
        kept.append(data[at:a])
        at = b
    kept.append(data[at:])
    return runs, b"".join(kept)


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot: int = HOT) -> DataFrame:
    """A row per document: doc_id, n_bytes, runs (removed, from and to), kept (the other bytes)."""
    rows, distinct = _ordered(docs, id_col, text_col)
    spans = repeated_spans(distinct, hot).groupBy("doc", "rank").agg(F.collect_set(F.struct("low", "high")).alias("spans"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, n, runs, kept = batch.column(0), [], [], []
            for text, found in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                data = text.encode()
                cuts, rest = _remove(data, [(x["low"], x["high"]) for x in found or []])
                n.append(len(data))
                runs.append([{"from": a, "to": b} for a, b in cuts])
                kept.append(rest)
            yield pa.RecordBatch.from_arrays([doc, pa.array(n, pa.int64()), pa.array(runs, pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64())]))), pa.array(kept, pa.binary())], names=["doc_id", "n_bytes", "runs", "kept"])

    joined = rows.join(spans, ["doc", "rank"], "left").select(F.nullif("doc", F.lit(-(1 << 63))).alias("doc"), "text", "spans")
    return joined.mapInArrow(cut, "doc_id long, n_bytes long, runs array<struct<from:long,to:long>>, kept binary")


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    got = suffix_dedup(table(spark, sf_dir, "documents"))
    return got.select("doc_id", "n_bytes", (F.col("n_bytes") - F.length("kept")).cast("long").alias("n_removed"), F.size("runs").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


#: The same on hexadecimal text: two characters a byte.
OP3_SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
wins AS (SELECT doc_id, i, substr(h, 2 * i + 1, 200) AS s FROM (SELECT doc_id, h, unnest(generate_series(0, length(h) // 2 - 100)) AS i FROM d)),
again AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS k FROM wins) WHERE k > 1),
marked AS (SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 100 THEN 0 ELSE 1 END AS new FROM again),
runs AS (SELECT doc_id, min(i) AS a, max(i) + 100 AS b FROM (SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS g FROM marked) GROUP BY doc_id, g),
parts AS (SELECT doc_id, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS f, a AS t FROM runs UNION ALL SELECT doc_id, coalesce(max(b), 0), any_value(length(h) // 2) FROM d LEFT JOIN runs USING (doc_id) GROUP BY doc_id),
kept AS (SELECT doc_id, string_agg(substr(h, 2 * f + 1, 2 * (t - f)), '' ORDER BY f) AS k FROM parts JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, length(h) // 2 AS n_bytes, (length(h) - length(k)) // 2 AS n_removed, coalesce(n, 0) AS n_spans, sha256(unhex(k)) AS kept_sha256
FROM d JOIN kept USING (doc_id) LEFT JOIN (SELECT doc_id, count(*) AS n FROM runs GROUP BY doc_id) USING (doc_id)
"""
