"""Line dedup by content-defined chunks of lines.

A text's lines are hashed, and a rolling hash over the last ``ROLL`` line hashes ends a chunk wherever
it falls on one of ``EVERY`` values, so boundaries follow the content and shift with it. A boundary less
than ``LEAST_LINES`` lines after the last one, or before the text's end, is passed over; from the next two
boundaries that far apart on, the same lines are cut alike again. So every line of a text of two or more
lines is in a chunk of two or more, and a whole copy goes whole. A passage repeated amid other lines keeps
those up to its first common boundary and after its last; one without a chunk of its own stays.

A chunk with a word in it that occurs more than once over all documents is a repeat once its
bytes are the same as its first occurrence's (least document, then place); all later ones are removed.

Digests of 128 bits bring chunks together and the bytes themselves decide: rows are counted by digest
first, map-side too, which needs no text, and only chunks whose digest occurs more than once are
shuffled with their bytes, grouped by them for the first occurrence, and joined to it on equal bytes.

Edge cases: a null text is empty and has one empty line, as an empty text has; texts of one line
have no multi-line chunk; null ids come first; rows with one id are ordered by a hash of the text, and
rows that are equal in both by nothing: they are one document, and none repeats another; very long
texts are cut like others; an empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicework.llm.common import BATCH_ROWS, bounded_batches, materialize, mix, table, text_or_empty

ROLL = 2
EVERY = 3
LEAST_LINES = 2
_PLACE = "doc long, th long, first int, n_lines int"


def chunk_ends(lines: list[bytes]) -> list[int]:
    """Where chunks of lines end (exclusive)."""
    hashes = np.array([xxhash.xxh64_intdigest(x) for x in lines], np.uint64)
    rolled = hashes.copy()
    for k in range(1, ROLL):
        rolled[k:] += hashes[:-k] * np.uint64(pow(0x9E3779B97F4A7C15, k, 1 << 64))
    ends, at = [], 0
    for end in (np.flatnonzero(mix(rolled) % np.uint64(EVERY) == 0) + 1).tolist():
        if end - at >= LEAST_LINES and len(lines) - end >= LEAST_LINES:
            ends.append(end)
            at = end
    return [*ends, len(lines)]


def chunks(text: str) -> list[tuple[int, int, bytes]]:
    """(first line, lines, bytes) of a text's chunks of LEAST_LINES or more lines with a word."""
    lines = text.encode().split(b"\n")
    if len(lines) < LEAST_LINES:
        return []
    out, at = [], 0
    for end in chunk_ends(lines):
        if end - at >= LEAST_LINES:
            data = b"\n".join(lines[at:end])
            if data.strip(b" \t\n\v\f\r"):
                out.append((at, end - at, data))
        at = end
    return out


def _digest(data: bytes) -> bytes:
    return xxhash.xxh3_128_digest(data)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc, th, text to a row per chunk: digest and place."""
    for batch in batches:
        rows = [(_digest(data), doc, th, first, n) for doc, th, text in zip(*(c.to_pylist() for c in batch.columns), strict=True) for first, n, data in chunks(text)]
        cols = list(zip(*rows, strict=True)) or [()] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.int32()), strict=True)], names=["digest", "doc", "th", "first", "n_lines"])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc, th, text and places (of chunks that occur more than once) to a row per chunk with its bytes."""
    for batch in batches:
        rows = []
        for doc, th, text, places in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            lines = text.encode().split(b"\n")
            for p in places:
                data = b"\n".join(lines[p["first"] : p["first"] + p["n_lines"]])
                rows.append((_digest(data), doc, th, p["first"], p["n_lines"], data))
        cols = list(zip(*rows, strict=True)) or [()] * 6
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()), strict=True)], names=["digest", "doc", "th", "first", "n_lines", "data"])


def _ordered(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63))).alias("doc"), F.xxhash64(text_or_empty(text_col)).alias("th"), text_or_empty(text_col).alias("text"))


def repeated_chunks(rows: DataFrame) -> DataFrame:
    """From doc, th, text: the places (doc, th, first, n_lines) of chunks that repeat an earlier one, byte for byte."""
    spark = rows.sparkSession
    bounded_batches(spark)
    place = F.struct("doc", "th", "first")
    found = materialize(rows.mapInArrow(_scan, "digest binary, " + _PLACE), "chunks")
    often = materialize(found.groupBy("digest").count().where("count > 1").select("digest"), "often")
    candidates = materialize(found.join(often.hint("merge"), "digest", "left_semi"), "candidates")
    per = candidates.groupBy("doc", "th").agg(F.collect_set(F.struct("first", "n_lines")).alias("places"))
    # the same join at every size: whether one side happens to fit a broadcast isn't left to chance
    cut = rows.join(per.hint("merge"), ["doc", "th"]).select("doc", "th", "text", "places").mapInArrow(_cut, "digest binary, " + _PLACE + ", data binary")
    # groups of one digest and the same bytes: their first keeps its place
    cut = materialize(cut, "cut")
    firsts = materialize(cut.groupBy("digest", "data").agg(F.min(place).alias("least")), "firsts")
    # a digest nearly always stands for one text, so the join compares each chunk with its first
    other = firsts.select(F.col("digest").alias("d"), F.col("data").alias("bytes"), "least")
    pairs = cut.join(other.hint("merge"), (F.col("digest") == F.col("d")) & (F.col("data") == F.col("bytes")))
    return pairs.where(place != F.col("least")).select("doc", "th", "first", "n_lines")


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per document: doc_id, n_lines, n_removed (lines), n_chunks (removed), text (what is left)."""
    rows = _ordered(docs, id_col, text_col)
    gone = repeated_chunks(rows).groupBy("doc", "th").agg(F.collect_set(F.struct("first", "n_lines")).alias("places"))
    gone = materialize(gone, "gone")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            totals, removed, counts, texts = [], [], [], []
            for text, places in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                lines = text.split("\n")
                drop = np.zeros(len(lines), bool)
                for p in places or []:
                    drop[p["first"] : p["first"] + p["n_lines"]] = True
                totals.append(len(lines))
                removed.append(int(drop.sum()))
                counts.append(len(places or []))
                texts.append("\n".join(x for x, d in zip(lines, drop, strict=True) if not d))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x, pa.int64()) for x in (totals, removed, counts)), pa.array(texts, pa.string())], names=["doc_id", "n_lines", "n_removed", "n_chunks", "text"])

    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    joined = rows.join(gone.hint("merge"), ["doc", "th"], "left").select(F.nullif("doc", F.lit(-(1 << 63))).alias("doc"), "text", "places")
    return joined.mapInArrow(cut, "doc_id long, n_lines long, n_removed long, n_chunks long, text string")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents: doc_id, n_lines, n_removed, n_chunks, n_chars (of what is left), text_sha256."""
    got = line_dedup(table(spark, sf_dir, "documents"))
    return got.select("doc_id", "n_lines", "n_removed", "n_chunks", F.length("text").cast("long").alias("n_chars"), F.sha2("text", 256).alias("text_sha256"))
