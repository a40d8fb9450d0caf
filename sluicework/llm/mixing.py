"""Mixing sources to target weights by pivotal dependent rounding.

Each source's words are repeated or thinned to a target; a document's expected number of copies is
its source's target divided by the source's size. The whole part is taken at once.
The fractional parts are rounded dependently: two documents trade words, in a random direction whose
odds keep each one's expectation, until one of the two has a whole number of copies. A trade moves as
many words to one as from the other, so the words of the source stay as they are, whatever the two sizes.
Documents come in order of size, largest first, so that the one left over of a group tends to be small. It
goes up a reduction tree, where the left-overs of several groups trade; the last one of a
source is settled by what brings the source nearer to its target, which is missed by half its size at most.

Edge cases: a null text has size 0; documents of size 0 take nothing, and are drawn one by one; the null source is a source,
last in order; repeated rows are rows of their own, and their number of copies is drawn among them;
null and repeated ids are allowed; very long texts count in full; an empty table gives no row; other
columns are ignored, or kept by ``mix`` whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluicework.llm.common import WORD, few_tasks, materialize, row_order, table, text_or_empty
from sluicework.llm.common import mix as spread

WEIGHTS = (5.0, 2.0, 1.0)
#: A source's target is at most this multiple of its size.
MOST_COPIES = 3.0
#: Documents of a group at the lowest level, on average, and groups that meet in one of the next.
GROUP_ROWS = 4096
FAN_IN = 64
SEED = 20240611
#: A part this near to a whole number is one.
NEAR = 1e-9
_STATE = "source string, bucket long, doc_id long, tie long, size long, whole long, part double"


def text_size(name: str) -> Column:
    """The number of words of a text."""
    return F.regexp_count(text_or_empty(name), F.lit(WORD)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = MOST_COPIES) -> DataFrame:
    """From source and source_size, the target of each source; a row per source.

    Weights repeat over the sources in code-point order, null last. Targets are a common level times
    the weight, but at most ``most`` times the size. The level rises from round to round, a sum over the sources
    each: what those that are full at it leave is dealt to the others by weight.
    """
    by_name = F.col("source").asc_nulls_last()
    ranked = sizes.select("source", "source_size", (most * F.col("source_size")).alias("most")).repartitionByRange(by_name).sortWithinPartitions(by_name)
    ranked = materialize(ranked.withColumn("number", F.monotonically_increasing_id()), "ranked").withColumn("range", F.shiftright("number", 33))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # a row per range
    shifts = ranked.groupBy("range").agg(F.min("number").alias("low"), F.count("*").alias("n")).select("range", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("low")).alias("shift"))
    weight = F.get(F.array(*map(F.lit, weights)), ((F.col("number") + F.col("shift")) % len(weights)).cast("int"))
    df = materialize(ranked.join(shifts, "range").select("source", "source_size", "most", weight.alias("weight")), "weights")
    total, level = df.agg(F.sum("source_size")).first()[0] or 0, 0.0
    while True:
        full = F.col("weight") * level >= F.col("most")
        taken, left = df.agg(F.sum(F.when(full, F.col("most"))), F.sum(F.when(~full, F.col("weight")))).first()
        rises = (total - (taken or 0.0)) / left if left else level
        if rises <= level:
            return df.select("source", "source_size", F.least("most", F.col("weight") * level).alias("target"))
        level = rises


def pivot(parts: np.ndarray, sizes: np.ndarray, draws: np.ndarray) -> tuple[np.ndarray, int]:
    """Round ``parts`` (each in 0..1) one against another, in the given order.

    The document held and the next one trade words until one of them is whole; which way is drawn, by
    odds that keep both expectations. Returns the parts and the index of the one that is left with a
    fraction, or -1.
    """
    out, held = parts.astype(float).tolist(), -1
    sizes, draws = sizes.astype(float).tolist(), draws.tolist()
    for i, (q, s) in enumerate(zip(out, sizes, strict=True)):
        if not NEAR < q < 1.0 - NEAR:
            out[i] = float(round(q))
            continue
        if s == 0:
            out[i] = float(draws[i] < q)
            continue
        if held < 0:
            held = i
            continue
        p, t = out[held], sizes[held]
        wins, loses = min((1.0 - p) * t, q * s), min(p * t, (1.0 - q) * s)  # most words that the held one can
        move = wins if draws[i] * (wins + loses) < loses else -loses
        p, q = p + move / t, q - move / s
        out[held] = p if NEAR < p < 1.0 - NEAR else float(round(p))
        out[i] = q if NEAR < q < 1.0 - NEAR else float(round(q))
        if out[held] in (0.0, 1.0):
            held = -1 if out[i] in (0.0, 1.0) else i
    return np.array(out), held


def _draws(tie: np.ndarray, place: np.ndarray, level: int, seed: int) -> np.ndarray:
    """A draw in 0..1 for each document at its place in a group, the same in each run."""
    keys = spread(tie.astype(np.int64).view(np.uint64) + spread(place.astype(np.uint64) + np.uint64((seed * 1000 + level) & (1 << 64) - 1)))
    return (keys >> np.uint64(11)).astype(float) / (1 << 53)


def _round(state: DataFrame, level: int, seed: int, last: bool = False) -> DataFrame:
    """Round within each (source, bucket). Adds ``open``: the document's part is still fractional.

    Rows are dealt by source and bucket and sorted, and a partition is read as a stream: however large
    a group is, the task holds one batch and the document left over.
    """
    order = ("source", "bucket", F.col("size").desc(), "tie", F.col("doc_id").asc_nulls_first(), "part")
    dealt = state.repartition("source", "bucket").sortWithinPartitions(*order)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, last_key, seen = None, None, 0  # the row left over so far, as a frame of one row; its group, and that one's rows so far
        for rows in batches:
            if not len(rows):
                continue
            key = (rows["source"].isna().astype(str) + rows["source"].fillna("") + "\x00" + rows["bucket"].astype(str)).to_numpy()
            starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            ends = np.r_[starts[1:], len(rows)]
            place = np.arange(len(rows)) - np.repeat(starts, ends - starts)
            place[: ends[0]] += seen if key[0] == last_key else 0
            last_key, seen = key[-1], int(place[-1]) + 1
            draws = _draws(rows["tie"].to_numpy(), place, level, seed)
            if held is not None:
                rows, draws, key = pd.concat([held, rows], ignore_index=True), np.r_[0.0, draws], np.r_[[held_key], key]
                starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
                ends, held = np.r_[starts[1:], len(rows)], None
            part, open_, left = rows["part"].to_numpy(float).copy(), np.zeros(len(rows), bool), -1
            size = rows["size"].to_numpy()
            for a, b in zip(starts.tolist(), ends.tolist(), strict=True):
                part[a:b], at = pivot(part[a:b], size[a:b], draws[a:b])
                left = a + at if at >= 0 else -1
                if left >= 0:
                    open_[left] = True
            rows = rows.assign(part=part, open=open_)
            if left >= 0:  # the last group may go on in the next batch
                held, held_key = rows.iloc[[left]].drop(columns="open"), key[left]
                rows = rows.drop(index=left)
            yield rows
        if held is not None:
            yield held.assign(open=True)

    out = dealt.mapInPandas(run, _STATE + ", open boolean")
    if last:
        out = out.withColumn("part", F.when(F.col("open"), F.round("part")).otherwise(F.col("part")))
    return out


def copies(docs: DataFrame, source_col: str = "source", id_col: str = "doc_id", text_col: str = "text", weights: tuple[float, ...] = WEIGHTS, most: float = MOST_COPIES, seed: int = SEED, group_rows: int = GROUP_ROWS) -> DataFrame:
    """The number of copies of each document: doc_id, tie, source, size, source_size, target, copies.

    ``tie`` is a hash of the id and the text. The same rows give the same numbers, however they are
    laid out in files or dealt to tasks.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"), text_size(text_col).alias("size"), F.xxhash64(F.col(id_col).cast("long"), F.col(text_col)).alias("tie"))
    rows = materialize(rows, "sizes")
    per = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    targets = materialize(source_targets(per.select("source", "source_size", "n"), weights, most).join(per.select(F.col("source").alias("s"), "n"), F.col("source").eqNullSafe(F.col("s"))).drop("s"), "targets")
    factor = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    wide = rows.join(targets.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s").withColumn("factor", factor)
    groups = F.ceil(F.col("n") / group_rows).cast("long")
    state = wide.select("source", F.pmod(F.col("tie"), groups).alias("bucket"), "doc_id", "tie", "size", F.floor("factor").cast("long").alias("whole"), (F.col("factor") - F.floor("factor")).alias("part"))
    most_groups = targets.agg(F.max(groups)).first()[0] or 1
    level, settled = 0, []
    while True:
        last = most_groups <= 1
        state = _round(state, level, seed, last)
        if last:
            settled.append(state)
            break
        state = materialize(state, f"level-{level}")
        settled.append(state.where(~F.col("open")))
        state = state.where("open").drop("open").withColumn("bucket", F.floor(F.col("bucket") / FAN_IN).cast("long"))
        most_groups, level = -(-most_groups // FAN_IN), level + 1
    out = settled[0]
    for x in settled[1:]:
        out = out.unionByName(x)
    out = out.select("doc_id", "tie", "source", "size", (F.col("whole") + F.round("part").cast("long")).alias("copies"))
    by = targets.select(F.col("source").alias("s"), "source_size", "target")
    return out.join(by, F.col("source").eqNullSafe(F.col("s"))).drop("s")


def mix(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, each as often as ``copies`` says; columns as they were.

    Rows are matched by id and text hash. Rows that are the same in both share their copies evenly:
    the number they have together is what was drawn, and odd ones go to the first in order of all columns.
    """
    id_col, text_col = options.get("id_col", "doc_id"), options.get("text_col", "text")
    took = copies(docs, **options).groupBy("tie", "doc_id", "source").agg(F.sum("copies").alias("copies"), F.count("*").alias("rows"))
    took = materialize(few_tasks(took, docs.count()), "copies")
    names = {c: f"took_{i}_{c}" for i, c in enumerate(took.columns)}
    took = took.select([F.col(c).alias(n) for c, n in names.items()])
    tie, source = F.xxhash64(F.col(id_col).cast("long"), F.col(text_col)), F.col(options.get("source_col", "source")).cast("string")
    out = docs.join(took, (tie == F.col(names["tie"])) & source.eqNullSafe(F.col(names["source"])) & F.col(id_col).cast("long").eqNullSafe(F.col(names["doc_id"])))
    if took.where(F.col(names["rows"]) > 1).limit(1).count():
        place = Window.partitionBy(names["tie"], names["doc_id"], names["source"]).orderBy(row_order(docs))
        share = F.floor(F.col(names["copies"]) / F.col(names["rows"])) + F.when(F.row_number().over(place) <= F.col(names["copies"]) % F.col(names["rows"]), 1).otherwise(0)
        out = out.withColumn(names["copies"], share.cast("long"))
    out = out.where(F.col(names["copies"]) > 0)
    return out.withColumn(names["rows"], F.explode(F.sequence(F.lit(1), F.col(names["copies"]).cast("int")))).select([docs[c] for c in docs.columns])


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents: doc_id, size, source_size, target, taken, source, copies."""
    got = copies(table(spark, sf_dir, "documents"))
    return got.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "source", "copies")
