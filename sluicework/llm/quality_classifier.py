"""Quality scores from random Fourier features of document statistics.

1. Each whole text becomes a few statistics of its words, lines and characters.
2. Labelled documents are standardised and mapped to cosines of random projections, which
   approximate a Gaussian kernel. Each partition sums its normal equations; the sums are added up row
   by row of the matrix in Spark and one small system is solved for the ridge weights.
3. Scores of labelled documents that the fit didn't see are put into bins of equal counts, and
   isotonic regression over the bins makes a score a probability of label 1.

Which documents may teach is a condition on the id; those with ``crc32(id) % 4 == 2`` never do. Of
the others, those with remainder 3 calibrate and the rest fit. If there are more labelled rows than
``MOST_LABELLED``, a sample by a hash of the id is taken; features and scores cover all documents.

Edge cases: a null text counts as empty, and empty texts are scored as any other; rows without a label or
with a null one teach nothing; with several labels for one id each counts; repeated rows are scored
alike; null ids are scored and held out of the fit; without any label, or with labels of one kind
only, the score is that kind's (1 where there are none: nothing speaks against any document); an
empty table gives no row; other columns are ignored by ``scores`` and kept by ``keep_good``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicework.llm.common import bounded_batches, materialize, table, text_or_empty, word_hashes

#: The most labelled rows that a fit reads.
MOST_LABELLED = 200_000
#: Random features, the kernel's width in standard deviations, the ridge.
N_FEATURES, WIDTH, RIDGE = 256, 2.5, 1e-3
BINS = 256
KEEP_AT = 0.7
SEED = 7

STATS = ("log_chars", "log_words", "word_length", "long_words", "upper", "capital_words", "digits", "symbols", "bars", "bangs", "commas", "stops", "marked_words", "distinct_words", "repeated_next", "top_word", "distinct_lines", "words_per_line", "distinct_pairs", "high_chars")
_CLASS = np.zeros((9, 256), np.float64)
for _row, _chars in enumerate((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"#*$%&<>{}[]\\^~@+=_/", b"|", b"!?", b",;:", b".", b"\n")):
    _CLASS[_row, list(_chars)] = 1.0
_CLASS[8, 0x80:] = 1.0


def document_stats(texts: list[str]) -> np.ndarray:
    """A row of ``STATS`` for each text; most are shares in 0..1."""
    out = np.zeros((len(texts), len(STATS)))
    raw = [t.encode() for t in texts]
    hashes, counts = word_hashes(raw)
    ends = np.cumsum(counts)
    for i, (text, data, n, end) in enumerate(zip(texts, raw, counts.tolist(), ends.tolist(), strict=True)):
        chars = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
        upper, digits, symbols, bars, bangs, commas, stops, _, high = _CLASS @ chars / max(len(data), 1)
        spaces = int(chars[0x20] + chars[9:14].sum())
        lines = [x for x in text.split("\n") if x.strip()]
        row = out[i]
        row[0], row[1] = np.log1p(len(text)), np.log1p(n)
        row[4], row[6:12], row[19] = upper, (digits, symbols, bars, bangs, commas, stops), high
        row[16] = len(set(lines)) / len(lines) if lines else 1.0
        row[17] = np.log1p(n / max(len(lines), 1))
        if n:
            own = hashes[end - n : end]
            _, times = np.unique(own, return_counts=True)
            words = text.split()
            row[2] = np.log1p((len(text) - spaces) / n)
            row[3] = sum(len(w) > 12 for w in words) / n
            row[5] = sum(w[0].isupper() for w in words) / n
            row[12] = sum(not (w[-1].isalnum() or w[-1] in ".,;:") for w in words) / n
            row[13] = len(times) / n**0.8
            row[14] = float((own[1:] == own[:-1]).mean()) if n > 1 else 0.0
            row[15] = times.max() / n
            row[18] = len(np.unique(own[1:] * np.uint64(31) + own[:-1])) / (n - 1) if n > 1 else 1.0
    return out


def held_out(id_col: str) -> Column:
    """Documents whose labels are never learned from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(True))


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, th (hash of the text) and stats of each text."""
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stats = document_stats(batch.column(2).to_pylist())
            values = pa.array(stats.ravel(), pa.float64())
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, stats.size + 1, len(STATS)), pa.int32()), values)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists], names=["doc_id", "th", "stats"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(text_col)).alias("th"), text_or_empty(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, th long, stats array<double>")


class Model:
    """Standardisation, random projection, ridge weights and calibration; a few thousand numbers."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, constant: float | None = None):
        rng = np.random.default_rng(SEED)
        self.mean, self.scale, self.constant = mean, scale, constant
        self.project = rng.normal(0, 1 / (WIDTH * np.sqrt(len(mean) / 8)), (len(mean), N_FEATURES))
        self.shift = rng.uniform(0, 2 * np.pi, N_FEATURES)
        self.weights = np.zeros(N_FEATURES + 1)
        self.knots = (np.array([0.0, 1.0]), np.array([0.0, 1.0]))

    def lift(self, stats: np.ndarray) -> np.ndarray:
        """The random Fourier features, and a one."""
        z = np.clip((stats - self.mean) / self.scale, -8, 8) @ self.project + self.shift
        return np.hstack([np.sqrt(2 / N_FEATURES) * np.cos(z), np.ones((len(stats), 1))])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.lift(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(stats), self.constant)
        raw = self.raw(stats)
        level = np.interp(raw, *self.knots)
        return np.clip(0.999 * level + 0.001 * np.clip((raw + 0.5) / 2, 0, 1), 0.0, 1.0)  # the raw score orders what calibration ties


def _normal_equations(labelled: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """X'X and X'y. A partition sends one row per row of X'X, and Spark adds up rows of one number."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((N_FEATURES + 1, N_FEATURES + 2))
        for rows in batches:
            if len(rows):
                x = model.lift(np.stack(rows["stats"].to_numpy()))
                total += x.T @ np.column_stack([x, rows["label"].to_numpy(float)])
        yield pd.DataFrame({"i": np.arange(len(total)), "sums": list(total)})

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"i": rows["i"].iloc[:1], "sums": [np.sum(np.stack(rows["sums"].to_numpy()), axis=0)]})

    # MOST_LABELLED / 50,000 partitions at most, so what is added up is bounded by it and not by the input's files
    parts = labelled.coalesce(max(1, -(-MOST_LABELLED // 50_000))).mapInPandas(run, "i int, sums array<double>")
    rows = parts.groupBy("i").applyInPandas(add, "i int, sums array<double>").collect()  # a row per feature; sorting them in Spark would run the sums twice
    total = np.array([r["sums"] for r in sorted(rows, key=lambda r: r["i"])])
    return total[:, :-1], total[:, -1]


def isotonic(values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The non-decreasing sequence nearest to ``values`` by weighted squares: adjacent violators are pooled."""
    blocks: list[list[float]] = []
    for v, w in zip(values.tolist(), weights.tolist(), strict=True):
        blocks.append([v, w, 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            b, a = blocks.pop(), blocks.pop()
            blocks.append([(a[0] * a[1] + b[0] * b[1]) / (a[1] + b[1]), a[1] + b[1], a[2] + b[2]])
    return np.repeat([b[0] for b in blocks], [b[2] for b in blocks])


def _calibrate(scored: DataFrame) -> tuple[np.ndarray, np.ndarray] | None:
    """Knots of raw score and probability, from raw and label; None without rows."""
    edges = scored.approxQuantile("raw", [k / BINS for k in range(1, BINS)], 0.001)
    if not edges:
        return None
    edges = sorted(set(edges))
    bin_ = F.array_size(F.filter(F.array(*map(F.lit, edges)), lambda e: e <= F.col("raw")))
    bins = scored.groupBy(bin_.alias("bin")).agg(F.avg("raw").alias("raw"), F.sum("label").alias("good"), F.count("*").alias("n")).collect()
    bins.sort(key=lambda b: b["bin"])
    raw, n = np.array([b["raw"] for b in bins]), np.array([b["n"] for b in bins], float)
    level = isotonic((np.array([b["good"] for b in bins], float)) / n, n)
    return raw, level


def fit(stats: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality") -> Model:
    """Fit on the labelled rows of ``features``."""
    label = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("double").alias("label")).where(~held_out("doc_id") & F.col("label").isin(0.0, 1.0))
    labelled = stats.join(label, "doc_id").withColumn("part", F.crc32(F.col("doc_id").cast("string")) % 4)
    n, ones = labelled.agg(F.count("*"), F.sum("label")).first()
    if not n or ones in (0, n):
        return Model(np.zeros(len(STATS)), np.ones(len(STATS)), 1.0 if not n else float(ones / n))
    if n > MOST_LABELLED:
        labelled = labelled.where(F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(1 << 20)) < int((1 << 20) * MOST_LABELLED / n))
    labelled = materialize(labelled, "labelled")
    moments = labelled.agg(*(f(F.col("stats")[i]) for i in range(len(STATS)) for f in (F.avg, F.stddev_pop))).first()
    model = Model(np.array(moments[0::2], float), np.maximum(np.array(moments[1::2], float), 1e-3))
    xx, xy = _normal_equations(labelled.where("part != 3"), model)
    model.weights = np.linalg.solve(xx + RIDGE * (1 + xx[-1, -1] * 1e-4) * np.eye(len(xx)), xy)

    def raw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            if len(rows):
                yield pd.DataFrame({"raw": model.raw(np.stack(rows["stats"].to_numpy())), "label": rows["label"]})

    scored = labelled.where("part = 3")
    knots = _calibrate(materialize(scored.mapInPandas(raw, "raw double, label double"), "raw"))
    model.knots = knots or model.knots
    return model


def scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", keep_at: float = KEEP_AT) -> DataFrame:
    """A row per document: doc_id, th, held_out, score, predicted."""
    stats = materialize(features(docs, id_col, text_col), "stats")
    model = fit(stats, labels, id_col, label_col)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            score = model.score(np.stack(rows["stats"].to_numpy())) if len(rows) else np.empty(0)
            yield rows[["doc_id", "th"]].assign(score=score)

    out = stats.mapInPandas(run, "doc_id long, th long, score double")
    return out.select("doc_id", "th", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= keep_at).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", keep_at: float = KEEP_AT) -> DataFrame:
    """The rows of ``docs`` that the classifier doesn't reject, with all their columns.

    The statistics are written beside the documents' own columns, so the verdict is a filter on what is
    reread: texts are neither shuffled nor joined.
    """
    bounded_batches(docs.sparkSession)

    @F.pandas_udf("array<double>")
    def stats_of(texts: pd.Series) -> pd.Series:
        return pd.Series(list(document_stats(texts.tolist())), dtype=object)

    own = "stats__"
    while own in docs.columns:
        own += "_"
    known = materialize(docs.withColumn(own, stats_of(text_or_empty(text_col))), "documents-stats")
    model = fit(known.select(F.col(id_col).cast("long").alias("doc_id"), F.col(own).alias("stats")), labels, id_col, label_col)

    @F.pandas_udf("double")
    def score_of(stats: pd.Series) -> pd.Series:
        return pd.Series(model.score(np.stack(stats.to_numpy())) if len(stats) else [], dtype=float)

    return known.where(score_of(own) >= keep_at).select([known[c] for c in docs.columns])


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents: doc_id, held_out, score, predicted."""
    return scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).select("doc_id", "held_out", "score", "predicted")
