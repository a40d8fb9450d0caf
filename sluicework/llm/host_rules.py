"""Quality rules per document, with verdicts on whole hosts.

Base rules judge each text by its words. Then the rule failures are aggregated by host (for the
table of documents, the source), each host's failure rate is shrunk towards the rate of all hosts by
a beta prior that is fitted to the hosts' rates by their moments, and the hosts whose shrunk rate is
above ``HOST_LIMIT`` are rejected; the verdict is joined back to their documents.

Edge cases: a null text has no words and fails; the null host is a host; ties and repeated rows are
judged row by row and each counts; very long texts are judged whole; an empty table gives no row;
with one host, or equal rates everywhere, the prior is worth one document; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicework.llm.common import bounded_batches, materialize, shingles, table, text_or_empty, word_hashes

WINDOW = 8
LEAST_WORDS = 20
MOST_REPEATED = 0.30
#: A host is rejected when its shrunk failure rate is above this.
HOST_LIMIT = 0.5
_SYMBOLS = "#*$%&|<>"
_WORD = re.compile(r"[^\x20\x09-\x0D]")
_STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def repeated_words(hashes: np.ndarray, raw: bytes) -> int:
    """How many of a text's words lie in an 8-word window that the text has twice or more."""
    if len(hashes) <= WINDOW:
        return 0
    windows, _ = shingles(hashes, np.array([len(hashes)]), WINDOW)
    order = np.argsort(windows, kind="stable")
    same = windows[order][1:] == windows[order][:-1]
    if not same.any():
        return 0
    at = np.unique(np.r_[order[1:][same], order[:-1][same]])
    words, seen = raw.split(), {}
    for i in at.tolist():  # the words themselves decide
        seen.setdefault(tuple(words[i : i + WINDOW]), []).append(i)
    starts = [i for found in seen.values() if len(found) > 1 for i in found]
    cover = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(cover, starts, 1)
    np.add.at(cover, np.array(starts, np.int64) + WINDOW, -1)
    return int((np.cumsum(cover) > 0).sum())


def duplicate_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in text.split("\n") if _WORD.search(x)]
    return len(lines) - len(set(lines))


def text_stats(texts: list[str]) -> list[np.ndarray]:
    """The columns of ``_STATS`` for some texts."""
    raw = [t.encode() for t in texts]
    hashes, counts = word_hashes(raw)
    ends = np.cumsum(counts)
    repeats = [repeated_words(hashes[e - n : e], r) for e, n, r in zip(ends.tolist(), counts.tolist(), raw, strict=True)]
    chars = [len(t) - sum(map(t.count, " \t\n\v\f\r")) for t in texts]
    symbols = [sum(map(t.count, _SYMBOLS)) for t in texts]
    return [counts, chars, symbols, [duplicate_lines(t) for t in texts], repeats]


def _stats_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        cols = text_stats(batch.column(2).to_pylist())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(c, pa.int64()) for c in cols)], names=["doc_id", "host", *_STATS])


def document_stats(docs: DataFrame, host_col: str = "source", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, host and the counts of each text, and base_failed."""
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(host_col).cast("string").alias("host"), text_or_empty(text_col).alias("text"))
    stats = rows.mapInArrow(_stats_of, "doc_id long, host string, " + ", ".join(f"{c} long" for c in _STATS))
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > int(100 * MOST_REPEATED) * F.col("n_words"))
    return stats.withColumn("base_failed", failed)


def host_verdicts(stats: DataFrame, limit: float = HOST_LIMIT) -> DataFrame:
    """From host and base_failed, a row per host: n_docs, n_failed, rate (shrunk), host_kept.

    Hosts are aggregated map-side first, so a hot host costs no more than another; the prior is
    fitted from four sums over hosts, the only values that reach the driver.
    """
    hosts = stats.groupBy("host").agg(F.count("*").alias("n_docs"), F.sum(F.col("base_failed").cast("long")).alias("n_failed"))
    rate = F.col("n_failed") / F.col("n_docs")
    mean, variance, inverse, n = hosts.agg(F.avg(rate), F.var_samp(rate), F.avg(1 / F.col("n_docs")), F.count("*")).first()
    alpha, beta = beta_prior(mean or 0.0, variance or 0.0, inverse or 1.0, n)
    shrunk = (F.col("n_failed") + F.lit(alpha)) / (F.col("n_docs") + F.lit(alpha + beta))
    return hosts.withColumn("rate", shrunk).withColumn("host_kept", F.col("rate") <= limit)


def beta_prior(mean: float, variance: float, inverse: float, n: int) -> tuple[float, float]:
    """The beta distribution whose mean is that of the hosts' rates, and whose variance is theirs less what chance adds."""
    mean = min(max(mean, 1e-6), 1 - 1e-6)
    chance = mean * (1 - mean) * inverse
    between = variance - chance
    strength = mean * (1 - mean) / between - 1 if n > 1 and between > 1e-12 else 1.0
    strength = min(max(strength, 1.0), 1e4)
    return mean * strength, (1 - mean) * strength


def host_rules(docs: DataFrame, host_col: str = "source", **cols) -> DataFrame:
    """document_stats with rate, host_kept and kept (not base_failed, and the host is kept)."""
    stats = materialize(document_stats(docs, host_col, **cols), "stats")
    verdicts = host_verdicts(stats).select(F.col("host").alias("h"), "rate", "host_kept")
    return stats.join(verdicts, F.col("host").eqNullSafe(F.col("h"))).drop("h").withColumn("kept", ~F.col("base_failed") & F.col("host_kept"))


def op8_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents: doc_id, the counts, base_failed, kept, host_kept."""
    return host_rules(table(spark, sf_dir, "documents")).select("doc_id", *_STATS, "base_failed", "kept", "host_kept")


#: The same rules in SQL, on windows as lists of words.
OP8_SQL = r"""
WITH words AS (SELECT doc_id, source, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
wins AS (SELECT doc_id, i, w[i:i + 7] AS win FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 7)) AS i FROM words)),
reps AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS n FROM wins) WHERE n > 1),
covered AS (SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM reps, generate_series(0, 7) t(k) GROUP BY doc_id),
line AS (SELECT doc_id, l, count(*) AS n FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS l FROM words) WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY ALL),
dups AS (SELECT doc_id, sum(n - 1)::BIGINT AS n_dup_lines FROM line GROUP BY doc_id),
stats AS (SELECT doc_id, source, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
  length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM words LEFT JOIN dups USING (doc_id) LEFT JOIN covered USING (doc_id)),
judged AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM stats),
hosts AS (SELECT source, count(*) AS n, count(*) FILTER (base_failed) AS f FROM judged GROUP BY source),
moments AS (SELECT least(greatest(avg(f / n), 1e-6), 1 - 1e-6) AS m, coalesce(var_samp(f / n), 0) AS v, avg(1 / n) AS inv, count(*) AS k FROM hosts),
prior AS (SELECT m, least(greatest(CASE WHEN k > 1 AND v - m * (1 - m) * inv > 1e-12 THEN m * (1 - m) / (v - m * (1 - m) * inv) - 1 ELSE 1 END, 1), 1e4) AS s FROM moments),
verdict AS (SELECT source, (f + m * s) / (n + s) <= 0.5 AS host_kept FROM hosts, prior)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND host_kept AS kept, host_kept
FROM judged JOIN verdict ON judged.source IS NOT DISTINCT FROM verdict.source
"""
