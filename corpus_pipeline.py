"""From raw documents to token shards, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as Parquet in a
shared folder and rereads it as the next one's docs. All but the last return the columns of docs.

``run(spark, sf_dir, out)`` leaves the product below ``out``, a URI that driver and executors share: the token shards,
their index and a manifest, in ``tokens``, and the last stage's rows in ``rows``. ``token_output.Reader(out + "/tokens")`` reads
documents from it, in any later process. Without ``out`` all of it is scratch and goes when the driver ends.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sluicework.llm import decontamination, jaccard_join, mixing, quality_classifier, token_output
from sluicework.llm.common import intermediates, materialize, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality_classifier.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the least id."""
    return jaccard_join.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of a benchmark item go."""
    return decontamination.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated or dropped until each source has its target."""
    return mixing.mix(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str, out: str | None = None) -> DataFrame:
    """Token shards and their index, below ``out`` if that is given; a row per document (and copy) with where its ids are."""
    return token_output.token_output(docs, token_output.default_tokenizer(), out and f"{out.rstrip('/')}/tokens")


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("mix_sources", mix_sources),
    ("tokens", tokens),
]

#: The classifier, banding, alignment and rounding have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str, out: str | None = None) -> DataFrame:
    """All stages over the table of documents; the rows of the last. A stage's own intermediates go when its result is written."""
    if out and token_output.finished(f"{out.rstrip('/')}/tokens"):
        raise FileExistsError(f"{out} holds a product already")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        with intermediates(spark):
            docs = materialize(tokens(spark, docs, sf_dir, out) if stage is tokens else stage(spark, docs, sf_dir), name, keep=True)
    if out:
        docs.write.parquet(f"{out.rstrip('/')}/rows")
        docs = spark.read.schema(docs.schema).parquet(f"{out.rstrip('/')}/rows")
    return docs
