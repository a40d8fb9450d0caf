"""Streams into merged tables and windowed counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sluicework.operators import merge


def merge_stream(stream: DataFrame, path: str, checkpoint: str, keys: list[str], rules: merge.MergeRules | None = None) -> StreamingQuery:
    """Merge each micro-batch into the Parquet table below ``path``, one folder per version.

    A version is named by its batch, so a batch that runs again after a failure replaces its own
    output and nothing else; the table is the newest version with a success marker.
    """
    def upsert(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        before = current_version(batch, path, below=number)
        if before is None:
            merged = merge.dedup_staging(batch, keys)
        else:
            merged = merge.apply_disposition("merge", batch, spark.read.parquet(before), keys, rules)
        merged.write.mode("overwrite").parquet(f"{path}/version={number}")

    return stream.writeStream.foreachBatch(upsert).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def current_version(df: DataFrame, path: str, below: int | None = None) -> str | None:
    """The folder of the newest whole version, or None."""
    sc = df.sparkSession.sparkContext
    root = sc._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(sc._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return None
    names = [s.getPath() for s in fs.listStatus(root) if s.isDirectory() and s.getPath().getName().startswith("version=")]
    whole = [(int(p.getName().split("=")[1]), p) for p in names if fs.exists(sc._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
    whole = [(n, p) for n, p in whole if below is None or n < below]
    return max(whole, key=lambda x: x[0])[1].toString() if whole else None


def windowed_counts(stream: DataFrame, ts: str, name: str, width: str = "1 day", late: str = "2 days") -> DataFrame:
    """Counts per tumbling window and name; rows later than ``late`` are dropped and state is bounded by it."""
    w = stream.withWatermark(ts, late).groupBy(F.window(ts, width).alias("w"), F.col(name).alias("table_name")).agg(F.count("*").alias("n"))
    return w.select("table_name", F.col("w.start").alias("from"), F.col("w.end").alias("to"), "n")


def dedup_stream(stream: DataFrame, keys: list[str], ts: str, late: str = "2 days") -> DataFrame:
    """The first row per key within the watermark."""
    return stream.withWatermark(ts, late).dropDuplicatesWithinWatermark(keys)
