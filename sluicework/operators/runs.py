"""Run logs: scorecards, estimates, KPIs and reports over jobs and tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluicework.operators import freshness


def steady_avg(column: str) -> Column:
    """The mean of doubles, which doesn't depend on how rows are dealt: multiples of 2^-20 add up without rounding, and what is left over is too small to round."""
    x, step = F.col(column), F.lit(float(1 << 20))
    high = F.rint(x * step) / step
    low = F.when(F.abs(x) < float(1 << 32), x - high).otherwise(0.0)
    return F.try_divide(F.sum(high) + F.sum(low), F.count(x))


def scorecard(names: DataFrame, parts: dict[str, DataFrame], key: str) -> DataFrame:
    """All names with the columns of each part (a row per key at most), left-joined; and score, grade.

    Parts may give success, freshness, quality, anomaly and schema as shares; what is missing counts 0.
    """
    out = names
    for p in parts.values():
        out = out.join(p, key, "left")
    shares = {k: F.col(k) if k in out.columns else F.lit(0.0) for k in ("success", "freshness", "quality", "anomaly", "schema")}
    return out.withColumn("score", freshness.reliability(shares)).withColumn("grade", freshness.grade(F.col("score")))


def estimate_seconds(plan: DataFrame, history: DataFrame, key: str, seconds: str, fallback: float, factor: Column | None = None) -> DataFrame:
    """key, estimate: the median of a table's past runs, or the fallback, times a factor."""
    past = history.groupBy(key).agg(F.median(seconds).alias("median_s"))
    return plan.join(past, key, "left").select(key, (F.coalesce("median_s", F.lit(fallback)) * (factor if factor is not None else F.lit(1.0))).alias("estimate"))


def kpis(runs: DataFrame, key: str, rows: str, seconds: str, errors: str, ok: str) -> DataFrame:
    """Per key: rows a minute, errors per 100 rows, success percent, health and its band."""
    agg = runs.groupBy(key).agg(F.sum(rows).alias("n"), F.sum(seconds).alias("s"), F.sum(errors).alias("e"), F.avg(F.col(ok).cast("int")).alias("success"))
    rate, bad = F.coalesce(F.try_divide(60 * F.col("n"), F.col("s")), F.lit(0.0)), F.coalesce(F.try_divide(100 * F.col("e"), F.col("n")), F.lit(0.0))
    out = agg.select(key, rate.alias("rows_per_minute"), bad.alias("error_rate"), (100 * F.col("success")).alias("success_pct"))
    h = F.round(freshness.health(F.col("success_pct"), F.least(F.col("error_rate"), F.lit(100.0)), F.col("rows_per_minute")), 1)
    band = F.when(F.col("health") >= 90, "excellent").when(F.col("health") >= 75, "good").when(F.col("health") >= 60, "fair").when(F.col("health") >= 40, "poor").otherwise("critical")
    return out.withColumn("health", h).withColumn("band", band)


def top_reasons(failures: DataFrame, reason: str, n: int = 10) -> DataFrame:
    """The most frequent reasons: a top-n report."""
    return failures.groupBy(reason).agg(F.count("*").alias("n")).orderBy(F.desc("n"), reason).limit(n)


def slowest(runs: DataFrame, key: str, seconds: str, n: int = 10, least_runs: int = 2) -> DataFrame:
    """The keys with the longest mean run, of those with enough runs: a top-n report."""
    return runs.groupBy(key).agg(F.count("*").alias("runs"), F.avg(seconds).alias("mean_s")).where(F.col("runs") >= least_runs).orderBy(F.desc("mean_s"), key).limit(n)


def latest(df: DataFrame, keys: list[str], order: list[Column], n: int = 1) -> DataFrame:
    """The first ``n`` rows per key in the given order."""
    return df.withColumn("place__", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("place__") <= n).drop("place__")


def batches(df: DataFrame, group: str, order: Column, size: int) -> DataFrame:
    """Numbers rows into batches of at most ``size`` within a group."""
    place = F.row_number().over(Window.partitionBy(group).orderBy(order)) - 1
    return df.withColumn("batch", F.floor(place / size).cast("long"))


def refresh_scope(changes: DataFrame, key: str, sentinel: str) -> DataFrame:
    """One row: changes of the sentinel (everything), distinct other keys, and the keys in order with their counts."""
    per = changes.groupBy(key).agg(F.count("*").alias("n"))
    return per.agg(F.coalesce(F.sum(F.when(F.col(key) == sentinel, F.col("n"))), F.lit(0)).alias("full_refreshes"), F.count_if(F.col(key) != sentinel).alias("keys"), F.array_sort(F.collect_list(F.when(F.col(key) != sentinel, F.struct(key, "n")))).alias("scope"))
