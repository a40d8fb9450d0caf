"""Freshness of tables, reliability scores of sources, and control of incremental loads."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def probe(df: DataFrame, candidates: list[str]) -> Column:
    """The latest date of the first candidate column that has one."""
    return F.coalesce(*(F.max(F.to_date(c)) for c in candidates if c in df.columns))


def status(days_behind: Column, limit: Column, warn: Column, static: Column) -> Column:
    """FAIL beyond the limit, STATIC for tables that don't change, WARNING from the warning threshold on, else PASS."""
    return F.when(days_behind.isNull(), "ERROR").when(static, "STATIC").when(days_behind > limit, "FAIL").when(days_behind >= warn, "WARNING").otherwise("PASS")


def status_delta(now: DataFrame, before: DataFrame, key: str = "table_name") -> DataFrame:
    """Tables whose status changed between two runs, from and to."""
    b = before.select(key, F.col("audit_status").alias("from_status"))
    return now.select(key, F.col("audit_status").alias("to_status")).join(b, key, "full_outer").where(~F.col("from_status").eqNullSafe(F.col("to_status")))


def at_risk(runs: DataFrame, key: str = "table_name", k: int = 3) -> DataFrame:
    """Tables whose days_behind rose strictly over their last ``k`` runs and that don't fail yet."""
    w = Window.partitionBy(key).orderBy(F.col("run_at").desc())
    last = runs.withColumn("place", F.row_number().over(w)).withColumn("prior", F.lead("days_behind").over(w)).where(F.col("place") <= k)
    out = last.groupBy(key).agg(F.count("*").alias("n"), F.bool_and(F.when(F.col("place") < k, F.col("days_behind") > F.col("prior"))).alias("rising"), F.max(F.when(F.col("place") == 1, F.col("audit_status"))).alias("audit_status"))
    return out.where((F.col("n") == k) & F.col("rising") & ~F.col("audit_status").isin("FAIL", "ERROR")).select(key, "audit_status")


def thresholds(limit: int | None, warn: int | None, preset: int | None = None, default: int = 7) -> tuple[int, int]:
    """(limit, warning): explicit, else the cadence preset, else the default; a warning is at most the limit."""
    top = limit if limit is not None else preset if preset is not None else default
    return top, min(warn, top) if warn is not None else top


def upstream_gate(ages: DataFrame, force: bool = False) -> DataFrame:
    """From source, age_hours, limit_hours and critical: stale per source, and blocked for all (any critical one stale, unless forced)."""
    stale = F.col("age_hours").isNull() | (F.col("age_hours") > F.col("limit_hours"))
    return ages.withColumn("stale", stale).withColumn("blocked", F.lit(not force) & F.bool_or(stale & F.col("critical")).over(Window.partitionBy(F.lit(1))))


def reliability(m: dict[str, Column]) -> Column:
    """0 to 100: success .45, freshness .20, quality .15, anomaly .10 and schema stability .10, each a share in 0..1."""
    weights = {"success": 45, "freshness": 20, "quality": 15, "anomaly": 10, "schema": 10}
    total = sum((w * F.least(F.greatest(F.coalesce(m[k], F.lit(0.0)), F.lit(0.0)), F.lit(1.0)) for k, w in weights.items()), F.lit(0.0))
    # ten times the total is rounded, as the SQL does: by its decimal digits 62.849999999999994, a sum of exact shares of 62.85, would be 62.8
    return F.round(total * 10) / 10


def grade(score: Column) -> Column:
    return F.when(score >= 90, "A").when(score >= 80, "B").when(score >= 70, "C").when(score >= 60, "D").otherwise("F")


def degraded(score: Column, baseline: Column, floor: float = 70.0, fall: float = 15.0) -> Column:
    """Below the floor, or at least ``fall`` below the baseline where there is one."""
    return (score < floor) | F.coalesce(baseline - score >= fall, F.lit(False))


def health(success: Column, errors: Column, per_minute: Column) -> Column:
    """.4 success + .3 (100 - errors) + .3 throughput, in percent; 1000 rows a minute count in full."""
    return 0.4 * success + 0.3 * (100 - errors) + 0.3 * F.least(F.lit(100.0), per_minute / 1000 * 100)


def retryable(failures: DataFrame, most: int = 3) -> DataFrame:
    """Per source and table with an open failure and retries left: their number and the latest error."""
    open_ = failures.where(~F.col("resolved") & (F.col("retry_count") < most))
    return open_.groupBy("source", "table_name").agg(F.count("*").alias("n"), F.max_by("error_type", F.struct("failed_at", "error_type")).alias("last_error"))


def watermark_start(now: datetime, watermark: datetime | None, initial: datetime | None = None, lookback: int = 7, safety: int = 0) -> datetime:
    """Where an incremental load starts: the watermark less the safety days, never in the future; without one the initial or now less the lookback."""
    if watermark is None:
        return initial or now - timedelta(days=lookback)
    return min(watermark - timedelta(days=max(safety, 0)), now)


def incremental_window(strategy: str, now: datetime, start: datetime | None = None, end: datetime | None = None, watermark: datetime | None = None, lookback: int = 7, safety: int = 0) -> tuple[datetime | None, datetime | None]:
    """(start, end) of a load: none for full, parent and none; the end only for id; else dates as given, or from the watermark."""
    if strategy in ("full", "parent", "none"):
        return None, None
    if strategy == "id":
        return None, end or now
    if start and end:
        return start, end
    return start or watermark_start(now, watermark, lookback=lookback, safety=safety), end or now


def in_window(df: DataFrame, column: str, start: datetime | None, end: datetime | None, keep_null: bool = True) -> DataFrame:
    """Rows from start up to the end's day; rows without a date stay if wanted."""
    cond = F.lit(True)
    if start:
        cond &= F.col(column) >= F.lit(start)
    if end:
        cond &= F.col(column) < F.date_add(F.lit(end), 1)
    return df.where(cond | F.col(column).isNull() if keep_null else cond)
