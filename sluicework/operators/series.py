"""Daily series: counts, spines, gaps and anomaly detectors. Every detector works on many series at once, keyed by ``table_name``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MAD_SCALE = 1.4826


def daily_counts(df: DataFrame, ts: str, name: Column) -> DataFrame:
    """table_name, d, n."""
    return df.groupBy(name.alias("table_name"), F.to_date(ts).alias("d")).agg(F.count("*").alias("n"))


def spine(series: DataFrame) -> DataFrame:
    """The series with a row for every day between its first and last; missing days count 0."""
    span = series.groupBy("table_name").agg(F.min("d").alias("a"), F.max("d").alias("b"))
    days = span.select("table_name", F.explode(F.sequence("a", "b")).alias("d"))
    return days.join(series, ["table_name", "d"], "left").select("table_name", "d", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def missing_days(series: DataFrame) -> DataFrame:
    """table_name, n_missing, first_missing, last_missing of the days without a row."""
    return spine(series).join(series, ["table_name", "d"], "left_anti").groupBy("table_name").agg(F.count("*").alias("n_missing"), F.min("d").alias("first_missing"), F.max("d").alias("last_missing"))


def gaps(series: DataFrame) -> DataFrame:
    """table_name, d, gap: days since the row before."""
    w = Window.partitionBy("table_name").orderBy("d")
    return series.select("table_name", "d", F.date_diff("d", F.lag("d").over(w)).alias("gap")).where("gap is not null")


def cadence(series: DataFrame) -> DataFrame:
    """table_name, cadence (most frequent gap, ties to the smaller; 1 for spans under 30 days), typical_gap (median)."""
    counts = gaps(series).groupBy("table_name", "gap").agg(F.count("*").alias("k"))
    mode = counts.groupBy("table_name").agg(F.max_by("gap", F.struct("k", -F.col("gap"))).alias("mode"))
    median = gaps(series).groupBy("table_name").agg(F.median("gap").alias("typical_gap"))
    span = series.groupBy("table_name").agg(F.date_diff(F.max("d"), F.min("d")).alias("span"))
    out = span.join(mode, "table_name", "left").join(median, "table_name", "left")
    return out.select("table_name", F.when(F.col("span") >= 30, F.coalesce("mode", F.lit(1))).otherwise(1).alias("cadence"), F.coalesce("typical_gap", F.lit(1.0)).alias("typical_gap"))


def recency(series: DataFrame, today: Column, grace: int = 2) -> DataFrame:
    """table_name, last_date, lag_days, cadence, severity (HIGH if the lag exceeds cadence and grace)."""
    last = series.groupBy("table_name").agg(F.max("d").alias("last_date"))
    lag = F.date_diff(today, F.col("last_date"))
    return last.join(cadence(series), "table_name").select("table_name", "last_date", lag.alias("lag_days"), "cadence", F.when(lag > F.col("cadence") + grace, "HIGH").otherwise("NONE").alias("severity"))


def abnormal_gaps(series: DataFrame, times: float = 3.0) -> DataFrame:
    """Gaps above ``times`` the series' typical one."""
    return gaps(series).join(cadence(series), "table_name").where(F.col("gap") > times * F.col("typical_gap")).select("table_name", "d", "gap")


def settle_lag(series: DataFrame, floor: int = 5, share: float = 0.8) -> DataFrame:
    """table_name, settle_days: at least ``floor``, or the run of last days that are below ``share`` of the median."""
    median = series.groupBy("table_name").agg(F.median("n").alias("body"))
    w = Window.partitionBy("table_name").orderBy(F.col("d").desc())
    low = series.join(median, "table_name").withColumn("low", F.col("n") < share * F.col("body")).withColumn("place", F.row_number().over(w))
    first_full = low.groupBy("table_name").agg(F.min(F.when(~F.col("low"), F.col("place"))).alias("full"), F.count("*").alias("k"))
    return first_full.select("table_name", F.greatest(F.lit(floor), F.coalesce(F.col("full") - 1, F.col("k"))).cast("int").alias("settle_days"))


def volume_outliers(series: DataFrame, settle: int = 5, recent: int = 14, least_days: int = 30, least_median: float = 100.0) -> DataFrame:
    """Days far below their series: n below median - 4 x 1.4826 x MAD and below half the median.

    The last ``settle`` days are still filling and left out; a series needs ``least_days`` others and a median of
    ``least_median``. Findings within ``recent`` days of the end are ACTIVE and MEDIUM, others HISTORICAL and LOW.
    """
    place = F.row_number().over(Window.partitionBy("table_name").orderBy(F.col("d").desc()))
    settled = series.withColumn("place", place).where(F.col("place") > settle)
    middle = settled.groupBy("table_name").agg(F.median("n").alias("median_n"), F.count("*").alias("days"), F.max("d").alias("last"))
    far = settled.join(middle, "table_name").withColumn("off", F.abs(F.col("n") - F.col("median_n")))
    mad = far.groupBy("table_name").agg(F.median("off").alias("mad"))
    out = far.join(mad, "table_name").withColumn("expected_low", F.col("median_n") - 4 * MAD_SCALE * F.col("mad"))
    out = out.where((F.col("days") >= least_days) & (F.col("median_n") >= least_median) & (F.col("n") < F.col("expected_low")) & (F.col("n") < 0.5 * F.col("median_n")))
    active = F.date_diff("last", "d") < recent
    return out.select("table_name", "d", "n", "median_n", "expected_low", F.when(active, "ACTIVE").otherwise("HISTORICAL").alias("status"), F.when(active, "MEDIUM").otherwise("LOW").alias("severity"))


def collapses(series: DataFrame, window: int = 7, share: float = 0.05) -> DataFrame:
    """Series whose last ``window`` days sum to less than ``share`` of the window before; both have to be full."""
    place = F.row_number().over(Window.partitionBy("table_name").orderBy(F.col("d").desc()))
    sums = spine(series).withColumn("place", place).groupBy("table_name").agg(F.sum(F.when(F.col("place") <= window, F.col("n"))).alias("recent_n"), F.sum(F.when(F.col("place").between(window + 1, 2 * window), F.col("n"))).alias("prior_n"), F.count("*").alias("days"))
    return sums.where(f"days >= {2 * window}").select("table_name", "recent_n", "prior_n", (F.col("recent_n") < share * F.col("prior_n")).alias("collapsed"))


def gone_to_zero(series: DataFrame, recent: int = 7) -> DataFrame:
    """table_name, flagged: the body's median is above 0 and every one of the last ``recent`` days is 0."""
    place = F.row_number().over(Window.partitionBy("table_name").orderBy(F.col("d").desc()))
    s = spine(series).withColumn("place", place)
    out = s.groupBy("table_name").agg(F.median(F.when(F.col("place") > recent, F.col("n"))).alias("body"), F.max(F.when(F.col("place") <= recent, F.col("n"))).alias("top"))
    return out.select("table_name", F.coalesce((F.col("body") > 0) & (F.col("top") == 0), F.lit(False)).alias("flagged"))


def active_delta(now: DataFrame, before: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that became active (new) or are no longer (resolved)."""
    label = lambda a, b, kind: a.select(keys).distinct().join(b.select(keys).distinct(), keys, "left_anti").withColumn("change", F.lit(kind))
    return label(now, before, "new").unionByName(label(before, now, "resolved"))
