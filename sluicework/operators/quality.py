"""Data-quality checks: each returns a frame of findings, so many checks union into one job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def null_rates(df: DataFrame, most: float = 5.0) -> DataFrame:
    """column_name, null_pct (two decimals) and passed for every column, in one pass."""
    one = df.agg(F.count("*").alias("n"), *(F.count_if(F.col(c).isNull()).alias(c) for c in df.columns))
    long = one.select("n", F.explode(F.array(*(F.struct(F.lit(c).alias("column_name"), F.col(c).alias("nulls")) for c in df.columns))).alias("x")).select("n", "x.*")
    pct = F.round(F.coalesce(F.try_divide(100 * F.col("nulls"), F.col("n")), F.lit(0.0)), 2)
    return long.select("column_name", pct.alias("null_pct"), (pct <= most).alias("passed"))


def duplicate_groups(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with n; null keys form groups."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def duplicate_ratio(df: DataFrame, keys: list[str], most: float = 0.001) -> DataFrame:
    """One row: rows, extra_rows (beyond one per key), ratio, flagged."""
    per = df.groupBy(*keys).agg(F.count("*").alias("n"))
    out = per.agg(F.sum("n").alias("n_rows"), F.sum(F.col("n") - 1).alias("extra_rows"))
    ratio = F.coalesce(F.try_divide("extra_rows", "n_rows"), F.lit(0.0))
    return out.select("n_rows", "extra_rows", ratio.alias("ratio"), (ratio > most).alias("flagged"))


def fresh_share(df: DataFrame, ts: str, now: Column, max_hours: int, least: float = 80.0) -> DataFrame:
    """One row: the share of rows at most ``max_hours`` whole hours old, and passed."""
    age = F.timestamp_diff("HOUR", F.col(ts), now)
    out = df.agg(F.count("*").alias("n_rows"), F.count_if(age <= max_hours).alias("n_fresh"))
    pct = F.round(F.coalesce(F.try_divide(100 * F.col("n_fresh"), F.col("n_rows")), F.lit(0.0)), 2)
    return out.select("n_rows", "n_fresh", pct.alias("fresh_pct"), (pct >= least).alias("passed"))


def row_bounds(df: DataFrame, least: int | None = None, most: int | None = None) -> DataFrame:
    """One row: n_rows and whether they are within the bounds."""
    n = F.col("n_rows")
    return df.agg(F.count("*").alias("n_rows")).withColumn("passed", (n >= least if least is not None else F.lit(True)) & (n <= most if most is not None else F.lit(True)))


def null_jump(recent: DataFrame, before: DataFrame, column: str, points: float = 20.0, least_rows: int = 100) -> DataFrame:
    """One row: null rates in percent of two periods, and flagged if the first is more than ``points`` above, both having enough rows."""
    rate = lambda df, name: df.agg(F.count("*").alias(f"{name}_rows"), (100 * F.try_divide(F.count_if(F.col(column).isNull()), F.count("*"))).alias(f"{name}_pct")).withColumn("k", F.lit(1))
    out = rate(recent, "recent").join(rate(before, "before"), "k").drop("k")
    enough = (F.col("recent_rows") >= least_rows) & (F.col("before_rows") >= least_rows)
    return out.withColumn("flagged", F.coalesce(enough & (F.col("recent_pct") - F.col("before_pct") > points), F.lit(False)))


def schema_diff(staging: StructType, main: StructType) -> list[tuple[str, str, str | None, str | None]]:
    """(change, field, type before, type after): new_field, missing_field, type_change, mode_change."""
    s, m = {f.name: f for f in staging}, {f.name: f for f in main}
    out = [("new_field", n, None, f.dataType.simpleString()) for n, f in s.items() if n not in m]
    out += [("missing_field", n, f.dataType.simpleString(), None) for n, f in m.items() if n not in s]
    for n in s.keys() & m.keys():
        before, after = m[n].dataType.simpleString(), s[n].dataType.simpleString()
        if before != after:
            out.append(("type_change", n, before, after))
        elif m[n].nullable != s[n].nullable:
            out.append(("mode_change", n, str(m[n].nullable), str(s[n].nullable)))
    return sorted(out)


def evolve(staging: DataFrame, main: DataFrame) -> tuple[DataFrame, list[tuple[str, str, str | None, str | None, bool]]]:
    """``main`` with the new fields of staging, text that staging has as timestamps converted, other changes blocked; and the log (last: applied)."""
    log, out = [], main
    for change, name, before, after in schema_diff(staging.schema, main.schema):
        ok = change == "new_field" or (change == "type_change" and before == "string" and after == "timestamp")
        if change == "new_field":
            out = out.withColumn(name, F.lit(None).cast(staging.schema[name].dataType))
        elif ok:
            out = out.withColumn(name, F.try_to_timestamp(name))
        log.append((change, name, before, after, ok))
    return out, log


def infer_types(df: DataFrame) -> DataFrame:
    """column_name and inferred: the first of timestamp, integer, float, boolean that fits all values of a text column, else string."""
    def fits(c: str, cast: Column) -> Column:
        return (F.count_if(F.col(c).isNotNull() & cast.isNull()) == 0) & (F.count(c) > 0)

    tries = lambda c: [("timestamp", F.when(F.col(c).rlike(r"^\d{4}-\d{2}-\d{2}"), F.try_to_timestamp(F.col(c)))), ("integer", F.when(F.col(c).rlike(r"^\s*[-+]?\d+\s*$"), F.col(c).try_cast("bigint"))), ("float", F.col(c).try_cast("double")), ("boolean", F.col(c).try_cast("boolean"))]

    def ladder(c: str) -> Column:
        out = None
        for name, cast in tries(c):
            out = F.when(fits(c, cast), name) if out is None else out.when(fits(c, cast), name)
        return out.otherwise("string")

    text = df.select([F.col(c).cast("string").alias(c) for c in df.columns])
    one = text.agg(*(ladder(c).alias(c) for c in df.columns))
    return one.select(F.explode(F.array(*(F.struct(F.lit(c).alias("column_name"), F.col(c).alias("inferred")) for c in df.columns))).alias("x")).select("x.*")


def shrink_guard(new: DataFrame, old: DataFrame, least: float = 0.5) -> DataFrame:
    """One row: counts of both, and blocked if the new one has less than ``least`` of the old one's."""
    out = new.agg(F.count("*").alias("n_new")).withColumn("k", F.lit(1)).join(old.agg(F.count("*").alias("n_old")).withColumn("k", F.lit(1)), "k").drop("k")
    return out.withColumn("blocked", F.col("n_new") < least * F.col("n_old"))


def orphans(df: DataFrame, column: str, lookup: DataFrame, key: str) -> DataFrame:
    """Distinct values that the lookup lacks."""
    return df.select(F.col(column).alias("value")).where("value is not null").subtract(lookup.select(F.col(key).alias("value")))
