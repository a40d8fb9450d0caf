"""The load path: deduplicated staging rows are merged into a table, or replace it with a changelog.

Tables are plain Parquet, so a merge is one full outer join on the keys and an overwrite of the
result; a changed row is found by its hash, and every rule is an expression in that join.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

METRICS = ("impressions", "clicks", "active_view_measurable_impressions", "active_view_viewable_impressions", "total_conversions")
SYSTEM = ("extracted_at", "loaded_at", "execution_id", "source", "updated_at", "row_hash")


def row_hash(df: DataFrame, exclude: tuple[str, ...] = SYSTEM) -> Column:
    """MD5 of all columns but ``exclude``, in order of name; null counts as empty, timestamps by the second."""
    kinds = dict(df.dtypes)
    text = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") if kinds[c].startswith("timestamp") else F.to_json(c) if kinds[c].startswith(("struct", "array", "map")) else F.col(c).cast("string")
    return F.md5(F.concat_ws("|", *(F.coalesce(text(c), F.lit("")) for c in sorted(df.columns) if c not in exclude)))


def dedup_staging(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key: the largest sum of metrics (where all are there), the latest extraction and load, then by hash."""
    order = []
    if set(METRICS) <= set(df.columns):
        order.append(sum((F.coalesce(c, F.lit(0)) for c in METRICS), F.lit(0)).desc())
    order += [F.col(c).desc_nulls_last() for c in ("extracted_at", "loaded_at") if c in df.columns] or [F.col(keys[0]).desc()]
    order.append(F.xxhash64(*[c for c in df.columns]))
    return df.withColumn("place__", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("place__ = 1").drop("place__")


def dedup_latest(df: DataFrame, keys: list[str], by: Column) -> DataFrame:
    """One row per key: the greatest ``by``; keys that the frame lacks are ignored."""
    keys = [k for k in keys if k in df.columns]
    if not keys:
        return df
    return df.withColumn("place__", F.row_number().over(Window.partitionBy(*keys).orderBy(by.desc_nulls_last(), F.xxhash64(*df.columns)))).where("place__ = 1").drop("place__")


def fill_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Null string keys become empty."""
    return df.fillna("", subset=[k for k, t in df.dtypes if k in keys and t == "string"])


@dataclass
class MergeRules:
    """What a merge does: keep old values where new ones are null, guard metrics from shrinking, delete what staging lacks."""

    preserve_nulls: bool = True
    guard_metrics: bool = False
    delete_missing: bool = False
    updated_at: Column | None = None


def hash_merge(staging: DataFrame, main: DataFrame, keys: list[str], rules: MergeRules | None = None) -> DataFrame:
    """The merged table with ``action`` per row: INSERT, UPDATE, KEEP or DELETE.

    Staging is deduplicated and cast to the table's types (values that don't fit become null). Keys match null-safely.
    A row is updated where its hash differs and, with ``guard_metrics``, its sum of metrics doesn't fall.
    """
    rules = rules or MergeRules()
    kinds = {f.name: f.dataType for f in main.schema}
    values = [c for c in main.columns if c not in keys]
    fitted = staging.select([F.col(c).try_cast(kinds[c]).alias(c) if c in staging.columns else F.lit(None).cast(kinds[c]).alias(c) for c in main.columns])
    s = dedup_staging(fitted, keys)
    s = s.select([F.col(c).alias(f"s_{c}") for c in main.columns] + [row_hash(s, (*SYSTEM, *keys)).alias("s_hash"), F.lit(True).alias("s_there")])
    m = main.select([F.col(c).alias(f"m_{c}") for c in main.columns] + [row_hash(main, (*SYSTEM, *keys)).alias("m_hash"), F.lit(True).alias("m_there")])
    on = [F.col(f"s_{k}").eqNullSafe(F.col(f"m_{k}")) for k in keys]
    both = F.col("s_there").isNotNull() & F.col("m_there").isNotNull()
    changed = both & (F.col("s_hash") != F.col("m_hash"))
    if rules.guard_metrics:
        total = lambda side: sum((F.coalesce(f"{side}_{c}", F.lit(0)) for c in METRICS if c in main.columns), F.lit(0))
        changed &= total("s") >= total("m")
    action = F.when(F.col("m_there").isNull(), "INSERT").when(F.col("s_there").isNull(), "DELETE" if rules.delete_missing else "KEEP").when(changed, "UPDATE").otherwise("KEEP")
    new = lambda c: F.coalesce(f"s_{c}", f"m_{c}") if rules.preserve_nulls else F.col(f"s_{c}")
    out = s.join(m, on, "full_outer").withColumn("action", action)
    cols = [F.coalesce(f"m_{k}", f"s_{k}").alias(k) for k in keys]
    cols += [F.when(F.col("action") == "UPDATE", new(c)).when(F.col("action") == "INSERT", F.col(f"s_{c}")).otherwise(F.col(f"m_{c}")).alias(c) for c in values]
    return out.select("action", *cols).select("action", *main.columns)


def change_stats(merged: DataFrame) -> DataFrame:
    """One row: rows_inserted, rows_updated, rows_removed, rows_total (left in the table)."""
    count = lambda a: F.count_if(F.col("action") == a)
    return merged.agg(count("INSERT").alias("rows_inserted"), count("UPDATE").alias("rows_updated"), count("DELETE").alias("rows_removed"), F.count_if(F.col("action") != "DELETE").alias("rows_total"))


def changelog(staging: DataFrame, main: DataFrame, keys: list[str]) -> DataFrame:
    """change_type (ADDED, REMOVED, UPDATED with the new values) and the columns; unchanged rows are left out."""
    s = staging.withColumn("hash__", row_hash(staging, (*SYSTEM, *keys)))
    m = main.withColumn("hash__", row_hash(main, (*SYSTEM, *keys)))
    on = [s[k].eqNullSafe(m[k]) for k in keys]
    added, removed = s.join(m, on, "left_anti"), m.join(s, on, "left_anti")
    updated = s.join(m.select(*keys, F.col("hash__").alias("old__")).withColumnsRenamed({k: f"{k}__m" for k in keys}), [s[k].eqNullSafe(F.col(f"{k}__m")) for k in keys]).where("hash__ != old__")
    label = lambda df, kind: df.select(F.lit(kind).alias("change_type"), *main.columns)
    return label(added, "ADDED").unionByName(label(removed, "REMOVED")).unionByName(label(updated, "UPDATED"))


def removed_records(staging: DataFrame, main: DataFrame, keys: list[str], reason: str = "not in source") -> DataFrame:
    """The rows of ``main`` that staging lacks, with the reason."""
    return main.join(staging.select(keys).distinct(), [main[k].eqNullSafe(staging[k]) for k in keys], "left_anti").withColumn("removal_reason", F.lit(reason))


def snapshot_replace(staging: DataFrame, main: DataFrame | None, keys: list[str], rebuild: bool = False) -> tuple[DataFrame, DataFrame | None, DataFrame | None]:
    """(new table, changelog, removed rows). Empty staging changes nothing; a first load or a rebuild has no changelog."""
    if main is not None and staging.isEmpty():
        return main, None, None
    if main is None or rebuild:
        return staging, None, None
    return staging, changelog(staging, main, keys), removed_records(staging, main, keys)


def apply_disposition(disposition: str, staging: DataFrame, main: DataFrame, keys: list[str], rules: MergeRules | None = None) -> DataFrame:
    """The table after a load: replace, merge or incremental; append isn't a disposition of the standard path."""
    if disposition == "replace":
        return snapshot_replace(staging, main, keys)[0]
    if disposition in ("merge", "incremental"):
        return hash_merge(staging, main, keys, rules).where("action != 'DELETE'").drop("action")
    raise ValueError(f"unknown write disposition: {disposition}")


def update_from_lookup(df: DataFrame, lookup: DataFrame, key: str, column: str, guard: str | None = None) -> DataFrame:
    """``column`` from the lookup where it differs null-safely; rows whose ``guard`` is true keep theirs."""
    one = lookup.groupBy(key).agg(F.min(column).alias("new__"))
    other = F.col("new__").isNotNull() & ~F.col("new__").eqNullSafe(F.col(column))
    if guard:
        other &= ~F.coalesce(F.col(guard), F.lit(False))
    return df.join(one, key, "left").withColumn("changed", other).withColumn(column, F.when(other, F.col("new__")).otherwise(F.col(column))).drop("new__")
