"""Table specs, reading day folders of reports, dated archives and atomic promotion."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sluicework.functions import normalise


@dataclass
class TableSpec:
    """A table: its keys, declared types, how it is loaded and laid out."""

    name: str
    keys: list[str]
    schema: dict[str, str] = field(default_factory=dict)
    disposition: str = "merge"
    incremental: str = "none"
    partition_by: str | None = None
    pattern: str | None = None
    priority: int = 0


def project(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Headers in snake case, the declared columns in order and coerced, missing ones null; rows with a blank first column go."""
    df = normalise.normalise_headers(df)
    first = F.col(df.columns[0])
    df = df.where(first.isNotNull() & (F.trim(first.cast("string")) != ""))
    if not spec.schema:
        return df
    return df.select([normalise.coerce(F.col(c) if c in df.columns else F.lit(None).cast("string"), kind).alias(c) for c, kind in spec.schema.items()])


def require_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def route(path: Column, specs: list[TableSpec]) -> Column:
    """The name of the spec whose pattern matches a path: the highest priority, then the first; null if none does."""
    out = None
    for s in sorted((s for s in specs if s.pattern), key=lambda s: -s.priority):
        out = F.when(path.rlike(s.pattern), s.name) if out is None else out.when(path.rlike(s.pattern), s.name)
    return out.otherwise(F.lit(None).cast("string")) if out is not None else F.lit(None).cast("string")


def read_reports(spark: SparkSession, root: str, spec: TableSpec, start: str, end: str, kind: str = "csv") -> DataFrame:
    """Report files in day folders (day=yyyy-mm-dd) from start to end, with lineage columns.

    The day is a partition column, so folders outside the dates aren't listed for reading.
    """
    reader = spark.read.option("basePath", root)
    raw = (reader.option("header", True).csv(root) if kind == "csv" else reader.json(root) if kind == "json" else reader.parquet(root)).where(F.col("day").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    if spec.pattern:
        raw = raw.where(F.col("_metadata.file_path").rlike(spec.pattern))
    stamped = raw.withColumns({"source_path": F.col("_metadata.file_path"), "report_day": F.col("day").cast("date")})
    return project(stamped.drop("day"), spec) if not spec.schema else project(stamped, TableSpec(spec.name, spec.keys, spec.schema | {"source_path": "STRING", "report_day": "DATE"}))


def consolidate(frames: list[DataFrame]) -> DataFrame:
    """The union of frames by name; columns that one lacks are null there."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def scan_range(df: DataFrame, column: str, start: str, end: str, closed: bool, keep_null: bool) -> DataFrame:
    """A date range: closed at both ends, or up to the end's day; rows without a date stay where wanted."""
    c = F.col(column)
    cond = c.between(F.lit(start), F.lit(end)) if closed else (c >= F.lit(start)) & (c < F.date_add(F.lit(end).cast("date"), 1))
    return df.where(cond | c.isNull()) if keep_null else df.where(cond)


def read_jdbc(spark: SparkSession, url: str, table: str, key: str, low: int, high: int, parts: int, **options: str) -> DataFrame:
    """A table over JDBC in ranges of a numeric key, fetched in batches."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, partitionColumn=key, lowerBound=low, upperBound=high, numPartitions=parts, fetchsize="10000", **options).load()


def write_dated(df: DataFrame, root: str, ts: str) -> None:
    """A raw archive by year, month and day."""
    d = F.col(ts)
    df.withColumns({"y": F.year(d), "m": F.month(d), "d": F.day(d)}).write.mode("append").partitionBy("y", "m", "d").parquet(root)


def promote(spark: SparkSession, staged: dict[str, str]) -> None:
    """Move staged folders (staged path to live path) into place together; on an error all are put back."""
    sc = spark.sparkContext
    path = sc._jvm.org.apache.hadoop.fs.Path
    done: list[tuple] = []
    try:
        for source, target in staged.items():
            src, dst, old = path(source), path(target), path(f"{target}.before")
            fs = dst.getFileSystem(sc._jsc.hadoopConfiguration())
            had = fs.exists(dst)
            if not fs.exists(src):
                raise FileNotFoundError(source)
            fs.delete(old, True)
            if had and not fs.rename(dst, old):
                raise OSError(f"can't move {target}")
            done.append((fs, src, dst, old, had))
            if not fs.rename(src, dst):
                raise OSError(f"can't move {source}")
    except Exception:
        for fs, src, dst, old, had in reversed(done):
            if fs.exists(dst):
                fs.rename(dst, src)
            if had:
                fs.rename(old, dst)
        raise
    for fs, _, _, old, _ in done:
        fs.delete(old, True)


def arrow_safe(schema: StructType) -> list[tuple[str, str]]:
    """Column names and kinds as a warehouse shows them: decimals, nested and unknown types are STRING."""
    kinds = {"byte": "INT64", "short": "INT64", "integer": "INT64", "long": "INT64", "float": "FLOAT64", "double": "FLOAT64", "boolean": "BOOL", "date": "DATE", "timestamp": "TIMESTAMP"}
    return [(f.name, kinds.get(f.dataType.typeName(), "STRING")) for f in schema]
