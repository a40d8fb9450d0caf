"""Shared folders: where intermediate tables go, so that lost executors cost only the tasks they ran."""

from __future__ import annotations

import atexit
import contextlib
import re
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

_OWN: list[tempfile.TemporaryDirectory] = []
_CLEANED: set[str] = set()
#: Spark's setting by which an execution removes its shuffle files when it ends.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: What one task reads of files or of a shuffle, at most about; a task sorts and hashes what it has read, so this bounds its memory.
TASK_BYTES = 8 << 20
#: Rows of some numbers or a digest that a task writes where their number is known, at least about.
TASK_ROWS = 20_000
#: Folders made in each open scope of intermediates.
_SCOPES: list[list[str]] = []


def _own_dir() -> str:
    if not _OWN:
        _OWN.append(tempfile.TemporaryDirectory(prefix="sluicework-"))
        atexit.register(_OWN[0].cleanup)
    return _OWN[0].name


def shared_dir(spark: SparkSession, keep: bool = False) -> str:
    """A new folder below ``spark.checkpoint.dir``, which the driver and the executors share.

    It goes with the scope of intermediates that is open, unless it is to be kept, or else when the driver ends.

    Where that is unset, a local master gets a temporary folder; on a cluster it is an error.
    """
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = f"file://{_own_dir()}"
    top = sc._jvm.org.apache.hadoop.fs.Path(f"{base.rstrip('/')}/sluicework/{sc.applicationId}")
    fs = top.getFileSystem(sc._jsc.hadoopConfiguration())
    if sc.applicationId not in _CLEANED:
        _CLEANED.add(sc.applicationId)
        atexit.register(_delete, fs, top)
    uri = re.sub("^file:/(?!/)", "file:///", fs.makeQualified(top).toString())
    made = f"{uri}/{uuid.uuid4().hex[:12]}"
    if _SCOPES and not keep:
        _SCOPES[-1].append(made)
    return made


@contextlib.contextmanager
def intermediates(spark: SparkSession) -> Iterator[None]:
    """A scope of intermediate tables: those written in it are deleted at its end, so nothing lazy that reads them may outlive it."""
    _SCOPES.append([])
    try:
        yield
    finally:
        for made in _SCOPES.pop():
            remove(spark, made)


def _delete(fs, top) -> None:
    """Remove an application's folder when its driver ends in order; one that was killed leaves it."""
    with contextlib.suppress(Exception):  # the JVM may have ended first
        fs.delete(top, True)


def small_tasks(spark: SparkSession) -> None:
    """From now on tasks of this session read about ``TASK_BYTES`` at most, so a task's memory doesn't grow with the tables.

    It stays set: Spark reads these when a frame runs, which may be later. Smaller settings are kept.
    """
    for key in ("spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes"):
        now = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(key, "64m"))
        spark.conf.set(key, str(min(now, TASK_BYTES)))


def materialize(df: DataFrame, label: str, keep: bool = False) -> DataFrame:
    """Write ``df`` as Parquet in a shared folder and return it as read from there; ``keep`` it beyond a scope of intermediates.

    The lineage ends at those files: a lost executor costs only the tasks it ran, and
    several readers of the result don't compute it again. Spark removes the write's own shuffle files when it ends, as nothing reads them again.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark, keep)}/{label}"
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def few_tasks(df: DataFrame, rows: int) -> DataFrame:
    """``df``, of about so many narrow rows at most, from no more tasks than they ask for: a small table isn't written as a file for each shuffle partition."""
    return df.coalesce(max(1, -(-rows // TASK_ROWS)))


def remove(spark: SparkSession, folder: str) -> None:
    """Delete a folder that ``shared_dir`` gave, when nothing will read it again."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    _delete(path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path)
