"""A Python data source over text files inside zip archives, inflated as they are read.

The driver reads an archive's directory only and plans a task per member; a task inflates its member piece by piece and holds one piece and one
batch of lines, whatever the member's size. A compressed stream can't be entered in its middle, so a member is one task's; a task that is lost
begins its member anew.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Bytes of text that a task inflates at a time, and lines of a batch.
PIECE_BYTES, BATCH_LINES = 1 << 20, 8192


@dataclass
class Member(InputPartition):
    """One file of an archive."""

    archive: str
    name: str


def _open(uri: str) -> zipfile.ZipFile:
    """An archive at a URI that pyarrow's filesystems know, read by offsets."""
    files, path = pafs.FileSystem.from_uri(uri)
    try:
        return zipfile.ZipFile(files.open_input_file(path))
    except pa.ArrowInvalid as e:  # too short to have an archive's end
        raise zipfile.BadZipFile(f"{uri} is no zip archive") from e


def lines(stream: io.BufferedIOBase, encoding: str, piece: int = PIECE_BYTES) -> Iterator[str]:
    """The lines of a stream without their ends (``\\n`` or ``\\r\\n``); a mark at its start goes. One piece and one line are held."""
    text = io.TextIOWrapper(io.BufferedReader(stream, piece), encoding=encoding, errors="replace", newline="\n")
    for number, line in enumerate(text):
        if number == 0:
            line = line.removeprefix("﻿")
        yield line[:-1].removesuffix("\r") if line.endswith("\n") else line


class ZipLines(DataSource):
    """``spark.read.format("zip_lines").option("path", uri).option("members", regex).load()``: archive, member, number (from 0), line.

    ``path`` is one archive, or a folder whose ``.zip`` files are taken; ``members`` has to match a member's whole name (all, if absent);
    ``encoding`` is UTF-8 if absent, and bytes that it doesn't know are replaced. Folders in archives are passed over. Empty members and archives give no
    row. Encrypted members and files that are no archives are errors.
    """

    @classmethod
    def name(cls) -> str:
        return "zip_lines"

    def schema(self) -> str:
        return "archive string, member string, number long, line string"

    def reader(self, schema) -> ZipLinesReader:
        return ZipLinesReader(dict(self.options))


class ZipLinesReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.uri, self.wanted, self.encoding = options["path"], re.compile(options.get("members", ".*"), re.S), options.get("encoding", "utf-8")

    def archives(self) -> list[str]:
        files, path = pafs.FileSystem.from_uri(self.uri)
        if files.get_file_info(path).type != pafs.FileType.Directory:
            return [self.uri]
        found = [f.base_name for f in files.get_file_info(pafs.FileSelector(path)) if f.type == pafs.FileType.File and f.extension.lower() == "zip"]
        return [f"{self.uri.rstrip('/')}/{name}" for name in sorted(found)]

    def partitions(self) -> list[InputPartition]:
        planned: list[InputPartition] = []
        for uri in self.archives():
            with _open(uri) as archive:
                planned += [Member(uri, m.filename) for m in archive.infolist() if not m.is_dir() and self.wanted.fullmatch(m.filename)]
        return planned

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        if not isinstance(partition, Member):  # there is nothing to read
            return
        with _open(partition.archive) as archive, archive.open(partition.name) as stream:
            held: list[str] = []
            size = number = 0
            for line in lines(stream, self.encoding):
                held.append(line)
                size += len(line)
                if len(held) >= BATCH_LINES or size >= PIECE_BYTES:
                    yield self._batch(partition, held, number)
                    number, held, size = number + len(held), [], 0
            if held:
                yield self._batch(partition, held, number)

    def _batch(self, member: Member, held: list[str], number: int) -> pa.RecordBatch:
        n = len(held)
        columns = [pa.array([member.archive] * n), pa.array([member.name] * n), pa.array(range(number, number + n), pa.int64()), pa.array(held, pa.string())]
        return pa.RecordBatch.from_arrays(columns, names=["archive", "member", "number", "line"])


def read_zip_csv(spark: SparkSession, path: str, schema: str, members: str = r".*\.csv", encoding: str = "utf-8", separator: str = ",") -> DataFrame:
    """Rows of the CSV files in archives, with archive, member and number: each file's first line is its header, and others have the columns of ``schema``.

    Spark parses the lines; a quoted field may not hold a line break. Empty lines are no rows; a field that isn't of its type, or isn't there, is null.
    """
    spark.dataSource.register(ZipLines)
    read = spark.read.format("zip_lines").option("path", path).option("members", members).option("encoding", encoding).load()
    rows = read.where("number > 0 AND line != ''").select("archive", "member", "number", F.from_csv("line", F.lit(schema), {"sep": separator, "mode": "PERMISSIVE"}).alias("row"))
    return rows.select("archive", "member", "number", "row.*")
