"""A Python data source over paged fetches, by offset or cursor; the fetch is any function that executors can import."""

from __future__ import annotations

import importlib
import json
from collections.abc import Callable, Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


def by_offset(fetch: Callable[[int, int], list[dict]], size: int, start: int = 0, stop: int | None = None) -> Iterator[dict]:
    """Rows of fetch(offset, limit) from ``start`` until a short page, or ``stop``."""
    at = start
    while stop is None or at < stop:
        n = size if stop is None else min(size, stop - at)
        page = fetch(at, n)
        yield from page
        if len(page) < n:
            return
        at += n


def by_cursor(fetch: Callable[[str | None], tuple[list[dict], str | None]]) -> Iterator[dict]:
    """Rows of fetch(cursor) until there is no next cursor; a cursor that comes back ends it."""
    cursor, seen = None, set()
    while True:
        page, cursor = fetch(cursor)
        yield from page
        if cursor is None or cursor in seen:
            return
        seen.add(cursor)


class PagedSource(DataSource):
    """``spark.read.format("paged").schema(...).options(fetch="module:function", total=..., size=..., parts=...)``."""

    @classmethod
    def name(cls) -> str:
        return "paged"

    def schema(self) -> str:
        return "value string"

    def reader(self, schema) -> PagedReader:
        return PagedReader(schema, self.options)


class PagedReader(DataSourceReader):
    def __init__(self, schema, options):
        self.fields, self.options = schema.fieldNames(), options

    def partitions(self) -> list[InputPartition]:
        total, parts = int(self.options["total"]), int(self.options.get("parts", "1"))
        step = -(-total // parts)
        return [InputPartition((a, min(a + step, total))) for a in range(0, total, step)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        module, _, name = self.options["fetch"].partition(":")
        fetch = getattr(importlib.import_module(module), name)
        start, stop = partition.value
        for row in by_offset(fetch, int(self.options.get("size", "100")), start, stop):
            yield (json.dumps(row),) if self.fields == ["value"] else tuple(row.get(f) for f in self.fields)
