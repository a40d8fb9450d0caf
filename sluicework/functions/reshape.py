"""Nested values to columns and rows, and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

from sluicework.functions.normalise import snake


def flatten(df: DataFrame, depth: int = 4, sep: str = "_") -> DataFrame:
    """Structs become columns down to ``depth``; deeper ones, arrays and maps become JSON."""
    def walk(c: Column, kind, name: str, level: int):
        if isinstance(kind, StructType) and level < depth:
            for f in kind:
                yield from walk(c.getField(f.name), f.dataType, f"{name}{sep}{snake(f.name)}" if name else snake(f.name), level + 1)
        elif isinstance(kind, (StructType, ArrayType, MapType)):
            yield F.to_json(c).alias(name)
        else:
            yield c.alias(name)

    return df.select([x for f in df.schema for x in walk(F.col(f"`{f.name}`"), f.dataType, snake(f.name), 0)])


def pairs_to_columns(df: DataFrame, array: str, key: str, value: str, names: list[str]) -> DataFrame:
    """An array of structs with a key and a value, to a column per name; of one key the last value counts."""
    def of(name: str) -> Column:
        return F.get(F.reverse(F.filter(array, lambda x: x[key] == name)), F.lit(0))[value].alias(snake(name))

    return df.select(*[c for c in df.columns if c != array], *map(of, names))


def repeating_groups(df: DataFrame, keys: list[str], groups: int, parts: dict[str, str]) -> DataFrame:
    """Numbered column groups (``parts``: name to pattern with {i}) to rows, with their number; empty groups go."""
    one = lambda i: F.struct(F.lit(i).alias("sequence"), *(F.col(p.format(i=i)).cast("string").alias(n) if p.format(i=i) in df.columns else F.lit(None).cast("string").alias(n) for n, p in parts.items()))
    rows = df.select(*keys, F.explode(F.array(*map(one, range(1, groups + 1)))).alias("x")).select(*keys, "x.*")
    first = F.col(next(iter(parts)))
    return rows.where(first.isNotNull() & (F.trim(first) != ""))


def path(c: Column, dotted: str) -> Column:
    """A scalar at a dotted path of JSON text; null for objects, arrays and no match."""
    value = F.get_json_object(c, f"$.{dotted}")
    return F.when(~value.rlike(r"^\s*[\[{]"), value)


def string_ids(df: DataFrame, suffix: str = "id") -> DataFrame:
    """Columns named ``id`` or ending with ``_id`` as text."""
    return df.select([F.col(c).cast("string").alias(c) if c == suffix or c.endswith(f"_{suffix}") else F.col(c) for c in df.columns])


def truncate(df: DataFrame, limits: dict[str, int]) -> DataFrame:
    return df.withColumns({c: F.substring(c, 1, n) for c, n in limits.items() if c in df.columns})
