"""Rule tables: text is classified by the first matching pattern of a small table of rules."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """``label`` for text that matches ``pattern`` (LIKE) and not ``unless``; the least priority counts, then the order."""

    label: str
    pattern: str
    priority: int = 0
    unless: str | None = None
    scope: str | None = None


def classify(text: Column, rules: list[Rule], scope: str | None = None) -> Column:
    """The label of the first rule of the scope (or of all scopes) that matches; null without one."""
    out = None
    for r in sorted((r for r in rules if r.scope in (None, scope)), key=lambda r: r.priority):
        hit = text.like(r.pattern) & (~text.like(r.unless) if r.unless else F.lit(True))
        out = F.when(hit, r.label) if out is None else out.when(hit, r.label)
    return out.otherwise(F.lit(None).cast("string")) if out is not None else F.lit(None).cast("string")


def classify_by_table(df: DataFrame, text: str, rules: DataFrame, key: str) -> DataFrame:
    """``df`` with label, for rules in a table (label, pattern, priority) too many for an expression.

    Distinct texts are matched, not rows, and Spark broadcasts the rules only while they are small.
    """
    texts = df.select(F.col(text).alias("t__")).distinct()
    hits = texts.join(rules, F.expr("t__ LIKE pattern")).groupBy("t__").agg(F.min_by("label", F.struct("priority", key)).alias("label"))
    return df.join(hits, df[text] == hits["t__"], "left").drop("t__")


def type_profile(df: DataFrame) -> DataFrame:
    """column_name, n_values, n_null, n_numeric, n_dates, min_length, max_length of every column as text, in one pass."""
    text = df.select([F.col(c).cast("string").alias(c) for c in df.columns])
    of = lambda c: F.struct(F.lit(c).alias("column_name"), F.count(c).alias("n_values"), F.count_if(F.col(c).isNull()).alias("n_null"), F.count_if(F.col(c).rlike(r"^[-+]?\d+(\.\d+)?$")).alias("n_numeric"), F.count_if(F.col(c).rlike(r"^\d{4}-\d{2}-\d{2}")).alias("n_dates"), F.min(F.length(c)).alias("min_length"), F.max(F.length(c)).alias("max_length"))
    return text.agg(F.array(*map(of, df.columns)).alias("a")).select(F.explode("a").alias("x")).select("x.*")


def parity_sample(a: DataFrame, b: DataFrame, key: str, n: int) -> DataFrame:
    """Rows of a deterministic sample of ``n`` keys that the two frames don't have alike; a sampling operator."""
    keys = a.select(key).distinct().orderBy(F.md5(F.col(key).cast("string")), key).limit(n)
    pick = lambda df: df.join(keys, key, "left_semi")
    left, right = pick(a), pick(b.select(a.columns))
    return left.exceptAll(right).withColumn("side", F.lit("a")).unionByName(right.exceptAll(left).withColumn("side", F.lit("b")))
