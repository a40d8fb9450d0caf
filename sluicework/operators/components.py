"""Connected components of an edge list, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluicework.storage import few_tasks, materialize

MOST_ROUNDS = 40


def components(edges: DataFrame) -> DataFrame:
    """From edges (u, v) of any comparable type, (node, component): a component is named by its least node.

    Nodes without an edge don't appear. Each round hangs a node's larger neighbours below its least
    one and then does so among the smaller ones, so paths shorten by a power; edges never multiply.
    The least neighbours are written before they are joined to the edges, so that the join has an
    exchange on both sides and a hub's edges can be split over tasks. The rounds end as soon as each node has larger
    neighbours only, or one smaller one alone; that is seen from the same counts, without another round.
    """
    edges = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u != v").distinct()
    edges = materialize(edges, "edges")
    n = edges.count()  # they never multiply
    for _ in range(MOST_ROUNDS):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        ends = both.groupBy("u").agg(F.min("v").alias("m"), F.count_if(F.col("v") < F.col("u")).alias("down"), F.count_if(F.col("v") > F.col("u")).alias("up"))
        amid = (F.col("down") > 1) | ((F.col("down") > 0) & (F.col("up") > 0))
        least = materialize(few_tasks(ends.select("u", F.least("u", "m").alias("m"), amid.alias("open")), 2 * n), "least")
        if least.where("open").isEmpty():
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(least.where("u = m").select(F.col("u").alias("node"), F.col("m").alias("component")))
        large = both.where("v > u").join(least.select("u", "m"), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").unionByName(low.select("u", F.col("m").alias("v")))
        edges = materialize(few_tasks(small.distinct(), n), "edges")
    raise RuntimeError(f"no stars after {MOST_ROUNDS} rounds")
