"""K-means on integer vectors by sort-means.

1. Vectors become integers, floor(scale * component). The first centroids are the vectors whose ids have the least hashes.
2. Each round the driver orders, for every centroid, the others by their distance from it (k * k numbers). A task reads
   its vectors with the centroid that each was assigned to, and scans the others in that one's order. It stops
   at the first that is strictly more than twice as far from the assigned centroid as the vector is: by the triangle
   inequality neither it nor any later one can be nearer, or as near. All of a block's vectors take a step of their scans at once.
3. The vectors are written with their new centroid, and the table before goes; so a lost executor costs its tasks only. Sums
   by centroid and component leave the tasks as digits, which Spark adds up; the driver gets k * dims of them.

All arithmetic is exact: 64-bit integers where no square can overflow, Python integers for the rows where one could.
No vector is shuffled. On disk are two copies of the vectors at most.

Edge cases: vectors that are null, of another length, or hold null or non-finite entries have no row; ties go to the smaller centroid;
equal vectors may be centroids side by side, and all but the first of those stay empty and where they are; with fewer than k vectors
there are as many centroids as vectors; null ids hash as an empty text; vectors of one id (or of none) follow
each other by their components where they compete as first centroids; an empty table gives no row; distances and
sums beyond 2**63 - 1 show as that number, while centroids are exact still; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicework.llm.common import bounded_batches, shared_dir, table
from sluicework.llm.vectors import LONG_MAX, SUM_SCHEMA, add_up, blocks, digits, exact_floors, floors, matrix, whole
from sluicework.storage import remove

CLUSTERS, ROUNDS, SCALE, DIMS, SEED = 40, 5, 256, 64, "2"
#: Components below this have squared distances, over up to so many of them, that fit 64 bits.
_MOST, _MOST_DIMS = 1 << 27, 64


class Clustering(NamedTuple):
    """Rows of id, cluster, distance, cluster_inertia, inertia and centroid_sha256; and the centroids."""

    rows: DataFrame
    centroids: list[list[int]]


class _Tables(NamedTuple):
    centroids: np.ndarray
    others: np.ndarray
    quarters: np.ndarray


def _tables(centroids: list[list[int]], kind) -> _Tables:
    """For each centroid the others, nearest first, and a quarter of their squared distances, rounded up.

    4 * d >= D for integers if and only if d >= ceil(D / 4), so this holds "within twice the distance" exactly.
    """
    k = len(centroids)
    far = [[sum((a - b) ** 2 for a, b in zip(x, y, strict=True)) for y in centroids] for x in centroids]
    others = [sorted((j for j in range(k) if j != i), key=lambda j: (far[i][j], j)) for i in range(k)]
    quarters = [[-(-far[i][j] // 4) for j in others[i]] for i in range(k)]
    return _Tables(np.array(centroids, kind), np.array(others, np.int64).reshape(k, k - 1), np.array(quarters, kind).reshape(k, k - 1))


def assign(x: np.ndarray, before: np.ndarray, tables: _Tables) -> tuple[np.ndarray, np.ndarray, int]:
    """The nearest centroid of each vector, its squared distance, and how many distances were computed."""
    centroids, others, quarters = tables
    here = ((x - centroids[before]) ** 2).sum(axis=1)
    best, at = here.copy(), before.copy()
    reach = (quarters[before] <= here[:, None]).sum(axis=1)  # the others that must be looked at are the first so many
    order = np.argsort(-reach, kind="stable")
    left = np.searchsorted(-reach[order], -np.arange(1, others.shape[1] + 1), side="right")
    for step, n in enumerate(left.tolist()):
        if not n:
            break
        rows = order[:n]
        other = others[before[rows], step]
        d = ((x[rows] - centroids[other]) ** 2).sum(axis=1)
        nearer = ((d < best[rows]) | ((d == best[rows]) & (other < at[rows]))).astype(bool)
        best[rows[nearer]], at[rows[nearer]] = d[nearer], other[nearer]
    return at, best, len(x) + int(reach.sum())


def _integers(column: pa.ChunkedArray, scale: int, dims: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """A block's vectors as integers, and their rows: those that 64 bits hold, then any others."""
    x = matrix(column, dims)
    small, held = floors(x, scale, _MOST)
    if held.any():
        yield small[held], np.flatnonzero(held)
    if not held.all():
        yield exact_floors(x[~held], scale), np.flatnonzero(~held)


def _assigner(centroids: list[list[int]], scale: int, dims: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fits = all(abs(c) < _MOST for x in centroids for c in x) and dims <= _MOST_DIMS
        fast, exact = (_tables(centroids, np.int64) if fits else None), None
        for block in blocks(batches):
            before = block.column("cluster").to_numpy().astype(np.int64)
            cluster, distance = np.empty(block.num_rows, np.int32), np.empty(block.num_rows, np.int64)
            for x, rows in _integers(block.column("vector"), scale, dims):
                if fast is None or x.dtype == object:
                    exact = exact or _tables(centroids, object)
                    at, d, _ = assign(x.astype(object), before[rows], exact)
                    d = np.array([min(v, LONG_MAX) for v in d], np.int64)
                else:
                    at, d, _ = assign(x, before[rows], fast)
                cluster[rows], distance[rows] = at, d
            yield from block.set_column(2, "cluster", pa.array(cluster)).set_column(3, "distance", pa.array(distance)).to_batches()

    return run


def _summer(scale: int, dims: int, k: int):
    """For assigned vectors: the sums of each cluster's components, and in place ``dims`` its count."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((k, dims + 1), object)
        for block in blocks(batches):
            cluster = block.column("cluster").to_numpy()
            for x, rows in _integers(block.column("vector"), scale, dims):
                for c in np.unique(cluster[rows]).tolist():
                    mine = x[cluster[rows] == c]
                    sums[c, :dims] += mine.sum(axis=0).astype(object)
                    sums[c, dims] += len(mine)
        yield digits((c * (dims + 1) + i, int(sums[c, i])) for c in range(k) for i in range(dims + 1))

    return run


def first_centroids(vectors: DataFrame, k: int, scale: int, dims: int, seed: str) -> list[list[int]]:
    """The k vectors whose ids, after the seed and a colon, have the least SHA-256."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    rows = vectors.select(key.alias("key"), "vector").orderBy("key", "vector").limit(k).collect()
    return [exact_floors(np.array([r.vector], float), scale)[0].tolist() for r in rows]


def cluster(vectors: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, scale: int = SCALE, dims: int = DIMS, seed: str = SEED, id_col: str = "vec_id", vector_col: str = "embedding") -> Clustering:
    """Assign every vector of ``dims`` components to one of k centroids, after so many rounds of moving these."""
    spark = vectors.sparkSession
    bounded_batches(spark)
    kept = vectors.where((F.size(vector_col) == dims) & whole(vector_col))
    kept = kept.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"))
    schema = f"id long, vector {kept.schema['vector'].dataType.simpleString()}, cluster int, distance long"
    centroids = first_centroids(kept, k, scale, dims, seed)
    k = len(centroids)
    now, folder = kept.withColumns({"cluster": F.lit(0), "distance": F.lit(0).cast("long")}), None
    for step in range(rounds + 1):
        if not k:
            break
        last, folder = folder, shared_dir(spark)
        now.mapInArrow(_assigner(centroids, scale, dims), schema).write.parquet(f"{folder}/assigned")
        now = spark.read.schema(schema).parquet(f"{folder}/assigned")
        if last:
            remove(spark, last)
        if step < rounds:
            sums = add_up(now.select("vector", "cluster").mapInArrow(_summer(scale, dims, k), SUM_SCHEMA))
            for c in range(k):
                place, n = c * (dims + 1), sums.get(c * (dims + 1) + dims, 0)
                if n:
                    centroids[c] = [sums.get(place + i, 0) // n for i in range(dims)]
    # a row for each of the k clusters
    inertia = {r.cluster: int(r.inertia) for r in now.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("inertia")).collect()} if k else {}
    total = min(sum(inertia.values()), LONG_MAX)
    shas = [hashlib.sha256(",".join(map(str, x)).encode()).hexdigest() for x in centroids]
    info = spark.createDataFrame([(c, min(n, LONG_MAX), total, shas[c]) for c, n in inertia.items()], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    out = now.select("id", "cluster", "distance").join(F.broadcast(info), "cluster")
    return Clustering(out.select(F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"), centroids)


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256."""
    return cluster(table(spark, sf_dir, "embeddings")).rows


def _op11_sql() -> str:
    """Every round as a step: all distances, the nearest by (distance, number), then floors of means."""
    steps = [
        f"kept AS MATERIALIZED (SELECT vec_id, [TRY_CAST(floor({SCALE} * CAST(c AS DOUBLE)) AS BIGINT) FOR c IN embedding] AS x FROM embeddings WHERE len(embedding) = {DIMS} AND len([c FOR c IN embedding IF c IS NOT NULL AND isfinite(c)]) = {DIMS})",
        f"c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('{SEED}:' || vec_id)) - 1 AS k, x AS c FROM kept ORDER BY sha256('{SEED}:' || vec_id) LIMIT {CLUSTERS})",
    ]
    for i in range(ROUNDS + 1):
        steps.append(f"a{i} AS MATERIALIZED (SELECT vec_id, any_value(x) AS x, min((d, k)) AS near FROM (SELECT vec_id, x, k, CAST(list_sum([(x[i] - c[i]) * (x[i] - c[i]) FOR i IN range(1, {DIMS + 1})]) AS BIGINT) AS d FROM kept, c{i}) GROUP BY vec_id)")
        if i < ROUNDS:
            steps.append(f"m{i + 1} AS (SELECT k, i, CAST(sum(v) AS BIGINT) AS s, count(*) AS n FROM (SELECT near[2] AS k, unnest(x) AS v, unnest(range(1, {DIMS + 1})) AS i FROM a{i}) GROUP BY k, i)")
            steps.append(f"c{i + 1} AS MATERIALIZED (SELECT k, coalesce(any_value(moved), any_value(c)) AS c FROM c{i} LEFT JOIN (SELECT k, list((s - ((s % n) + n) % n) // n ORDER BY i) AS moved FROM m{i + 1} GROUP BY k) USING (k) GROUP BY k)")
    end = f"SELECT vec_id, CAST(near[2] AS INTEGER) AS cluster, near[1] AS distance, CAST(sum(near[1]) OVER (PARTITION BY near[2]) AS BIGINT) AS cluster_inertia, CAST(sum(near[1]) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256 FROM a{ROUNDS} JOIN c{ROUNDS} ON near[2] = k"
    return "WITH " + ",\n".join(steps) + "\n" + end


OP11_SQL = _op11_sql()
