"""Centroid clustering in exact integers, with a LAESA table of pivot distances.

The distances of all vectors to a few fixed pivots are computed once and stored beside them. In every round the
pivots' distances to the centroids are compared with those stored: by the triangle inequality their difference
bounds each centroid's distance from below. The centroid with the least bound gets its exact distance first; of the
others, only those whose bound doesn't exceed it do.

Vectors are read where they lie: a round is one pass over the stored table that returns one row of sums for each
centroid and task, so nothing is shuffled by vector, and a vector that makes up a third of the rows costs no more
than any other. The driver holds the centroids, k x dims integers.

Null vectors, those of another length, and those with null, NaN or infinite components are left out. Equal
distances go to the smaller cluster number. Repeated rows count, and appear, as often as they occur; null ids are
clustered like any other but never chosen as a start unless there are fewer than k others. With fewer than k vectors
each is a centroid. An empty table gives an empty result. Columns other than the two named are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from batchloom.llm.vectors import is_whole, matrix, to_integers
from batchloom.storage import inline_rows, materialise

CHUNK_ROWS = 8_192
#: What rounding may do to a difference of two square roots, relative to their sum.
SLACK = 1e-9


def squared(rows: np.ndarray, point: np.ndarray) -> np.ndarray:
    difference = rows - point
    return np.einsum("ij,ij->i", difference, difference)


def spread_pivots(points: np.ndarray, pivots: int) -> np.ndarray:
    """Points with the greatest sum of distances to those chosen before; the first has the greatest to all."""
    roots = np.sqrt(np.array([squared(points, p) for p in points], float).reshape(len(points), len(points)))
    chosen = [int(roots.sum(0).argmax())] if len(points) else []
    while len(chosen) < min(pivots, len(points)):
        total = roots[chosen].sum(0)
        total[chosen] = -1.0
        chosen.append(int(total.argmax()))
    return points[chosen]


def pivot_distances(rows: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.stack([squared(rows, p) for p in pivots], axis=1).astype(float))


def nearest(rows: np.ndarray, table: np.ndarray, centroids: np.ndarray, to_pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest centroid and squared distance of each row, and how many distances were computed."""
    bound = np.zeros((len(rows), len(centroids)))
    for p in range(table.shape[1]):
        stored, other = table[:, p, None], to_pivots[None, :, p]
        np.maximum(bound, np.abs(stored - other) - SLACK * (stored + other), out=bound)
    cluster = bound.argmin(1)
    difference = rows - centroids[cluster]
    distance = np.einsum("ij,ij->i", difference, difference)
    computed = len(rows)
    bound *= bound
    bound *= 1 - SLACK
    first = cluster.copy()
    for c, centroid in enumerate(centroids):
        left = np.flatnonzero((bound[:, c] <= distance) & (first != c))
        computed += len(left)
        exact = squared(rows[left], centroid)
        better = (exact < distance[left]) | ((exact == distance[left]) & (c < cluster[left]))
        cluster[left[better]], distance[left[better]] = c, exact[better]
    return cluster, distance, computed


class Assigner:
    """Assigns stored vectors to centroids, a chunk of rows at a time."""

    def __init__(self, centroids: np.ndarray, pivots: np.ndarray):
        self.centroids, self.dims, self.pivots = centroids, centroids.shape[1], len(pivots)
        self.to_pivots = pivot_distances(centroids, pivots)

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK_ROWS):
                part = batch.slice(at, CHUNK_ROWS)
                rows = matrix(part.column("vector"), self.dims).astype(np.int64)
                table = matrix(part.column("to_pivots"), self.pivots)
                cluster, distance, _ = nearest(rows, table, self.centroids, self.to_pivots)
                yield part, rows, cluster, distance


def stored_table(kept: DataFrame, pivots: np.ndarray, dims: int) -> DataFrame:
    """``kept`` (id, vector) with each vector's distances to the pivots, written once."""

    def with_table(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK_ROWS):
                part = batch.slice(at, CHUNK_ROWS)
                table = pivot_distances(matrix(part.column("vector"), dims).astype(np.int64), pivots)
                ends = np.arange(0, table.size + 1, len(pivots), dtype=np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(table.ravel()))
                yield pa.RecordBatch.from_arrays([*part.columns, lists], names=["id", "vector", "to_pivots"])

    schema = f"id {kept.schema['id'].dataType.simpleString()}, vector array<int>, to_pivots array<double>"
    return materialise(kept.mapInArrow(with_table, schema), "pivots")


def moved(stored: DataFrame, assign: Assigner) -> np.ndarray:
    """The centroids after one round: exact floored means; a centroid without vectors stays."""
    k, dims = assign.centroids.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, counts = np.zeros((k, dims), np.int64), np.zeros(k, np.int64)
        for _, rows, cluster, _ in assign(batches):
            np.add.at(counts, cluster, 1)
            order = np.argsort(cluster, kind="stable")
            met, starts = np.unique(cluster[order], return_index=True)
            totals[met] += np.add.reduceat(rows[order], starts, axis=0)
        met = np.flatnonzero(counts)
        lists = pa.array(list(totals[met]), pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(counts[met]), lists], names=["cluster", "n", "totals"])

    parts = stored.select("vector", "to_pivots").mapInArrow(sums, "cluster long, n long, totals array<long>")
    totals = [F.sum(F.col("totals")[i]).alias(f"t{i}") for i in range(dims)]
    after = assign.centroids.copy()
    for cluster, n, *total in parts.groupBy("cluster").agg(F.sum("n").alias("n"), *totals).collect():
        after[cluster] = [t // n for t in total]
    return after


def cluster_vectors(
    vectors: DataFrame,
    k: int = 40,
    rounds: int = 5,
    pivots: int = 8,
    dims: int = 64,
    scale: int = 256,
    seed: int = 2,
    vec_id: str = "vec_id",
    vector: str = "embedding",
) -> tuple[DataFrame, DataFrame]:
    """Each kept vector's id, ``cluster`` and squared ``distance``; and the centroids (cluster, centroid array<long>).

    The start is the k vectors with the least sha256 of ``<seed>:<id>``; of equal hashes the lesser vector.
    """
    kept = vectors.select(F.col(vec_id).alias("id"), F.col(vector).alias("vector")).where(is_whole(F.col("vector"), dims))
    kept = kept.select("id", to_integers(F.col("vector"), scale).alias("vector"))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")).cast("binary"), 256)
    starts = kept.orderBy(digest.asc_nulls_last(), "vector").limit(k).collect()
    centroids = np.array([r.vector for r in starts], np.int64).reshape(len(starts), dims)
    schema = f"id {kept.schema['id'].dataType.simpleString()}, cluster int, distance long"
    found = inline_rows(vectors.sparkSession, [], schema)
    if starts:
        fixed = spread_pivots(centroids, pivots)
        stored = stored_table(kept, fixed, dims)
        for _ in range(rounds):
            centroids = moved(stored, Assigner(centroids, fixed))
        assign = Assigner(centroids, fixed)

        def assigned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part, _, cluster, distance in assign(batches):
                columns = [part.column("id"), pa.array(cluster.astype(np.int32)), pa.array(distance)]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "cluster", "distance"])

        found = stored.mapInArrow(assigned, schema)
    rows = list(enumerate(centroids.tolist()))
    return found.withColumnRenamed("id", vec_id), inline_rows(vectors.sparkSession, rows, "cluster int, centroid array<long>")


def with_inertia(assigned: DataFrame, centroids: DataFrame) -> DataFrame:
    """``assigned`` with ``cluster_inertia``, ``inertia`` (distances summed over the cluster, over all) and ``centroid_sha256``.

    The driver holds one row for each centroid.
    """
    assigned = materialise(assigned, "assigned")
    sums = dict(assigned.groupBy("cluster").agg(F.sum("distance")).collect())
    digests = {c: hashlib.sha256(",".join(map(str, v)).encode()).hexdigest() for c, v in centroids.collect()}
    rows = [(c, sums[c], sum(sums.values()), digests[c]) for c in sums]
    schema = "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    return assigned.join(inline_rows(assigned.sparkSession, rows, schema), "cluster")
