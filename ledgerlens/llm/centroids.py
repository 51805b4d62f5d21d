"""Centroid clustering with a LAESA pivot table.

The distances of every vector to a few fixed pivots are computed once and
stored beside it. In every round the centroids' distances to the same pivots
bound each vector's distance to each centroid from below:
``|d(v, p) - d(c, p)| <= d(v, c)``. Starting with the centroid of least bound,
a vector gets exact integer distances only to centroids whose bound does not
exceed the best exact distance so far. The pivots are the first centroids and
vectors of a bounded sample that lie far from the pivots before them; they
change the number of exact distances, not the result.

A round is one scan of the stored table: tasks add up their vectors by
cluster, Spark adds the tasks' sums, and the driver sees one sum per cluster
and component.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import Stages
from ledgerlens.llm.vectors import integer_vectors

#: pivots of the table, first centroids included
PIVOTS = 16
#: vectors from which further pivots are chosen (bounded sample; speed only)
PIVOT_SAMPLE = 512
#: components beyond this count as this: a squared distance of 64 components still fits a long
BOUND = 1 << 27
_LONG_MAX = (1 << 63) - 1


def _distances(x: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Euclidean distances (float) of all rows of ``x`` to all ``points``."""
    out = np.empty((len(x), len(points)))
    for j, p in enumerate(points):
        out[:, j] = np.sqrt(((x - p) ** 2).sum(axis=1).astype(np.float64))
    return out


def choose_pivots(first: np.ndarray, sample: np.ndarray, n: int) -> np.ndarray:
    """``first`` and then vectors of ``sample``, each the farthest from the
    pivots before it, up to ``n`` different ones."""
    pivots = list(np.unique(first, axis=0))
    if len(sample):
        nearest = _distances(sample, np.array(pivots)).min(axis=1)
        while len(pivots) < n and nearest.max() > 0:
            pivots.append(sample[int(nearest.argmax())])
            nearest = np.minimum(nearest, _distances(sample, pivots[-1][None, :])[:, 0])
    return np.array(pivots)


def assign(x: np.ndarray, table: np.ndarray, centroids: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """``(cluster, squared distance)`` of the vectors ``x`` with pivot
    distances ``table``, ties to the smaller cluster, and how many exact
    distances that took."""
    to_pivots = _distances(centroids, pivots)
    bound = np.zeros((len(x), len(centroids)))
    for p in range(len(pivots)):
        np.maximum(bound, np.abs(table[:, p, None] - to_pivots[None, :, p]), out=bound)
    bound *= 1 - 1e-9  # both distances are rounded: stay below the true bound
    order = np.argsort(bound, axis=1, kind="stable")
    rows = np.arange(len(x))
    cluster = order[:, 0].copy()
    best = ((x - centroids[cluster]) ** 2).sum(axis=1)
    exact = len(x)
    for r in range(1, len(centroids)):
        c = order[:, r]
        low = bound[rows, c]
        open_ = np.flatnonzero(low * low <= best * (1 + 1e-9) + 1e-6)
        if not len(open_):
            break  # bounds rise along the order and the best only falls
        exact += len(open_)
        d = ((x[open_] - centroids[c[open_]]) ** 2).sum(axis=1)
        better = (d < best[open_]) | ((d == best[open_]) & (c[open_] < cluster[open_]))
        at = open_[better]
        best[at], cluster[at] = d[better], c[at]
    return cluster, best, exact


def _decoded(batch: pa.RecordBatch, dims: int) -> tuple[np.ndarray, np.ndarray]:
    v = np.frombuffer(b"".join(batch.column("v").to_pylist()), dtype="<i4").reshape(-1, dims).astype(np.int64)
    table = np.frombuffer(b"".join(batch.column("table").to_pylist()), dtype="<f8").reshape(len(v), -1)
    return v, table


def _vectors_of(rows, dims: int) -> np.ndarray:
    return np.array([np.frombuffer(r.v, dtype="<i4") for r in rows], dtype=np.int64).reshape(-1, dims)


def cluster_vectors(vectors: DataFrame, stages: Stages, k: int = 8, rounds: int = 10, seed: str = "3:",
                    id_col: str = "vec_id", vec_col: str = "embedding", dims: int = 64, scale: float = 1024.0) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256``,
    a row per vector with ``dims`` components, none null or non-finite.

    Components are ``floor(scale * x)`` (beyond 2**27: held there). The ``k``
    first centroids are the vectors of smallest SHA-256 of ``seed`` and id, in
    that order; of a repeated id the vectors follow in byte order of their
    components, and rows with a null id come last. Fewer vectors make fewer
    centroids. Ties go to the smaller cluster; an empty cluster keeps its
    centroid. Equal rows are rows of their own. Sums of distances beyond a
    long count as its largest value. An empty table gives no rows. Ids must be
    integers.
    """
    schema = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    kept = stages.write(integer_vectors(vectors, id_col, vec_col, scale, BOUND, components=dims), "vectors")
    ranked = kept.withColumn("h", F.sha2(F.concat(F.lit(seed), F.col("vec_id").cast("string")).cast("binary"), 256))
    sample = _vectors_of(ranked.orderBy(F.asc_nulls_last("h"), "v").limit(max(k, PIVOT_SAMPLE)).collect(), dims)
    if not len(sample):
        return vectors.sparkSession.createDataFrame([], schema)
    centroids = sample[:k]
    pivots = choose_pivots(centroids, sample, PIVOTS)

    def with_table(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.frombuffer(b"".join(b.column("v").to_pylist()), dtype="<i4").reshape(-1, dims).astype(np.int64)
            table = [row.tobytes() for row in _distances(x, pivots)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(table, pa.binary())], ["vec_id", "v", "table"])

    stored = stages.write(kept.mapInArrow(with_table, "vec_id long, v binary, table binary"), "pivot-table")
    stages.drop(kept)
    for _ in range(rounds):
        centroids = _next_centroids(stored, centroids, pivots)

    def last(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, table = _decoded(b, dims)
            cluster, distance, _ = assign(x, table, centroids, pivots)
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), pa.array(cluster, pa.int32()), pa.array(distance, pa.int64())],
                                             ["vec_id", "cluster", "distance"])

    placed = stages.write(stored.mapInArrow(last, "vec_id long, cluster int, distance long"), "placed")
    stages.drop(stored)
    sums = dict(placed.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)"))).collect())  # one row a cluster
    total = sum(sums.values(), Decimal(0))
    per_cluster = vectors.sparkSession.createDataFrame(
        [(c, min(int(s), _LONG_MAX), min(int(total), _LONG_MAX),
          hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest()) for c, s in sums.items()],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return (placed.join(F.broadcast(per_cluster), "cluster")  # k rows
            .select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"))


def _next_centroids(stored: DataFrame, centroids: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Componentwise floor of the mean of every cluster's vectors."""
    k, dims = centroids.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros((k, dims), dtype=np.int64), np.zeros(k, dtype=np.int64)
        for b in batches:
            x, table = _decoded(b, dims)
            cluster, _, _ = assign(x, table, centroids, pivots)
            np.add.at(total, cluster, x)
            count += np.bincount(cluster, minlength=k)
        at = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at, pa.int32()), pa.array(count[at], pa.int64()), pa.array(total[at].tolist(), pa.list_(pa.int64()))],
            ["cluster", "n", "sums"])

    exact = lambda c: F.sum(F.col(c).cast("decimal(38,0)"))
    parts = stored.select("v", "table").mapInArrow(sums, "cluster int, n long, sums array<long>")
    rows = (parts.select("cluster", "n", F.posexplode("sums").alias("dim", "part"))
            .groupBy("cluster", "dim").agg(exact("n").alias("n"), exact("part").alias("total")).collect())  # k * dims rows
    out = centroids.copy()
    for r in rows:
        out[r.cluster, r.dim] = int(r.total) // int(r.n)
    return out
