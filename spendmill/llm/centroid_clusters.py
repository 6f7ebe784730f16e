"""K-means over whole-number vectors, with Ptolemaic lower bounds in place of most exact distances.

Pivots are fixed for the whole run (the starting centroids) and every vector's exact squared distances to them are
stored beside it once. Ptolemy's inequality over a pair of pivots p, q bounds the distance of a vector x to a centroid c
from below by |d(x,p) d(c,q) - d(x,q) d(c,p)| / d(p,q). In each round a vector is measured exactly against the centroid
of its least bound; any other centroid whose bound lies above that distance cannot be nearer, and the survivors are
measured exactly. Bounds are rounded down by more than the arithmetic can be off, so a tie is never cut away.

A round is one scan: tasks return sums for each cluster, Spark adds them, and the driver sees clusters x components
numbers. Nothing is keyed by cluster, so a cluster that holds most vectors costs no more than another.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import stored
from .vectors import list_matrix, squared_distances, whole_vectors

CLUSTERS, ROUNDS, WIDTH, SCALE, SEED = 8, 10, 64, 1024, 3
#: Relative slack of a bound's difference and of its square; sums of a few roundings of 2**-53 stay far below.
SLACK, SHRINK = 2.0**-50, 1 - 2.0**-47
RESULT = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"


@dataclass(frozen=True)
class Pivots:
    """Fixed points; neighbours in their ring are the pairs of the inequality. Pairs of equal points say nothing and go."""

    points: np.ndarray

    def pairs(self) -> list[tuple[int, int, float]]:
        n = len(self.points)
        apart = np.sqrt(squared_distances(self.points, self.points).astype(np.float64))
        ring = {tuple(sorted((i, (i + step) % n))) for i in range(n) for step in (1, 2)}
        return [(i, j, apart[i, j]) for i, j in sorted(ring) if i != j and apart[i, j] > 0]

    def lower_bounds(self, cached: np.ndarray, centroids: np.ndarray) -> np.ndarray:
        """Squared distances that no vector (row) can fall below for a centroid (column). ``cached``: squared, to the pivots."""
        to_vector = np.sqrt(cached.astype(np.float64))
        to_centroid = np.sqrt(squared_distances(centroids, self.points).astype(np.float64))
        best = np.zeros((len(cached), len(centroids)))
        for i, j, apart in self.pairs():
            one, other = np.outer(to_vector[:, i], to_centroid[:, j]), np.outer(to_vector[:, j], to_centroid[:, i])
            gap = (np.abs(one - other) - SLACK * (one + other)) / apart
            np.maximum(best, gap, out=best)
        return best * best * SHRINK


def nearest(vectors: np.ndarray, cached: np.ndarray, pivots: Pivots, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(number of the nearest centroid, squared distance to it, exact distances taken); ties go to the smaller number."""
    lower = pivots.lower_bounds(cached, centroids)
    first = lower.argmin(axis=1)
    best, owner, taken = ((vectors - centroids[first]) ** 2).sum(axis=1), first.copy(), len(vectors)
    for number, centroid in enumerate(centroids):
        rows = np.flatnonzero((lower[:, number] <= best) & (first != number))
        far = ((vectors[rows] - centroid) ** 2).sum(axis=1)
        won = (far < best[rows]) | ((far == best[rows]) & (number < owner[rows]))
        best[rows[won]], owner[rows[won]], taken = far[won], number, taken + len(rows)
    return owner, best, taken


def _whole(embeddings: DataFrame, width: int, scale: int) -> DataFrame:
    """(vec_id, vector) of the vectors that count."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, matrix = whole_vectors(batch.column(1), scale, width)
            vectors = pa.ListArray.from_arrays(np.arange(len(rows) + 1, dtype=np.int32) * width, matrix.astype(np.int32).reshape(-1))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows)), vectors], names=["vec_id", "vector"])

    return embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").mapInArrow(run, "vec_id long, vector array<int>")


def _starts(vectors: DataFrame, clusters: int, seed: int) -> np.ndarray:
    """The first centroids: by hash of the id, null ids after all others, equal ids by components."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = vectors.select("vector", order.alias("order")).orderBy(F.col("order").asc_nulls_last(), "vector").limit(clusters).collect()
    return np.array([r["vector"] for r in rows], dtype=np.int64)


def _with_pivot_distances(vectors: DataFrame, pivots: Pivots, width: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            far = squared_distances(list_matrix(batch.column(1), width), pivots.points)
            lists = pa.ListArray.from_arrays(np.arange(len(far) + 1, dtype=np.int32) * far.shape[1], far.reshape(-1))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=["vec_id", "vector", "to_pivots"])

    return vectors.mapInArrow(run, "vec_id long, vector array<int>, to_pivots array<long>")


def _sums(vectors: DataFrame, pivots: Pivots, centroids: np.ndarray) -> dict[int, tuple[int, list[int]]]:
    """Of each cluster that has vectors their number and the sums of their components; a task returns its own sums once."""
    clusters, width = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros(clusters, np.int64), np.zeros((clusters, width), np.int64)
        for batch in batches:
            matrix = list_matrix(batch.column(0), width)
            owner, _, _ = nearest(matrix, list_matrix(batch.column(1), len(pivots.points)), pivots, centroids)
            counts += np.bincount(owner, minlength=clusters)
            for number in np.unique(owner):
                sums[number] += matrix[owner == number].sum(axis=0)
        full = np.flatnonzero(counts)
        at = np.arange(width + 1)  # position 0 is the count
        values = np.concatenate([counts[full, None], sums[full]], axis=1)
        columns = [np.repeat(full, width + 1).astype(np.int32), np.tile(at, len(full)).astype(np.int32), values.reshape(-1)]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["cluster", "at", "value"])

    parts = vectors.select("vector", "to_pivots").mapInArrow(run, "cluster int, at int, value long")
    totals = parts.groupBy("cluster", "at").agg(F.sum(F.col("value").cast("decimal(20,0)")).alias("value")).collect()
    found = {(r["cluster"], r["at"]): int(r["value"]) for r in totals}
    return {c: (n, [found[c, i + 1] for i in range(width)]) for (c, at_), n in found.items() if at_ == 0}


def _assigned(vectors: DataFrame, pivots: Pivots, centroids: np.ndarray) -> DataFrame:
    width = centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cached = list_matrix(batch.column(2), len(pivots.points))
            owner, best, _ = nearest(list_matrix(batch.column(1), width), cached, pivots, centroids)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(owner.astype(np.int32)), pa.array(best)], names=["vec_id", "cluster", "distance"])

    return vectors.mapInArrow(run, "vec_id long, cluster int, distance long")


def cluster_vectors(
    embeddings: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, *, width: int = WIDTH, scale: int = SCALE, seed: int = SEED
) -> tuple[DataFrame, np.ndarray]:
    """(one row per vector that counts: vec_id, cluster, squared distance; the final centroids, clusters x ``width``).

    A vector counts if it has ``width`` components, none null or non-finite; others have no row. Components are
    floor(scale * x); one beyond 2**27 is an error. Equal distances go to the smaller centroid; a cluster without
    vectors keeps its centroid. Fewer vectors than clusters give as many centroids as vectors, an empty table gives no
    row and no centroid. Null and repeated ids and repeated rows are vectors like others; at the start null ids come
    last, and equal ids go by their components. Reads vec_id and embedding only.
    """
    vectors = _whole(embeddings, width, scale)
    centroids = _starts(vectors, clusters, seed)
    if not len(centroids):
        return vectors.sparkSession.createDataFrame([], "vec_id long, cluster int, distance long"), np.zeros((0, width), np.int64)
    pivots = Pivots(centroids)
    kept = stored(_with_pivot_distances(vectors, pivots, width), "vectors")
    for _ in range(rounds):
        found = _sums(kept, pivots, centroids)
        centroids = np.array([[s // found[c][0] for s in found[c][1]] if c in found else list(old) for c, old in enumerate(centroids)], dtype=np.int64)
    return stored(_assigned(kept, pivots, centroids), "clusters"), centroids


def clustered(embeddings: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, **options) -> DataFrame:
    """The rows of ``cluster_vectors`` with the inertia of the cluster and of all, and the centroid's SHA-256."""
    rows, centroids = cluster_vectors(embeddings, clusters, rounds, **options)
    if not len(centroids):
        return rows.sparkSession.createDataFrame([], RESULT)
    inertia = {r["cluster"]: r["inertia"] for r in rows.groupBy("cluster").agg(F.sum("distance").alias("inertia")).collect()}
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]

    def of_cluster(values: list) -> Column:
        return F.element_at(F.array(*map(F.lit, values)), F.col("cluster") + 1)

    return rows.select(
        "vec_id",
        "cluster",
        "distance",
        of_cluster([inertia.get(c, 0) for c in range(len(centroids))]).cast("long").alias("cluster_inertia"),
        F.lit(sum(inertia.values())).cast("long").alias("inertia"),
        of_cluster(digests).alias("centroid_sha256"),
    )
