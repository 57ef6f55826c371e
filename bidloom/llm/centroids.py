"""Clustering around integer centroids; each vector finds its centroid by an equal-average equal-variance search."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import materialise

#: Components have to stay below this size, so that all distances fit 64 bits (for up to 64 components).
WIDEST = 1 << 27


class Search:
    """Centroids sorted by the sum of their components (d times their mean).

    With S the sum of components and R the length of the part orthogonal to (1, ..., 1), times sqrt(d), the inequality
    d * |x - c|^2 >= (Sx - Sc)^2 + (Rx - Rc)^2 rejects centroids. A scan goes outward from Sx, always to the side whose sum is nearer, and
    ends when the sums alone reject, as all centroids further out have sums at least as far. What is left gets its exact distance in
    integers. Float bounds are lowered by more than their rounding error, so that none rejects a centroid as near as the best.
    """

    def __init__(self, centroids: np.ndarray):
        centroids = np.asarray(centroids, np.int64)
        self.order = np.lexsort((np.arange(len(centroids)), centroids.sum(1)))
        self.vectors = centroids[self.order]
        self.sums = self.vectors.sum(1)
        self.rests = self._rests(self.vectors, self.sums)

    @staticmethod
    def _rests(vectors: np.ndarray, sums: np.ndarray) -> np.ndarray:
        d = max(1, vectors.shape[1])
        middle = vectors - (sums / d)[:, None]
        return np.sqrt(d * np.einsum("ij,ij->i", middle, middle))

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Number of the nearest centroid (ties: the smallest number) and squared distance of each row; distances computed in all."""
        n, d = x.shape
        count = len(self.order)
        sums, rests = x.sum(1), self._rests(x, x.sum(1))
        best, at = np.full(n, np.iinfo(np.int64).max), np.full(n, count, np.int64)
        high = np.searchsorted(self.sums, sums)
        low = high - 1
        active, computed = np.arange(n), 0
        while len(active):
            s, lo, hi = sums[active], low[active], high[active]
            far = np.iinfo(np.int64).max
            below = np.where(lo >= 0, s - self.sums[np.maximum(lo, 0)], far)
            above = np.where(hi < count, self.sums[np.minimum(hi, count - 1)] - s, far)
            down = below <= above
            gap = np.where(down, below, above)
            limit = best[active].astype(np.float64) * d
            mean_bound = (gap.astype(np.float64) ** 2) * (1 - 1e-12)
            go = (gap != far) & (mean_bound <= limit)  # else neither this centroid nor any further out
            active, down, mean_bound, limit = active[go], down[go], mean_bound[go], limit[go]
            c = np.where(down, low[active], high[active])
            low[active] -= down
            high[active] += ~down
            slack = 1e-9 * (rests[active] + self.rests[c] + np.abs(sums[active]) + np.abs(self.sums[c]))
            rest = np.maximum(np.abs(rests[active] - self.rests[c]) - slack, 0)
            close = mean_bound + rest * rest * (1 - 1e-12) <= limit
            row, c = active[close], c[close]
            difference = x[row] - self.vectors[c]
            distance = np.einsum("ij,ij->i", difference, difference)
            computed += len(row)
            number = self.order[c]
            better = (distance < best[row]) | ((distance == best[row]) & (number < at[row]))
            best[row[better]], at[row[better]] = distance[better], number[better]
        return at, best, computed


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False).reshape(-1, dims)


def _summer(centroids: np.ndarray):
    """A row for each centroid that has vectors in the task: how many, and the sum of each component."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search, (k, dims) = Search(centroids), centroids.shape
        n, sums = np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
        for batch in batches:
            x = _matrix(batch.column("v"), dims)
            at, _, _ = search.nearest(x)
            n += np.bincount(at, minlength=k)
            np.add.at(sums, at, x)
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_pydict({
            "cluster": pa.array(some.astype(np.int32)), "n": pa.array(n[some]),
            "sums": pa.array(list(sums[some]), pa.list_(pa.int64()))})
    return add


def _assigner(centroids: np.ndarray):
    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(centroids)
        for batch in batches:
            at, distance, _ = search.nearest(_matrix(batch.column("v"), centroids.shape[1]))
            yield pa.RecordBatch.from_pydict({
                "vec_id": batch.column("vec_id"), "cluster": pa.array(at.astype(np.int32)), "distance": pa.array(distance)})
    return assign


def integer_vectors(embeddings: DataFrame, dims: int, scale: int) -> DataFrame:
    """vec_id, v: floor(scale * x) of the vectors with `dims` components, none null or non-finite."""
    x = F.transform("embedding", lambda e: e.cast("double"))
    sound = (F.size("embedding") == dims) & F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(math.inf)))
    whole = lambda e: F.floor(e * scale)
    held = lambda e: F.when(F.abs(e * scale) < WIDEST, whole(e)).otherwise(
        F.raise_error(F.lit(f"a component times {scale} does not lie within {WIDEST}, so distances may not fit 64 bits")).cast("long"))
    return embeddings.filter(F.col("embedding").isNotNull() & sound).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.transform(x, held).alias("v"))


def first_centroids(vectors: DataFrame, k: int, seed: int) -> np.ndarray:
    """The k vectors with the smallest sha256 of `seed:vec_id`, in that order; vectors without an id are no candidates, and equal ids
    go by their components."""
    named = vectors.filter(F.col("vec_id").isNotNull())
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = named.select(digest.alias("h"), "v").orderBy("h", "v").limit(k).collect()
    return np.array([r["v"] for r in rows], np.int64)


def refined(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """One round: every centroid that has vectors moves to the floor of their mean, exactly."""
    parts = vectors.select("v").mapInArrow(_summer(centroids), "cluster int, n long, sums array<long>")
    sums = (
        parts.select("cluster", "n", F.posexplode("sums").alias("pos", "s"))
        .groupBy("cluster", "pos").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).collect())  # k * dims rows
    moved = centroids.copy()
    for r in sums:
        moved[r["cluster"], r["pos"]] = r["s"] // r["n"]
    return moved


def clusters(embeddings: DataFrame, k: int = 16, rounds: int = 3, dims: int = 64, scale: int = 64, seed: int = 1) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid: a row for each vector of `embeddings(vec_id, embedding)` that has
    exactly `dims` components, none of them null or non-finite; components count as floor(scale * x).

    `rounds` times every vector goes to its nearest centroid (ties: the smaller number) and every centroid that has vectors moves to the
    floor of their mean; then vectors are assigned once more. The centroid is returned as its list of components.

    Vectors left out have no row. Vectors without an id take part but start no centroid; equal ids are vectors of their own. Fewer than k
    vectors: as many centroids. No vector with an id: no rows. An empty table gives an empty result; other columns are ignored. Components
    that are too large for distances of 64 bits end the job with an error.

    Each round is one narrow pass over the integer vectors, written once; a task hands on one row a centroid, and the driver holds
    k * dims numbers.
    """
    spark = embeddings.sparkSession
    vectors = materialise(integer_vectors(embeddings, dims, scale), "integer-vectors")
    centroids = first_centroids(vectors, k, seed)
    if not len(centroids):
        return spark.createDataFrame(
            [], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid array<long>")
    for _ in range(rounds):
        centroids = refined(vectors, centroids)
    found = materialise(vectors.mapInArrow(_assigner(centroids), "vec_id long, cluster int, distance long"), "assigned")
    per = {r["cluster"]: r["s"] for r in found.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    totals = spark.createDataFrame(
        [(c, s, sum(per.values()), centroids[c].tolist()) for c, s in sorted(per.items())],
        "cluster int, cluster_inertia long, inertia long, centroid array<long>")  # at most k rows
    return found.join(F.broadcast(totals), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid")
