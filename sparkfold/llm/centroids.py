"""Centroid clustering by the threshold algorithm.

Vectors are turned into integers, so that distances and means are exact and do not depend on the
order in which rows are added. To find a vector's nearest centroid the centroids are sorted once
per dimension; every list is walked outward from the vector's own value, and each centroid that
turns up gets its exact distance. A centroid not seen yet is at least as far in every dimension as
the list has been walked, so the walk ends once the sum of the squared frontier distances is
strictly above the best distance: up to then a centroid of a smaller number could still tie.
Centroids (k times the dimensions, a parameter) are held by the driver; rows never are.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkfold.llm.common import kept_table

#: Rows walked at a time.
BLOCK = 1024
#: Stands at both ends of a list, beyond every component.
FAR = np.int64(2**40)


def largest(dims: int) -> int:
    """Components below this size keep a squared distance within 64 bits."""
    return math.isqrt(2**62 // dims) // 2


def integer_vectors(df: DataFrame, id_col: str, vector: str, dims: int, scale: int) -> DataFrame:
    """(id, v): floor(scale * x) of the rows whose vector has dims components, all finite numbers."""
    x = F.col(vector)
    sound = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    rows = df.select(F.col(id_col).alias("id"), x.alias("x")).where(
        x.isNotNull() & (F.size(x) == dims) & sound
    )
    limit = largest(dims)
    huge = F.raise_error(F.lit(f"scaled vector components must stay below {limit} in size.")).cast("long")
    scaled = F.transform("x", lambda e: F.lit(float(scale)) * e.cast("double"))
    return rows.select(
        "id", F.transform(scaled, lambda e: F.when(F.abs(e) < limit, F.floor(e)).otherwise(huge)).alias("v")
    )


def sorted_lists(centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per dimension the centroids' values in ascending order, and whose they are."""
    order = np.argsort(centroids, axis=0, kind="stable")
    return np.take_along_axis(centroids, order, axis=0), order


def nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid of each row (ties: the smaller) and its squared distance."""
    k, dims = centroids.shape
    values, owners = sorted_lists(centroids)
    # a wall at both ends of each list
    walled = np.vstack([np.full((1, dims), -FAR), values, np.full((1, dims), FAR)])
    d = np.arange(dims)
    right = np.stack([np.searchsorted(values[:, j], x[:, j]) for j in d], axis=1) + 1
    left = right - 1
    best = np.full(len(x), np.iinfo(np.int64).max)
    found = np.full(len(x), k)
    seen = np.zeros((len(x), k), dtype=bool)
    walking = np.arange(len(x))
    while len(walking):
        l, r, own = left[walking], right[walking], x[walking]
        below, above = own - walled[l, d], walled[r, d] - own
        down = below <= above
        gap = np.minimum(below, above)
        owner = owners[np.where(down, l, r) - 1, d]
        left[walking], right[walking] = l - down, r + ~down
        new = np.zeros((len(walking), k), dtype=bool)
        np.put_along_axis(new, owner, True, axis=1)
        new &= ~seen[walking]
        seen[walking] |= new
        row, c = np.nonzero(new)
        distance = np.full((len(walking), k), np.iinfo(np.int64).max)
        distance[row, c] = ((own[row] - centroids[c]) ** 2).sum(axis=1)
        at = distance.argmin(axis=1)
        near = distance[np.arange(len(walking)), at]
        better = (near < best[walking]) | ((near == best[walking]) & (at < found[walking]))
        best[walking[better]], found[walking[better]] = near[better], at[better]
        frontier = (gap * gap).sum(axis=1)
        walking = walking[(frontier <= best[walking]) & ~seen[walking].all(axis=1)]
    return found, best


def _matrix(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    return batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def _sums(vectors: DataFrame, centroids: np.ndarray) -> dict[int, tuple[int, list[int]]]:
    """Row count and componentwise sum per cluster that has rows; tasks add up before the shuffle."""
    k, dims = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, dims + 1), dtype=np.int64)
        for batch in batches:
            x = _matrix(batch, dims)
            for start in range(0, len(x), BLOCK):
                part = x[start : start + BLOCK]
                cluster, _ = nearest(part, centroids)
                for c in np.unique(cluster):
                    own = part[cluster == c]
                    total[c] += np.append(own.sum(axis=0), len(own))
        c, j = np.nonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[c, j])], ["c", "j", "s"]
        )

    parts = vectors.select("v").mapInArrow(run, "c int, j int, s long")
    # wider than a long: a task's sums fit, those of all rows need not
    rows = parts.groupBy("c", "j").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()
    sums: dict[int, list[int]] = {}
    for c, j, s in rows:
        sums.setdefault(c, [0] * (dims + 1))[j] = int(s)
    return {c: (s[dims], s[:dims]) for c, s in sums.items()}


def first_centroids(vectors: DataFrame, rank: Column, k: int) -> np.ndarray:
    """The k vectors least by rank, then by their components; rows without a rank come last."""
    rows = vectors.select(rank.isNull().alias("none"), rank.alias("rank"), "v")
    least = rows.orderBy("none", "rank", "v").limit(k).collect()
    return np.array([r.v for r in least], dtype=np.int64)


def train(vectors: DataFrame, centroids: np.ndarray, rounds: int) -> np.ndarray:
    """Centroids after so many rounds; a cluster without rows keeps its centroid."""
    for _ in range(rounds):
        centroids = centroids.copy()
        for c, (n, total) in _sums(vectors, centroids).items():
            centroids[c] = [s // n for s in total]
    return centroids


def assigned(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(id, cluster, distance) of every vector (id, v)."""
    dims = centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch, dims)
            for start in range(0, len(x), BLOCK):
                cluster, distance = nearest(x[start : start + BLOCK], centroids)
                ids = batch.column("id").slice(start, BLOCK)
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(cluster.astype(np.int32)), pa.array(distance)], ["id", "cluster", "distance"]
                )

    kind = vectors.schema["id"].dataType.simpleString()
    return vectors.mapInArrow(run, f"id {kind}, cluster int, distance long")


def cluster(
    df: DataFrame, id_col: str, vector: str, *, dims: int, k: int, rounds: int, scale: int = 64, seed: int = 1
) -> tuple[DataFrame, np.ndarray]:
    """Clusters (id, cluster, distance) of the sound vectors of df, and the k centroids.

    Rows whose vector is NULL, has another length than dims, or holds a NULL, NaN or infinity are
    left out; scaled components beyond ``largest(dims)`` (2 ** 27 for 64) are an error. The first centroids are the vectors of
    the k rows whose '<seed>:<id>' has the least SHA-256; rows without an id come last there and
    are clustered like all others, and rows of one id are ordered by their components. Equal
    distances go to the smaller number. Repeated rows count as often as they occur. With fewer than
    k vectors there are fewer centroids; without any the result is empty. Other columns are ignored.
    """
    vectors = integer_vectors(df, id_col, vector, dims, scale)
    rank = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")).cast("binary"), 256)
    start = first_centroids(vectors, rank, k)
    if not len(start):
        kind = vectors.schema["id"].dataType.simpleString()
        return df.sparkSession.createDataFrame([], f"id {kind}, cluster int, distance long"), start
    centroids = train(vectors, start, rounds)
    return kept_table(assigned(vectors, centroids), "clusters"), centroids


def with_inertia(clusters: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Add cluster_inertia and inertia (summed distances) and the centroid's SHA-256 to clusters."""
    sums = dict(clusters.groupBy("cluster").agg(F.sum("distance")).collect())
    whole = sum(sums.values())
    rows = [
        (c, sums[c], whole, sha256(",".join(map(str, v)).encode()).hexdigest())
        for c, v in enumerate(centroids.tolist()) if c in sums
    ]
    named = clusters.sparkSession.createDataFrame(
        rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    )
    return clusters.join(F.broadcast(named), "cluster")  # one row per centroid
