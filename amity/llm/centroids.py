"""Clusters of integer vectors around centroids, each vector's centroid found by Orchard's search.

For every centroid there is a list of the others by their distance from it. A vector starts at one
centroid and walks along its list. Where it meets a closer one, it jumps to that one's list. What
was measured once is marked and not measured again. The walk stops where the next in the list is
strictly farther than twice the vector's distance from the list's own centroid: by the triangle
inequality this one and all behind it are farther from the vector than the centroid it has. Strictly,
because at just twice the distance a centroid can be as near, and of equals the smallest number counts.

All arithmetic is on whole numbers: squared distances fit 64 bits by a bound on the components, and
means are exact quotients rounded down. A round reads the vectors once; each task sends the sums of
its clusters, ``k`` by dimension numbers, which are also all that comes to the driver. So neither a
cluster that holds a third of all vectors nor the table's size weighs on one task.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Vectors that walk in step.
BLOCK = 4096


class Orchard:
    """The lists of ``k`` centroids, of which no squared distance exceeds 2^63 - 1."""

    def __init__(self, centroids: np.ndarray) -> None:
        self.centroids = centroids
        gaps = np.array([((centroids - c) ** 2).sum(axis=1) for c in centroids]).reshape(len(centroids), -1)
        near = np.argsort(gaps, axis=1, kind="stable")
        # A centroid's own entry goes, wherever equal centroids put it.
        self.lists = np.array([row[row != i] for i, row in enumerate(near)], np.int64).reshape(len(centroids), -1)
        # gap > 4 * distance, without the product: a quarter of the gap, rounded up, exceeds the distance.
        self.reach = (np.take_along_axis(gaps, self.lists, axis=1) + 3) // 4

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The number of each vector's centroid, and the squared distance."""
        m, k = len(vectors), len(self.centroids)
        at = np.zeros(m, np.int64)  # whose list the vector walks along
        place = np.zeros(m, np.int64)
        distance = ((vectors - self.centroids[0]) ** 2).sum(axis=1)
        best = at.copy()
        marked = np.zeros((m, k), bool)
        marked[:, 0] = True
        walking = np.arange(m)
        while True:
            walking = walking[place[walking] < k - 1]
            walking = walking[self.reach[at[walking], place[walking]] <= distance[walking]]
            if not len(walking):
                return best, distance
            other = self.lists[at[walking], place[walking]]
            place[walking] += 1
            new = ~marked[walking, other]
            who, other = walking[new], other[new]
            marked[who, other] = True
            d = ((vectors[who] - self.centroids[other]) ** 2).sum(axis=1)
            equal = (d == distance[who]) & (other < best[who])
            best[who[equal]] = other[equal]
            closer = d < distance[who]
            who, other = who[closer], other[closer]
            distance[who] = d[closer]
            best[who], at[who], place[who] = other, other, 0


def greatest_component(dims: int) -> int:
    """No squared distance of vectors up to this exceeds 2^63 - 1."""
    return isqrt((2**63 - 4) // max(1, dims)) // 2


def usable(vectors: DataFrame, dims: int, id_col: str = "vec_id", vector_col: str = "vector") -> DataFrame:
    """``id, v`` of the rows that take part: vectors of ``dims`` whole numbers, none NULL, none
    beyond ``greatest_component``. NULL ids take part."""
    most = greatest_component(dims)
    fits = F.forall("v", lambda x: F.coalesce(x.between(-most, most), F.lit(False)))
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<bigint>").alias("v"))
    return rows.where((F.size("v") == dims) & fits)


def first_centroids(rows: DataFrame, k: int, order: Column) -> np.ndarray:
    """The ``k`` rows that come first by ``order``, then by vector."""
    first = rows.select(order.alias("place"), "v").orderBy("place", "v").limit(k).collect()
    return np.array([r["v"] for r in first], np.int64)


def _blocks(batch: pa.RecordBatch, dims: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for start in range(0, batch.num_rows, BLOCK):
        part = batch.slice(start, BLOCK)
        yield part, part.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def _sums(batches: Iterator[pa.RecordBatch], centroids: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Of each cluster of the task: rows, the high and low halves of the distances, the components."""
    k, dims = centroids.shape
    index, total = Orchard(centroids), np.zeros((k, 3 + dims), np.int64)
    for batch in batches:
        for _, vectors in _blocks(batch, dims):
            best, distance = index.nearest(vectors)
            order = np.argsort(best, kind="stable")
            owner, start = np.unique(best[order], return_index=True)
            parts = np.column_stack([np.ones_like(distance), distance >> 32, distance & 0xFFFFFFFF, vectors])
            total[owner] += np.add.reduceat(parts[order], start, axis=0)
    cluster, what = np.divmod(np.arange(total.size), 3 + dims)
    some = np.repeat(total[:, 0] > 0, 3 + dims)
    columns = [cluster.astype(np.int32)[some], what.astype(np.int32)[some], total.ravel()[some]]
    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["cluster", "what", "total"])


def _totals(rows: DataFrame, centroids: np.ndarray) -> list[list[int]]:
    """One pass: for each cluster the numbers of ``_sums`` over all rows."""
    k, dims = centroids.shape
    out = [[0] * (3 + dims) for _ in range(k)]
    parts = rows.select("v").mapInArrow(partial(_sums, centroids=centroids), "cluster int, what int, total bigint")
    exact = F.sum(F.col("total").cast("decimal(38,0)"))
    for r in parts.groupBy("cluster", "what").agg(exact.alias("total")).collect():
        out[r["cluster"]][r["what"]] = int(r["total"])
    return out


def fit_centroids(rows: DataFrame, centroids: np.ndarray, rounds: int) -> np.ndarray:
    """After ``rounds`` rounds: every vector to its centroid, then every centroid to the mean of its
    vectors, rounded down in each component; those without vectors stay."""
    for _ in range(rounds if len(centroids) else 0):
        totals = _totals(rows, centroids)
        means = [[s // t[0] for s in t[3:]] if t[0] else list(c) for t, c in zip(totals, centroids.tolist(), strict=True)]
        centroids = np.array(means, np.int64)
    return centroids


def _assigned(batches: Iterator[pa.RecordBatch], centroids: np.ndarray) -> Iterator[pa.RecordBatch]:
    index = Orchard(centroids)
    for batch in batches:
        for part, vectors in _blocks(batch, centroids.shape[1]):
            best, distance = index.nearest(vectors)
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), pa.array(best.astype(np.int32)), pa.array(distance)], names=["id", "cluster", "distance"]
            )


def cluster(rows: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``id, cluster, distance, cluster_inertia, inertia, centroid`` of every row of ``usable``.

    ``distance`` is squared; the inertias are its sums over the cluster and over all, NULL where one
    is beyond 64 bits. Of equally near centroids the smallest number counts, so a row's result
    does not depend on other rows' order. Rows that repeat an id or a vector count each for itself.
    Without centroids, which is without rows, the result is empty.
    """
    spark, kind = rows.sparkSession, rows.schema["id"].dataType.simpleString()
    columns = "cluster int, cluster_inertia bigint, inertia bigint, centroid array<bigint>"
    if not len(centroids):
        return spark.createDataFrame([], f"id {kind}, cluster int, distance bigint, {columns.split(', ', 1)[1]}")
    inertia = [(t[1] << 32) + t[2] for t in _totals(rows, centroids)]

    def fit(x: int) -> int | None:
        return x if x < 2**63 else None

    known = [(i, fit(x), fit(sum(inertia)), c) for i, (x, c) in enumerate(zip(inertia, centroids.tolist(), strict=True))]
    found = rows.select("id", "v").mapInArrow(
        partial(_assigned, centroids=centroids), f"id {kind}, cluster int, distance bigint"
    )
    # One row a centroid.
    return found.join(F.broadcast(spark.createDataFrame(known, columns)), "cluster").select(
        "id", "cluster", "distance", "cluster_inertia", "inertia", "centroid"
    )
