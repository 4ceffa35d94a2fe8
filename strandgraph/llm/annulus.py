"""Centroid clustering by exact annulus search.

Each round sorts the centroids by norm.  A vector's distance to the centroid whose norm is next to its own bounds
its distance to the nearest one, so by the triangle inequality only centroids whose norms lie in the annulus of
that width around its norm can be nearer or as near: two binary searches find them, and they are compared in exact
integer arithmetic.  The annulus is widened by more than the rounding of its float bounds, so no tie at its border
is lost; equal distances go to the smaller number.

Vectors stay where they lie: a task passes on a sum and a count for each centroid, and the driver holds ``k`` times
``dims`` numbers, whatever the input.

Edge cases: vectors that are null, of another length, or hold a null, a non-finite component or one of ``LARGEST``
steps or more (whose squared distances would not fit in a long) take no part.  Fewer vectors than ``k`` give as many
centroids; no vectors give no rows.  Rows that repeat an id or a vector each count and each have a row; a null id
comes last among the starting centroids.  Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean, materialise, table_of_few

#: Size of a component, in steps, from which a vector takes no part.
LARGEST = 1 << 27


def squared(rows: np.ndarray, centroid: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer rows to a centroid, or to one centroid a row."""
    away = rows - centroid
    return np.einsum("ij,ij->i", away, away)


class Annulus:
    """Nearest centroids; ``centroids`` are integer rows, numbered from 0."""

    def __init__(self, centroids: np.ndarray):
        norms = np.sqrt(np.einsum("ij,ij->i", centroids, centroids).astype(float))
        self.number = np.lexsort((np.arange(len(norms)), norms))
        self.norms, self.rows = norms[self.number], centroids[self.number]

    def candidates(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """For each row a centroid near in norm, its squared distance, and the range of places in order of norm
        that its annulus takes."""
        own = np.sqrt(np.einsum("ij,ij->i", rows, rows).astype(float))
        right = np.minimum(np.searchsorted(self.norms, own), len(self.norms) - 1)
        left = np.maximum(right - 1, 0)
        start = np.where(np.abs(self.norms[left] - own) < np.abs(self.norms[right] - own), left, right)
        bound = squared(rows, self.rows[start])
        width = np.sqrt(bound.astype(float))
        width += 1e-9 * (1 + width + own)
        return start, bound, np.searchsorted(self.norms, own - width, "left"), np.searchsorted(self.norms, own + width, "right")

    def nearest(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The number of the nearest centroid of each row, and the squared distance."""
        start, best, first, last = self.candidates(rows)
        number = self.number[start]
        for place, of in enumerate(self.number):
            at = np.flatnonzero((first <= place) & (place < last) & (start != place))
            far = squared(rows[at], self.rows[place])
            nearer = (far < best[at]) | (far == best[at]) & (of < number[at])
            at = at[nearer]
            best[at], number[at] = far[nearer], of
        return number, best


def _matrix(column: pa.Array, dims: int, scale: int) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False).astype(float)
    return np.floor(scale * values).astype(np.int64).reshape(-1, dims)


def centroids(vectors: DataFrame, k: int, rounds: int, dims: int, scale: int) -> np.ndarray:
    """The centroids after ``rounds`` rounds over (key, vector), all vectors whole."""
    first = vectors.select(F.sha2(F.concat(F.lit("1:"), F.col("key").cast("string")), 256).alias("place"), "vector").orderBy(F.asc_nulls_last("place"), "vector").limit(k)
    now = np.array([[int(np.floor(scale * float(x))) for x in r["vector"]] for r in first.collect()], np.int64).reshape(-1, dims)
    for _ in range(rounds if len(now) else 0):
        search = Annulus(now)

        def add(batches, search=search, k=len(now)):
            sums, sizes = np.zeros((k, dims), np.int64), np.zeros(k, np.int64)
            for batch in batches:
                rows = _matrix(batch.column(0), dims, scale)
                number, _ = search.nearest(rows)
                sizes += np.bincount(number, minlength=k)
                for c in np.unique(number):
                    sums[c] += rows[number == c].sum(0)
            some = np.flatnonzero(sizes)
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(sizes[some]), pa.array(sums[some].tolist(), pa.list_(pa.int64()))], ["number", "n", "sums"])

        parts = vectors.select("vector").mapInArrow(lean(add), "number long, n long, sums array<long>")
        moved = parts.groupBy("number").agg(F.sum("n").alias("n"), *[F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(dims)])
        now = now.copy()
        for r in moved.collect():  # a row for each centroid
            now[r["number"]] = [r[f"s{i}"] // r["n"] for i in range(dims)]
    return now


def cluster(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = 16, rounds: int = 3, dims: int = 64, scale: int = 64) -> DataFrame:
    """key, cluster, distance (squared, in steps of 1/``scale``), the distances summed over the cluster and over all,
    and the SHA-256 of the cluster's centroid."""
    whole = F.forall(F.col(vector), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < LARGEST / scale))
    usable = vectors.where((F.size(vector) == dims) & whole).select(F.col(key).alias("key"), F.col(vector).alias("vector"))
    final = centroids(usable, k, rounds, dims, scale)
    kind = vectors.schema[key].dataType.simpleString()

    def assign(batches):
        search = Annulus(final)
        for batch in batches:
            number, far = search.nearest(_matrix(batch.column(1), dims, scale))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(number.astype(np.int32)), pa.array(far)], ["key", "cluster", "distance"])

    if not len(final):
        usable = usable.limit(0)
    found = materialise(usable.mapInArrow(lean(assign), f"key {kind}, cluster int, distance long"), "clusters")
    sums = {r["cluster"]: r["inertia"] for r in found.groupBy("cluster").agg(F.sum("distance").alias("inertia")).collect()}  # at most k rows
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in final.tolist()]
    few = table_of_few(vectors.sparkSession, [(c, n, sum(sums.values()), digests[c]) for c, n in sorted(sums.items())], "number int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(few, F.col("cluster") == F.col("number")).select(F.col("key").alias(key), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
