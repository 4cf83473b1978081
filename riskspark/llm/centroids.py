"""Centroid clustering with lower bounds from Ptolemy's inequality.

Vectors become integers, so that distances and means are exact and a run gives the same result
on any cluster. For an object o, a centroid c and two pivots p and s, Ptolemy's inequality gives

    d(o, c) >= |d(o, p) d(c, s) - d(o, s) d(c, p)| / d(p, s).

The distances from every vector to the fixed pivots are worked out once and kept beside the
vector. Each assignment then takes the greatest bound over the pivot pairs, measures the centroid
with the smallest bound exactly, and measures another one exactly only if its bound, lowered by
more than any rounding can have raised it, is not above the best distance so far.

A round is one pass: tasks send back the count and the sums of each of their clusters (``k`` rows),
which Spark adds up; ``k`` centroids go out again. No vector is shuffled.

Defined results: only vectors with exactly ``dims`` components, none null or not finite, are kept;
the others, and null vectors, have no row. A scaled component is held within +-``LARGEST``, so
that squared distances fit 64 bits. The first centroids are the kept vectors with the smallest
hashes of ``seed:id`` (null ids as ``null``; equal ids in the order of their components). With
fewer vectors than ``k`` there are as many centroids as vectors. Equal rows get equal results, one
each; equal distances go to the smaller number, so of two equal centroids the second stays empty.
An inertia above 64 bits is null. Other columns are ignored. An empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.llm.stage import dropped, staged

LARGEST = 1 << 27
PIVOTS = 8
_SLACK = 32 * np.finfo(np.float64).eps  # above the rounding of some ten operations


def whole_numbers(vector: Column, dims: int, scale: int) -> Column:
    """``floor(scale * x)`` of each component; null if the vector is not to be kept."""
    good = F.coalesce((F.size(vector) == dims) & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf"))), F.lit(False))
    limit = F.lit(LARGEST).cast("double")
    return F.when(good, F.transform(vector, lambda x: F.greatest(-limit, F.least(limit, F.floor(x.cast("double") * scale).cast("double"))).cast("int")))


def _matrix(column) -> np.ndarray:
    """A list column of equally long integer lists as a matrix."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return flat.reshape(len(column), -1)


def _squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows of ``a`` and rows of ``b``, or of one ``b``."""
    d = a - b
    return np.einsum("ij,ij->i", d, d)


class Bounds:
    """The lower bounds of the distances to centroids from the distances to pivots."""

    def __init__(self, pivots: np.ndarray, centroids: np.ndarray):
        self.centroids = centroids
        away = np.sqrt(np.array([_squared(pivots, c) for c in centroids], np.float64)).reshape(len(centroids), len(pivots))
        self.pairs = []
        for p, s in combinations(range(len(pivots)), 2):
            apart = float(np.sqrt(float(_squared(pivots[p:p + 1], pivots[s])[0])))
            if apart > 0:
                self.pairs.append((p, s, away[:, s] / apart, away[:, p] / apart))

    def below(self, to_pivots: np.ndarray) -> np.ndarray:
        """Squares of distances that no centroid is nearer than: a row for each vector, a column for each centroid."""
        d = np.sqrt(to_pivots.astype(np.float64))
        best = np.zeros((len(d), len(self.centroids)))
        for p, s, to_s, to_p in self.pairs:
            x, y = d[:, p, None] * to_s, d[:, s, None] * to_p
            np.maximum(best, np.abs(x - y) - _SLACK * (x + y), out=best)
        return best * best * (1 - _SLACK)

    def nearest(self, vectors: np.ndarray, to_pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """For each vector the nearest centroid and its squared distance, and how many distances were measured."""
        low = self.below(to_pivots)
        cluster = low.argmin(1)
        distance = _squared(vectors, self.centroids[cluster])
        first, measured = cluster.copy(), len(vectors)
        for c in range(len(self.centroids)):
            open_ = np.flatnonzero((first != c) & (low[:, c] <= distance * (1 + _SLACK)))
            if len(open_):
                d = _squared(vectors[open_], self.centroids[c])
                better = (d < distance[open_]) | ((d == distance[open_]) & (c < cluster[open_]))
                at = open_[better]
                cluster[at], distance[at] = c, d[better]
                measured += len(open_)
        return cluster, distance, measured


def _measured(pivots: np.ndarray):
    def run(batches):
        for batch in batches:
            v = _matrix(batch.column("v"))
            to = np.stack([_squared(v, p) for p in pivots], 1) if len(pivots) else np.empty((len(v), 0), np.int64)
            cells = pa.ListArray.from_arrays(pa.array(np.arange(len(v) + 1, dtype=np.int32) * to.shape[1]), pa.array(to.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("v"), cells], names=["id", "v", "to"])
    return run


def _sums(bounds: Bounds):
    """The count and the sums of each cluster of a task."""
    def run(batches):
        n, total = np.zeros(len(bounds.centroids), np.int64), np.zeros(bounds.centroids.shape, np.int64)
        seen = False
        for batch in batches:
            v = _matrix(batch.column("v"))
            if len(v):
                cluster, _, _ = bounds.nearest(v, _matrix(batch.column("to")))
                np.add.at(total, cluster, v)
                n += np.bincount(cluster, minlength=len(n))
                seen = True
        if seen:
            k, dims = total.shape
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(k), dims), pa.int32()), pa.array(np.tile(np.arange(dims), k), pa.int32()),
                                              pa.array(np.repeat(n, dims)), pa.array(total.ravel())], names=["cluster", "component", "n", "total"])
    return run


def _assigned(bounds: Bounds):
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                cluster, distance, _ = bounds.nearest(_matrix(batch.column("v")), _matrix(batch.column("to")))
                yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(cluster, pa.int32()), pa.array(distance, pa.int64())], names=["id", "cluster", "distance"])
    return run


def cluster_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 16, rounds: int = 3,
                    dims: int = 64, scale: int = 64, seed: str = "1") -> tuple[DataFrame, list[list[int]]]:
    """The kept vectors as the id column, ``cluster`` and ``distance`` (squared, of the scaled vectors), and the final
    centroids. Jobs run when it is called; the driver gets ``k`` and PIVOTS vectors, and ``k`` sums a round."""
    spark = vectors.sparkSession
    whole = whole_numbers(F.col(f"`{vector_col}`"), dims, scale)
    base = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), whole.alias("v")).where("v is not null")
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("null"))), 256)
    start = [r.v for r in base.select("v", order.alias("h")).orderBy("h", "v").limit(max(k, PIVOTS)).collect()]
    pivots = np.array(start[:PIVOTS], np.int64).reshape(-1, dims)
    centroids = np.array(start[:k], np.int64).reshape(-1, dims)
    near = staged(base.mapInArrow(_measured(pivots), "id long, v array<int>, to array<long>"), "pivots")
    for _ in range(rounds if start else 0):
        sums = (near.select("v", "to").mapInArrow(_sums(Bounds(pivots, centroids)), "cluster int, component int, n long, total long")
                .groupBy("cluster", "component").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total")))
        for r in sums.where("n > 0").collect():
            centroids[r.cluster, r.component] = int(r.total) // r.n
    if not start:
        return spark.createDataFrame([], "id long, cluster int, distance long").withColumnRenamed("id", id_col), []
    out = staged(near.mapInArrow(_assigned(Bounds(pivots, centroids)), "id long, cluster int, distance long"), "clusters")
    dropped(near)
    return out.withColumnRenamed("id", id_col), centroids.tolist()


def with_inertia(assigned: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """``assigned`` with ``cluster_inertia``, ``inertia`` and ``centroid_sha256``."""
    sums = {r.cluster: int(r.s) for r in assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    number = lambda n: F.lit(n if n < 1 << 63 else None).cast("long")
    each = [number(sums.get(c, 0)) for c in range(len(centroids))]
    digests = [F.lit(hashlib.sha256(",".join(map(str, v)).encode()).hexdigest()) for v in centroids]
    pick = lambda values, kind: (F.get(F.array(*values), F.col("cluster")) if values else F.lit(None)).cast(kind)
    return assigned.withColumns({"cluster_inertia": pick(each, "long"), "inertia": number(sum(sums.values())), "centroid_sha256": pick(digests, "string")})
