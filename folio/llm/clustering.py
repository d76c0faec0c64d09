"""Centroid clustering of embedding vectors in exact integers.

A vector counts if it has the asked number of components, none of them null, NaN or infinite;
each component x becomes floor(scale * x). Distances come by |x|^2 - 2 x.c + |c|^2 as one float64 matrix
product a block of rows. All terms are integers, so the product is exact as long as (|x| + |c|)^2,
bounded by the largest components, stays below 2^53; rows beyond that bound are compared component by component
in 64-bit integers, and in Python's unbounded ones where these don't do either. A round is one scan: every
task sums its vectors by cluster, and treeAggregate combines the sums (clusters x components numbers a task) on
the way to the driver, where the new centroids are made. Nothing is shuffled by cluster, so a cluster or a
vector that holds most rows costs no task more than its share; the centroids are all that goes to the tasks.

The vectors are read anew in each round, so a lost executor costs its tasks only; store what is dear to compute.

Defined results: vectors that don't count have no row. Rows that repeat an id are vectors like others. First centroids
are those of the least hashes; equal hashes go by components, and rows without id (which have none) come last. With fewer vectors than
clusters, each is a centroid. No vectors, no rows. A distance or a sum that 64 bits can't hold is null (the assignment is
exact all the same). Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.llm.batches import lean

#: Integers up to here are exact as float64.
EXACT = 1 << 53
#: Sums of squares up to here leave room in 64-bit integers.
WIDE = 1 << 62
LONG = (1 << 63) - 1
#: Rows of a matrix product: bounds the temporary arrays of a task.
BLOCK = 4096


def counted(rows: DataFrame, size: int, id_col: str, vector_col: str) -> DataFrame:
    """(id, v array<double>) of the vectors that count."""
    v = F.col(vector_col).cast("array<double>")
    fit = (F.size(v) == size) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.select(F.col(id_col).alias("id"), v.alias("v")).where(F.coalesce(fit, F.lit(False)))


def integers(v: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * v) as float64 where that is exact, else as Python integers."""
    with np.errstate(over="ignore"):
        out = np.floor(v * scale)
    if np.abs(out).max(initial=0) < EXACT:
        return out
    # numbers this large are whole, so the product is taken in integers
    return np.array([[int(x) * scale if abs(x) >= EXACT else int(np.floor(x * scale)) for x in row] for row in v.tolist()], object)


class Centroids:
    """Centroids as rows of integers of any size."""

    def __init__(self, rows: list[list[int]]):
        self.rows = rows
        self.most = max((abs(x) for r in rows for x in r), default=0)
        self.floats = np.array(rows, np.float64) if self.most < EXACT else None

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(cluster, squared distance) of the rows of integers(); ties go to the smaller number."""
        size = x.shape[1]
        most = np.abs(x).max(axis=1)
        reach = [size * (int(m) + self.most) ** 2 for m in most.tolist()]
        small = np.array([r < EXACT for r in reach], bool)
        if small.all():
            return self._product(x.astype(np.float64))
        which, far = np.zeros(len(x), np.int64), np.zeros(len(x), object)
        if small.any():
            which[small], far[small] = self._product(x[small].astype(np.float64))
        for i in np.flatnonzero(~small).tolist():
            kind = np.int64 if reach[i] < WIDE else object
            row = np.array([int(a) for a in x[i].tolist()], kind)
            d = ((row - np.array(self.rows, kind)) ** 2).sum(axis=1).tolist()
            which[i] = d.index(min(d))
            far[i] = min(d)
        return which, far

    def _product(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        c = self.floats
        d = (x * x).sum(axis=1)[:, None] - 2.0 * (x @ c.T) + (c * c).sum(axis=1)
        which = d.argmin(axis=1)
        return which, d[np.arange(len(x)), which].astype(np.int64)


class Sums:
    """Of each cluster: vectors, component sums, distance sum; integers of any size."""

    def __init__(self, clusters: int, size: int):
        self.n = np.zeros(clusters, object)
        self.x = np.zeros((clusters, size), object)
        self.far = np.zeros(clusters, object)

    def take(self, x: np.ndarray, which: np.ndarray, far: np.ndarray) -> None:
        if x.dtype != object and np.abs(x).max(initial=0) * len(x) < EXACT:
            one = np.zeros((len(self.n), len(x)))
            one[which, np.arange(len(x))] = 1.0
            self.x += (one @ x).astype(np.int64).astype(object)
        else:
            for c, row in zip(which.tolist(), x.tolist(), strict=True):
                self.x[c] += np.array([int(a) for a in row], object)
        self.n += np.bincount(which, minlength=len(self.n)).astype(object)
        for c in np.unique(which).tolist():
            self.far[c] += sum(far[which == c].tolist())

    def add(self, other: Sums) -> Sums:
        self.n, self.x, self.far = self.n + other.n, self.x + other.x, self.far + other.far
        return self

    def means(self, before: list[list[int]]) -> list[list[int]]:
        return [[s // n for s in sums] if n else old for n, sums, old in zip(self.n.tolist(), self.x.tolist(), before, strict=True)]


def _blocks(batches: Iterator[pa.RecordBatch], size: int, scale: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    for b in lean(batches):
        for at in range(0, b.num_rows, BLOCK):
            part = b.slice(at, BLOCK)
            yield part.column(0), integers(part.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, size), scale)


def summed(vectors: DataFrame, centroids: list[list[int]], scale: int) -> Sums:
    """Sums of all vectors by nearest centroid: one scan, one small row a task, combined in a tree."""
    clusters, size = len(centroids), len(centroids[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        near, out = Centroids(centroids), Sums(clusters, size)
        for _, x in _blocks(batches, size, scale):
            out.take(x, *near.nearest(x))
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(out)], pa.binary())], names=["sums"])

    parts = vectors.mapInArrow(run, "sums binary").rdd
    return parts.treeAggregate(Sums(clusters, size), lambda a, r: a.add(pickle.loads(r[0])), Sums.add)


def first_centroids(vectors: DataFrame, clusters: int, size: int, scale: int, seed: int) -> list[list[int]]:
    """The vectors with the least hashes of "seed:id", as integers: a top-k of `clusters` rows."""
    hashed = vectors.withColumn("h", F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256))
    got = hashed.orderBy(F.asc_nulls_last("h"), "v").limit(clusters).select("v").collect()
    return [[int(a) for a in row] for row in integers(np.array([r.v for r in got], np.float64).reshape(-1, size), scale).tolist()]


def _long(x: int) -> int | None:
    return x if x <= LONG else None


def cluster(rows: DataFrame, clusters: int = 40, rounds: int = 5, size: int = 64, scale: int = 256, seed: int = 2, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every vector that counts, after `rounds` rounds."""
    vectors = counted(rows, size, id_col, vector_col)
    centroids = first_centroids(vectors, clusters, size, scale, seed)
    kind = dict(vectors.dtypes)["id"]
    schema = f"`{id_col}` {kind}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    if not centroids:
        return rows.sparkSession.createDataFrame([], schema)
    for _ in range(rounds):
        centroids = summed(vectors, centroids, scale).means(centroids)
    far = summed(vectors, centroids, scale).far.tolist()
    whole = _long(sum(far))
    own = [(_long(f), hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for f, c in zip(far, centroids, strict=True)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        near = Centroids(centroids)
        for ids, x in _blocks(batches, size, scale):
            which, d = near.nearest(x)
            of = which.tolist()
            columns = [pa.array(which, pa.int32()), pa.array([_long(a) for a in d.tolist()], pa.int64()), pa.array([own[c][0] for c in of], pa.int64()), pa.array([whole] * len(of), pa.int64()), pa.array([own[c][1] for c in of])]
            yield pa.RecordBatch.from_arrays([ids, *columns], names=[id_col, "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"])

    return vectors.mapInArrow(run, schema)
