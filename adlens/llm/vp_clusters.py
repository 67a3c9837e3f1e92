"""Operator 12: centroid clustering with a vantage-point tree over the centroids.

Vectors become integers ``floor(scale * x)``. In every round the centroids are
put into a new vantage-point tree, which is broadcast; each vector searches it
best first: of the nodes that wait, the one with the least lower bound comes
next, and the search ends when that bound exceeds the best distance found. A
node whose bound equals it is still opened, so that a tie is never missed; all
distances are exact integers, and of equal ones the smaller centroid number
wins. Tasks add up their vectors by cluster before anything is shuffled, so a
round moves ``k`` sums a task, whatever a cluster's size.

What reaches the driver is bounded by ``k`` and the number of components: the
starting vectors, the sums of a round, the totals of the clusters. The tree
that is broadcast holds the ``k`` centroids.

Defined results
---------------
* vectors that are null, of another length, or hold a null or a non-finite
  component are left out.
* fewer than ``k`` vectors: as many clusters; none, or an empty table: no rows.
* repeated rows: each is a vector of its own, also as a starting centroid; of
  equal centroids the smaller number takes all vectors.
* null vec_id: clustered and carried as null, but starts a centroid only where
  ids are too few.
* ties in distance: the smaller centroid; ties of the starting hash: the
  smaller vector.
* components of 2**27 or more after scaling raise an error, since squared
  distances would no longer fit a long; there are no texts, long or empty.
* extra columns are not carried, so no name can clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import saved

#: Centroids in a leaf of the tree.
LEAF = 4
#: Vectors searched at once in a task, times nodes of the tree.
BLOCK = 1 << 18
#: Components must be smaller than this, so that squared distances fit a long.
LARGEST = 1 << 27
#: Share by which a lower bound is lessened against rounding of square roots.
SLACK = 1e-9


class VpTree:
    """Nodes in arrays: ``members`` (vantage point, or a leaf's centroids; -1 fills up),
    ``child`` (inside, outside; -1 in a leaf), ``reach`` (least and largest distance of each child's centroids)."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        self.points = points
        self.leaf = leaf
        self.members: list | np.ndarray = []
        self.child: list | np.ndarray = []
        self.reach: list | np.ndarray = []
        if len(points):
            self._grow(np.arange(len(points)))
        self.members = np.array(self.members, np.int64).reshape(-1, leaf)
        self.child = np.array(self.child, np.int64).reshape(-1, 2)
        self.reach = np.array(self.reach, np.float64).reshape(-1, 2, 2)

    def _grow(self, ids: np.ndarray) -> int:
        at = len(self.members)
        self.members.append([-1] * self.leaf)
        self.child.append([-1, -1])
        self.reach.append([[0.0, 0.0]] * 2)
        if len(ids) <= self.leaf:
            self.members[at] = [*ids, *[-1] * (self.leaf - len(ids))]
            return at
        vantage, rest = ids[0], ids[1:]
        far = squared(self.points[rest], self.points[vantage])
        order = np.lexsort((rest, far))
        half = len(rest) // 2
        self.members[at][0] = vantage
        for side, own in enumerate((order[:half], order[half:])):
            self.reach[at][side] = np.sqrt(far[own[[0, -1]]].astype(np.float64))
            self.child[at][side] = self._grow(rest[own])
        return at

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(centroid, squared distance) of each vector."""
        step = max(1, BLOCK // max(1, len(self.members)))
        parts = [self._nearest(vectors[i:i + step]) for i in range(0, len(vectors), step)]
        return (np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))

    def _nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = len(vectors)
        best = np.full(n, np.iinfo(np.int64).max)
        found = np.full(n, len(self.points), np.int64)
        waiting = np.full((n, len(self.members)), np.inf)
        waiting[:, 0] = 0.0
        rows = np.arange(n)
        while len(rows):
            node = waiting[rows].argmin(axis=1)
            bound = waiting[rows, node]
            near = np.isfinite(bound) & (bound <= np.sqrt(best[rows].astype(np.float64)))  # inclusive: ties are opened
            rows, node, bound = rows[near], node[near], bound[near]
            waiting[rows, node] = np.inf
            far = None
            for k in range(self.leaf):
                who = self.members[node, k]
                on = np.flatnonzero(who >= 0)
                if not len(on):
                    continue
                d = squared(vectors[rows[on]], self.points[who[on]])
                if k == 0:
                    far = d
                at = rows[on]
                less = (d < best[at]) | ((d == best[at]) & (who[on] < found[at]))
                best[at[less]], found[at[less]] = d[less], who[on][less]
            inner = np.flatnonzero(self.child[node, 0] >= 0)
            if len(inner):
                r = np.sqrt(far[inner].astype(np.float64))
                for side in (0, 1):
                    lo, hi = self.reach[node[inner], side].T
                    low = np.maximum(lo - r, r - hi) - SLACK * (r + hi + 1)
                    waiting[rows[inner], self.child[node[inner], side]] = np.maximum(low, bound[inner])
        return found, best


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    d = a - b
    return np.einsum("ij,ij->i", d, d)


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dim)


def integers(vectors: DataFrame, id: str = "vec_id", embedding: str = "embedding", dim: int = 64,
             scale: float = 64.0) -> DataFrame:
    """(i, v): the kept vectors as integers."""
    rows = vectors.select(F.col(id).cast("bigint").alias("i"), F.col(embedding).cast("array<double>").alias("v"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            right = pc.fill_null(pc.equal(pc.list_value_length(b.column("v")), dim), False)
            b = b.filter(right)
            x = b.column("v").flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
            whole = np.isfinite(x).all(axis=1)
            x = np.floor(scale * x[whole])
            if len(x) and np.abs(x).max() >= LARGEST:
                raise ValueError(f"a component times {scale:g} reaches {LARGEST}: squared distances would not fit a long")
            v = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * dim, pa.int32()),
                                         pa.array(x.astype(np.int32).ravel()))
            yield pa.RecordBatch.from_arrays([b.column("i").filter(pa.array(whole)), v], names=["i", "v"])

    return rows.mapInArrow(run, "i bigint, v array<int>")


def starts(rows: DataFrame, k: int, salt: str = "1") -> np.ndarray:
    """The ``k`` vectors with the smallest hash of their id, in its order."""
    digest = F.sha2(F.concat(F.lit(salt + ":"), F.col("i").cast("string")), 256)
    first = rows.orderBy(digest.asc_nulls_last(), "v").limit(k).select("v").collect()
    return np.array([r.v for r in first], np.int64)


def assign(rows: DataFrame, points: np.ndarray) -> DataFrame:
    """(i, cluster, distance) of every vector."""
    tree, dim = rows.sparkSession.sparkContext.broadcast(VpTree(points)), points.shape[1]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                own, far = tree.value.nearest(_matrix(b.column("v"), dim))
                yield pa.RecordBatch.from_arrays([b.column("i"), pa.array(own.astype(np.int32)), pa.array(far)],
                                                 names=["i", "cluster", "distance"])

    return rows.mapInArrow(run, "i bigint, cluster int, distance bigint")


def moved(rows: DataFrame, points: np.ndarray) -> np.ndarray:
    """The centroids after one round: the exact floor of each mean; empty clusters stay."""
    tree, (k, dim) = rows.sparkSession.sparkContext.broadcast(VpTree(points)), points.shape

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros((k, dim), np.int64), np.zeros(k, np.int64)
        for b in batches:
            if b.num_rows:
                v = _matrix(b.column("v"), dim)
                own, _ = tree.value.nearest(v)
                np.add.at(total, own, v)
                count += np.bincount(own, minlength=k)
        for c in np.flatnonzero(count):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(dim, c, np.int32)), pa.array(np.arange(dim, dtype=np.int32)),
                 pa.array(total[c]), pa.array(np.full(dim, count[c]))], names=["cluster", "pos", "total", "n"])

    sums = rows.mapInArrow(run, "cluster int, pos int, total bigint, n bigint").groupBy("cluster", "pos").agg(
        F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n")).collect()  # k * dim rows
    out = points.copy()
    for r in sums:
        out[r["cluster"], r["pos"]] = int(r["total"]) // r["n"]
    return out


def cluster(vectors: DataFrame, k: int = 16, rounds: int = 3, id: str = "vec_id", embedding: str = "embedding",
            dim: int = 64, scale: float = 64.0, salt: str = "1") -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every kept vector."""
    spark = vectors.sparkSession
    rows = saved(integers(vectors, id, embedding, dim, scale), "vectors")
    points = starts(rows, k, salt).reshape(-1, dim)
    for _ in range(rounds if len(points) else 0):
        points = moved(rows, points)
    if not len(points):
        return spark.createDataFrame([], "vec_id bigint, cluster int, distance bigint, cluster_inertia bigint, "
                                         "inertia bigint, centroid_sha256 string")
    done = saved(assign(rows, points), "assigned")
    sums = {r["cluster"]: int(r["s"]) for r in done.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}  # at most k rows
    told = pd.DataFrame({
        "cluster": pd.Series(list(sums), dtype="int32"), "cluster_inertia": list(sums.values()), "inertia": sum(sums.values()),
        "centroid_sha256": [hashlib.sha256(",".join(map(str, points[c])).encode()).hexdigest() for c in sums]})
    totals = spark.createDataFrame(told, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return done.join(F.broadcast(totals), "cluster").select(  # at most k rows
        F.col("i").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
