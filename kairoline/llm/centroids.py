"""Centroid clustering in whole numbers, nearest centroids by the threshold algorithm.

Per dimension the centroids are sorted by their value. For a vector the lists are walked outwards from its own value, one
step in every dimension at a time; each centroid met for the first time is measured exactly. No centroid that has not been
met is nearer than the sum of the squared distances to the next entries, so a vector is done once that sum strictly
exceeds its best distance (on equality a smaller number might still tie). A task walks all its vectors together.

Every round is one pass over the settled vectors: tasks assign and add up per cluster, Spark adds the tasks' sums, and
the driver receives one number per cluster and dimension. Nothing else is broadcast or collected.

Defined results: a vector takes part if it has exactly ``dim`` components, none null or non-finite, and none beyond the
range in which a squared distance fits 64 bits (``2**17`` in 64 dimensions); a null id takes part, written as
``null`` where ids are hashed. Rows are vectors, repeated rows too; equal hashes go by components. With fewer vectors
than ``k`` there are as many centroids as vectors; an empty table gives no rows. Clashing column names
cannot occur, since only the id and results are returned.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kairoline.llm.common import col, settled

#: Vectors of a batch that are walked together.
WALK = 4096


@dataclass(frozen=True)
class Clustering:
    """``k`` centroids of ``dim`` components, ``rounds`` updates, ``scale`` steps per unit; ``seed`` draws the start."""

    k: int = 8
    dim: int = 64
    rounds: int = 10
    scale: int = 1024
    seed: int = 3

    @property
    def widest(self) -> int:
        """Components below this size have differences whose squares add up to less than 2**63."""
        return 1 << ((62 - (self.dim - 1).bit_length()) // 2 - 1)


def grid_vector(v: Column, p: Clustering) -> Column:
    """Whole-number components, or null where the vector takes no part."""
    d = F.transform(v, lambda x: F.floor(x.cast("double") * p.scale).cast("long"))
    sound = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float(p.widest // p.scale)))
    return F.when((F.size(v) == p.dim) & sound, d)


def nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number and squared distance of each vector's nearest centroid, and how many were measured."""
    n, dim = x.shape
    k = len(centroids)
    order = np.argsort(centroids, axis=0, kind="stable")
    values = np.take_along_axis(centroids, order, axis=0)
    best, who = np.full(n, np.iinfo(np.int64).max), np.full(n, k)
    met = np.zeros((n, k), bool)
    right = np.stack([np.searchsorted(values[:, j], x[:, j]) for j in range(dim)], axis=1)
    left = right - 1
    far = np.iinfo(np.int64).max
    at = np.arange(dim)
    rows = np.arange(n)

    def gaps() -> tuple[np.ndarray, np.ndarray]:
        own = x[rows]
        below = np.where(left >= 0, own - values[np.maximum(left, 0), at], far)
        above = np.where(right < k, values[np.minimum(right, k - 1), at] - own, far)
        return below, above

    below, above = gaps()
    while len(rows):
        down = below <= above
        step = order[np.where(down, left, right), at]
        new = np.zeros((len(rows), k), bool)
        new[np.arange(len(rows))[:, None], step] = True
        new &= ~met[rows]
        met[rows] |= new
        for c in range(k):
            r = rows[new[:, c]]
            if len(r):
                apart = x[r] - centroids[c]
                d = np.einsum("ij,ij->i", apart, apart)
                nearer = (d < best[r]) | ((d == best[r]) & (c < who[r]))
                best[r[nearer]], who[r[nearer]] = d[nearer], c
        left, right = left - down, right + ~down
        open_ = ~met[rows].all(axis=1)
        rows, left, right = rows[open_], left[open_], right[open_]
        if len(rows):
            below, above = gaps()
            front = np.minimum(below, above)
            open_ = np.einsum("ij,ij->i", front, front) <= best[rows]
            rows, left, right, below, above = rows[open_], left[open_], right[open_], below[open_], above[open_]
    return who, best, met.sum(axis=1)


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def start(sound: DataFrame, p: Clustering) -> np.ndarray:
    """The vectors with the smallest hashes of their ids, in the order of these."""
    drawn = F.sha2(F.concat(F.lit(f"{p.seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("null"))), 256)
    rows = sound.select("v", drawn.alias("h")).orderBy("h", "v").limit(p.k).collect()
    return np.array([r[0] for r in rows], np.int64).reshape(len(rows), p.dim)


def _round(sound: DataFrame, centroids: np.ndarray, p: Clustering) -> np.ndarray:
    """Exact floor of the mean of each cluster; an empty cluster keeps its centroid."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros_like(centroids), np.zeros(len(centroids), np.int64)
        for batch in batches:
            x = _matrix(batch.column(0), p.dim)
            for a in range(0, len(x), WALK):
                who = nearest(x[a:a + WALK], centroids)[0]
                np.add.at(sums, who, x[a:a + WALK])
                counts += np.bincount(who, minlength=len(centroids))
            if counts.max() > 1 << 30:  # hand on before a sum can overflow
                yield rows(sums, counts)
                sums[:], counts[:] = 0, 0
        if counts.any():
            yield rows(sums, counts)

    def rows(sums: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        used = np.flatnonzero(counts)
        return pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(counts[used]),
                                           pa.array(sums[used].tolist(), pa.list_(pa.int64()))], ["c", "n", "sums"])

    parts = sound.select("v").mapInArrow(add, "c int, n bigint, sums array<bigint>")
    total = parts.select("c", "n", F.posexplode("sums").alias("j", "s")).groupBy("c", "j").agg(
        F.sum(F.col("s").cast("decimal(38,0)")).alias("s"), F.sum("n").alias("n"))
    moved = centroids.copy()
    for c, j, s, n in total.collect():  # at most k * dim rows
        moved[c, j] = int(Decimal(s)) // n
    return moved


def cluster(vectors: DataFrame, p: Clustering = Clustering(), id_col: str = "vec_id", vector: str = "embedding",
            ) -> tuple[DataFrame, np.ndarray]:
    """Per vector its id, ``cluster`` and squared ``distance``; and the final centroids."""
    sound = settled(vectors.select(col(id_col).alias("id"), grid_vector(col(vector), p).alias("v")).filter("v is not null"))
    centroids = start(sound, p)
    for _ in range(p.rounds if len(centroids) else 0):
        moved = _round(sound, centroids, p)
        if np.array_equal(moved, centroids):  # all later rounds are the same
            break
        centroids = moved
    kind = sound.schema["id"].dataType.simpleString()

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1), p.dim)
            found = [nearest(x[a:a + WALK], centroids)[:2] for a in range(0, len(x), WALK)]
            who, far = (np.concatenate([f[i] for f in found]) if found else np.zeros(0, np.int64) for i in (0, 1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(who.astype(np.int32)), pa.array(far)],
                                             ["id", "cluster", "distance"])

    out = sound.mapInArrow(assign, f"id {kind}, cluster int, distance bigint")
    return out.withColumnRenamed("id", id_col), centroids


def with_inertia(assigned: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Adds ``cluster_inertia``, ``inertia`` (null beyond 64 bits) and ``centroid_sha256``; one row per cluster is sent."""
    assigned = settled(assigned)
    sums = {r[0]: int(r[1]) for r in assigned.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)"))).collect()}
    total = sum(sums.values())

    def fits(x: int) -> int | None:
        return x if x < 1 << 63 else None

    rows = [(c, fits(s), fits(total), hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest())
            for c, s in sums.items()]
    small = assigned.sparkSession.createDataFrame(
        rows, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return assigned.join(F.broadcast(small), "cluster")
