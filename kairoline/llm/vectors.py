"""Approximate nearest neighbours by largest inner product: inverted lists with an adaptive dimension scan.

Vectors are rotated by a random orthogonal matrix and kept in blocks of columns. A list's candidates are scanned block by
block; after each one a hypothesis test compares the inner product estimated from the dimensions seen so far with
the best found so far and drops candidates that would need an improbable rest. Survivors are scored in double precision
on the original vectors, so every returned score is exact; only the set of candidates is approximate.

Lists: centroids are fitted on a bounded sample (``sample`` vectors in expectation, a parameter), but every vector is in the list of its
nearest centroid, and a query probes its ``probes`` nearest lists. Lists are cut into chunks of bounded size and their
queries into blocks, so a vector that a third of all rows share fills many small tasks instead of one large one.

Defined results: vectors that are null, empty, zero, of another length than the first ones, or hold a null or
non-finite component take no part, neither as query nor as candidate; rows without an id do not either. A query's own
id is never its neighbour. Rows equal in id and vector count once. An id with several vectors asks with the smallest of
those that are queries (compared component by component) and is one neighbour with the best score of its vectors. Ties go to the smaller id; with fewer candidates than ``k`` all found ones return; an empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kairoline.llm.common import col, settled
from kairoline.llm.near_dups import _lists


@dataclass(frozen=True)
class Index:
    """Parameters; ``sample`` and ``lists`` bound what the driver fits and the tasks receive."""

    sample: int = 20_000
    lists: int = 64
    probes: int = 44  # measured on directions without clusters, where fewer probes miss neighbours (see README)
    columns: int = 16  # dimensions per block
    doubt: float = 2.1  # standard errors of the test; larger drops fewer candidates
    chunk: int = 8192  # vectors per task group
    block: int = 1024  # queries per task group
    steps: int = 12
    seed: int = 11


def usable(v: Column) -> Column:
    """Vectors that take part."""
    d = F.transform(v, lambda x: x.cast("double"))
    finite = F.forall(d, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(v.isNotNull() & (F.size(v) > 0) & finite & F.exists(d, lambda x: x != 0), F.lit(False))


def rotation(dim: int, seed: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def centroids(x: np.ndarray, p: Index) -> np.ndarray:
    """Spherical k-means on the sample; directions only, as for inner products of queries of any length."""
    u = np.unique(x, axis=0)
    u = u / np.linalg.norm(u, axis=1, keepdims=True)
    rng = np.random.default_rng(p.seed)
    c = u[rng.permutation(len(u))[:min(p.lists, len(u))]]
    for _ in range(p.steps):
        near = np.argmax(u @ c.T, axis=1)
        total = np.zeros_like(c)
        np.add.at(total, near, u)
        norm = np.linalg.norm(total, axis=1, keepdims=True)
        c = np.where(norm > 0, total / np.maximum(norm, 1e-300), c)
    return c


def _best(ids: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Positions of the ``k`` ids with the best scores, best first; an id once, with its best one."""
    order = np.argsort(-score, kind="stable")
    first = np.unique(ids[order], return_index=True)[1]
    return order[np.sort(first)[:k]]


def scan(queries: np.ndarray, rotated_q: np.ndarray, vectors: np.ndarray, blocks: list[np.ndarray], norms: np.ndarray,
         q_ids: np.ndarray, ids: np.ndarray, k: int, p: Index) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per query the number, and the positions and exact scores of its best candidates.

    ``ids`` ascend, so stable sorting gives ties to the smaller id. ``blocks`` holds the rotated vectors by columns.
    """
    dim, width = vectors.shape[1], blocks[0].shape[0]
    upto = np.cumsum([np.einsum("ij,ij->j", b, b) for b in blocks], axis=0)
    first = rotated_q[:, :width] @ blocks[0]
    for n in range(len(queries)):
        alive = np.flatnonzero(ids != q_ids[n])
        if not len(alive):
            continue
        q, partial, seen = rotated_q[n], first[n][alive], width
        q_norm = float(q @ q)
        # a sure lower bound of the k-th best: exact scores of the most promising candidates
        lead = alive if len(alive) <= 2 * k else alive[np.argpartition(-partial, 2 * k)[:2 * k]]
        top = _best(ids[lead], vectors[lead] @ queries[n], k)
        bound = (vectors[lead[top[-1]]] @ queries[n]) if len(top) == k else -np.inf
        for b in range(1, len(blocks) + 1):
            if len(alive) > 2 * k and np.isfinite(bound):
                # squared distance from the seen dimensions, scaled up, against the distance at the bound
                q_seen = float(q[:seen] @ q[:seen])
                apart = np.sqrt(np.maximum(q_seen + upto[b - 1][alive] - 2 * partial, 0) * dim / seen)
                limit = np.sqrt(np.maximum(q_norm + norms[alive] - 2 * bound, 0))
                keep = (apart <= limit * (1 + p.doubt / np.sqrt(seen))) if seen < dim else (partial >= bound - 1e-6 * (1 + abs(bound)))
                alive, partial = alive[keep], partial[keep]
            if b == len(blocks) or not len(alive):
                break
            rows = blocks[b][:, alive]
            partial = partial + q[seen:seen + len(rows)] @ rows
            seen += len(rows)
        alive = np.union1d(alive, lead)
        score = vectors[alive] @ queries[n]
        best = _best(ids[alive], score, k)
        yield n, alive[best], score[best]


def search(vectors: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vector: str = "embedding",
           p: Index = Index()) -> DataFrame:
    """``query_id``, ``rank`` (from 1), the neighbour's id under ``id_col``, and ``score``."""
    spark = vectors.sparkSession
    sound = vectors.filter(col(id_col).isNotNull() & usable(col(vector))).select(
        col(id_col).cast("long").alias("id"), F.transform(col(vector), lambda x: x.cast("double")).alias("v"),
        is_query.alias("q"))
    sound = settled(sound.groupBy("id", "v").agg(F.max("q").alias("q")))
    schema = "query_id long, rank int, vec_id long, score double"
    head = sound.agg(F.count(F.lit(1)), F.mode(F.size("v"), True)).first()
    if not head[0]:
        return spark.createDataFrame([], schema).withColumnRenamed("vec_id", id_col)
    dim = head[1]
    sound = sound.filter(F.size("v") == dim)
    rate = min(p.sample / head[0], 1.0)
    share = F.pmod(F.xxhash64("id", "v", F.lit(p.seed)), F.lit(1 << 48)) / float(1 << 48)
    sample = np.array([r[0] for r in sound.filter(share < rate).select("v").toLocalIterator()] or
                      [sound.select("v").first()[0]])
    shared = spark.sparkContext.broadcast((centroids(sample, p), rotation(dim, p.seed)))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c, _ = shared.value
        for batch in batches:
            x = np.array(list(_lists(batch.column(1)))).reshape(batch.num_rows, dim)
            near = x @ c.T
            query = batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
            probes = np.argsort(-near, axis=1, kind="stable")[:, :p.probes].astype(np.int32)
            own = np.argmax(near, axis=1).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(own),
                pa.array([row.tolist() if q else None for row, q in zip(probes, query, strict=True)], pa.list_(pa.int32()))],
                ["id", "v", "list", "probes"])

    shape = "id long, v array<double>, list int, probes array<int>"
    placed = settled(sound.select("id", "v", F.lit(False)).mapInArrow(assign, shape))
    asked = sound.filter("q").groupBy("id").agg(F.min("v").alias("v"))
    probing = settled(asked.select("id", "v", F.lit(True)).mapInArrow(assign, shape)).select(
        "id", "v", F.explode("probes").alias("list"))
    sizes = settled(placed.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / p.chunk).cast("int").alias("chunks")).join(
        probing.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / p.block).cast("int").alias("parts")), "list"))

    def slot(count: str) -> Column:
        return F.pmod(F.xxhash64("id", "v"), F.col(count)).cast("int")

    def all_of(count: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(count) - 1))

    small = F.broadcast(sizes)  # one row per list, at most ``lists``
    left = placed.select("id", "v", "list").join(small, "list").select(
        "list", slot("chunks").alias("i"), all_of("parts").alias("j"), F.lit(False).alias("query"), "id", "v")
    right = probing.join(small, "list").select(
        "list", all_of("chunks").alias("i"), slot("parts").alias("j"), F.lit(True).alias("query"), "id", "v")

    def probe(table: pa.Table) -> pa.Table:
        _, turn = shared.value
        table = table.combine_chunks().sort_by("id")
        query = table.column("query").to_numpy(zero_copy_only=False).astype(bool)
        ids = table.column("id").to_numpy()
        v = np.array(list(_lists(table.column("v").combine_chunks()))).reshape(len(ids), dim)
        out_q, out_v, out_s = [], [], []
        x, q = v[~query], v[query]
        if len(x) and len(q):
            turned = (x @ turn).T.astype(np.float64)
            blocks = [np.ascontiguousarray(turned[a:a + p.columns]) for a in range(0, dim, p.columns)]
            x_ids, q_ids = ids[~query], ids[query]
            for n, at, score in scan(q, q @ turn, x, blocks, np.einsum("ij,ij->i", x, x), q_ids, x_ids, k, p):
                out_q.append(np.full(len(at), q_ids[n]))
                out_v.append(x_ids[at])
                out_s.append(score)
        join = lambda parts, kind: pa.array(np.concatenate(parts) if parts else np.zeros(0), kind)
        return pa.table({"query_id": join(out_q, pa.int64()), "vec_id": join(out_v, pa.int64()),
                         "score": join(out_s, pa.float64())})

    found = left.union(right).groupBy("list", "i", "j").applyInArrow(probe, "query_id long, vec_id long, score double")
    # at most k rows per query and task group: the k best by (-score, id) of a bounded list; an id may be in several lists
    found = found.repartition("query_id").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = F.struct((-F.col("score")).alias("s"), F.col("vec_id").alias("v"))
    best = found.groupBy("query_id").agg(F.slice(F.array_sort(F.collect_list(order)), 1, k).alias("best"))
    return best.select("query_id", F.posexplode("best").alias("at", "hit")).select(
        "query_id", (F.col("at") + 1).alias("rank"), F.col("hit.v").alias(id_col), (-F.col("hit.s")).alias("score"))
