"""Exact k-nearest-neighbour join with missing values.

Only the best ``k`` donors of a receiver leave a task; pairs are never emitted. Donors lie in the blocks of a k-d tree
over all coordinates. A receiver visits the block that can be nearest, then further ones by rising least distance, and stops where
that exceeds the distance of its k-th neighbour so far; the result equals a full comparison. Receivers with the same coordinates
present see donors by those alone; of donors at one place only the first ``k`` can be among the best, so only those are kept.

Donors are broadcast when a count shows that they are few, and tasks visit the blocks by themselves. Otherwise a visit is a
join on the block, in rounds of 1, 4 and all remaining blocks. Blocks are bounded in rows on both sides, so neither a dense
region nor a popular donor ends up in one task.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kairoline.operators import kdtree
from kairoline.operators.grid import with_nulls
from kairoline.session import settle

BROADCAST_CELLS = 1_000_000  # donor rows x columns: about 8 MB of doubles
BLOCK_ROWS = 20_000
MOST_BLOCKS = 100_000  # their bounding boxes are broadcast; beyond this, blocks grow instead
PLACES = kdtree.PLACES
SAMPLE = 50_000  # donors, in expectation, that the tree is built from
ROUNDS = (1, 4)  # blocks that a receiver visits in the first rounds; the last round takes all that are left
LOCAL_ROWS = 256  # donors of a block inside a task
LOCAL_GROUP = 64  # receivers that a block inside a task should serve
GATHERED_ROWS = 100_000  # receivers of a task that are matched together
MOST_PATTERNS = 64  # of present coordinates that donors are shown to; rarer ones meet all donors as they are
_PAIRS_AT_ONCE = 500_000


def _top_k(x: np.ndarray, y: np.ndarray, k: int, total: int):
    """Indices and distances of the k nearest rows of ``y`` for each row of ``x``.

    ``y`` is in tie order. Two matrix products screen candidates with a safe margin; those are
    then measured directly, so cancellation in the products does not show in the result.
    """
    mx, my = ~np.isnan(x), ~np.isnan(y)
    x0, y0 = np.where(mx, x, 0.0), np.where(my, y, 0.0)
    fx, fy = mx.astype(float), my.astype(float)
    left = np.hstack([x0 * x0, fx, -2.0 * x0])
    right = np.ascontiguousarray(np.hstack([fy, y0 * y0, y0]).T)
    fy = np.ascontiguousarray(fy.T)
    norm_x, norm_y = (x0 * x0).sum(1), (y0 * y0).sum(1).max(initial=0.0)
    groups = max(k, min(len(y), 64 * k)) if len(y) > k else 0
    cuts = np.linspace(0, len(y), groups + 1).astype(int)[:-1] if groups else None
    rows, cols, dist = [], [], []
    step = max(1, _PAIRS_AT_ONCE // max(1, len(y)))
    for a in range(0, len(x), step):
        b = slice(a, a + step)
        present = fx[b] @ fy
        square = left[b] @ right
        with np.errstate(divide="ignore", invalid="ignore"):
            square *= np.divide(total, present, out=present)
        np.copyto(square, np.inf, where=~np.isfinite(square))
        upper = np.full(len(square), np.finfo(float).max)
        if groups:
            # k groups have a member at most this far, hence at least k rows do.
            nearest_in_group = np.minimum.reduceat(square, cuts, axis=1)
            kth = np.partition(nearest_in_group, k - 1, axis=1)[:, k - 1]
            upper = np.minimum(upper, kth + 2e-12 * total * (norm_x[b] + norm_y) + 1e-8)
        i, j = np.nonzero(square <= upper[:, None])
        both = mx[b][i] & my[j]
        exact = np.where(both, x0[b][i] - y0[j], 0.0)
        d = np.round(np.sqrt(total / both.sum(1) * (exact * exact).sum(1)), PLACES)
        order = np.lexsort((j, d, i))
        i, j, d = i[order], j[order], d[order]
        rank = np.arange(len(i)) - np.searchsorted(i, np.arange(len(square)))[i]
        keep = rank < k
        rows.append(i[keep] + a)
        cols.append(j[keep])
        dist.append(d[keep])
    if not rows:
        return np.empty(0, int), np.empty(0, int), np.empty(0)
    return np.concatenate(rows), np.concatenate(cols), np.concatenate(dist)


def _matches(receivers: pd.DataFrame, donors: pd.DataFrame, rid, did, coords, k, payload, total):
    """Candidate rows for one block of receivers against donors already in tie order."""
    i, j, d, _ = LocalBlocks(donors[coords].to_numpy(float), total).nearest(
        receivers[coords].to_numpy(float), k, receivers["_bound"].to_numpy(float))
    return _named(receivers, donors, i, j, d, rid, did, payload)


def _named(receivers: pd.DataFrame, donors: pd.DataFrame, i, j, d, rid, did, payload) -> pd.DataFrame:
    out = receivers[rid].iloc[i].reset_index(drop=True)
    for c in did:
        out[f"donor_{c}"] = donors[c].to_numpy()[j]
    out[payload] = donors[payload].to_numpy()[j]
    out["distance"] = d
    return out


class LocalBlocks:
    """Donors of one task (in tie order) in blocks of a k-d tree."""

    def __init__(self, y: np.ndarray, total: int, rows: int = LOCAL_ROWS):
        self.y, self.total = y, total
        self.tree = kdtree.build(y, rows) if len(y) else None
        block = self.tree.route(y) if len(y) else np.zeros(0, int)
        order = np.argsort(block, kind="stable")
        self.members = np.split(order, np.searchsorted(block[order], np.arange(1, self.tree.leaves))) if len(y) else []
        self.boxes = kdtree.Boxes.of(y, block, len(self.members)) if len(y) else None

    def nearest(self, x: np.ndarray, k: int, bound: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        """Receiver, donor and distance of the best ``k`` of every row of ``x``, and the number of pairs compared.

        Rows that lie in one block walk the others together; a row stops where even the nearest of a block exceeds its k-th
        neighbour so far, or its ``bound``.
        """
        n, compared = len(x), 0
        if not len(self.y) or not n:
            return np.empty(0, int), np.empty(0, int), np.empty(0), 0
        best = np.full((n, k), np.inf)
        who = np.full((n, k), len(self.y))
        limit = np.full(n, np.inf) if bound is None else bound.astype(float)
        for rows in kdtree.alike(x, self.tree.route(x)):
            ahead = self.boxes.least_of_all(x[rows], self.total)
            for block in np.argsort(ahead, kind="stable").tolist():
                if not np.isfinite(ahead[block]) or ahead[block] > limit[rows].max():
                    break  # later blocks are no nearer
                on = rows[self.boxes.take(slice(block, block + 1)).least(x[rows], self.total)[:, 0] <= limit[rows]]
                if not len(on):
                    continue
                members = self.members[block]
                compared += len(on) * len(members)
                i, j, d = _top_k(x[on], self.y[members], k, self.total)
                slot = np.arange(len(i)) - np.searchsorted(i, np.arange(len(on)))[i]
                new_d, new_j = np.full((len(on), k), np.inf), np.full((len(on), k), len(self.y))
                new_d[i, slot], new_j[i, slot] = d, members[j]
                both_d, both_j = np.hstack([best[on], new_d]), np.hstack([who[on], new_j])
                first = np.lexsort((both_j, both_d), axis=1)[:, :k]
                best[on], who[on] = np.take_along_axis(both_d, first, 1), np.take_along_axis(both_j, first, 1)
                limit[on] = np.minimum(limit[on], best[on, k - 1])
        i, slot = np.nonzero(who < len(self.y))
        return i, who[i, slot], best[i, slot], compared


def _schema(receivers: DataFrame, donors: DataFrame, rid, did, payload) -> T.StructType:
    return T.StructType(
        [receivers.schema[c] for c in rid]
        + [T.StructField(f"donor_{c}", donors.schema[c].dataType) for c in did]
        + [T.StructField(payload, T.DoubleType()), T.StructField("distance", T.DoubleType())]
    )


def nearest(receivers: DataFrame, donors: DataFrame, rid: Sequence[str], did: Sequence[str],
            coords: Sequence[str], k: int, payload: str, coordinate_count: int | None = None,
            broadcast_cells: int = BROADCAST_CELLS, block_rows: int = BLOCK_ROWS, report: dict | None = None) -> DataFrame:
    """At most ``k`` rows per receiver: ids, ``donor_*`` ids, ``payload``, ``distance``, ``rank``.

    Donors with no coordinate in common with a receiver never match it. A receiver that is given
    more than once is compared once; one id with different coordinates is an error. A ``report`` receives the number of
    blocks, of rounds, and the share of all pairs that joins on blocks compared (one more job).
    """
    rid, did, coords = list(rid), list(did), list(coords)
    total = coordinate_count or len(coords)
    receivers = _once(receivers.select(*rid, *coords), rid)
    bits = [F.when(F.col(c).isNotNull() & ~F.isnan(c), F.lit(1 << i).cast("long")).otherwise(F.lit(0)) for i, c in enumerate(coords)]
    receivers = settle(receivers.withColumn("_seen", sum(bits, F.lit(0))).where("_seen <> 0"))
    found = receivers.groupBy("_seen").count().orderBy(F.desc("count"), "_seen").limit(MOST_PATTERNS + 1).collect()
    whole = (1 << len(coords)) - 1
    patterns = sorted({*[r["_seen"] for r in found[:MOST_PATTERNS]], *([whole] if len(found) > MOST_PATTERNS else [])}) or [whole]
    receivers = receivers.withColumn("_seen", F.when(F.col("_seen").isin(patterns), F.col("_seen")).otherwise(F.lit(whole)))
    # Settled, so that a mean computed anew with another last bit cannot move a donor between passes.
    donors = settle(_first_of_equal(donors.select(*did, payload, *coords), did, coords, k, payload, patterns))
    n_donors = donors.count()
    if n_donors * (len(coords) + 2) <= broadcast_cells:
        return _best(_by_broadcast(receivers, donors, rid, did, coords, k, payload, total), rid, did, k)
    return _by_blocks(receivers, donors, n_donors, rid, did, coords, k, payload, total, block_rows, report)


def _first_of_equal(donors: DataFrame, did, coords, k: int, payload: str, patterns: Sequence[int]) -> DataFrame:
    """Per pattern (bits of the coordinates that its receivers have) the donors with those coordinates only. Of donors that are
    the same then, and so equally far from these receivers, the ``k`` that come first. Spark ranks them before the shuffle
    too, so a place that many donors share does not meet in one task."""
    shown = donors.withColumn("_seen", F.explode(F.array(*[F.lit(s).cast("long") for s in patterns])))
    masked = shown.select(*did, payload, *[F.when(F.col("_seen").bitwiseAND(F.lit(1 << i).cast("long")) != 0, F.col(c)).alias(c)
                                           for i, c in enumerate(coords)], "_seen")
    order = Window.partitionBy("_seen", *coords).orderBy(*[F.col(c).asc_nulls_last() for c in did])
    return masked.withColumn("_copy", F.row_number().over(order)).where(F.col("_copy") <= k).drop("_copy")


def _best(found: DataFrame, rid, did, k: int) -> DataFrame:
    order = Window.partitionBy(*rid).orderBy("distance", *[F.col(f"donor_{c}").asc_nulls_last() for c in did])
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _once(receivers: DataFrame, rid) -> DataFrame:
    """Distinct receivers, spread by id; one shuffle serves both."""
    spread = int(receivers.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    same_id = F.count("*").over(Window.partitionBy(*rid))
    distinct = receivers.repartition(spread, *rid).dropDuplicates().withColumn("_same", same_id)
    message = F.lit(f"rows to be matched are not unique by {rid}")
    return distinct.where(F.when(F.col("_same") == 1, True).otherwise(F.raise_error(message))).drop("_same")


def _by_broadcast(receivers, donors, rid, did, coords, k, payload, total) -> DataFrame:
    spark = receivers.sparkSession
    table = donors.toPandas().sort_values(did, kind="stable").reset_index(drop=True)
    held = spark.sparkContext.broadcast(table)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kinds = {s: own for s, own in held.value.groupby("_seen")}
        blocks: dict[int, LocalBlocks] = {}
        for gathered in _gathered(batches):
            for s, some in gathered.groupby("_seen"):
                if s in kinds:
                    if s not in blocks:
                        rows = max(LOCAL_ROWS, LOCAL_GROUP * len(kinds[s]) // len(some))
                        blocks[s] = LocalBlocks(kinds[s][coords].to_numpy(float), total, rows)
                    i, j, d, _ = blocks[s].nearest(some[coords].to_numpy(float), k)
                    yield _named(some, kinds[s], i, j, d, rid, did, payload)

    return receivers.mapInPandas(run, _schema(receivers, donors, rid, did, payload))


def _gathered(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The rows of a task in fewer frames, so that more of them lie in the same block."""
    held, n = [], 0
    for batch in batches:
        held, n = [*held, batch], n + len(batch)
        if n >= GATHERED_ROWS:
            yield pd.concat(held, ignore_index=True)
            held, n = [], 0
    if n:
        yield pd.concat(held, ignore_index=True)


def _by_blocks(receivers, donors, n_donors, rid, did, coords, k, payload, total, block_rows, report) -> DataFrame:
    spark = receivers.sparkSession
    block_rows = max(block_rows, n_donors // MOST_BLOCKS)
    share = F.pmod(F.xxhash64(*did), F.lit(1 << 40)) / float(1 << 40)
    some = donors.where(share < F.lit(min(1.0, SAMPLE / n_donors))).select(*coords, "_seen").toPandas()
    sampled = {s: own[coords].to_numpy(float) for s, own in some.groupby("_seen")}
    kinds = [r["_seen"] for r in donors.select("_seen").distinct().collect()]  # at most MOST_PATTERNS + 1
    tree = kdtree.Forest({s: kdtree.build(sampled.get(s, np.zeros((1, len(coords)))), max(1, int(block_rows * len(some) / n_donors)))
                          for s in sorted(kinds)})
    kept = T.StructType([*donors.schema.fields, T.StructField("_leaf", T.LongType())])

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(_leaf=tree.route(batch[coords].to_numpy(float), batch["_seen"].to_numpy()))

    tagged = donors.mapInPandas(place, kept)
    sizes = tagged.groupBy("_leaf").agg(F.count("*").alias("_size"))
    # Rows that no coordinate tells apart are cut further by a hash of the donor id.
    tagged = settle(tagged.join(F.broadcast(sizes), "_leaf").withColumn(
        "_sub", F.pmod(F.xxhash64(*did), F.ceil(F.col("_size") / F.lit(block_rows)))).drop("_size"))
    bounds = tagged.groupBy("_leaf", "_sub").agg(
        F.count("*").alias("_n"), *[f(F.when(~F.isnan(c), F.col(c))).alias(f"{c}_{end}") for c in coords for f, end in (
            (F.min, "lo"), (F.max, "hi"), (F.count, "seen"))]).toPandas()  # one row per block of about ``block_rows`` donors
    bounds["_block"] = np.arange(len(bounds))
    ends = {end: bounds[[f"{c}_{end}" for c in coords]].to_numpy(float) for end in ("lo", "hi", "seen")}
    boxes = kdtree.Boxes(ends["lo"], ends["hi"], ends["seen"] == bounds[["_n"]].to_numpy(), ends["seen"] > 0)
    block_ids = spark.createDataFrame(bounds[["_leaf", "_sub", "_block", "_n"]].astype("int64"))
    blocked = tagged.join(F.broadcast(block_ids.drop("_n")), ["_leaf", "_sub"]).drop("_leaf", "_sub")
    held = spark.sparkContext.broadcast(boxes)
    kind = tree.kind[bounds["_leaf"].to_numpy()]
    of_kind = {s: np.flatnonzero(kind == s) for s in sorted(kinds)}  # their blocks
    receivers = receivers.where(F.col("_seen").isin(kinds))
    route = T.StructType([*receivers.schema.fields, T.StructField("_bound", T.DoubleType()), T.StructField("_block", T.LongType())])

    def visits(first: int, last: int | None):
        """Blocks number ``first`` to ``last`` by rising least distance, as far as that is within the bound."""
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            all_boxes = held.value
            for frame in _gathered(batches):
                x, bound, seen = frame[coords].to_numpy(float), frame["_bound"].to_numpy(float), frame["_seen"].to_numpy()
                for group in kdtree.alike(x, tree.route(x, seen)):
                    own = of_kind[seen[group[0]]]
                    kind_boxes = all_boxes.take(own)
                    ahead = kind_boxes.least_of_all(x[group], total)
                    reach = bound[group].max()
                    if not first:  # the nearest block of a row is no farther than this one
                        nearest = int(ahead.argmin())
                        reach = kind_boxes.take(slice(nearest, nearest + 1)).least(x[group], total).max()
                    near_all = np.flatnonzero(np.isfinite(ahead) & (ahead <= reach))
                    if len(near_all) <= first:
                        continue
                    boxes, near_all = kind_boxes.take(near_all), own[near_all]
                    size = max(1, 4 * _PAIRS_AT_ONCE // len(near_all))
                    for a in range(0, len(group), size):
                        rows = group[a:a + size]
                        least = boxes.least(x[rows], total)
                        order = np.argsort(least, axis=1, kind="stable")[:, first:last]
                        near = np.take_along_axis(least, order, 1)
                        i, j = np.nonzero(np.isfinite(near) & (near <= bound[rows, None]))
                        if len(i):
                            yield frame.iloc[rows[i]][[*rid, *coords, "_seen", "_bound"]].reset_index(drop=True).assign(_block=near_all[order[i, j]].astype("int64"))
        return run

    out_schema = _schema(receivers, donors, rid, did, payload)
    most = max(map(len, of_kind.values()), default=0)

    def visit(placed: DataFrame) -> DataFrame:
        """Compare receivers with the donors of their block, both sides bounded in rows."""
        load = placed.groupBy("_block").agg(
            F.ceil(F.count("*") / F.lit(block_rows)).cast("int").alias("_lanes"))
        left = placed.join(F.broadcast(load), "_block").withColumn(
            "_lane", F.pmod(F.xxhash64(*rid), F.col("_lanes")).cast("int")).drop("_lanes")
        right = blocked.join(F.broadcast(load), "_block").withColumn(
            "_lane", F.explode(F.sequence(F.lit(0), F.col("_lanes") - 1))).drop("_lanes")

        def compare(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
            b = b.sort_values(did, kind="stable")
            return _matches(a, b, rid, did, coords, k, payload, total)

        return left.groupBy("_block", "_lane").cogroup(right.groupBy("_block", "_lane")).applyInPandas(
            compare, out_schema)

    best, first, compared, rounds = None, 0, 0, 0
    for size in (*ROUNDS, None):
        if best is None:
            asked = receivers.withColumn("_bound", F.lit(float("inf")))
        else:
            kth = best.groupBy(*rid).agg(F.count("*").alias("_got"), F.max("distance").alias("_far"))
            bound = F.when(F.col("_got") >= k, F.col("_far")).otherwise(F.lit(float("inf")))
            asked = with_nulls(receivers, kth, rid, how="left").select(
                *rid, *coords, "_seen", F.coalesce(bound, F.lit(float("inf"))).alias("_bound"))
        placed = settle(asked.mapInPandas(visits(first, None if size is None else first + size), route))
        first += size or 0
        if placed.isEmpty():
            break
        rounds += 1
        if report is not None:
            compared += placed.groupBy("_block").count().join(F.broadcast(block_ids), "_block").agg(
                F.sum(F.col("count") * F.col("_n"))).first()[0]
        found = visit(placed)
        best = settle(_best(found if best is None else found.unionByName(best.drop("rank")), rid, did, k))
        if first >= most:
            break
    if report is not None:
        report.update(blocks=len(bounds), rounds=rounds, visited=compared / max(1, n_donors * receivers.count()))
    if best is None:
        return _best(spark.createDataFrame([], out_schema), rid, did, k)
    return best
