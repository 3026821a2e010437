"""Regression trees grown level by level over a settled table.

The table is kept in blocks of rows, each feature's values of a block side by side, so that tasks work on whole columns and
Spark moves few large records. A level costs a fixed number of scans, whatever the number of trees and open nodes: tasks route their rows to the open nodes,
add up what the level needs per node and feature, and Spark adds the tasks' sums. The driver receives one row per
node and feature (times bins), decides on the splits, and sends the grown trees to the tasks of the next level. Open nodes
beyond ``MOST_CELLS`` go in several scans, so neither side has to hold more than that.

Two split rules are offered. *Random thresholds*: per node and feature one threshold between the smallest and largest value in
the node, drawn from an md5 of seed, tree, node and feature; the best of these splits is taken. *Second order*: features are
cut into bins once, and the sums of gradients and Hessians per bin give the gain of every cut.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kairoline.session import settle

MOST_CELLS = 1_000_000  # nodes x features (x bins) of one scan
BLOCK_ROWS = 1 << 15
MARGIN_ROUNDS = 8  # rounds after which predictions so far are written down
_ALIKE = 1e-10  # relative difference below which two scores count as equal


@dataclass
class Tree:
    """Nodes in the order they were made; ``feature`` is -1 at a leaf, values at most ``cut`` go left."""

    feature: list[int] = field(default_factory=lambda: [-1])
    cut: list[float] = field(default_factory=lambda: [0.0])
    left: list[int] = field(default_factory=lambda: [-1])
    right: list[int] = field(default_factory=lambda: [-1])
    value: list[float] = field(default_factory=lambda: [0.0])
    rows: list[float] = field(default_factory=lambda: [0.0])
    gain: list[float] = field(default_factory=lambda: [0.0])
    place: list[int] = field(default_factory=lambda: [1])  # 1 for the root, 2p and 2p + 1 below p

    def split(self, node: int, feature: int, cut: float, gain: float) -> tuple[int, int]:
        children = len(self.feature), len(self.feature) + 1
        self.feature[node], self.cut[node], self.gain[node] = feature, cut, gain
        self.left[node], self.right[node] = children
        for side in (0, 1):
            for name, start in (("feature", -1), ("cut", 0.0), ("left", -1), ("right", -1), ("value", 0.0), ("rows", 0.0), ("gain", 0.0)):
                getattr(self, name).append(start)
            self.place.append(2 * self.place[node] + side)
        return children

    def arrays(self) -> tuple[np.ndarray, ...]:
        return (np.array(self.feature), np.array(self.cut, float), np.array(self.left), np.array(self.right),
                np.array(self.value, float))

    def router(self) -> tuple:
        """For ``_routed``: features, cuts and children (a leaf leads to itself), values, and the depth."""
        feature, cut, left, right, value = self.arrays()
        end, own = feature < 0, np.arange(len(feature))
        children = np.stack([np.where(end, own, left), np.where(end, own, right)], axis=1)
        return (np.where(end, 0, feature), np.where(end, np.inf, cut), children.ravel(), value, max(self.place).bit_length() - 1)


def leaves(arrays: tuple[np.ndarray, ...], x: np.ndarray) -> np.ndarray:
    """Node of every row of ``x``."""
    feature, cut, left, right, _ = arrays
    at, rows = np.zeros(len(x), np.int64), np.arange(len(x))
    while len(rows):
        node = at[rows]
        rows = rows[feature[node] >= 0]
        node = at[rows]
        at[rows] = np.where(x[rows, feature[node]] <= cut[node], left[node], right[node])
    return at


def _routed(router: tuple, x: np.ndarray) -> np.ndarray:
    """Node of every row of a block; ``x`` has one row per feature."""
    feature, cut, children, _, depth = router
    at, row, flat, start = np.zeros(x.shape[1], np.int64), np.arange(x.shape[1]), x.ravel(), feature * x.shape[1]
    for _ in range(depth):
        at = children.take(2 * at + (flat.take(start.take(at) + row) > cut.take(at)))
    return at


def _values(column: pa.Array, i: int, kind=np.float64) -> np.ndarray:
    return np.frombuffer(column[i].as_buffer(), kind)


def _each(batches: Iterator[pa.RecordBatch], p: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Features (one row each) and labels of every block."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield _values(batch.column(0), i).reshape(p, -1), _values(batch.column(1), i)


def _packed(held: Sequence[pa.RecordBatch]) -> pa.RecordBatch:
    table = pa.Table.from_batches(held)
    *columns, ids = (c.to_numpy() for c in table.columns)
    x, y = np.stack(columns[:-1]), np.ascontiguousarray(columns[-1], float)
    bad = [int((~np.isfinite(c)).sum()) for c in columns]
    return pa.RecordBatch.from_arrays([
        pa.array([x.tobytes()], pa.binary()), pa.array([y.tobytes()], pa.binary()), pa.array([len(y)]), pa.array([float(y.sum())]),
        pa.array([int(ids[0])]), pa.array([bad], pa.list_(pa.int64()))], ["x", "y", "n", "s", "id", "bad"])


def matrix(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """Settled blocks: ``x`` (features, one after the other), ``y``, rows ``n``, label sum ``s``, and the ``id`` of the first row, from
    which the others count on. Nulls, NaN and infinite values raise, with counts per column."""
    cols = [F.col(f"`{c}`").cast("double") for c in (*features, label)]
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < cores:  # the table is read once per level: cut it evenly first
        df = df.select(*[F.col(f"`{c}`") for c in dict.fromkeys((*features, label))]).repartition(cores)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            if batch.num_rows:
                held, n = [*held, batch], n + batch.num_rows
            if n >= BLOCK_ROWS:
                yield _packed(held)
                held, n = [], 0
        if n:
            yield _packed(held)

    flat = df.select(*[c.alias(f"_{i}") for i, c in enumerate(cols)], F.monotonically_increasing_id().alias("id"))
    rows = settle(flat.mapInArrow(pack, "x binary, y binary, n bigint, s double, id bigint, bad array<bigint>"))
    found = rows.agg(*[F.sum(F.col("bad")[i]) for i in range(len(cols))]).first()
    if any(found):
        where = ", ".join(f"{c} ({n})" for c, n in zip((*features, label), found, strict=True) if n)
        raise ValueError(f"nulls or values that are no finite number in {where}; impute them first")
    return rows.drop("bad")


def _mean_label(rows: DataFrame) -> float:
    total, n = rows.agg(F.sum("s"), F.sum("n")).first()
    if not n:
        raise ValueError("no rows")
    return total / n


def _drawn(*parts) -> float:
    """Uniform number in [0, 1) from an md5."""
    return int(hashlib.md5(":".join(map(str, parts)).encode()).hexdigest()[:13], 16) / float(1 << 52)


def _slots(trees: Sequence[Tree], open_nodes: Sequence[tuple[int, int]]) -> list[tuple[tuple, np.ndarray, np.ndarray]]:
    """Per tree with open nodes: its router, the number among them of each of its nodes (-1: none), and their cells."""
    of_tree: dict[int, list[int]] = {}
    for cell, (t, _) in enumerate(open_nodes):
        of_tree.setdefault(t, []).append(cell)
    out = []
    for t, cells in of_tree.items():
        number = np.full(len(trees[t].feature), -1, np.int16 if len(cells) < 1 << 15 else np.int64)  # short ones sort faster
        number[[open_nodes[c][1] for c in cells]] = np.arange(len(cells))
        out.append((trees[t].router(), number, np.array(cells)))
    return out


def _parts(items: Sequence, size: int) -> list[Sequence]:
    return [items[i:i + max(size, 1)] for i in range(0, len(items), max(size, 1))]


def _by_cell(number: np.ndarray, many: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows in order of their open nodes, where each node starts, and the nodes."""
    order = np.argsort(number, kind="stable")
    counts = np.bincount(number.astype(np.int64) + 1, minlength=many + 1)
    seen = np.flatnonzero(counts[1:])
    return order[counts[0]:], (np.cumsum(counts[1:]) - counts[1:])[seen], seen


def _ranges(rows: DataFrame, trees: Sequence[Tree], open_nodes: Sequence[tuple[int, int]], p: int, shift: float) -> dict:
    """Per open node: rows, sum and squared sum of the label, and each feature's smallest and largest value."""
    slots, n_cells = _slots(trees, open_nodes), len(open_nodes)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, high = np.full((n_cells, p), np.inf), np.full((n_cells, p), -np.inf)
        sums = np.zeros((n_cells, 3))
        for x, y in _each(batches, p):
            for router, number, cells in slots:
                order, starts, seen = _by_cell(number[_routed(router, x)], len(cells))
                if len(order):
                    at, z = cells[seen], y[order] - shift
                    for f in range(p):
                        own = x[f].take(order)
                        low[at, f] = np.minimum(low[at, f], np.minimum.reduceat(own, starts))
                        high[at, f] = np.maximum(high[at, f], np.maximum.reduceat(own, starts))
                    sums[at] += np.stack([np.add.reduceat(v, starts) for v in (np.ones(len(z)), z, z * z)], axis=1)
        used = np.flatnonzero(sums[:, 0])
        yield pa.RecordBatch.from_arrays([
            pa.array(np.repeat(used, p)), pa.array(np.tile(np.arange(p), len(used))), pa.array(low[used].ravel()),
            pa.array(high[used].ravel()), *(pa.array(np.repeat(sums[used, i], p)) for i in range(3))],
            ["cell", "f", "low", "high", "n", "s", "ss"])

    parts = rows.select("x", "y").mapInArrow(add, "cell bigint, f bigint, low double, high double, n double, s double, ss double")
    found = parts.groupBy("cell", "f").agg(F.min("low"), F.max("high"), F.sum("n"), F.sum("s"), F.sum("ss"))
    out: dict[int, tuple] = {}
    for cell, f, low, high, n, s, ss in found.collect():
        bounds = out.setdefault(cell, (n, s, ss, np.zeros(p), np.zeros(p)))
        bounds[3][f], bounds[4][f] = low, high
    return out


def _sides(rows: DataFrame, trees: Sequence[Tree], open_nodes: Sequence[tuple[int, int]], cuts: np.ndarray, shift: float) -> dict:
    """Rows and label sums left of the given thresholds (one per open node and feature; NaN: none)."""
    slots, (n_cells, p) = _slots(trees, open_nodes), cuts.shape

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, s = np.zeros((n_cells, p)), np.zeros((n_cells, p))
        for x, y in _each(batches, p):
            for router, number, cells in slots:
                own, z = number[_routed(router, x)], y - shift
                rows_in = np.flatnonzero(own >= 0)
                own, z = own[rows_in].astype(np.int64), z[rows_in]
                for f in range(p):
                    goes = np.flatnonzero(x[f].take(rows_in) <= cuts[cells, f].take(own))
                    left = own.take(goes)
                    n[cells, f] += np.bincount(left, minlength=len(cells))
                    s[cells, f] += np.bincount(left, z.take(goes), len(cells))
        c, f = np.nonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(c), pa.array(f), pa.array(n[c, f]), pa.array(s[c, f])], ["cell", "f", "n", "s"])

    parts = rows.select("x", "y").mapInArrow(add, "cell bigint, f bigint, n double, s double")
    return {(c, f): (n, s) for c, f, n, s in parts.groupBy("cell", "f").agg(F.sum("n"), F.sum("s")).collect()}


def _picked(seed: int, t: int, place: int, usable: Sequence[int], subset: int) -> list[int]:
    """The features a node may use: those with the smallest draws, in their own order."""
    if subset >= len(usable):
        return list(usable)
    return sorted(sorted(usable, key=lambda f: _drawn(seed, t, place, f, "use"))[:subset])


def extra_trees(df: DataFrame, features: Sequence[str], label: str, trees: int = 100, depth: int = 30, leaf: int = 1,
                split: int = 2, subset: int | None = None, seed: int = 42) -> list[Tree]:
    """Extremely randomised trees: every tree sees all rows; all trees grow together, two scans a level.

    A node splits if it has ``split`` rows, differing labels and a feature that varies, at the drawn threshold with the largest
    fall of squared error that leaves ``leaf`` rows on both sides; the first of equal ones wins. ``subset`` features are tried
    (all if None). The drawn number ``u`` gives the threshold ``low + u * (high - low)``.
    """
    rows = matrix(df, features, label)
    p = len(features)
    shift = _mean_label(rows)
    forest = [Tree() for _ in range(trees)]
    level = [(t, 0) for t in range(trees)]
    for d in range(depth + 1):
        below = []
        for open_nodes in _parts(level, MOST_CELLS // p):
            bounds = _ranges(rows, forest, open_nodes, p, shift)
            cuts = np.full((len(open_nodes), p), np.nan)
            for cell, (t, node) in enumerate(open_nodes):
                n, s, ss, low, high = bounds[cell]
                tree = forest[t]
                tree.value[node], tree.rows[node] = s / n + shift, n
                usable = [f for f in range(p) if low[f] < high[f]]
                if d < depth and n >= max(split, 2 * leaf) and ss - s * s / n > _ALIKE * max(ss, 1e-300) and usable:
                    for f in _picked(seed, t, tree.place[node], usable, subset or p):
                        u = _drawn(seed, t, tree.place[node], f)
                        cuts[cell, f] = min(low[f] + u * (high[f] - low[f]), np.nextafter(high[f], -np.inf))
            live = np.flatnonzero(~np.isnan(cuts).all(axis=1))
            if not len(live):
                continue
            nodes = [open_nodes[i] for i in live]
            left = _sides(rows, forest, nodes, cuts[live], shift)
            for cell, (t, node) in enumerate(nodes):
                n, s, *_ = bounds[live[cell]]
                scores = []
                for f in np.flatnonzero(~np.isnan(cuts[live[cell]])).tolist():
                    nl, sl = left.get((cell, f), (0.0, 0.0))
                    if nl >= leaf and n - nl >= leaf:
                        scores.append((sl * sl / nl + (s - sl) ** 2 / (n - nl) - s * s / n, f))
                if scores:
                    best = max(scores)[0]
                    gain, f = next(x for x in scores if x[0] >= best - _ALIKE * abs(best))
                    below += [(t, child) for child in forest[t].split(node, f, float(cuts[live[cell], f]), gain)]
        level = below
        if not level:
            break
    return forest


def bin_cuts(rows: DataFrame, p: int, bins: int) -> list[np.ndarray]:
    """Ascending cuts per feature: between all its values if it has at most ``bins``, else at its quantiles."""

    def some(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = [np.zeros(0)] * p
        for x, _ in _each(batches, p):
            seen = [np.union1d(s, x[f])[:bins + 1] if len(s) <= bins else s for f, s in enumerate(seen)]
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(p), [len(s) for s in seen])),
                                          pa.array(np.concatenate(seen))], ["f", "v"])

    few: dict[int, list[float]] = {f: [] for f in range(p)}
    distinct = rows.select("x", "y").mapInArrow(some, "f bigint, v double").distinct()
    # a task names at most bins + 1 values of a feature; more than bins in all mean quantiles
    counted = {f: n for f, n in distinct.groupBy("f").count().collect()}
    narrow = [f for f in range(p) if counted.get(f, 0) <= bins]
    for f, v in distinct.filter(F.col("f").isin(narrow)).collect():
        few[f].append(v)
    broad = [f for f in range(p) if f not in narrow]
    shares = [i / bins for i in range(1, bins)]

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x, _ in _each(batches, p):
            yield pa.RecordBatch.from_arrays([pa.array(x[f]) for f in broad], [f"x{f}" for f in broad])

    values = rows.select("x", "y").mapInArrow(opened, ", ".join(f"x{f} double" for f in broad)) if broad else rows
    quantiles = values.agg(*[F.percentile_approx(f"x{f}", shares, 40 * bins).alias(f"q{f}") for f in broad]).first() if broad else ()
    wide = dict(zip(broad, quantiles, strict=True))
    out = []
    for f in range(p):
        v = np.unique(wide[f] if f in wide else few[f])
        out.append(v if f in wide else (v[:-1] + v[1:]) / 2)
    return out


@dataclass
class Boosted:
    base: float
    trees: list[Tree]


def _histograms(rows: DataFrame, done: Sequence[tuple], tree: Tree, open_nodes: Sequence[int], p: int, bins: int,
                draw: Callable[[np.ndarray], np.ndarray] | None) -> dict[int, np.ndarray]:
    """Per open node sums of gradients and Hessians (rows) by feature and bin."""
    router, n_cells = tree.router(), len(open_nodes)
    cell_of = np.full(len(tree.feature), -1)
    cell_of[list(open_nodes)] = np.arange(n_cells)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, p, n_cells * bins))
        for batch in batches:
            for i in range(batch.num_rows):
                b, g = _binned(batch, i, p), _gradient(batch, i, done, p)
                cell = cell_of.take(_routed(router, b))
                used = cell >= 0
                if draw is not None:
                    used &= draw(batch.column(3)[i].as_py() + np.arange(len(g)))
                if not used.all():
                    used = np.flatnonzero(used)
                    b, g, cell = b[:, used], g.take(used), cell.take(used)
                start = cell * bins
                for f in range(p):
                    at = start + b[f]
                    sums[0, f] += np.bincount(at, g, n_cells * bins)
                    sums[1, f] += np.bincount(at, minlength=n_cells * bins)
        sums = sums.reshape(2, p, n_cells, bins).swapaxes(1, 2).reshape(2, -1)
        at = np.flatnonzero(sums[1])
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(sums[0, at]), pa.array(sums[1, at])], ["at", "g", "h"])

    parts = rows.mapInArrow(add, "at bigint, g double, h double")
    out = np.zeros((2, n_cells * p * bins))
    for at, g, h in parts.groupBy("at").agg(F.sum("g"), F.sum("h")).collect():
        out[:, at] = g, h
    shaped = out.reshape(2, n_cells, p, bins)
    return {node: shaped[:, i] for i, node in enumerate(open_nodes)}


def _binned(batch: pa.RecordBatch, i: int, p: int) -> np.ndarray:
    return _values(batch.column(0), i, np.int16).reshape(p, -1)


def _gradient(batch: pa.RecordBatch, i: int, done: Sequence[tuple], p: int) -> np.ndarray:
    """Prediction so far less the label: the gradient of half the squared error, whose Hessian is 1."""
    b, m = _binned(batch, i, p), _values(batch.column(2), i).copy()
    for router in done:
        m += router[3].take(_routed(router, b))
    return m - _values(batch.column(1), i)


def _hashed(ids: np.ndarray, seed: int) -> np.ndarray:
    """Uniform numbers in [0, 1) from row numbers."""
    x = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64((seed * 0xBF58476D1CE4E5B9) & ((1 << 64) - 1))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)) / float(1 << 53)


def best_cut(sums: np.ndarray, sizes: Sequence[int], ridge: float, least: float, leaf: float) -> tuple[float, int, int] | None:
    """Gain, feature and last left bin of the best cut: G^2 / (H + ridge) of both sides less that of the whole.

    The first of equal gains wins; ``leaf`` rows (Hessian) must lie on both sides, and the gain must exceed ``least``.
    """
    g, h = sums.cumsum(axis=2)
    all_g, all_h = g[0, -1], h[0, -1]
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = g ** 2 / (h + ridge) + (all_g - g) ** 2 / (all_h - h + ridge) - all_g ** 2 / (all_h + ridge)
    fits = (h >= leaf) & (all_h - h >= leaf) & (np.arange(g.shape[1]) < np.asarray(sizes)[:, None]) & (h > 0) & (all_h - h > 0)
    gain = np.where(fits, gain, -np.inf)
    best = gain.max()
    if not best > max(least, _ALIKE * (best + (all_g ** 2 / (all_h + ridge)).max())):
        return None
    f, b = np.argwhere(gain >= best - _ALIKE * abs(best))[0].tolist()
    return float(gain[f, b]), f, b


def boosted(df: DataFrame, features: Sequence[str], label: str, rounds: int = 100, depth: int = 6, rate: float = 0.3,
            ridge: float = 1.0, least_gain: float = 0.0, leaf: float = 1.0, split: int = 2, subsample: float = 1.0, bins: int = 256,
            seed: int = 42) -> Boosted:
    """Squared-error boosting by gradients and Hessians, from the mean; leaves are ``-rate * G / (H + ridge)``.

    With ``ridge`` and ``least_gain`` 0 this is plain gradient boosting. One scan a level adds up the bins of all open nodes;
    predictions of earlier rounds are recomputed from their trees and written down every ``MARGIN_ROUNDS`` rounds.
    """
    rows = matrix(df, features, label)
    p = len(features)
    base = _mean_label(rows)
    cuts = bin_cuts(rows, p, bins)
    width = max(map(len, cuts), default=0) + 1

    def block(b: bytes, y: bytes, m: bytes, first: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*(pa.array([v], pa.binary()) for v in (b, y, m)), pa.array([first])], ["b", "y", "m", "id"])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                x, y = _values(batch.column(0), i).reshape(p, -1), _values(batch.column(1), i)
                b = np.stack([np.searchsorted(c, x[f]) for f, c in enumerate(cuts)]).astype(np.int16)
                yield block(b.tobytes(), y.tobytes(), np.full(len(y), base).tobytes(), batch.column(2)[i].as_py())

    shape = "b binary, y binary, m binary, id bigint"
    rows = settle(rows.select("x", "y", "id").mapInArrow(place, shape))
    sizes = [len(c) for c in cuts]
    trees: list[Tree] = []
    done: list[tuple] = []

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                y = _values(batch.column(1), i)
                m = _gradient(batch, i, done, p) + y
                yield block(batch.column(0)[i].as_py(), y.tobytes(), m.tobytes(), batch.column(3)[i].as_py())

    for r in range(rounds):
        if len(done) == MARGIN_ROUNDS:
            rows, done = settle(rows.mapInArrow(written, shape)), []
        draw = None if subsample >= 1 else (lambda ids, r=r: _hashed(ids, seed + r) < subsample)
        binned, level = Tree(), [0]
        for _ in range(depth):
            below = []
            for open_nodes in _parts(level, MOST_CELLS // (p * width)):
                for node, sums in _histograms(rows, done, binned, open_nodes, p, width, draw).items():
                    g, h = sums[:, 0].sum(axis=1)
                    binned.rows[node], binned.value[node] = float(h), float(-rate * g / (h + ridge)) if h + ridge else 0.0
                    found = best_cut(sums, sizes, ridge, least_gain, leaf) if h >= split else None
                    if found is None:
                        continue
                    gain, f, b = found
                    for child, (cg, ch) in zip(binned.split(node, f, b, gain), (
                            sums[:, f, :b + 1].sum(axis=1), sums[:, f, b + 1:].sum(axis=1)), strict=True):
                        binned.rows[child], binned.value[child] = float(ch), float(-rate * cg / (ch + ridge))
                        below.append(child)
            level = below
            if not level:
                break
        done.append(binned.router())
        trees.append(binned)
        if len(binned.feature) == 1 and draw is None:  # nothing left to split; later rounds are the same
            break
    for tree in trees:
        tree.cut = [float(cuts[f][int(c)]) if f >= 0 else 0.0 for f, c in zip(tree.feature, tree.cut, strict=True)]
    return Boosted(base, trees)


def importances(trees: Sequence[Tree], p: int) -> np.ndarray:
    """Gain per feature, each tree's made to add up to 1, and the mean of these."""
    total = np.zeros(p)
    for tree in trees:
        own = np.zeros(p)
        for f, gain in zip(tree.feature, tree.gain, strict=True):
            if f >= 0:
                own[f] += gain
        total += own / own.sum() if own.sum() > 0 else 0
    return total / total.sum() if total.sum() > 0 else total
