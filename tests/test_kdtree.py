"""Neighbour joins over a k-d tree: exact with missing values, and visiting few blocks where space allows it."""

from __future__ import annotations

import numpy as np
import pytest

from kairoline.operators import kdtree, knn

COLS = [f"c{i}" for i in range(12)]


def clouds(n, m, seed=2):
    """Twelve coordinates around few centres; no column is complete."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, 12)) * 40
    y = centres[rng.integers(0, 12, n)] + rng.normal(size=(n, 12))
    x = centres[rng.integers(0, 12, m)] + rng.normal(size=(m, 12))
    for table in (x, y):
        table[rng.random(table.shape) < 0.1] = np.nan
    y[: n // 3] = y[0]  # one donor makes a third of all
    y[5], x[3] = np.nan, np.nan
    return x, y


def plain(x, y, k, total):
    out = []
    for r in x:
        both = ~np.isnan(r) & ~np.isnan(y)
        n = both.sum(1)
        with np.errstate(divide="ignore", invalid="ignore"):
            d = np.round(np.sqrt(total / n * np.where(both, (r - y) ** 2, 0).sum(1)), knn.PLACES)
        order = np.lexsort((np.arange(len(y)), d))
        out.append([(d[j], j) for j in order if n[j] > 0][:k])
    return out


@pytest.mark.parametrize("limits", [{}, {"broadcast_cells": 0, "block_rows": 60}, {"broadcast_cells": 0, "block_rows": 5000}])
def test_twelve_coordinates_none_complete(spark, limits):
    x, y = clouds(900, 80)

    def frame(z):
        return spark.createDataFrame([(i, float(i), *[None if np.isnan(v) else float(v) for v in r]) for i, r in enumerate(z)],
                                     "id long, p double, " + ", ".join(f"{c} double" for c in COLS)).repartition(3)

    report: dict = {}
    got = {}
    for r in knn.nearest(frame(x), frame(y), ["id"], ["id"], COLS, 4, "p", 13, report=report, **limits).collect():
        got.setdefault(r["id"], []).append((r["rank"], r["distance"], r["donor_id"]))
    for i, want in enumerate(plain(x, y, 4, 13)):
        assert [(d, j) for _, d, j in sorted(got.get(i, []))] == want
    if limits.get("block_rows") == 60:
        assert report["blocks"] >= 15 and 0 < report["visited"] < 0.7


def test_few_pairs_are_compared_inside_a_task():
    rng = np.random.default_rng(1)
    x, y = rng.random((300, 3)), rng.random((20_000, 3))
    y[rng.random(y.shape) < 0.2] = np.nan
    blocks = knn.LocalBlocks(y, 3, 200)
    i, j, d, compared = blocks.nearest(x, 5)
    want = plain(x, y, 5, 3)
    assert [list(zip(d[i == r], j[i == r])) for r in range(300)] == want
    assert compared < 0.35 * 300 * 20_000


def test_tree_parts_missing_rows_and_stops_at_equal_ones():
    x = np.array([[1.0, np.nan], [1.0, 2.0], [1.0, np.nan], [1.0, 3.0]] * 5)
    tree = kdtree.build(x, 2)
    leaf = tree.route(x)
    assert tree.leaves == 3 and len({*leaf[np.isnan(x[:, 1])]}) == 1 and len({*leaf}) == 3
    boxes = kdtree.Boxes.of(x, leaf, tree.leaves)
    assert boxes.least(np.array([[1.0, 9.0], [np.nan, np.nan]]), 2)[1].tolist() == [np.inf] * 3
    assert kdtree.build(np.ones((50, 2)), 3).leaves == 1
    ramp = np.arange(64.0).reshape(-1, 1)
    assert kdtree.build(ramp, 8).leaves == 8


@pytest.mark.parametrize("most", [64, 1])
def test_donors_are_few_per_pattern_of_present_coordinates(spark, monkeypatch, most):
    """Most donors differ only in coordinates that the receivers lack: they are equally far, and only the first can be near."""
    monkeypatch.setattr(knn, "MOST_PATTERNS", most)
    rng = np.random.default_rng(4)
    y = np.round(rng.random((600, 3)) * [1, 90, 90], 2)
    y[:, 0] = rng.integers(0, 3, 600)
    y[::7, 1] = np.nan
    x = np.full((40, 3), np.nan)
    x[:, 0] = rng.integers(0, 3, 40)
    x[::4, 1] = np.round(rng.random(10) * 90, 2)

    def frame(z, parts):
        return spark.createDataFrame([(i, float(i), *[None if np.isnan(v) else float(v) for v in r]) for i, r in enumerate(z)],
                                     "id long, p double, c0 double, c1 double, c2 double").repartition(parts)

    kept, first = [], knn._first_of_equal
    monkeypatch.setattr(knn, "_first_of_equal", lambda *a: kept.append(first(*a)) or kept[-1])
    for limits in ({}, {"broadcast_cells": 0, "block_rows": 30}):
        got: dict = {}
        for r in knn.nearest(frame(x, 2), frame(y, 3), ["id"], ["id"], COLS[:3], 4, "p", **limits).collect():
            got.setdefault(r["id"], []).append((r["rank"], r["distance"], r["donor_id"]))
        for i, want in enumerate(plain(x, y, 4, 3)):
            assert [(d, j) for _, d, j in sorted(got.get(i, []))] == want
    if most == 64:
        assert kept[0].groupBy("_seen").count().where("_seen = 1").first()["count"] == 3 * 4
