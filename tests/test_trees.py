"""Grown trees against a plain recursive version."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from kairoline.operators import trees
from kairoline.plans.grown import GrownTreesModel
from kairoline.plans.regressors import build

NAMES = ["a", "b", "c"]


def table(spark, n=300, seed=1):
    rnd = random.Random(seed)
    rows = [(rnd.choice([0.0, 1.0, 2.5, 4.0]), rnd.random() * 10, float(rnd.randint(0, 40))) for _ in range(n)]
    rows = [(*r, 3 * r[0] - (r[1] > 5) * 7 + r[2] / 10 + rnd.gauss(0, 0.1)) for r in rows]
    return spark.createDataFrame(rows, "a double, b double, c double, y double").repartition(4), np.array(rows)


def plain_extra(x, y, shift, t, place, d, depth, leaf, split, subset, seed):
    n, z = len(y), y - shift
    usable = [f for f in range(x.shape[1]) if n and x[:, f].min() < x[:, f].max()]
    if d == depth or n < max(split, 2 * leaf) or z.var() < 1e-9 or not usable:
        return {place: y.mean()}
    if subset < len(usable):
        usable = sorted(sorted(usable, key=lambda f: trees._drawn(seed, t, place, f, "use"))[:subset])
    best = None
    for f in usable:
        cut = x[:, f].min() + trees._drawn(seed, t, place, f) * (x[:, f].max() - x[:, f].min())
        goes = x[:, f] <= cut
        if leaf <= goes.sum() <= n - leaf:
            gain = z[goes].sum() ** 2 / goes.sum() + z[~goes].sum() ** 2 / (~goes).sum() - z.sum() ** 2 / n
            if best is None or gain > best[0] + 1e-9:
                best = gain, goes
    if best is None:
        return {place: y.mean()}
    out = {}
    for side, rows in ((0, best[1]), (1, ~best[1])):
        out |= plain_extra(x[rows], y[rows], shift, t, 2 * place + side, d + 1, depth, leaf, split, subset, seed)
    return out


@pytest.mark.parametrize("options", [{}, {"leaf": 20}, {"split": 60, "subset": 1}])
def test_extra_trees_equal_plain(spark, monkeypatch, options):
    monkeypatch.setattr(trees, "MOST_CELLS", 5)  # several scans per level
    df, rows = table(spark)
    found = trees.extra_trees(df, NAMES, "y", trees=2, depth=3, seed=5, **options)
    o = {"leaf": 1, "split": 2, "subset": 3, **options}
    for t, tree in enumerate(found):
        want = plain_extra(rows[:, :3], rows[:, 3], rows[:, 3].mean(), t, 1, 0, 3, o["leaf"], o["split"], o["subset"], 5)
        got = {p: v for p, v, f in zip(tree.place, tree.value, tree.feature) if f < 0}
        assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in got)


def plain_boost(x, y, rounds, depth, rate, ridge, least, leaf):
    m = np.full(len(y), y.mean())

    def grow(rows, d):
        g, h = (m - y)[rows].sum(), len(rows)
        best = None
        if d < depth:
            for f in range(x.shape[1]):
                for v in np.unique(x[rows, f])[:-1]:
                    go = rows[x[rows, f] <= v]
                    gl, hl = (m - y)[go].sum(), len(go)
                    gain = gl**2 / (hl + ridge) + (g - gl) ** 2 / (h - hl + ridge) - g**2 / (h + ridge)
                    if leaf <= hl <= h - leaf and gain > max(least, 1e-9) and (best is None or gain > best[0] + 1e-9):
                        best = gain, go
        if best is None:
            add[rows] = -rate * g / (h + ridge)
            return
        grow(best[1], d + 1)
        grow(np.setdiff1d(rows, best[1]), d + 1)

    for _ in range(rounds):
        add = np.zeros(len(y))
        grow(np.arange(len(y)), 0)
        m = m + add
    return m


@pytest.mark.parametrize("options", [{"ridge": 1.0}, {"ridge": 0.0, "leaf": 25}, {"ridge": 2.0, "least_gain": 60.0}])
def test_boosting_equals_plain(spark, monkeypatch, options):
    monkeypatch.setattr(trees, "MARGIN_ROUNDS", 2)
    df, rows = table(spark, 200)
    df, x = df.withColumn("b", F.floor("b").cast("double")), rows[:, :3].copy()
    x[:, 1] = np.floor(x[:, 1])
    found = trees.boosted(df, NAMES, "y", rounds=5, depth=3, rate=0.3, **options)
    m = np.full(len(x), found.base)
    for tree in found.trees:
        a = tree.arrays()
        m += a[4][trees.leaves(a, x)]
    want = plain_boost(x, rows[:, 3], 5, 3, 0.3, options["ridge"], options.get("least_gain", 0.0), options.get("leaf", 1.0))
    assert np.abs(m - want).max() < 1e-8


def test_quantile_bins_and_subsample(spark):
    df, rows = table(spark, 2000, 3)
    cuts = trees.bin_cuts(trees.matrix(df, NAMES, "y"), 3, 16)
    assert len(cuts[0]) == 3 and len(cuts[1]) <= 15 and np.all(np.diff(cuts[1]) > 0)
    share = np.searchsorted(np.sort(rows[:, 1]), cuts[1]) / 2000
    assert np.abs(share - np.arange(1, 16) / 16).max() < 0.01
    full = trees.boosted(df, NAMES, "y", rounds=20, depth=3, rate=0.3, bins=16)
    part = trees.boosted(df, NAMES, "y", rounds=20, depth=3, rate=0.3, bins=16, subsample=0.5)
    for found in (full, part):
        m = found.base + sum(t.arrays()[4][trees.leaves(t.arrays(), rows[:, :3])] for t in found.trees)
        assert np.sqrt(((m - rows[:, 3]) ** 2).mean()) < 0.8 < rows[:, 3].std()
    assert 800 < part.trees[0].rows[0] < 1200 and full.trees[0].rows[0] == 2000


@pytest.mark.parametrize("kind", ["ExtraTreesRegressor", "GradientBoostingRegressor", "XGBRegressor"])
def test_model_saves_predicts_and_ranks(spark, tmp_path, kind):
    df, _ = table(spark)
    stage = build(kind, {"n_estimators": 4, "max_depth": 3}, NAMES, "y")[0]
    model = stage.fit(df)
    model.write().save(str(tmp_path / "m"))
    again = GrownTreesModel.load(str(tmp_path / "m"))
    asked = df.limit(20).union(spark.createDataFrame([(None, 1.0, 1.0, 0.0)], df.schema))
    one, two = ([r["prediction"] for r in m.transform(asked).collect()] for m in (model, again))
    assert one == two and one[-1] is None and None not in one[:-1]
    weights = again.featureImportances.toArray()
    assert abs(weights.sum() - 1) < 1e-9 and weights.argmax() == 0


def test_unusable_input_is_refused_and_constant_labels_give_one_leaf(spark):
    df, _ = table(spark, 30)
    for bad in (None, float("nan"), float("inf")):
        with pytest.raises(ValueError, match=r"b \(30\)"):
            trees.boosted(df.withColumn("b", F.lit(bad).cast("double")), NAMES, "y", rounds=1)
    with pytest.raises(ValueError, match="no rows"):
        trees.extra_trees(df.limit(0), NAMES, "y", trees=1)
    flat = df.withColumn("y", F.lit(3.0))
    assert trees.extra_trees(flat, NAMES, "y", trees=1)[0].value == [3.0]
    found = trees.boosted(flat, NAMES, "y", rounds=5)
    assert found.base == 3.0 and all(abs(v) < 1e-12 for t in found.trees for v in t.value)


def test_blocks_hold_all_rows_and_their_numbers(spark, monkeypatch):
    monkeypatch.setattr(trees, "BLOCK_ROWS", 64)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    try:
        df, rows = table(spark, 3000)
        found = trees.matrix(df.repartition(8), NAMES, "y").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sum(r["n"] for r in found) == 3000 and 24 < len(found) < 60
    x = np.concatenate([np.frombuffer(r["x"]).reshape(3, -1) for r in found], axis=1)
    y = np.concatenate([np.frombuffer(r["y"]) for r in found])
    assert sorted(zip(*x, y)) == sorted(map(tuple, rows))
    ids = np.concatenate([r["id"] + np.arange(r["n"]) for r in found])
    assert len(np.unique(ids)) == 3000


def test_adaboost_writes_no_weights_after_its_last_round(spark, monkeypatch):
    from pyspark.ml import Pipeline

    from kairoline.plans import regressors

    written, settle = [], regressors.settle
    monkeypatch.setattr(regressors, "settle", lambda df: written.append(1) or settle(df))
    df, _ = table(spark)
    model = Pipeline(stages=build("AdaBoostRegressor", {"n_estimators": 3, "max_depth": 2}, NAMES, "y")).fit(df)
    assert len(model.stages[-1].trees) == 3 and len(written) == 3
