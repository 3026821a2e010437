"""Scans over null and very long series, fills of whole grid rows, and series models in the search."""

from __future__ import annotations

import datetime as dt
import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from kairoline.operators import arima, fill, impute, order
from kairoline.plans import presets, search
from kairoline.plans.regressors import build

START = dt.datetime(2024, 1, 1)


def panel(spark, n=60, seed=4, series=("a", "b", None)):
    rnd = random.Random(seed)
    rows = [(s, START + dt.timedelta(hours=3 * i), None if rnd.random() < 0.4 else rnd.gauss(0, 5) + i, None if rnd.random() < 0.4 else float(i))
            for s in series for i in range(n)]
    return spark.createDataFrame(rows, "s string, t timestamp_ntz, v double, w double").repartition(5), rows


def frames(rows):
    out = {}
    for s, t, v, w in rows:
        out.setdefault(s, []).append((t, v, w))
    return {s: pd.DataFrame(r, columns=["t", "v", "w"]).set_index("t").astype(float) for s, r in out.items()}


@pytest.mark.parametrize("steps", [2, 3, 4096])
def test_scans_keep_null_series_and_cross_both_levels_of_cuts(spark, steps):
    df, rows = panel(spark)
    want = frames(rows)

    def same(found, column, expected):
        got = {}
        for r in found.collect():
            got.setdefault(r["s"], {})[r["t"]] = r[column]
        assert got.keys() == want.keys()
        for s, table in got.items():
            assert [x if x is None else round(x, 9) for _, x in sorted(table.items())] == [
                None if math.isnan(x) else round(x, 9) for x in expected(want[s])]

    same(fill.forward_fill(df, ["s"], "t", "v", "o", steps=steps), "o", lambda x: x["v"].ffill())
    same(fill.backward_fill(df, ["s"], "t", "v", "o", steps=steps), "o", lambda x: x["v"].bfill())
    same(fill.linear_fill(df, ["s"], "t", "v", "o", steps=steps), "o", lambda x: x["v"].interpolate())
    same(order.previous(df, ["s"], "t", "v", "o", steps=steps), "o", lambda x: x["v"].shift())
    same(order.running_sum(df, ["s"], "t", "w", "o", steps=steps), "o", lambda x: x["w"].fillna(0).cumsum())
    one = df.filter("s = 'a'").drop("s").withColumn("s", F.lit("a"))
    assert order.running_sum(one, [], "t", "w", "o", steps=steps).agg(F.max("o")).first()[0] == want["a"]["w"].sum()


@pytest.mark.parametrize("mode", fill.MODES)
@pytest.mark.parametrize("steps", [3, 4096])
def test_grid_rows_are_filled_in_all_columns(spark, mode, steps):
    df, rows = panel(spark, 40)
    rnd = random.Random(1)
    gone = {t for _, t, *_ in rows if rnd.random() < 0.3 and t not in (START, START + dt.timedelta(hours=3 * 39))}
    got = {}
    kw = {} if mode == "zero" else {"steps": steps}
    for r in fill.regularise_and_fill(df.filter(~F.col("t").isin(list(gone))), ["s"], "t", ["v", "w"], mode, **kw).collect():
        got.setdefault(r["s"], []).append((r["t"], r["v"], r["w"]))
    for s, x in frames(rows).items():
        x = x[[t.to_pydatetime() not in gone for t in x.index]].asfreq("3h")
        empty = x.isna().all(axis=1)
        filled = {"interpolate": x.interpolate(), "ffill": x.ffill(), "bfill": x.bfill(), "zero": x.fillna(0)}[mode]
        x.loc[empty] = filled.loc[empty]
        mine = pd.DataFrame(sorted(got[s]), columns=["t", "v", "w"]).set_index("t").astype(float)
        assert list(mine.index) == list(x.index) and np.allclose(mine, x, equal_nan=True)
    with pytest.raises(ValueError, match="unknown fill mode"):
        fill.regularise_and_fill(df, ["s"], "t", ["v"], "nearest")


def test_interpolation_and_neighbours_impute_null_series(spark):
    df, rows = panel(spark)
    out = impute.impute_interpolate(df, ["s"], "t", "v", "o")
    assert out.count() == len(rows) and out.filter("o is null").count() == 0
    near = impute.impute_knn(df, "t", "v", "o", ["s", "t"], ["v", "w"]).filter("s is null and v is null")
    mean = df.agg(F.avg("v")).first()[0]
    found = near.collect()
    assert found and not any(abs(r["o"] - mean) < 1e-9 for r in found)


def plain_cv(rows, kind, k, order_of):
    """Folds by position over all series; fits and forecasts in plain numpy."""
    rows = sorted((r for r in rows), key=lambda r: (r[1], r[0] is not None, r[0] or ""))
    n, size = len(rows), len(rows) // (k + 1)
    out = []
    for f in range(k):
        cut = n - (k - f) * size
        errors = []
        for s in {r[0] for r in rows}:
            train = [(t, v) for i, (x, t, v) in enumerate(rows) if x == s and i < cut]
            test = [(t, v) for i, (x, t, v) in enumerate(rows) if x == s and cut <= i < cut + size]
            y = np.array([v for _, v in train])
            d = np.diff(y) if order_of else y
            if kind == "AR":
                phi = ((d[1:] - d[1:].mean()) * (d[:-1] - d[:-1].mean())).sum() / ((d[:-1] - d[:-1].mean()) ** 2).sum()
                const, e = d[1:].mean() - phi * d[:-1].mean(), 0.0
            else:
                const, c = d.mean(), d - d.mean()
                r = (c[1:] * c[:-1]).sum() / (c * c).sum()
                phi, e = math.copysign(1, r) if abs(r) >= 0.5 else (1 - math.sqrt(1 - 4 * r * r)) / (2 * r), 0.0
                for x in c:
                    e = x - phi * e
            last, step = y[-1], d[-1]
            for h, (_, v) in enumerate(test, 1):
                step = const + phi * step if kind == "AR" else const + (phi * e if h == 1 else 0)
                last = last + step if order_of else step
                errors.append(last - v)
        out.append(math.sqrt(np.mean(np.square(errors))))
    return out


@pytest.mark.parametrize("kind,order_of", [("AR", 1), ("MA", 1), ("MA1", 0), ("AR", 0)])
def test_series_models_in_the_search(spark, kind, order_of):
    rnd, rows = random.Random(8), []
    for s in ("a", "b", None):
        v = 0.0
        for i in range(80):
            v = 0.6 * v + rnd.gauss(1, 2)
            rows.append((s, START + dt.timedelta(hours=3 * i), v))
    df = spark.createDataFrame(rows, "s string, time timestamp_ntz, y double").repartition(4)
    folds = search.make_folds(df, ["time", "s"], [], "y", 3, series=["s"])
    found = search.search(folds, search.Candidate(kind, {"difference_order": order_of}), tuning=False)
    want = plain_cv(rows, kind, 3, order_of)
    assert np.allclose(search.fold_errors(folds, found.candidate), want) and abs(found.cv_rmse - np.mean(want)) < 1e-9
    folds.release()


def test_series_model_saves_and_forecasts(spark, tmp_path):
    rows = [("a", START + dt.timedelta(hours=3 * i), float(v)) for i, v in enumerate([1, 3, 2, 5, 4, 7, 5, 9])]
    df = spark.createDataFrame(rows, "s string, time timestamp_ntz, y double")
    model = Pipeline(stages=build("AR", presets.ARIMA[1].params, [], "y", (), ["s"])).fit(df)
    model.write().save(str(tmp_path / "m"))
    ahead = spark.createDataFrame([("a", START + dt.timedelta(hours=3 * (7 + h)), h) for h in range(4)] + [("x", START, 9)],
                                  "s string, time timestamp_ntz, h int")
    got = {r["h"]: r["prediction"] for r in PipelineModel.load(str(tmp_path / "m")).transform(ahead).collect()}
    changes = arima.lagged_changes(df, ["s"], "time", "y")
    want = {r["h"]: r["forecast"] for r in arima.forecast_ar1(changes, arima.fit_ar1(changes, ["s"]), ["s"], "time", "y", 3).collect()}
    assert got[0] is None and got[9] is None and all(abs(got[h] - want[h]) < 1e-9 for h in (1, 2, 3))


def test_orders_that_are_not_offered_are_refused(spark):
    for params in ({"AR_order": 2}, {"MA_order": 1}, {"difference_order": 2}):
        with pytest.raises(ValueError, match="AR takes"):
            build("AR", params, [], "y")


def test_one_neighbour_join_per_fold(spark, monkeypatch):
    from kairoline.operators import knn

    rnd = random.Random(2)
    rows = [(i, rnd.random(), rnd.random() * 100, rnd.random()) for i in range(120)]
    df = spark.createDataFrame(rows, "i long, a double, b double, y double")
    folds = search.make_folds(df, ["i"], ["a", "b"], "y", 3)
    c = search.Candidate("KNeighborsRegressor", {}, True, {"n_neighbors": [1, 4], "weights": ["uniform", "distance"]})
    calls, nearest = [], knn.nearest
    monkeypatch.setattr(knn, "nearest", lambda *a, **k: calls.append(1) or nearest(*a, **k))
    found = search.search(folds, c, search_type="grid")
    assert len(calls) == 3 and len(found.tried) == 4
    for params, score in found.tried:
        assert abs(np.mean(search.fitted_fold_errors(folds, c, params)) - score) < 1e-9
    with pytest.raises(ValueError, match="does not take"):
        search.neighbour_fold_errors(folds, c, [{"radius": 1}])
    folds.release()
