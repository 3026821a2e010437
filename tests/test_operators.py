"""Operators against brute force on small fixtures, with the paths for large input forced."""

import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from kairoline.functions import calendar, scalars
from kairoline.operators import (arima, attribution, autocorr, contract, fill, gram, grid, impute, knn, order, profile,
                                 quantiles, rank, scale, split)
from kairoline.operators.contract import Field

T0 = dt.datetime(2023, 1, 1)


def at(i, hours=3):
    return T0 + dt.timedelta(hours=i * hours)


def series(spark, values, hours=3, name="v"):
    return spark.createDataFrame([(at(i, hours), None if v is None else float(v)) for i, v in enumerate(values)], f"t timestamp_ntz, {name} double")


@pytest.fixture(scope="module")
def gaps(spark):
    """Two series with gaps that cross stretch cuts; one of them holds most rows."""
    rng = np.random.default_rng(1)
    rows = []
    for s, n in (("hot", 90), ("cold", 20)):
        v = rng.normal(size=n).round(3)
        missing = rng.random(n) < 0.5
        missing[30:48] = True
        rows += [(s, at(i), None if m else float(x)) for i, (x, m) in enumerate(zip(v, missing))]
    return spark.createDataFrame(rows, "s string, t timestamp_ntz, v double").cache()


def by_series(df, col):
    pdf = df.toPandas().sort_values(["s", "t"])
    return {s: g[col].tolist() for s, g in pdf.groupby("s")}


def same(a, b):
    return all((x is None or x != x) and (y is None or y != y) or x == pytest.approx(y, abs=1e-9) for x, y in zip(a, b)) and len(a) == len(b)


@pytest.mark.parametrize("steps", [5, 7, 4096])
def test_fills_across_stretches(gaps, steps):
    pdf = gaps.toPandas().sort_values(["s", "t"])
    fwd = by_series(fill.forward_fill(gaps, ["s"], "t", "v", "o", steps=steps), "o")
    bwd = by_series(fill.backward_fill(gaps, ["s"], "t", "v", "o", steps=steps), "o")
    lin = by_series(fill.linear_fill(gaps, ["s"], "t", "v", "o", steps=steps), "o")
    for s, g in pdf.groupby("s"):
        assert same(fwd[s], g["v"].ffill().tolist())
        assert same(bwd[s], g["v"].bfill().tolist())
        assert same(lin[s], g["v"].interpolate().tolist())


@pytest.mark.parametrize("steps", [5, 4096])
def test_interpolation_respects_gap_length(gaps, steps):
    out = by_series(fill.interpolate(gaps, ["s"], "t", "v", "o", max_gap=9, steps=steps), "o")
    for s, g in gaps.toPandas().sort_values(["s", "t"]).groupby("s"):
        v = g["v"]
        run = v.isna().groupby(v.notna().cumsum()).transform("sum")
        want = v.interpolate(limit_area="inside").where(v.notna() | (run * 3 <= 9))
        assert same(out[s], want.tolist())


@pytest.mark.parametrize("steps", [4, 4096])
def test_lag_and_running_sum(gaps, steps):
    lag = by_series(order.previous(gaps, ["s"], "t", "v", "o", steps=steps), "o")
    run = by_series(order.running_sum(gaps, ["s"], "t", "v", "o", steps=steps), "o")
    for s, g in gaps.toPandas().sort_values(["s", "t"]).groupby("s"):
        assert same(lag[s], g["v"].shift(1).tolist())
        assert same(run[s], g["v"].fillna(0).cumsum().tolist())


def test_gap_islands(spark):
    df = series(spark, [1, None, None, 2, None, 3, None]).withColumn("s", F.lit("a"))
    rows = fill.gap_islands(df, ["s"], "t", "v", steps=2).orderBy("gap_start").collect()
    assert [(r["gap_start"], r["gap_steps"]) for r in rows] == [(at(1), 2), (at(4), 1)]


def test_difference_inverts(spark):
    df = series(spark, list(np.random.default_rng(0).normal(size=40)), name="y")
    d = arima.difference(df, [], "t", "y", "d").select("t", "d")
    back = arima.undifference(d, df.agg(F.min_by("y", "t").alias("start")), [], "t", "d", "y2")
    joined = df.join(back, "t").toPandas()
    assert len(joined) == 39 and np.allclose(joined["y"], joined["y2"])


def test_quantile_paths_agree(spark):
    rng = np.random.default_rng(2)
    rows = [("hot" if i % 3 else None, float(v)) for i, v in enumerate(np.r_[rng.integers(0, 50, 4000), np.full(2000, 7.0)])]
    rows += [("one", 3.0), ("nan", float("nan")), ("nan", 1.0), ("none", None)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(6)
    probs = {"a": 0.1, "b": 0.5, "c": 0.937, "lo": 0.0, "hi": 1.0}
    fast = {r["k"]: tuple(r)[1:] for r in quantiles.quantiles(df, ["k"], "v", probs).collect()}
    slow = {r["k"]: tuple(r)[1:] for r in quantiles.quantiles(df, ["k"], "v", probs, limit=0).collect()}
    assert fast.keys() == slow.keys()
    for k in fast:
        assert fast[k] == pytest.approx(slow[k])
    whole = quantiles.medians(df, [], "v", limit=0).first()[0]
    assert whole == pytest.approx(np.nanmedian([v for _, v in rows if v is not None]))


def brute_knn(x, y, k, total):
    out = []
    for i, a in enumerate(x):
        cand = []
        for j, b in enumerate(y):
            both = ~np.isnan(a) & ~np.isnan(b)
            if both.any():
                cand.append((round(math.sqrt(total / both.sum() * ((a[both] - b[both]) ** 2).sum()), 9), j))
        out.append(sorted(cand)[:k])
    return out


@pytest.mark.parametrize("block", [None, 40])
def test_knn_paths_match_brute_force(spark, block):
    rng = np.random.default_rng(3)
    y = np.round(rng.normal(size=(400, 4)) * [50, 1, 1, 5], 2)
    y[:130] = [1.0, 2.0, 3.0, 4.0]  # a third of the donors are copies
    y[130:200, 2] = np.nan
    x = np.round(rng.normal(size=(90, 4)) * [50, 1, 1, 5], 2)
    x[:30] = [1.0, 2.0, np.nan, 4.0]
    x[30:40, 1:] = np.nan
    x[40] = np.nan
    cols = ["a", "b", "c", "d"]
    frame = lambda z, p: spark.createDataFrame(
        [(i, float(i), *[None if np.isnan(v) else float(v) for v in r]) for i, r in enumerate(z)],
        f"id long, p double, a double, b double, c double, d double").repartition(p)
    limits = {} if block is None else {"broadcast_cells": 0, "block_rows": block}
    got = knn.nearest(frame(x, 4), frame(y, 5), ["id"], ["id"], cols, 5, "p", coordinate_count=5, **limits).toPandas()
    want = brute_knn(x, y, 5, 5)
    for i in range(len(x)):
        mine = got[got["id"] == i].sort_values("rank")
        assert list(zip(mine["distance"], mine["donor_id"])) == want[i], i


def test_knn_impute_falls_back_to_mean(spark):
    df = series(spark, [10.0, None, 14.0])
    out = impute.impute_knn(df, "t", "v", "o", ["t"], ["v"], k=5).orderBy("t").collect()
    assert [r["o"] for r in out] == [10.0, 12.0, 14.0]


def test_grid_is_not_broadcast_where_missing_steps_are_dropped(spark):
    df = spark.createDataFrame([("a", at(0), 1.0), ("a", at(40_000), 3.0), (None, at(2), 5.0)], "s string, t timestamp_ntz, v double")
    known = grid.regularise(df.repartition(2), ["s"], "t").where("v IS NOT NULL")
    assert sorted(r["v"] for r in known.collect()) == [1.0, 3.0, 5.0]
    plan = known._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan.split("Initial Plan")[0]
    filled = impute.impute_column(grid.regularise(df, ["s"], "t"), "v", "o", "median", limit=0)
    assert filled.where("v IS NULL").select("o").distinct().collect() == [(3.0,)] and filled.count() == 40_002


def test_positions_and_ranks(spark):
    rng = np.random.default_rng(4)
    df = spark.createDataFrame([(int(i), float(v)) for i, v in enumerate(rng.integers(0, 5, 500))], "id long, v double").repartition(7)
    pos = order.positions(df, ["v", "id"]).toPandas().sort_values("pos")
    assert pos["pos"].tolist() == list(range(500))
    assert pos[["v", "id"]].values.tolist() == df.toPandas().sort_values(["v", "id"])[["v", "id"]].values.tolist()
    ranked = rank.average_rank(df, "v").toPandas()
    assert np.allclose(ranked["rank"], ranked["v"].rank())


def test_fold_starts():
    assert split.fold_starts(8763, 5)[0] == 1463
    assert split.fold_starts(9, 5) == [4, 5, 6, 7, 8]
    with pytest.raises(ValueError):
        split.fold_starts(4, 5)


def test_expanding_split_is_ordered_and_complete(spark):
    df = spark.range(101).select((F.col("id") * 7 % 101).alias("k"))
    pdf = split.expanding_split(df, ["k"], 5).toPandas()
    tests = pdf[pdf["role"] == "test"]
    assert sorted(tests["pos"]) == list(range(101 - 5 * 16, 101))
    for f, g in pdf.groupby("fold"):
        train, test = g[g["role"] == "train"], g[g["role"] == "test"]
        assert len(test) == 16 and train["pos"].max() + 1 == test["pos"].min() and len(train) == train["pos"].max() + 1


@pytest.mark.parametrize("chunk", [16, 8192])
def test_acf_and_pacf(spark, chunk):
    y = np.cumsum(np.random.default_rng(5).normal(size=120))
    df = series(spark, list(map(float, y)), name="y")
    c = y - y.mean()
    want = [(c[k:] @ c[: len(c) - k]) / (c @ c) for k in range(31)]
    got = [r["acf"] for r in autocorr.acf(df, ["t"], "y", 30, chunk).orderBy("lag").collect()]
    assert np.allclose(got, want)
    part = [r["pacf"] for r in autocorr.pacf(df, ["t"], "y", 10, chunk).orderBy("lag").collect()]
    for k in (1, 4, 10):
        toeplitz = np.array([[want[abs(i - j)] for j in range(k)] for i in range(k)])
        assert part[k] == pytest.approx(np.linalg.solve(toeplitz, want[1 : k + 1])[-1])


def test_adf_matches_direct_regression(spark):
    rng = np.random.default_rng(6)
    y = np.zeros(200)
    for i in range(1, 200):
        y[i] = 0.6 * y[i - 1] + rng.normal()
    row = autocorr.adf(series(spark, list(map(float, y)), name="y"), ["t"], "y", max_lag=4).first()
    p, d = row["used_lag"], np.diff(y)
    x = np.column_stack([np.ones(len(d) - p), y[p:-1], *[d[p - k : len(d) - k] for k in range(1, p + 1)]])
    t = d[p:]
    beta = np.linalg.lstsq(x, t, rcond=None)[0]
    s2 = ((t - x @ beta) ** 2).sum() / (len(t) - x.shape[1])
    assert row["statistic"] == pytest.approx(beta[1] / math.sqrt(s2 * np.linalg.inv(x.T @ x)[1, 1]), rel=1e-6)
    assert row["nobs"] == len(t) and row["p_value"] < 0.01
    assert row["crit_5"] == pytest.approx(-2.876, abs=2e-3)


def test_ar_ma_forecasts(spark):
    rng = np.random.default_rng(7)
    y = np.cumsum(rng.normal(size=80))
    c = arima.lagged_changes(series(spark, list(map(float, y)), name="y"), [], "t", "y").cache()
    d = np.diff(y)
    phi, const = np.polyfit(d[:-1], d[1:], 1)
    fit = arima.fit_ar1(c, [])
    row = fit.first()
    assert (row["const"], row["phi"], row["n"]) == (pytest.approx(const), pytest.approx(phi), 78)
    ahead = [r["forecast"] for r in arima.forecast_ar1(c, fit, [], "t", "y", 3).orderBy("h").collect()]
    level, step, want = y[-1], d[-1], []
    for _ in range(3):
        step = const + phi * step
        level += step
        want.append(level)
    assert ahead == pytest.approx(want)
    ma = arima.fit_ma1(c, [])
    m, theta = ma.first()["mean"], ma.first()["theta"]
    e = 0.0
    for v in d:
        e = v - m - theta * e
    got = [r["forecast"] for r in arima.forecast_ma1(c, ma, [], "t", "y", 2).orderBy("h").collect()]
    assert got == pytest.approx([y[-1] + m + theta * e, y[-1] + 2 * m + theta * e])


def test_grid_and_fused_filter(spark):
    rows = [(at(0), 1.0, 2.0), (at(1), None, None), (at(2), 3.0, None), (T0 + dt.timedelta(hours=7), 9.0, 9.0), (at(4), None, 5.0)]
    df = spark.createDataFrame(rows, "t timestamp_ntz, a double, b double")
    full = grid.regularise(df.withColumn("s", F.lit(1)), ["s"], "t")
    assert [r["t"] for r in full.orderBy("t").collect()] == [at(i) for i in range(5)]
    fused = grid.on_grid(df, [], "t", ["a", "b"])
    slow = grid.drop_all_null(full, ["a", "b"]).select("t", "a", "b")
    assert sorted(map(tuple, fused.collect()), key=str) == sorted(map(tuple, slow.collect()), key=str)
    assert fused.count() == 3


def test_long_grid_is_opened_in_stretches(spark):
    df = spark.createDataFrame([("a", at(0)), ("a", at(10_000))], "s string, t timestamp_ntz")
    out = grid.grid_of(df, ["s"], "t")
    assert out.count() == 10_001 and out.distinct().count() == 10_001


def test_time_functions_ignore_the_session_zone(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 3, 31, 2, 30, 0, 250000),), (dt.datetime(1960, 1, 1, 0, 0, 1),)], "t timestamp_ntz")
    want = [int((r["t"] - dt.datetime(1970, 1, 1)) / dt.timedelta(microseconds=1)) for r in df.collect()]
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        assert [r[0] for r in df.select(scalars.epoch_us("t")).collect()] == want
        assert df.select(scalars.from_epoch_us(scalars.epoch_us("t")).alias("t")).collect() == df.collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_scalars(spark):
    df = spark.createDataFrame([("level_10", "sp25", -3.0), ("nan", None, None), ("oops", "spx", 200.0)], "a string, b string, x double")
    got = df.select(scalars.strip_prefix("a", "level_"), scalars.strip_prefix_int("b", "sp"), scalars.clamp("x", 0, 100)).collect()
    assert [tuple(r) for r in got] == [(10.0, 25, 0.0), (None, None, None), (None, None, 100.0)]
    codes = spark.createDataFrame([(0.6, 0.0), (0.5, 81.0), (0.0, 80.0), (0.0, 21.0), (0.0, 20.0)], "rain double, clouds double")
    assert [r[0] for r in codes.select(scalars.weather_code("rain", "clouds")).collect()] == [500, 804, 803, 802, 800]
    times = spark.createDataFrame([(dt.datetime(2018, 1, 1, 5, 59),), (dt.datetime(2017, 12, 31, 23, 30),)], "t timestamp_ntz")
    assert [r[0] for r in times.select(scalars.elapsed_hours("t")).collect()] == [8765, 8759]


def test_calendar_columns(spark):
    df = series(spark, [20, 21, 19, 22], hours=1)
    assert len(calendar.add_calendar(df, "t", "cyclical").columns) == len(df.columns) + 7
    assert len(calendar.onehot("t")) == 24 + 7 + 12 + 1 and len(calendar.onehot("t", drop_first=True)) == 23 + 6 + 11 + 1
    assert calendar.feature_list(["time", "b", "a"], "cyclical") == ["b", "a", *calendar.CYCLICAL]
    with pytest.raises(ValueError):
        calendar.add_calendar(df, "t", "other")


def test_pattern_levels_fall_through(spark):
    df = series(spark, [1.0, None, 3.0, 5.0] + [None] * 4 + [7.0] * 3 + [None])
    out = impute.impute_pattern(df, "t", "v", "o").toPandas().sort_values("t")
    assert out["o"].notna().all()
    assert out.loc[out["v"].notna(), "o"].tolist() == out["v"].dropna().tolist()
    assert out["o"].iloc[1] == 7.0  # nothing at this hour and weekday, one reading at this hour


def test_contract(spark):
    df = spark.createDataFrame([(1, "2.5", -1.0, 3), (2, "x", 0.0, 4), (3, None, None, None)], "id long, text string, x double, code int")
    fields = (Field("id", "bigint"), Field("text", "double"), Field("x", "double", rule="positive"), Field("code", "string"), Field("gone", "double"))
    rep = {(r["rule"], r["column"]): r["violations"] for r in contract.report(df, fields).collect()}
    assert rep == {("whole_number", "id"): 0, ("type", "text"): 1, ("positive", "x"): 2, ("type", "code"): 2, ("missing", "gone"): 3}
    good, bad = contract.split(df, fields[:3])
    assert [r["id"] for r in good.collect()] == [3] and bad.count() == 2
    with pytest.raises(contract.ContractViolation):
        contract.validate(df, fields, strict=True)
    assert [r["column"] for r in contract.unknown_columns(df, fields[:2]).collect()] == ["x", "code"]
    assert {(r["column"], r["side"]) for r in contract.column_diff(df, ["id", "new", "x", "text"]).collect()} == {("code", "left"), ("new", "right")}


def test_scaler_moments(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (None, 5.0), (6.0, 5.0)], "a double, b double")
    out = scale.standardise(df, ["a", "b"], scale.moments(df, ["a", "b"])).toPandas()
    assert out["a"].mean() == pytest.approx(0) and out["a"].var(ddof=0) == pytest.approx(1)
    assert out["b"].tolist() == [0.0] * 4 and out["a"].isna().sum() == 1


def test_profiles(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 2, 3, 4, 100]] + [(None,)], "v double")
    row = profile.column_profile(df, ["v"]).first()
    assert (row["missing"], row["median"], row["max"]) == (1, 3.0, 100.0) and row["std"] == pytest.approx(np.std([1, 2, 3, 4, 100], ddof=1))
    box = profile.box_summary(df, "v").first()
    assert (box["q1"], box["q3"], box["whisker_high"], box["outliers"]) == (2.0, 4.0, 4.0, 1)
    hist = {r["bin"]: r["n"] for r in profile.histogram(df, "v", 3).collect()}
    assert hist == {0: 4, 2: 1}
    flat = spark.createDataFrame([(2.0,), (2.0,)], "v double")
    assert [(r["bin"], r["n"]) for r in profile.histogram(flat, "v", 3).collect()] == [(0, 2)]


def test_mutual_information_against_numpy(spark):
    rng = np.random.default_rng(8)
    x = rng.integers(0, 4, 300).astype(float)
    y = x * 2 + rng.integers(0, 2, 300)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)], "x double, y double")
    for limit in (10**6, 0):
        got = attribution.mutual_information(df, ["x"], "y", bins=4, limit=limit).first()["mutual_info"]
        cut = lambda v: np.searchsorted(np.unique(np.quantile(v, [0.25, 0.5, 0.75])), v, side="left")
        table = pd.crosstab(cut(x), cut(y)).to_numpy() / 300
        outer = np.outer(table.sum(1), table.sum(0))
        want = (table[table > 0] * np.log(table[table > 0] / outer[table > 0])).sum()
        assert got == pytest.approx(want)


def test_permutation_importance_prefers_the_used_feature(spark):
    from kairoline.plans.regressors import LinearExpressionModel
    rng = np.random.default_rng(9)
    df = spark.createDataFrame([(i, float(a), float(b), float(3 * a)) for i, (a, b) in enumerate(rng.normal(size=(200, 2)))], "id long, a double, b double, y double")
    model = LinearExpressionModel()._set(inputCols=["a", "b"], fitted='{"coef": [3.0, 0.0], "intercept": 0.0}')
    got = {r["feature"]: r["importance"] for r in attribution.permutation_importance(df, model, ["a", "b"], "y", ["id"]).collect()}
    assert got["a"] > 2 and got["b"] == pytest.approx(0)


def test_combined_rank_shares_ties(spark):
    a = spark.createDataFrame([("p", 1.0), ("q", 1.0), ("r", 5.0)], "feature string, v double")
    b = spark.createDataFrame([("p", -9.0), ("s", 2.0)], "feature string, v double")
    got = {r["feature"]: r["score"] for r in rank.combined_rank({"a": a, "b": b}).collect()}
    assert got == {"p": 2.5 + 4, "q": 2.5 + 1.5, "r": 4 + 1.5, "s": 1 + 3}


def test_gram_against_numpy(spark):
    rng = np.random.default_rng(10)
    x = rng.normal(size=(300, 3)) * [1, 10, 0.1] + [1e6, 0, 5]
    y = x @ [0.5, -1, 20] + rng.normal(size=300)
    df = spark.createDataFrame([(*map(float, r), float(t), int(i % 3)) for i, (r, t) in enumerate(zip(x, y))],
                               "a double, b double, c double, y double, seg int").repartition(4)
    parts = gram.accumulate_by(df, ["a", "b", "c"], "y", "seg")
    g = parts[0] + parts[1] + parts[2]
    assert np.allclose(g.centred[:3, :3], np.cov(x.T, bias=True) * 300, rtol=1e-6)
    fit = gram.ols(g)
    design = np.column_stack([np.ones(300), x - x.mean(0)])
    beta = np.linalg.lstsq(design, y, rcond=None)[0]
    assert np.allclose(fit.coef, beta[1:], rtol=1e-6)
    pred = fit.intercept + x[::3] @ fit.coef
    assert fit.sse(parts[0]) == pytest.approx(((y[::3] - pred) ** 2).sum(), rel=1e-6)
    xc, yc = x - x.mean(0), y - y.mean()
    assert np.allclose(gram.ridge(g, 5.0).coef, np.linalg.solve(xc.T @ xc + 5 * np.eye(3), xc.T @ yc), rtol=1e-6)
    w = gram.elastic_net(g, 0.3, 0.6).coef
    grad = xc.T @ (yc - xc @ w) / 300 - 0.3 * 0.4 * w
    assert np.all(np.where(w != 0, np.abs(grad - 0.18 * np.sign(w)) < 1e-6, np.abs(grad) <= 0.18 + 1e-9))
