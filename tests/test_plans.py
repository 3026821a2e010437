"""Stages, regressors, search, champion selection, run tables, sources and streams."""

import datetime as dt
import json

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from kairoline.operators import gram
from kairoline.operators.contract import report, split
from kairoline.plans import champion, search, stages, tracking
from kairoline.plans.regressors import build, linear_solution
from kairoline.session import scratch_path
from kairoline.sources import readers, sinks, weather
from kairoline.streaming import scoring

T0 = dt.datetime(2023, 1, 1)
STEP = dt.timedelta(hours=3)


@pytest.fixture(scope="module")
def codes(spark):
    rows = [("2023-01-01 00:00:00", "level_10", "sp1010", 15.0), ("2023-01-01 03:00:00", "level_20", "sp1020", 16.5),
            ("2023-01-01 06:00:00", None, "sp1030", None)]
    return spark.createDataFrame(rows, "time string, Valencia_wind_deg string, Seville_pressure string, temperature double")


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(11)
    x = rng.normal(size=(240, 3)) * [2, 1, 4] + [10, 0, 3]
    y = x @ [1.5, -2.0, 0.0] + rng.normal(size=240) * 0.5 + 7
    rows = [(T0 + i * STEP, *map(float, r), float(t)) for i, (r, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "time timestamp_ntz, a double, b double, c double, label double").cache()


def prep(**kw):
    return stages.ReadingPrep(codes=json.dumps(weather.CODES), **kw)


def test_prep_parses_codes_and_time(codes):
    out = prep().transform(codes)
    types = dict(out.dtypes)
    assert types["Valencia_wind_deg"] == types["Seville_pressure"] == "double" and types["time"] == "timestamp_ntz"
    assert [r["Valencia_wind_deg"] for r in out.orderBy("time").collect()] == [10.0, 20.0, None]
    assert {"hour_sin", "hour_cos", "dow_sin", "dow_cos", "month_sin", "month_cos"} <= set(out.columns)


def test_prep_leaves_missing_steps_out_and_drops_bookkeeping(codes):
    holed = codes.where("time <> '2023-01-01 03:00:00'").withColumn("Unnamed: 0", F.lit(1))
    out = prep().transform(holed)
    assert out.count() == 2 and "Unnamed: 0" not in out.columns


def test_prep_onehot_has_a_fixed_schema(codes):
    assert len(prep(mode="onehot").transform(codes).columns) == 4 + 44
    assert len(prep(mode="none").transform(codes).columns) == 4


@pytest.fixture
def nulls(spark):
    rows = [(T0, None, 30.0), (T0 + STEP, 20.0, None), (T0 + 2 * STEP, 21.0, 40.0), (T0 + 3 * STEP, 19.0, 45.0)]
    return spark.createDataFrame(rows, "time timestamp_ntz, temperature double, humidity double")


@pytest.mark.parametrize("kind", sorted(stages.IMPUTERS))
def test_imputers_fill_their_column_only(spark, nulls, kind):
    model = stages.build_imputer(kind, "temperature").fit(nulls)
    out = model.transform(nulls)
    pdf = out.toPandas().sort_values("time")
    assert out.columns == nulls.columns and len(pdf) == 4
    assert pdf["temperature"].iloc[1:].tolist() == [20.0, 21.0, 19.0]
    assert pdf["humidity"].isna().sum() == 1
    assert pdf["temperature"].isna().sum() == (1 if kind == "ValenciaPressureImputer" else 0)
    path = scratch_path(spark, "stage")
    Pipeline(stages=[stages.build_imputer(kind, "temperature")]).fit(nulls).write().save(path)
    again = PipelineModel.load(path).transform(nulls).toPandas().sort_values("time")
    assert again["temperature"].fillna(-1).tolist() == pytest.approx(pdf["temperature"].fillna(-1).tolist())


@pytest.mark.parametrize("kind", sorted(stages.IMPUTERS))
def test_imputer_without_column_changes_nothing(nulls, kind):
    out = stages.build_imputer(kind, None).fit(nulls).transform(nulls)
    assert sorted(map(str, out.collect())) == sorted(map(str, nulls.collect()))


def test_helper_names_do_not_clash(spark):
    rows = [(T0 + i * dt.timedelta(hours=1), float(t), *[v] * 4) for i, (t, v) in enumerate(zip([20, 21, 19, 22], [30.0, 35.0, None, 45.0]))]
    df = spark.createDataFrame(rows, "time timestamp_ntz, temperature double, year double, dow_sin double, month_cos double, month double")
    for kind in ("ValenciaPressureImputer", "SimplifiedPatternImputer", "TimeAwareKNNImputer"):
        assert stages.build_imputer(kind, "temperature").fit(df).transform(df).columns == df.columns
    with pytest.raises(ValueError):
        stages.build_imputer("other", "temperature")


LINEAR = [("LinearRegression", {}), ("Ridge", {"alpha": 30.0}), ("Lasso", {"alpha": 0.3}), ("ElasticNet", {"alpha": 0.5, "l1_ratio": 0.3}),
          ("SGDRegressor", {"alpha": 0.2}), ("BayesianRidge", {})]


@pytest.mark.parametrize("kind,params", LINEAR)
def test_ml_fit_equals_normal_equations(table, kind, params):
    feats = ["a", "b", "c"]
    model = Pipeline(stages=build(kind, params, feats)).fit(table).stages[-1]
    want = linear_solution(kind, params, gram.accumulate(table, feats, "label"))
    assert np.allclose(np.array(list(model.coefficients)), want.coef, atol=2e-4)
    assert model.intercept == pytest.approx(want.intercept, abs=2e-3)


def test_bayes_ridge_reaches_the_evidence_fixed_point(table):
    pdf = table.toPandas()
    x, y = pdf[["a", "b", "c"]].to_numpy(), pdf["label"].to_numpy()
    xc, yc, n = x - x.mean(0), y - y.mean(), len(y)
    noise, weight, w = 1 / y.var(), 1.0, np.zeros(3)
    for _ in range(500):
        a = noise * xc.T @ xc + weight * np.eye(3)
        w = np.linalg.solve(a, noise * xc.T @ yc)
        eff = 3 - weight * np.trace(np.linalg.inv(a))
        weight = (eff + 2e-6) / (w @ w + 2e-6)
        noise = (n - eff + 2e-6) / (((yc - xc @ w) ** 2).sum() + 2e-6)
    assert np.allclose(gram.bayes_ridge(gram.accumulate(table, ["a", "b", "c"], "label")).coef, w, atol=1e-4)


@pytest.mark.parametrize("kind,params", [
    *LINEAR[:1], LINEAR[1], LINEAR[5], ("DecisionTreeRegressor", {"max_depth": 4}), ("RandomForest", {"n_estimators": 3, "max_depth": None, "min_samples_leaf": 5}),
    ("ExtraTreesRegressor", {"n_estimators": 3, "max_depth": 4}), ("GradientBoostingRegressor", {"n_estimators": 3, "max_depth": 2}),
    ("XGBRegressor", {"n_estimators": 3, "max_depth": 2}), ("AdaBoostRegressor", {"n_estimators": 3}), ("KNeighborsRegressor", {"n_neighbors": 3, "weights": "distance"})])
def test_every_regressor_beats_the_mean_and_survives_saving(spark, table, kind, params):
    model = Pipeline(stages=build(kind, params, ["a", "b", "c"], "label", ["time"])).fit(table)
    path = scratch_path(spark, "model")
    model.write().save(path)
    pdf = model.transform(table).select("time", "label", "prediction").toPandas().sort_values("time")
    again = PipelineModel.load(path).transform(table).select("time", "prediction").toPandas().sort_values("time")
    assert ((pdf["label"] - pdf["prediction"]) ** 2).mean() < pdf["label"].var()
    assert np.allclose(pdf["prediction"], again["prediction"])


def test_adaboost_weighted_median(table):
    model = Pipeline(stages=build("AdaBoostRegressor", {"n_estimators": 4}, ["a", "b", "c"])).fit(table)
    boost = model.stages[-1]
    df = model.stages[0].transform(table)
    preds = np.column_stack([[r["p"] for r in t.copy().setPredictionCol("p").transform(df).orderBy("time").collect()] for t in boost.trees])
    votes = np.array(json.loads(boost.get("votes")))
    order = preds.argsort(1)
    seen = votes[order].cumsum(1)
    pick = (seen >= 0.5 * votes.sum()).argmax(1)
    want = preds[np.arange(len(preds)), order[np.arange(len(preds)), pick]]
    got = [r["prediction"] for r in boost.transform(df).orderBy("time").collect()]
    assert np.allclose(got, want)


def test_unknown_names_are_refused(table):
    with pytest.raises(ValueError):
        build("Nope", {}, ["a"])
    with pytest.raises(ValueError):
        build("Ridge", {"gamma": 1}, ["a"])
    with pytest.raises(ValueError):
        champion.folds_for(table, champion.Setup("label", ["a"], split_type="random"))


@pytest.mark.parametrize("scope", ["fold", "all"])
def test_sums_and_fitted_folds_agree(table, scope):
    """The one-pass errors equal fitting every fold on Spark ML."""
    feats = ["a", "b", "c"]
    folds = search.make_folds(table, ["time"], feats, "label", 4, fit_scope=scope)
    ridge = search.Candidate("Ridge", {"alpha": 8.0}, scaling=True)
    fast = search.fold_errors(folds, ridge)
    slow = search.fitted_fold_errors(folds, ridge, ridge.params)
    folds.release()
    assert fast == pytest.approx(slow, rel=1e-5)


def test_preparation_is_fitted_inside_each_fold(table):
    holed = table.withColumn("a", F.when(F.hour("time") != 9, F.col("a")))
    make = lambda: [stages.build_imputer("SimpleImputer", "a")]
    folds = search.make_folds(holed, ["time"], ["a", "b"], "label", 3, make)
    lasso = search.Candidate("Lasso", {"alpha": 0.1}, scaling=True)
    assert search.fold_errors(folds, lasso) == pytest.approx(search.fitted_fold_errors(folds, lasso, lasso.params), rel=1e-5)
    pdf = holed.toPandas().sort_values("time")
    got = folds.frames(0)[1].toPandas()
    assert got["a"].notna().all() and (got["a"].round(9) == round(pdf["a"].iloc[:60].mean(), 9)).sum() == pdf["a"].iloc[60:120].isna().sum()
    folds.release()


def test_grids():
    params = {"b": [1, 2, 3], "a": ["x", "y"]}
    full = search.grid(params)
    assert full[0] == {"a": "x", "b": 1} and full[1] == {"a": "x", "b": 2} and len(full) == 6
    assert search.sample_grid(params, 10) == full
    drawn = search.sample_grid(params, 4, seed=1)
    assert len({json.dumps(d) for d in drawn}) == 4 and drawn == search.sample_grid(params, 4, seed=1)


def test_presets_build(spark):
    from kairoline.plans import presets
    for c in presets.SHALLOW:
        for params in (c.params, *search.sample_grid(c.tuning_params, 3)) if c.tuning_params else (c.params,):
            assert build(c.type, params, ["a"], "label", ["time"])


def test_empty_grid_reports_no_params(table):
    folds = search.make_folds(table, ["time"], ["a"], "label", 3)
    found = search.search(folds, search.Candidate("LinearRegression"))
    folds.release()
    assert found.best_params is None and found.cv_rmse > 0


def board(spark, *rows):
    return spark.createDataFrame([(i, t, s, None) for i, (t, s) in enumerate(rows)], search.LEADERBOARD)


def test_best_candidate(spark):
    assert search.best_candidate(board(spark, ("A", 0.6), ("B", 0.4), ("C", 0.5))).first()["model_type"] == "B"
    assert search.best_candidate(board(spark, ("A", 0.4), ("B", 0.4))).first()["model_type"] == "A"


@pytest.mark.parametrize("held,new,decision", [(0.3, 0.35, "keep"), (0.5, 0.4, "replace"), (0.4, 0.4, "keep"), (0.0, 0.1, "keep"), (None, 0.1, "replace")])
def test_champion_rule(spark, held, new, decision):
    rows = [] if held is None else [("old", held)]
    verdict = tracking.upload_decision(search.best_candidate(board(spark, ("new", new))), board(spark, *rows)).first()
    assert verdict["decision"] == decision and verdict["upload"] == (decision == "replace")
    assert verdict["model_type"] == ("old" if decision == "keep" else "new")


def test_run_tables(spark):
    tables = tracking.RunTables(spark, scratch_path(spark, "runs"))
    assert tables.production("m").first() is None and tables.latest_path().first() is None
    assert tables.register("m", "r1", "Ridge", 0.5, "p1") == 1
    assert tables.register("m", "r2", "Lasso", 0.4, "p2") == 2
    assert tables.register("other", "r3", "Lasso", 0.1, "p3") == 1
    now = tables.production("m").first()
    assert (now["version"], now["model_type"], now["cv_rmse"]) == (2, "Lasso", 0.4)


def test_whole_run_with_codes_gaps_and_neighbours(spark):
    """Nine coded rows with a gap: search, refit, register, then a second run keeps the champion."""
    temp = [15, 16.5, 134, 15, None, 14, 15, 16.5, 14]
    rows = [(str(T0 + i * STEP), f"level_{10 + 10 * (i % 2)}", f"sp10{10 + 10 * (i % 3)}", None if t is None else float(t), float(i % 3 != 1))
            for i, t in enumerate(temp)]
    df = spark.createDataFrame(rows, "time string, Valencia_wind_deg string, Seville_pressure string, temperature double, load_shortfall_3h double")
    setup = champion.Setup(label="load_shortfall_3h", features=["Valencia_wind_deg", "Seville_pressure", "temperature", "hour_sin"],
                           codes=json.dumps(weather.CODES), impute_column="temperature", n_splits=2)
    tables = tracking.RunTables(spark, scratch_path(spark, "runs"))
    models = [search.Candidate("Ridge", {"alpha": 1.0}, True, {"alpha": [0.1, 10.0]}), search.Candidate("DecisionTreeRegressor", {"max_depth": 2})]
    first = champion.choose(df, setup, models, tables)
    second = champion.choose(df, setup, models, tables)
    assert first.is_new and not second.is_new and second.version == 1 and second.cv_rmse == first.cv_rmse > 0
    scored = champion.score(champion.load_latest(tables), df, ["time"])
    assert scored.count() == 9 and scored.where("prediction is null").count() == 0
    assert tables.read("scores").count() == 4 and [r["outcome"] for r in tables.summary().orderBy("executed").collect()] == [
        "new model uploaded", "existing model kept"]


def test_refit_uses_found_parameters_only(table):
    setup = champion.Setup(label="label", features=["a", "b"], calendar_mode="")
    model = champion.refit(table, setup, search.Candidate("RandomForest", {"n_estimators": 9, "max_depth": 2}), {"max_depth": 3, "n_estimators": 2})
    assert model.stages[-1].getNumTrees == 2


REQUEST = {"Unnamed: 0": 8763, "time": "2018-01-01 00:00:00", "Valencia_wind_deg": "level_8", "Seville_pressure": "sp25",
           **{c: 5.0 for c in weather.NUMBERS}, "Valencia_pressure": None}


def test_weather_contract(spark):
    assert len(weather.CONTRACT) == 49 and len(weather.SCHEMA) == 49
    bad = {**REQUEST, "Madrid_wind_speed": -1.0, "Madrid_pressure": 0.0, "Valencia_wind_speed": -4.0}
    lines = spark.createDataFrame([(json.dumps({"features": r}),) for r in (REQUEST, bad)], "value string")
    rows = readers.parse_requests(lines, "value", weather.FEATURES)
    good, held = split(rows, weather.CONTRACT)
    assert good.count() == 1 and sorted(weather_errors(held)) == [
        "non_negative:Madrid_wind_speed", "positive:Madrid_pressure"]
    broken = spark.createDataFrame([(None, 1.0), (None, 0.0), (None, None)], "feature1 double, target double")
    assert report(broken, weather.CONTRACT).where("violations > 0").count() == 47  # all required columns are missing


def weather_errors(held):
    return held.first()["errors"]


def test_csv_and_request_files(spark, tmp_path):
    (tmp_path / "request.json").write_text(json.dumps({"features": REQUEST}, indent=2))
    row = readers.read_requests(spark, str(tmp_path / "request.json"), weather.FEATURES).first()
    assert row["Unnamed: 0"] == 8763 and row["Valencia_pressure"] is None and row["Seville_temp"] == 5.0
    df = spark.createDataFrame([(1, 2.0)], "a long, b double")
    sinks.write_features(df, str(tmp_path / "f"), "csv")
    assert readers.read_csv(spark, str(tmp_path / "f"), df.schema).collect() == df.collect()
    sinks.write_predictions(df.withColumn("prediction", F.lit(1.0)), str(tmp_path / "p"), ["a"])
    assert [r["expected"] for r in sinks.missing_outputs(spark, str(tmp_path), ["f", "p", "q"]).collect()] == ["q"]


def test_stream_equals_batch_and_keeps_bad_rows(spark, tmp_path):
    docs = [{**REQUEST, "Unnamed: 0": i, "Madrid_temp": 270.0 + i, "Madrid_wind_speed": -1.0 if i % 4 == 0 else 1.0} for i in range(12)]
    for part in range(3):
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / "in" / f"{part}.txt").write_text("\n".join(json.dumps({"features": d}) for d in docs[part::3]) + "\n")
    base = readers.parse_requests(spark.read.text(str(tmp_path / "in")), "value", weather.FEATURES)
    train = base.withColumn("label", F.col("Madrid_temp") * 2)
    model = Pipeline(stages=[prep(dropCols=[]), stages.build_imputer("SimplifiedPatternImputer", "Madrid_pressure"),
                             *build("LinearRegression", {}, ["Madrid_temp"])]).fit(train.withColumn("time", F.lit("2018-01-01 00:00:00")))
    want = {r["Unnamed: 0"]: r["prediction"] for r in scoring.score_rows(base, model, weather.CONTRACT, ["Unnamed: 0"]).collect()}
    assert len(want) == 9
    stream = lambda: scoring.request_stream(spark, str(tmp_path / "in"), weather.FEATURES, files_per_batch=1)
    out = {k: str(tmp_path / k) for k in ("a", "a_state", "b", "b_bad", "b_state")}
    scoring.score_stream(stream(), model, weather.CONTRACT, ["Unnamed: 0"], out["a"], out["a_state"]).awaitTermination()
    scoring.score_with_quarantine(stream(), model, weather.CONTRACT, ["Unnamed: 0"], out["b"], out["b_bad"], out["b_state"]).awaitTermination()
    for name in ("a", "b"):
        got = {r["Unnamed: 0"]: r["prediction"] for r in spark.read.parquet(out[name]).collect()}
        assert got == pytest.approx(want)
    bad = spark.read.parquet(out["b_bad"]).collect()
    assert sorted(r["Unnamed: 0"] for r in bad) == [0, 4, 8] and bad[0]["errors"] == ["non_negative:Madrid_wind_speed"]
