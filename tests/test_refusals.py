"""Inputs that must be refused or kept, never lost in silence."""

import pytest
from pyspark.sql import functions as F

from kairoline.operators import arima, contract, gram, grid, knn, profile
from kairoline.plans import regressors, search
from kairoline.sources import readers, sinks


def test_csv_columns_are_found_by_name(spark, tmp_path):
    (tmp_path / "f.csv").write_text("b,a\n1.5,7\n")
    schema = spark.createDataFrame([], "a long, b double").schema
    assert readers.read_csv(spark, str(tmp_path / "f.csv"), schema).collect() == [(7, 1.5)]
    with pytest.raises(ValueError, match="missing columns"):
        readers.read_csv(spark, str(tmp_path / "f.csv"), spark.createDataFrame([], "a long, c double").schema)


def test_sums_name_the_columns_with_nulls(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 3.0), (4.0, 6.0)], "x double, y double")
    with pytest.raises(ValueError, match=r"x \(1\)"):
        gram.accumulate(df, ["x"], "y")
    assert gram.accumulate_by(df, ["x"], "y", nulls="drop")[0].n == 2


def test_difference_keeps_the_row_after_a_gap(spark):
    df = spark.sql("SELECT 1 AS s, timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 3 * id) AS t, "
                   "CASE WHEN id <> 1 THEN CAST(id * id AS DOUBLE) END AS v FROM range(4)")
    assert [r.d for r in arima.difference(df, ["s"], "t", "v").orderBy("t").collect()] == [None, None, 5.0]


def test_depth_and_missing_scores(spark):
    with pytest.raises(ValueError, match="depth 30"):
        regressors.build("DecisionTreeRegressor", {"max_depth": 100}, ["x"])
    board = spark.createDataFrame([(0, "a", None), (1, "b", float("nan")), (2, "c", 0.5)], "seq int, t string, cv_rmse double")
    assert search.best_candidate(board).first().t == "c"


def test_outputs_by_plain_and_qualified_path(spark, tmp_path):
    sinks.write_features(spark.range(2), f"{tmp_path}/a/b")
    for root in (str(tmp_path), f"file://{tmp_path}"):
        assert [r.expected for r in sinks.missing_outputs(spark, root, ["a/b", "a", "c"]).collect()] == ["c"]


def test_repeated_receivers_are_matched_once(spark):
    donors = spark.createDataFrame([(10, 1.0, 0.0), (11, 2.0, 1.0), (12, 9.0, 9.0)], "d long, y double, x double")
    for limits in ({}, {"broadcast_cells": 0, "block_rows": 2}):
        twice = spark.createDataFrame([(1, 0.1), (1, 0.1), (None, 8.0)], "r long, x double")
        near = knn.nearest(twice, donors, ["r"], ["d"], ["x"], 2, "y", **limits)
        assert sorted((r.r or 0, r.donor_d) for r in near.collect()) == [(0, 11), (0, 12), (1, 10), (1, 11)]
    with pytest.raises(Exception, match="not unique"):
        other = spark.createDataFrame([(1, 0.1), (1, 0.2)], "r long, x double")
        knn.nearest(other, donors, ["r"], ["d"], ["x"], 1, "y").collect()


def test_readings_without_a_series_stay(spark):
    df = spark.sql("SELECT IF(id < 3, 1, NULL) AS s, timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 3 * id) AS t, "
                   "CAST(id AS DOUBLE) AS v FROM range(6) WHERE id <> 4")
    assert grid.on_grid(df, ["s"], "t", ["v"]).columns == ["s", "t", "v"]
    assert sorted(r.v for r in grid.on_grid(df, ["s"], "t", ["v"]).collect()) == [0, 1, 2, 3, 5]
    on = grid.regularise(df, ["s"], "t")
    assert on.columns == ["s", "t", "v"]
    assert sorted((r.v for r in on.collect()), key=lambda v: (v is None, v)) == [0, 1, 2, 3, 5, None]
    boxes = {r.s: r.median for r in profile.box_summary(df, "v", ["s"]).collect()}
    assert boxes == {1: 1.0, None: 4.0}


def test_bad_documents_are_kept_with_their_reasons(spark):
    texts = ['{"features": {"k": 1.5, "a b": "x"}}', "not json", '{"features": {"k": "abc", "a b": 7}}', '{"features": {"k": null}}',
             '{"other": 1}', None, '{"features": {"k": "2", "a b": null}}']
    df = spark.createDataFrame(list(enumerate(texts)), "i long, value string")
    features = spark.createDataFrame([], "k double, `a b` string").schema
    rows = readers.checked_requests(df, "value", features)
    fields = (contract.Field("k", "double", rule="positive"), contract.Field("a b", "string"))
    good, bad = contract.split(rows, fields)
    assert good.columns == ["i", "k", "a b"]
    assert good.orderBy("i").collect() == [(0, 1.5, "x"), (6, 2.0, None)]
    assert {r.i: r.errors for r in bad.collect()} == {
        1: ["malformed:document"], 2: ["type:k", "type:a b"], 3: ["missing:a b"], 4: ["malformed:document"], 5: ["malformed:document"]}
    assert bad.where("i = 1").first()["_document"] == "not json"
