"""Values that do not fit their type, steps read twice, registration by several callers, quantile summaries."""

from __future__ import annotations

import datetime as dt
import random
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kairoline.operators import contract, grid, impute, quantiles
from kairoline.plans.stages import ReadingPrep
from kairoline.plans.tracking import RunTables
from kairoline.sources import readers

SHAPE = T.StructType([T.StructField("i", T.LongType()), T.StructField("x", T.DoubleType()), T.StructField("s", T.StringType())])
FIELDS = [contract.Field("i", "bigint"), contract.Field("x", "double", rule="positive"), contract.Field("s", "string")]
LINES = {  # text of i and x -> values and problems
    ("1", "2.5"): (1, 2.5, []), ("1.5", "2"): (None, 2.0, ["type:i"]), ("2.0", "1e400"): (2, None, ["type:x"]),
    ("abc", "NaN"): (None, None, ["type:i", "type:x"]), ("", "1"): (None, 1.0, []), ("9007199254740993", "3"): (9007199254740993, 3.0, []),
    ("1e30", "Infinity"): (None, None, ["type:i", "type:x"])}


def test_csv_values_that_do_not_fit_are_named(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("x,s,i\n" + "".join(f"{x},t,{i}\n" for i, x in LINES))
    df = readers.checked_csv(spark, str(path), SHAPE)
    assert sorted(map(str, ((r["i"], r["x"], r[contract.PROBLEMS]) for r in df.collect()))) == sorted(map(str, LINES.values()))
    assert readers.read_csv(spark, str(path), SHAPE).columns == ["i", "x", "s"]
    found = {(r["rule"], r["column"]): r["violations"] for r in contract.report(df, FIELDS).collect()}
    assert found["type", "i"] == 3 and found["type", "x"] == 3 and found["positive", "x"] == 0
    good, bad = contract.split(df, FIELDS)
    assert good.count() == 3 and bad.count() == 4


def test_request_values_that_do_not_fit_are_named(spark):
    docs = ['{"features": {"i": 1, "x": 2, "s": "a"}}', '{"features": {"i": 1.5, "x": 2, "s": "a"}}',
            '{"features": {"i": 2.0, "x": 1e400, "s": "a"}}', '{"features": {"i": "7", "x": null, "s": 3}}', "nothing"]
    df = readers.checked_requests(spark.createDataFrame([(n, d) for n, d in enumerate(docs)], "n int, v string"), "v", SHAPE)
    got = {r["n"]: (r["i"], r["x"], r[contract.PROBLEMS]) for r in df.collect()}
    assert got[0] == (1, 2.0, []) and got[1] == (None, 2.0, ["type:i"])
    assert got[2][0] == 2 and got[2][2] == ["type:x"] or got[2][2] == ["malformed:document"]
    assert got[3][:2] == (7, None) and got[3][2] == ["type:s"] and got[4][2][0] == "malformed:document"


def test_steps_read_twice(spark):
    t = dt.datetime(2024, 1, 1)
    rows = [("a", t, 2.0), ("a", t, 1.0), (None, t, 5.0), (None, t + dt.timedelta(hours=3), 6.0)]
    df = spark.createDataFrame(rows, "s string, time timestamp_ntz, v double")
    assert grid.single_steps(df, ["s"], "time", "keep").count() == 4
    assert sorted(r["v"] for r in grid.single_steps(df, ["s"], "time", "first").collect()) == [1.0, 5.0, 6.0]
    with pytest.raises(PySparkException, match="read more than once"):
        grid.single_steps(df, ["s"], "time").collect()
    with pytest.raises(ValueError, match="duplicates must be"):
        grid.single_steps(df, ["s"], "time", "last")
    prep = {"seriesCols": ["s"], "mode": "none"}
    assert ReadingPrep(duplicates="first", **prep).transform(df).count() == 3
    with pytest.raises(PySparkException, match="read more than once"):
        ReadingPrep(duplicates="error", **prep).transform(df).collect()
    assert ReadingPrep(duplicates="error", **prep).transform(df.filter("v <> 2")).count() == 3
    assert ReadingPrep(**prep).transform(df).count() == 4


def test_callers_at_the_same_time_get_their_own_versions(spark, tmp_path):
    tables = RunTables(spark, str(tmp_path / "runs"))
    with ThreadPoolExecutor(4) as pool:
        versions = list(pool.map(lambda i: tables.register("m", f"r{i}", "Ridge", float(i), f"/p/{i}"), range(4)))
    assert sorted(versions) == [1, 2, 3, 4]
    moves = tables.read("aliases").collect()
    assert sorted(r["event_seq"] for r in moves) == [1, 2, 3, 4]
    last = max(moves, key=lambda r: r["event_seq"])["version"]
    assert [r["version"] for r in tables.production("m").collect()] == [last]
    assert tables.register("other name/x", "r", "Ridge", 1.0, "/p") == 1


def test_summaries_keep_their_rank_error(spark):
    rnd = random.Random(3)
    rows = [(i % 3 if i % 7 else None, rnd.choice([rnd.gauss(0, 1), 5.0])) for i in range(9000)] + [(1, None), (1, float("nan"))]
    df = spark.createDataFrame(rows, "g int, v double").repartition(6)
    got = {r["g"]: r for r in quantiles.sketched(df, ["g"], "v", {"low": 0.1, "mid": 0.5}, 0.01).collect()}
    for g, r in got.items():
        v = sorted(x for k, x in rows if k == g and x is not None and x == x)
        for name, p in (("low", 0.1), ("mid", 0.5)):
            below, upto = sum(x < r[name] for x in v) / len(v), sum(x <= r[name] for x in v) / len(v)
            assert r[name] in v and below <= p + 0.01 and upto >= p - 0.01
    assert len(got) == 4
    with pytest.raises(ValueError, match="error must lie"):
        quantiles.medians(df, ["g"], "v", error=0.7)
    t = dt.datetime(2024, 1, 1)
    series = spark.createDataFrame([(t + dt.timedelta(hours=3 * i), None if i % 5 == 0 else float(i % 8)) for i in range(400)],
                                   "t timestamp_ntz, v double")
    exact, near = (impute.impute_pattern(series, "t", "v", "o", error=e).agg(F.sum("o")).first()[0] for e in (None, 0.001))
    assert abs(exact - near) <= 80
