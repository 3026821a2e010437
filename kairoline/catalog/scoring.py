"""Streaming queries: request documents in, predictions and quarantined rows out."""

from pyspark.ml import Pipeline
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kairoline.catalog import query
from kairoline.catalog.views import r, table
from kairoline.functions.scalars import rounded
from kairoline.operators.contract import Field
from kairoline.plans.regressors import build
from kairoline.session import scratch_path
from kairoline.sources import readers
from kairoline.streaming import scoring

FEATURES = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("k", T.DoubleType()),
                         T.StructField("value", T.DoubleType())])
CONTRACT = (Field("event_id", "bigint"), Field("k", "double", rule="positive"), Field("value", "double", rule="non_negative"))
_BASE = """e AS (SELECT event_id, (props::JSON ->> 'k')::DOUBLE AS k, value - 1 AS value FROM events),
b AS (SELECT regr_slope(value, k) AS s, regr_intercept(value, k) AS i FROM e)"""


def _features(spark, sf):
    k = F.from_json("props", "k double")["k"]
    return table(spark, sf, "events").select("event_id", k.alias("k"), (F.col("value") - 1).alias("value"))


def _documents(spark, sf):
    """The events as request documents, one per line."""
    path = scratch_path(spark, "requests")
    doc = F.to_json(F.struct(F.struct("event_id", "k", "value").alias("features")))
    _features(spark, sf).select(doc.alias("value")).write.text(path)
    return path


def _model(spark, sf):
    return Pipeline(stages=build("LinearRegression", {}, ["k"], "value")).fit(_features(spark, sf))


@query("json_requests", f"WITH {_BASE} SELECT event_id, k, {r('value')} AS value FROM e")
def json_requests(spark, sf):
    requests = spark.read.text(_documents(spark, sf))
    return readers.parse_requests(requests, "value", FEATURES).select("event_id", "k", rounded("value").alias("value"))


@query("stream_score", f"WITH {_BASE} SELECT event_id, {r('i + s * k')} AS prediction FROM e, b WHERE value >= 0 AND k > 0")
def stream_score(spark, sf):
    out = scratch_path(spark, "scored")
    stream = scoring.request_stream(spark, _documents(spark, sf), FEATURES)
    job = scoring.score_stream(stream, _model(spark, sf), CONTRACT, ["event_id"], out, scratch_path(spark, "state"))
    job.awaitTermination()
    return spark.read.parquet(out).select("event_id", rounded("prediction").alias("prediction"))


@query("stream_quarantine", f"""WITH {_BASE} SELECT event_id, concat_ws(',', CASE WHEN k <= 0 THEN 'positive:k' END, CASE WHEN value < 0 THEN 'non_negative:value' END) AS errors
FROM e WHERE value < 0 OR k <= 0""")
def stream_quarantine(spark, sf):
    out, held = scratch_path(spark, "scored"), scratch_path(spark, "held")
    stream = scoring.request_stream(spark, _documents(spark, sf), FEATURES)
    job = scoring.score_with_quarantine(stream, _model(spark, sf), CONTRACT, ["event_id"], out, held, scratch_path(spark, "state"))
    job.awaitTermination()
    return spark.read.parquet(held).select("event_id", F.concat_ws(",", "errors").alias("errors"))
