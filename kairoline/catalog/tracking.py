"""Run-table and file round-trip queries. The tables are written to new scratch folders."""

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kairoline.catalog import query
from kairoline.catalog.selection import _BOARD, _board
from kairoline.catalog.views import WIDE, r, table, wide
from kairoline.functions.scalars import rounded
from kairoline.plans import stages, tracking
from kairoline.session import scratch_path
from kairoline.sources import readers, sinks


def _tables(spark):
    return tracking.RunTables(spark, scratch_path(spark, "runs"))


@query("leaderboard_log", f"""WITH {_BOARD} SELECT seq, line || '/' || model_type AS model_type, {r('cv_rmse', 4)} AS cv_rmse, line AS segment FROM board""")
def leaderboard_log(spark, sf):
    tables = _tables(spark)
    board = _board(spark, sf).select(
        "seq", F.concat_ws("/", "line", "model_type").alias("model_type"), "cv_rmse", F.create_map(F.lit("segment"), "line").alias("params"))
    tables.log_scores("run-1", board)
    return tables.read("scores").select("seq", "model_type", rounded("cv_rmse", 4).alias("cv_rmse"), F.col("params")["segment"].alias("segment"))


_VERSIONS = """versions AS (SELECT o_orderpriority AS model_name, year(o_orderdate)::BIGINT AS version, stddev_pop(o_totalprice) AS cv_rmse FROM orders GROUP BY 1, 2)"""


def _versions(spark, sf):
    return table(spark, sf, "orders").groupBy(
        F.col("o_orderpriority").alias("model_name"), F.year("o_orderdate").cast("bigint").alias("version")).agg(
        F.stddev_pop("o_totalprice").alias("cv_rmse"), F.count("*").alias("event_seq"))


@query("production_lookup", f"""WITH {_VERSIONS}, aliases AS (SELECT o_orderpriority AS model_name, year(o_orderdate)::BIGINT AS version, count(*) AS event_seq FROM orders GROUP BY 1, 2),
p AS (SELECT model_name, arg_max(version, event_seq * 10000 + version) AS version FROM aliases GROUP BY 1)
SELECT v.model_name, v.version, {r('cv_rmse', 4)} AS cv_rmse FROM versions v JOIN p ON v.model_name = p.model_name AND v.version = p.version""")
def production_lookup(spark, sf):
    """A version per order year, with the alias moved in order of yearly counts."""
    tables, rows = _tables(spark), _versions(spark, sf)
    tables.append("versions", rows)
    tables.append("aliases", rows.select("model_name", "version", F.lit("production").alias("alias"),
                                         (F.col("event_seq") * 10000 + F.col("version")).alias("event_seq")))
    current = tracking.current_version(tables.read("versions"), tables.read("aliases"))
    return current.select("model_name", "version", rounded("cv_rmse", 4).alias("cv_rmse"))


def _daily_runs(spark, sf):
    """A run record per order day."""
    tables = _tables(spark)
    runs = table(spark, sf, "orders").groupBy(F.col("o_orderdate").alias("created_at")).agg(
        F.concat(F.lit("run-"), F.min("o_orderkey").cast("string")).alias("run_id"), F.lit("Ridge").alias("model_type"),
        F.avg("o_totalprice").alias("cv_rmse"), F.count("*").alias("rows"), (F.count("*") > 5).alias("is_new"), F.lit("done").alias("status"))
    tables.append("runs", runs.withColumn("path", F.concat(F.lit("models/"), F.col("run_id"))))
    return tables


@query("latest_pointer", """WITH d AS (SELECT o_orderdate AS created_at, 'models/run-' || min(o_orderkey) AS path FROM orders GROUP BY 1)
SELECT arg_max(path, created_at) AS path, max(created_at) AS created_at FROM d""")
def latest_pointer(spark, sf):
    return _daily_runs(spark, sf).latest_path()


@query("run_summary", f"""SELECT strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS executed, 'run-' || min(o_orderkey) AS run_id, 'Ridge' AS model_type,
  {r('avg(o_totalprice)', 5)} AS cv_rmse, count(*) AS "rows", CASE WHEN count(*) > 5 THEN 'new model uploaded' ELSE 'existing model kept' END AS outcome,
  'done' AS status FROM orders GROUP BY o_orderdate""")
def run_summary(spark, sf):
    return _daily_runs(spark, sf).summary().withColumn("cv_rmse", rounded("cv_rmse", 5))


@query("missing_outputs", "SELECT DISTINCT 'segment=' || c_mktsegment AS expected FROM customer WHERE c_mktsegment NOT IN (SELECT c_mktsegment FROM customer GROUP BY 1 HAVING avg(c_acctbal) > 4500)")
def missing_outputs(spark, sf):
    """One folder is expected per market segment; only some are written."""
    customers = table(spark, sf, "customer")
    rich = customers.groupBy("c_mktsegment").agg(F.avg("c_acctbal").alias("a")).where("a > 4500").select("c_mktsegment")
    root = scratch_path(spark, "outputs")
    kept = customers.join(F.broadcast(rich), "c_mktsegment")
    kept.select("c_custkey", F.col("c_mktsegment").alias("segment")).write.partitionBy("segment").parquet(root)
    expected = [f"segment={x[0]}" for x in customers.select("c_mktsegment").distinct().collect()]  # a few segments
    return sinks.missing_outputs(spark, root, expected)


@query("feature_sink", f"SELECT p_partkey, replace(p_brand, 'Brand#', '')::DOUBLE AS brand, p_retailprice FROM part")
def feature_sink(spark, sf):
    from kairoline.functions.scalars import strip_prefix
    path = scratch_path(spark, "features")
    sinks.write_features(table(spark, sf, "part").select("p_partkey", strip_prefix("p_brand", "Brand#").alias("brand"), "p_retailprice"), path)
    return spark.read.parquet(path)


@query("prediction_sink", "SELECT o_orderkey, o_totalprice * 2 AS prediction FROM orders")
def prediction_sink(spark, sf):
    path = scratch_path(spark, "predictions")
    sinks.write_predictions(table(spark, sf, "orders").withColumn("prediction", F.col("o_totalprice") * 2), path, ["o_orderkey"])
    return spark.read.parquet(path)


@query("csv_scan", "SELECT s_suppkey, s_name, s_nationkey::BIGINT AS s_nationkey, s_acctbal FROM supplier")
def csv_scan(spark, sf):
    path = scratch_path(spark, "csv")
    sinks.write_features(table(spark, sf, "supplier"), path, "csv")
    schema = T.StructType([T.StructField("s_suppkey", T.LongType()), T.StructField("s_name", T.StringType()),
                           T.StructField("s_nationkey", T.LongType()), T.StructField("s_acctbal", T.DoubleType())])
    return readers.read_csv(spark, path, schema)


_HD = "hour(t) AS h, isodow(t) - 1 AS d"
_PREPARED = f"""{WIDE}, k AS (SELECT *, {_HD} FROM wide), hd AS (SELECT h, d, median(click) AS med FROM k GROUP BY 1, 2), hh AS (SELECT h, median(click) AS med FROM k GROUP BY 1),
dd AS (SELECT d, median(click) AS med FROM k GROUP BY 1), gg AS (SELECT median(click) AS med FROM k),
i AS (SELECT k.user_id, k.t, coalesce(k.click, hd.med, hh.med, dd.med, gg.med) AS click, sin(2 * pi() * k.h / 24) AS hour_sin
  FROM k LEFT JOIN hd ON k.h = hd.h AND k.d = hd.d LEFT JOIN hh ON k.h = hh.h LEFT JOIN dd ON k.d = dd.d CROSS JOIN gg),
m AS (SELECT avg(click) AS mc, stddev_pop(click) AS sc, avg(hour_sin) AS mh, stddev_pop(hour_sin) AS sh FROM i)"""


@query("roundtrip_stages", f"""WITH {_PREPARED} SELECT user_id, t, {r('(click - mc) / sc')} AS click, {r('(hour_sin - mh) / sh')} AS hour_sin FROM i, m""")
def roundtrip_stages(spark, sf):
    """Fit grid, calendar, imputation and scaling; save, load and apply."""
    df = wide(spark, sf).select("user_id", "t", "click", "view", "error", "purchase", "signup")
    fitted = Pipeline(stages=[
        stages.ReadingPrep(timeCol="t", hours=6, seriesCols=["user_id"], mode="cyclical", dropCols=[]),
        stages.build_imputer("SimplifiedPatternImputer", "click", "t", ["user_id"]),
        stages.PopulationScaler(inputCols=["click", "hour_sin"]),
    ]).fit(df)
    path = scratch_path(spark, "model")
    fitted.write().overwrite().save(path)
    out = PipelineModel.load(path).transform(df)
    return out.select("user_id", "t", rounded("click").alias("click"), rounded("hour_sin").alias("hour_sin"))
