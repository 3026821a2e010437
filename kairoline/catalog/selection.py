"""Cross-validation, search and champion queries."""

from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from kairoline.catalog import query
from kairoline.catalog.views import r, table
from kairoline.functions.scalars import rounded
from kairoline.operators import profile
from kairoline.plans import champion, search, tracking
from kairoline.plans.regressors import build
from kairoline.session import scratch_path

K = 5
ORDER = ["o_orderdate", "o_orderkey"]
# Orders in time order, the time as single feature, and the sums of every expanding training part.
_FOLDS = f"""o AS (SELECT o_totalprice AS y, date_diff('day', TIMESTAMP '1995-01-01', o_orderdate)::DOUBLE AS x,
    row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS pos, count(*) OVER () AS n FROM orders),
f AS (SELECT o.*, fold, pos < n - ({K} - fold) * (n // {K + 1}) AS is_train
    FROM o, range({K}) q(fold) WHERE pos < n - ({K} - fold) * (n // {K + 1}) + n // {K + 1}),
t AS (SELECT fold, count(*)::DOUBLE AS m, avg(x) AS mx, avg(y) AS my, covar_pop(x, y) AS cxy, var_pop(x) AS vx FROM f WHERE is_train GROUP BY 1)"""


def _orders(spark, sf):
    days = F.timestamp_diff("DAY", F.expr("TIMESTAMP_NTZ'1995-01-01 00:00:00'"), F.col("o_orderdate"))
    return table(spark, sf, "orders").select(*ORDER, F.col("o_totalprice").alias("label"), days.cast("double").alias("x"))


def _folds(spark, sf, **kw):
    return search.make_folds(_orders(spark, sf), ORDER, ["x"], "label", K, **kw)


@query("cv_fold_rmse", f"""WITH {_FOLDS} SELECT fold::INT AS fold, {r('sqrt(avg((y - my - cxy / vx * (x - mx)) ** 2))', 4)} AS rmse
FROM f JOIN t USING (fold) WHERE NOT is_train GROUP BY fold""")
def cv_fold_rmse(spark, sf):
    folds = _folds(spark, sf)
    errors = search.fold_errors(folds, search.Candidate("LinearRegression"))
    folds.release()
    return spark.createDataFrame(list(enumerate(errors)), "fold int, rmse double").select("fold", rounded("rmse", 4).alias("rmse"))


@query("cv_rmse", f"""WITH {_FOLDS}, e AS (SELECT fold, sqrt(avg((y - my - cxy / vx * (x - mx)) ** 2)) AS rmse
FROM f JOIN t USING (fold) WHERE NOT is_train GROUP BY fold) SELECT 'LinearRegression' AS model_type, {r('avg(rmse)', 4)} AS cv_rmse FROM e""")
def cv_rmse(spark, sf):
    folds = _folds(spark, sf)
    found = search.evaluate(folds, [search.Candidate("LinearRegression")], tuning=False)
    folds.release()
    return search.leaderboard(spark, found).select("model_type", rounded("cv_rmse", 4).alias("cv_rmse"))


# With standardised x (variance 1 on the training part) the coefficient has a closed form.
_RIDGE = f"""a(seq, alpha) AS (VALUES (0, 0.1), (1, 1.0), (2, 10.0), (3, 100.0)),
e AS (SELECT seq, alpha, fold, sqrt(avg((y - my - (m * cxy / sqrt(vx)) / (m + alpha) * (x - mx) / sqrt(vx)) ** 2)) AS rmse
  FROM f JOIN t USING (fold), a WHERE NOT is_train GROUP BY ALL),
g AS (SELECT seq, alpha, avg(rmse) AS cv_rmse FROM e GROUP BY 1, 2)"""
RIDGE = search.Candidate("Ridge", {"alpha": 1.0, "random_state": 42}, True, {"alpha": [0.1, 1.0, 10.0, 100.0]})
NET = search.Candidate("ElasticNet", {"alpha": 1.0, "l1_ratio": 0.5}, True,
                       {"alpha": [100.0, 1000.0, 10000.0], "l1_ratio": [0.1, 0.3, 0.5, 0.7, 0.9]})


@query("grid_search", f"WITH {_FOLDS}, {_RIDGE} SELECT seq::BIGINT AS seq, alpha::VARCHAR AS alpha, {r('cv_rmse', 4)} AS cv_rmse FROM g")
def grid_search(spark, sf):
    folds = _folds(spark, sf)
    found = search.search(folds, RIDGE, search_type="grid")
    folds.release()
    return search.trials(spark, found).select("seq", F.col("params")["alpha"].alias("alpha"), rounded("cv_rmse", 4).alias("cv_rmse"))


@query("random_search", f"""WITH {_FOLDS}, a AS (SELECT alpha, l1 FROM (VALUES (100.0), (1000.0), (10000.0)) q(alpha), (VALUES (0.1), (0.3), (0.5), (0.7), (0.9)) w(l1)),
e AS (SELECT alpha, l1, fold, sqrt(avg((y - my - sign(cxy) * greatest(abs(cxy / sqrt(vx)) - alpha * l1, 0) / (1 + alpha * (1 - l1)) * (x - mx) / sqrt(vx)) ** 2)) AS rmse
  FROM f JOIN t USING (fold), a WHERE NOT is_train GROUP BY ALL)
SELECT alpha::DOUBLE::VARCHAR AS alpha, l1::DOUBLE::VARCHAR AS l1_ratio, {r('avg(rmse)', 4)} AS cv_rmse FROM e GROUP BY alpha, l1""")
def random_search(spark, sf):
    folds = _folds(spark, sf)
    found = search.search(folds, NET, search_type="random", n_iter=30)
    folds.release()
    return search.trials(spark, found).select(
        F.col("params")["alpha"].alias("alpha"), F.col("params")["l1_ratio"].alias("l1_ratio"), rounded("cv_rmse", 4).alias("cv_rmse"))


NEAR = search.Candidate("KNeighborsRegressor", {"n_neighbors": 8}, False, {"n_neighbors": [2, 5, 8], "weights": ["uniform", "distance"]})


@query("cv_neighbours", f"""WITH c AS (SELECT c_custkey AS id, c_acctbal AS a, c_nationkey AS b, coalesce(sum(o_totalprice), 0) AS y,
    row_number() OVER (ORDER BY c_custkey) - 1 AS pos, count(*) OVER () AS n FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY 1, 2, 3),
f AS (SELECT c.*, fold, pos < n - (3 - fold) * (n // 4) AS is_train FROM c, range(3) q(fold) WHERE pos < n - (3 - fold) * (n // 4) + n // 4),
d AS (SELECT t.fold, t.id, t.y, s.y AS v, round(sqrt((t.a - s.a) ** 2 + (t.b - s.b) ** 2), 9) AS d, s.id AS other
  FROM f t JOIN f s ON t.fold = s.fold AND NOT t.is_train AND s.is_train),
k AS (SELECT *, row_number() OVER (PARTITION BY fold, id ORDER BY d, other) AS rk FROM d),
p AS (SELECT fold, id, any_value(y) AS y, kk, w, CASE WHEN w = 'uniform' THEN avg(v) ELSE
    coalesce(avg(v) FILTER (d = 0), sum(v / d) FILTER (d > 0) / sum(1 / d) FILTER (d > 0)) END AS p
  FROM k, (VALUES (2), (5), (8)) q(kk), (VALUES ('uniform'), ('distance')) r(w) WHERE rk <= kk GROUP BY fold, id, kk, w),
e AS (SELECT kk, w, fold, sqrt(avg((y - p) ** 2)) AS rmse FROM p GROUP BY ALL)
SELECT kk::VARCHAR AS n_neighbors, w AS weights, {r('avg(rmse)', 4)} AS cv_rmse FROM e GROUP BY kk, w""")
def cv_neighbours(spark, sf):
    """Six points of the grid over three folds: one neighbour join per fold."""
    spend = table(spark, sf, "orders").groupBy("o_custkey").agg(F.sum("o_totalprice").alias("_s"))
    customers = table(spark, sf, "customer").select("c_custkey", "c_acctbal", "c_nationkey")
    rows = customers.join(spend, F.col("c_custkey") == F.col("o_custkey"), "left").select(
        "c_custkey", "c_acctbal", "c_nationkey", F.coalesce("_s", F.lit(0.0)).alias("spend"))
    folds = search.make_folds(rows, ["c_custkey"], ["c_acctbal", "c_nationkey"], "spend", 3)
    found = search.search(folds, NEAR, search_type="grid")
    folds.release()
    return search.trials(spark, found).select(
        F.col("params")["n_neighbors"].alias("n_neighbors"), F.col("params")["weights"].alias("weights"), rounded("cv_rmse", 4).alias("cv_rmse"))


@query("cv_tree")
def cv_tree(spark, sf):
    folds = _folds(spark, sf)
    candidate = search.Candidate("DecisionTreeRegressor", {"max_depth": 3}, False, {"max_depth": [2, 4]})
    found = search.search(folds, candidate, search_type="grid")
    folds.release()
    return search.trials(spark, found)


@query("score_table", f"""WITH b AS (SELECT regr_slope(o_totalprice, x) AS s, regr_intercept(o_totalprice, x) AS i FROM (
  SELECT *, date_diff('day', TIMESTAMP '1995-01-01', o_orderdate) AS x FROM orders))
SELECT o_orderkey, {r("i + s * date_diff('day', TIMESTAMP '1995-01-01', o_orderdate)", 4)} AS prediction FROM orders, b""")
def score_table(spark, sf):
    df = _orders(spark, sf)
    model = Pipeline(stages=build("LinearRegression", {}, ["x"], "label")).fit(df)
    return champion.score(model, df, ["o_orderkey"]).select("o_orderkey", rounded("prediction", 4).alias("prediction"))


_BOARD = """board AS (SELECT o_orderpriority AS line, u.seq::BIGINT AS seq, u.model_type, u.cv_rmse FROM (
  SELECT o_orderpriority, stddev_pop(o_totalprice) AS a, sqrt(avg(o_totalprice * o_totalprice)) AS b FROM orders GROUP BY 1) s,
  LATERAL (VALUES (0, 'zero', b), (1, 'mean', a), (2, 'mean_again', a)) u(seq, model_type, cv_rmse))"""
# The held champion predicts the mean of its status, learned before 1998; like the board, it is scored over all orders.
_HELD = """held AS (SELECT o_orderpriority AS line, 'held' AS model_type, sqrt(avg((o_totalprice - m) ** 2)) AS cv_rmse
  FROM orders JOIN (SELECT o_orderpriority AS p, o_orderstatus AS s, avg(o_totalprice) FILTER (o_orderdate < TIMESTAMP '1998-01-01') AS m
    FROM orders GROUP BY 1, 2) ON o_orderpriority = p AND o_orderstatus = s GROUP BY 1)"""
_PICK = "best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY line ORDER BY cv_rmse, seq) AS rk FROM board) WHERE rk = 1)"


def _board(spark, sf):
    """Scores of constant predictors per order priority."""
    s = table(spark, sf, "orders").groupBy(F.col("o_orderpriority").alias("line")).agg(
        F.stddev_pop("o_totalprice").alias("a"), F.sqrt(F.avg(F.col("o_totalprice") * F.col("o_totalprice"))).alias("b"))
    rows = [(0, "zero", "b"), (1, "mean", "a"), (2, "mean_again", "a")]
    items = F.array(*[F.struct(F.lit(i).cast("bigint").alias("seq"), F.lit(t).alias("model_type"), F.col(c).alias("cv_rmse")) for i, t, c in rows])
    return s.select("line", F.explode(items).alias("_i")).select("line", "_i.*")


def _held(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderpriority", "o_orderstatus", "o_orderdate", "o_totalprice")
    early = F.col("o_orderdate") < F.expr("TIMESTAMP_NTZ'1998-01-01 00:00:00'")
    keys = ["o_orderpriority", "o_orderstatus"]
    learned = orders.groupBy(*keys).agg(F.avg(F.when(early, F.col("o_totalprice"))).alias("m"))
    error = F.col("o_totalprice") - F.col("m")
    return orders.join(learned, keys).groupBy(F.col("o_orderpriority").alias("line")).agg(
        F.lit("held").alias("model_type"), F.sqrt(F.avg(error * error)).alias("cv_rmse"))


@query("best_candidate", f"WITH {_BOARD}, {_PICK} SELECT line, seq, model_type, {r('cv_rmse', 4)} AS cv_rmse FROM best")
def best_candidate(spark, sf):
    best = search.best_candidate(_board(spark, sf), ["line"])
    return best.select("line", "seq", "model_type", rounded("cv_rmse", 4).alias("cv_rmse"))


_DECIDED = f"""{_BOARD}, {_PICK}, {_HELD}, d AS (SELECT b.line, coalesce(h.cv_rmse <= b.cv_rmse, false) AS keep, b.model_type AS bt, b.cv_rmse AS br,
  h.model_type AS ht, h.cv_rmse AS hr FROM best b LEFT JOIN held h ON b.line = h.line)"""


@query("champion_challenger", f"""WITH {_DECIDED} SELECT line, CASE WHEN keep THEN ht ELSE bt END AS model_type,
  {r('CASE WHEN keep THEN hr ELSE br END', 4)} AS cv_rmse, CASE WHEN keep THEN 'keep' ELSE 'replace' END AS decision FROM d""")
def champion_challenger(spark, sf):
    d = tracking.upload_decision(search.best_candidate(_board(spark, sf), ["line"]), _held(spark, sf))
    return d.select("line", "model_type", rounded("cv_rmse", 4).alias("cv_rmse"), "decision")


@query("upload_decision", f"WITH {_DECIDED} SELECT line, bt AS model_type FROM d WHERE NOT keep")
def upload_decision(spark, sf):
    d = tracking.upload_decision(search.best_candidate(_board(spark, sf), ["line"]), _held(spark, sf))
    return d.where("upload").select("line", "model_type")


@query("select_and_register", f"""WITH {_FOLDS}, {_RIDGE}, l AS (SELECT fold, sqrt(avg((y - my - cxy / vx * (x - mx)) ** 2)) AS rmse
  FROM f JOIN t USING (fold) WHERE NOT is_train GROUP BY fold),
c AS (SELECT 0 AS seq, 'LinearRegression' AS model_type, avg(rmse) AS cv_rmse FROM l UNION ALL SELECT 1, 'Ridge', min(cv_rmse) FROM g),
w AS (SELECT * FROM c ORDER BY cv_rmse, seq LIMIT 1)
SELECT u.run::INT AS run, model_type, {r('cv_rmse', 4)} AS cv_rmse, u.is_new, 1::BIGINT AS version, (SELECT count(*) FROM orders) AS "rows"
FROM w, (VALUES (1, true), (2, false)) u(run, is_new)""")
def select_and_register(spark, sf):
    """Two training runs: the first registers its winner, the second keeps it."""
    tables = tracking.RunTables(spark, scratch_path(spark, "runs"))
    setup = champion.Setup(label="label", features=["x"], order=ORDER, time="o_orderdate", hours=24, calendar_mode="",
                           search_type="grid", drop=[], duplicates="keep")
    ids = []
    for _ in range(2):
        ids.append(champion.choose(_orders(spark, sf), setup, [search.Candidate("LinearRegression", scaling=True), RIDGE], tables).run_id)
    runs = tables.read("runs")
    return runs.select(
        F.when(F.col("run_id") == ids[0], 1).otherwise(2).alias("run"), "model_type", rounded("cv_rmse", 4).alias("cv_rmse"),
        "is_new", "version", "rows")
