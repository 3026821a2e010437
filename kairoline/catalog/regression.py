"""Regressor and attribution queries."""

from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from kairoline.catalog import query, tree_sql
from kairoline.catalog.views import REG, orthogonal, r, reg, table
from kairoline.functions.scalars import rounded
from kairoline.operators import attribution, gram, profile, rank
from kairoline.plans.regressors import build, neighbour_means

FEATURES = ("quantity", "discount", "tax", "dow_sin", "dow_cos", "month_sin", "month_cos", "year")
TWO = ("quantity", "discount")

# Centred sums of two features and the label.
_SUMS = f"""WITH {REG}, m AS (SELECT avg(quantity) AS ma, avg(discount) AS mb, avg(label) AS my, count(*)::DOUBLE AS n FROM reg),
s AS (SELECT any_value(ma) AS ma, any_value(mb) AS mb, any_value(my) AS my, any_value(n) AS n,
  sum((quantity - ma) ** 2) AS aa, sum((discount - mb) ** 2) AS bb, sum((quantity - ma) * (discount - mb)) AS ab,
  sum((quantity - ma) * (label - my)) AS ay, sum((discount - mb) * (label - my)) AS byy FROM reg, m)"""


def _two_sql(penalty: str, places: int = 4) -> str:
    return f"""{_SUMS}, p AS (SELECT *, aa + {penalty} AS pa, bb + {penalty} AS pb FROM s),
w AS (SELECT *, (ay * pb - byy * ab) / (pa * pb - ab * ab) AS wa, (byy * pa - ay * ab) / (pa * pb - ab * ab) AS wb FROM p)
SELECT 'quantity' AS term, {r('wa', places)} AS coef FROM w UNION ALL SELECT 'discount', {r('wb', places)} FROM w
UNION ALL SELECT 'intercept', {r('my - wa * ma - wb * mb', places)} FROM w"""


def _one_sql(coef: str, places: int = 4) -> str:
    return f"""{_SUMS}, w AS (SELECT *, {coef} AS wa FROM s)
SELECT 'quantity' AS term, {r('wa', places)} AS coef FROM w UNION ALL SELECT 'intercept', {r('my - wa * ma', places)} FROM w"""


def _soft(x: str, cut: str) -> str:
    return f"sign({x}) * greatest(abs({x}) - {cut}, 0)"


def _fit(df, kind, params, features):
    return Pipeline(stages=build(kind, params, list(features), "label")).fit(df).stages[-1]


def _terms(spark, model, features, places=4):
    values = [*zip(features, map(float, model.coefficients)), ("intercept", float(model.intercept))]
    return spark.createDataFrame(values, "term string, coef double").select("term", rounded("coef", places).alias("coef"))


def _linear(kind, params, features):
    def run(spark, sf):
        df = reg(spark, sf).select("label", *features)
        return _terms(spark, _fit(df, kind, params, features), features)
    return run


query("reg_ols", _two_sql("0"))(_linear("LinearRegression", {}, TWO))
query("reg_ridge", _two_sql("1000"))(_linear("Ridge", {"alpha": 1000.0}, TWO))
query("reg_sgd", _two_sql("n * 0.5"))(_linear("SGDRegressor", {"alpha": 0.5}, TWO))
query("reg_lasso", _one_sql(f"{_soft('ay / n', '10')} / (aa / n)"))(_linear("Lasso", {"alpha": 10.0}, TWO[:1]))
query("reg_elasticnet", _one_sql(f"{_soft('ay / n', '5')} / (aa / n + 5)"))(
    _linear("ElasticNet", {"alpha": 10.0, "l1_ratio": 0.5}, TWO[:1]))
query("reg_bayes_ridge", f"""WITH RECURSIVE {_SUMS.removeprefix('WITH ')}, q AS (SELECT s.*, (SELECT sum((label - my) ** 2) FROM reg) AS yy FROM s),
b(k, noise, weight, coef, done) AS (
  SELECT 0, 1 / (yy / n), 1.0::DOUBLE, NULL::DOUBLE, false FROM q
  UNION ALL
  SELECT k + 1, (n - eff + 2e-6) / (c * c * aa - 2 * c * ay + yy + 2e-6), (eff + 2e-6) / (c * c + 2e-6), c, coalesce(abs(coef - c) < 1e-3, false)
  FROM (SELECT b.*, q.*, ay / (aa + weight / noise) AS c, noise * aa / (weight + noise * aa) AS eff FROM b, q WHERE NOT done AND k < 300))
, w AS (SELECT *, ay / (aa + weight / noise) AS wa FROM q, (SELECT noise, weight FROM b ORDER BY k DESC LIMIT 1))
SELECT 'quantity' AS term, {r('wa', 4)} AS coef FROM w UNION ALL SELECT 'intercept', {r('my - wa * ma', 4)} FROM w""")(
    _linear("BayesianRidge", {}, TWO[:1]))


def _errors(kind, params):
    """All features; one row with the number of coefficients in use and the error on the table."""
    def run(spark, sf):
        df = reg(spark, sf)
        model = Pipeline(stages=build(kind, params, list(FEATURES), "label")).fit(df)
        last = model.stages[-1]
        used = sum(abs(c) > 1e-12 for c in last.coefficients)
        return model.transform(df).agg(profile.rmse("label", "prediction").alias("rmse")).select(
            F.lit(kind).alias("model_type"), F.lit(used).alias("coefficients"), rounded("rmse", 4).alias("rmse"))
    return run


query("reg_ols_multi", f"""WITH {REG}, {orthogonal('q', 'reg', [*FEATURES, 'label'])}
SELECT 'LinearRegression' AS model_type, 8 AS coefficients, {r('sqrt(avg(label * label))', 4)} AS rmse FROM q""")(_errors("LinearRegression", {}))
query("reg_lasso_multi")(_errors("Lasso", {"alpha": 50.0}))
query("reg_elasticnet_multi")(_errors("ElasticNet", {"alpha": 50.0, "l1_ratio": 0.5}))
query("reg_bayes_ridge_multi")(_errors("BayesianRidge", {}))


@query("gram_sums", f"WITH {REG} " + " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, {r(f'covar_pop({a}, {b})', 4)} AS cov, count(*) AS n FROM reg"
    for i, a in enumerate((*FEATURES, "label")) for b in (*FEATURES, "label")[i:]))
def gram_sums(spark, sf):
    names = (*FEATURES, "label")
    g = gram.accumulate(reg(spark, sf), FEATURES, "label")
    cov = g.centred / g.n
    rows = [(a, b, float(cov[i, names.index(b)]), int(g.n)) for i, a in enumerate(names) for b in names[i:]]
    return spark.createDataFrame(rows, "a string, b string, cov double, n bigint").select("a", "b", rounded("cov", 4).alias("cov"), "n")


_STUMP = " UNION ALL ".join(f"SELECT '{f}' AS f, {f} AS x, label FROM reg" for f in ("discount", "tax"))


@query("reg_tree", f"""WITH {REG}, long AS ({_STUMP}), v AS (SELECT f, x, count(*) AS n, sum(label) AS s FROM long GROUP BY 1, 2),
c AS (SELECT f, x, sum(n) OVER w AS nl, sum(s) OVER w AS sl, sum(n) OVER (PARTITION BY f) AS nn, sum(s) OVER (PARTITION BY f) AS ss
  FROM v WINDOW w AS (PARTITION BY f ORDER BY x)),
best AS (SELECT *, row_number() OVER (ORDER BY sl * sl / nl + (ss - sl) ** 2 / (nn - nl) DESC) AS rk FROM c WHERE nn > nl)
SELECT nl AS "rows", {r('sl / nl', 3)} AS prediction FROM best WHERE rk = 1
UNION ALL SELECT nn - nl, {r('(ss - sl) / (nn - nl)', 3)} FROM best WHERE rk = 1""")
def reg_tree(spark, sf):
    df = reg(spark, sf).select("label", "discount", "tax")
    model = Pipeline(stages=build("DecisionTreeRegressor", {"max_depth": 1}, ["discount", "tax"], "label")).fit(df)
    return model.transform(df).groupBy(rounded("prediction", 3).alias("prediction")).agg(F.count("*").alias("rows"))


def _tree(kind, params):
    def run(spark, sf):
        df = reg(spark, sf)
        model = Pipeline(stages=build(kind, params, list(FEATURES), "label")).fit(df)
        return model.transform(df).agg(profile.rmse("label", "prediction").alias("rmse")).select(
            F.lit(kind).alias("model_type"), "rmse")
    return run


query("reg_tree_deep")(_tree("DecisionTreeRegressor", {"max_depth": 6}))
query("reg_forest")(_tree("RandomForest", {"n_estimators": 10, "max_depth": 6}))

# Sines and cosines of different libraries differ in the last digit, which is enough to part equal values.
_LIST = ", ".join(f if f in ("quantity", "discount", "tax", "year") else f"round({f}, 9) + 0.0" for f in FEATURES)
_TREE_ROWS = f"SELECT label AS y, [{_LIST}] AS x FROM reg"
_STUMP_ROWS = "SELECT label AS y, [discount, tax] AS x FROM reg"


def _grown(kind, params, names=FEATURES):
    """Error on the table of a tree model over rounded features."""
    def run(spark, sf):
        df = reg(spark, sf)
        df = df.select("label", *[(F.col(f) if f in ("quantity", "discount", "tax", "year") else rounded(f, 9)).alias(f) for f in names])
        model = Pipeline(stages=build(kind, params, list(names), "label")).fit(df)
        return model.transform(df).agg(rounded(profile.rmse("label", "prediction"), 4).alias("rmse")).select(
            F.lit(kind).alias("model_type"), "rmse")
    return run


def _leaves(kind, params):
    """Predictions of a tree model on two features, with their rows."""
    def run(spark, sf):
        df = reg(spark, sf).select("label", "discount", "tax")
        model = Pipeline(stages=build(kind, params, ["discount", "tax"], "label")).fit(df)
        return model.transform(df).groupBy(rounded("prediction", 3).alias("prediction")).agg(F.count("*").alias("rows"))
    return run


def _grown_sql(kind, ctes):
    return f"WITH {REG}, {ctes} SELECT '{kind}' AS model_type, {r('sqrt(avg((y - prediction) ** 2))', 4)} AS rmse FROM pred"


def _leaves_sql(ctes):
    return f"WITH {REG}, {ctes} SELECT {r('prediction', 3)} AS prediction, count(*) AS \"rows\" FROM pred GROUP BY 1"


query("reg_extra_trees", _grown_sql("ExtraTreesRegressor", tree_sql.extra_trees(_TREE_ROWS, 10, 6)))(
    _grown("ExtraTreesRegressor", {"n_estimators": 10, "max_depth": 6}))
query("reg_gbt", _grown_sql("GradientBoostingRegressor", tree_sql.boosted(_TREE_ROWS, 10, 4, 0.1, 0.0)))(
    _grown("GradientBoostingRegressor", {"n_estimators": 10, "max_depth": 4, "learning_rate": 0.1}))
query("reg_xgb_like", _grown_sql("XGBRegressor", tree_sql.boosted(_TREE_ROWS, 10, 4, 0.1, 1.0)))(
    _grown("XGBRegressor", {"n_estimators": 10, "max_depth": 4, "learning_rate": 0.1}))
query("extra_tree_leaves", _leaves_sql(tree_sql.extra_trees(_STUMP_ROWS, 1, 2, 7)))(
    _leaves("ExtraTreesRegressor", {"n_estimators": 1, "max_depth": 2, "random_state": 7}))
query("boosted_leaves", _leaves_sql(tree_sql.boosted(_STUMP_ROWS, 2, 1, 0.3, 1.0)))(
    _leaves("XGBRegressor", {"n_estimators": 2, "max_depth": 1}))
query("reg_adaboost")(_tree("AdaBoostRegressor", {"n_estimators": 5}))

_SPEND = """spend AS (SELECT c_custkey, c_acctbal, c_nationkey, coalesce(sum(o_totalprice), 0) AS spend
  FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY 1, 2, 3)"""


def _spend(spark, sf):
    orders = table(spark, sf, "orders").groupBy("o_custkey").agg(F.sum("o_totalprice").alias("_s"))
    customers = table(spark, sf, "customer").select("c_custkey", "c_acctbal", "c_nationkey")
    joined = customers.join(orders, F.col("c_custkey") == F.col("o_custkey"), "left")
    return joined.select("c_custkey", "c_acctbal", "c_nationkey", F.coalesce("_s", F.lit(0.0)).alias("spend"))


@query("knn_regress", f"""WITH {_SPEND}, p AS (SELECT a.c_custkey AS id, b.spend, row_number() OVER (PARTITION BY a.c_custkey ORDER BY
  round(sqrt((a.c_acctbal - b.c_acctbal) ** 2 + (a.c_nationkey - b.c_nationkey) ** 2), 9), b.c_custkey) AS rk FROM spend a, spend b)
SELECT id AS c_custkey, {r('avg(spend)', 6)} AS prediction FROM p WHERE rk <= 8 GROUP BY 1""")
def knn_regress(spark, sf):
    df = _spend(spark, sf)
    stage = build("KNeighborsRegressor", {"n_neighbors": 8}, ["c_acctbal", "c_nationkey"], "spend", ["c_custkey"])[0]
    return stage.fit(df).transform(df).select("c_custkey", rounded("prediction", 6).alias("prediction"))


@query("knn_regress_distance", f"""WITH {_SPEND}, d AS (SELECT s_suppkey AS id, c_custkey AS cid, spend,
  round(sqrt((s_acctbal - c_acctbal) ** 2 + (s_nationkey - c_nationkey) ** 2), 9) AS dist FROM supplier, spend),
p AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY dist, cid) AS rk FROM d)
SELECT id AS s_suppkey, {r('coalesce(avg(spend) FILTER (dist = 0), sum(spend / dist) FILTER (dist > 0) / sum(1 / dist) FILTER (dist > 0))', 4)} AS prediction
FROM p WHERE rk <= 5 GROUP BY 1""")
def knn_regress_distance(spark, sf):
    donors = _spend(spark, sf).select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("bal"), F.col("c_nationkey").alias("nation"), "spend")
    asked = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("bal"), F.col("s_nationkey").alias("nation"))
    p = neighbour_means(asked, donors, ["id"], ["bal", "nation"], "spend", 5, "distance")
    return p.select(F.col("id").alias("s_suppkey"), rounded("prediction", 4).alias("prediction"))


_MI_FEATURES = ("quantity", "discount", "tax", "year")
_CUTS = " UNION ALL ".join(
    f"SELECT '{c}' AS c, unnest(list_distinct(quantile_cont({c}, [{', '.join(str(i / 10) for i in range(1, 10))}]))) AS cut FROM reg"
    for c in (*_MI_FEATURES, "label"))
_BINNED = ", ".join(f"(SELECT count(*) FROM cuts WHERE c = '{c}' AND cut < {c}) AS {c}" for c in (*_MI_FEATURES, "label"))
_MI_CELLS = " UNION ALL ".join(
    f"SELECT '{f}' AS feature, {f} AS bx, label AS bl, count(*)::DOUBLE AS n FROM binned GROUP BY 2, 3" for f in _MI_FEATURES)
_MI = f"""cuts AS ({_CUTS}), binned AS (SELECT {_BINNED} FROM reg), cells AS ({_MI_CELLS}),
mj AS (SELECT *, sum(n) OVER (PARTITION BY feature, bx) AS nx, sum(n) OVER (PARTITION BY feature, bl) AS ny, sum(n) OVER (PARTITION BY feature) AS nn FROM cells),
mi AS (SELECT feature, sum(n / nn * ln(n * nn / (nx * ny))) AS mutual_info FROM mj GROUP BY 1)"""


@query("mutual_info", f"WITH {REG}, {_MI} SELECT feature, {r('mutual_info', 8)} AS mutual_info FROM mi")
def mutual_info(spark, sf):
    mi = attribution.mutual_information(reg(spark, sf), _MI_FEATURES, "label")
    return mi.select("feature", rounded("mutual_info", 8).alias("mutual_info"))


@query("combined_rank", f"""WITH {REG}, {_MI},
cr AS ({' UNION ALL '.join(f"SELECT '{f}' AS feature, corr({f}, label) AS v FROM reg" for f in _MI_FEATURES[:3])}),
sl AS ({' UNION ALL '.join(f"SELECT '{f}' AS feature, regr_slope(label, {f}) AS v FROM reg" for f in _MI_FEATURES[1:])}),
j AS (SELECT feature, coalesce(mi.mutual_info, 0) AS mi, coalesce(cr.v, 0) AS corr, coalesce(sl.v, 0) AS slope
  FROM mi FULL JOIN cr USING (feature) FULL JOIN sl USING (feature))
SELECT feature, (rank() OVER (ORDER BY mi) + (count(*) OVER (PARTITION BY mi) - 1) / 2 + rank() OVER (ORDER BY abs(corr)) + (count(*) OVER (PARTITION BY abs(corr)) - 1) / 2
  + rank() OVER (ORDER BY abs(slope)) + (count(*) OVER (PARTITION BY abs(slope)) - 1) / 2)::DOUBLE AS score FROM j""")
def combined_rank(spark, sf):
    df = reg(spark, sf)
    slopes = df.agg(*[F.regr_slope("label", f).alias(f) for f in _MI_FEATURES[1:]])
    parts = {
        "mi": attribution.mutual_information(df, _MI_FEATURES, "label"),
        "corr": profile.correlations(df, _MI_FEATURES[:3], "label"),
        "slope": attribution.long_form(slopes, [(f,) for f in _MI_FEATURES[1:]], list(_MI_FEATURES[1:]), ("feature",), "v"),
    }
    return rank.combined_rank(parts, ranked=["mi", "corr", "slope"]).select("feature", "score")


@query("feature_ranking")
def feature_ranking(spark, sf):
    """The whole ranking: mutual information, forest importance and lasso size."""
    ids = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    df = reg(spark, sf, ids)
    model = Pipeline(stages=build("RandomForest", {"n_estimators": 10, "max_depth": 5}, list(FEATURES), "label")).fit(df)
    parts = {
        "mutual_info": attribution.mutual_information(df, FEATURES, "label"),
        "forest": attribution.tree_importances(FEATURES, model.stages[-1], spark),
        "lasso": attribution.lasso_path(df, FEATURES, "label", ids).select("feature", "coef"),
        "corr": profile.correlations(df, FEATURES, "label"),
    }
    return rank.combined_rank(parts, ranked=["mutual_info", "forest", "lasso"], top=50)


@query("lasso_select")
def lasso_select(spark, sf):
    df = table(spark, sf, "orders").select(
        "o_orderkey", "o_orderdate", F.col("o_totalprice").alias("label"), F.month("o_orderdate").cast("double").alias("month"),
        F.weekday("o_orderdate").cast("double").alias("dow"), F.year("o_orderdate").cast("double").alias("year"),
        F.col("o_custkey").cast("double").alias("cust"))
    return attribution.lasso_path(df, ["month", "dow", "year", "cust"], "label", ["o_orderdate", "o_orderkey"])


@query("tree_importance")
def tree_importance(spark, sf):
    model = Pipeline(stages=build("RandomForest", {"n_estimators": 10, "max_depth": 5}, list(FEATURES), "label")).fit(reg(spark, sf))
    return attribution.tree_importances(FEATURES, model.stages[-1], spark, 5)


@query("linear_attribution", f"""{_SUMS}, w AS (SELECT *, (ay * bb - byy * ab) / (aa * bb - ab * ab) AS wa, (byy * aa - ay * ab) / (aa * bb - ab * ab) AS wb FROM s)
SELECT l_orderkey, l_linenumber, l_partkey, {r('wa * (l_quantity - ma)', 4)} AS contrib_quantity, {r('wb * (l_discount - mb)', 4)} AS contrib_discount
FROM lineitem, w""")
def linear_attribution(spark, sf):
    df = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.col("l_extendedprice").alias("label"), F.col("l_quantity").alias("quantity"),
        F.col("l_discount").alias("discount"))
    fit = gram.ols(gram.accumulate(df, TWO, "label"))
    means = df.agg(*[F.avg(f).alias(f) for f in TWO]).first().asDict()
    out = attribution.linear_contributions(df, dict(zip(TWO, fit.coef)), means)
    return out.select("l_orderkey", "l_linenumber", "l_partkey", *[rounded(f"contrib_{f}", 4).alias(f"contrib_{f}") for f in TWO])


@query("attribution_ranking", f"""{_SUMS}, w AS (SELECT *, (ay * bb - byy * ab) / (aa * bb - ab * ab) AS wa, (byy * aa - ay * ab) / (aa * bb - ab * ab) AS wb FROM s)
SELECT 'quantity' AS feature, {r('avg(abs(wa * (quantity - ma)))', 4)} AS importance FROM reg, w
UNION ALL SELECT 'discount', {r('avg(abs(wb * (discount - mb)))', 4)} FROM reg, w""")
def attribution_ranking(spark, sf):
    df = reg(spark, sf).select("label", *TWO)
    fit = gram.ols(gram.accumulate(df, TWO, "label"))
    means = df.agg(*[F.avg(f).alias(f) for f in TWO]).first().asDict()
    out = attribution.mean_contributions(attribution.linear_contributions(df, dict(zip(TWO, fit.coef)), means), TWO)
    return out.select("feature", rounded("importance", 4).alias("importance"))


@query("permutation_importance")
def permutation_importance(spark, sf):
    df = table(spark, sf, "orders").select(
        "o_orderkey", F.col("o_totalprice").alias("label"), F.month("o_orderdate").cast("double").alias("month"),
        F.weekday("o_orderdate").cast("double").alias("dow"), F.col("o_custkey").cast("double").alias("cust"))
    features = ["month", "dow", "cust"]
    model = Pipeline(stages=build("DecisionTreeRegressor", {"max_depth": 5}, features, "label")).fit(df)
    return attribution.permutation_importance(df, model, features, "label", ["o_orderkey"])


@query("rmse", f"""WITH {REG}, b AS (SELECT regr_slope(label, quantity) AS s, regr_intercept(label, quantity) AS i FROM reg)
SELECT {r('sqrt(avg((label - i - s * quantity) ** 2))', 4)} AS rmse FROM reg, b""")
def rmse(spark, sf):
    df = reg(spark, sf).select("label", "quantity")
    model = Pipeline(stages=build("LinearRegression", {}, ["quantity"], "label")).fit(df)
    return model.transform(df).agg(rounded(profile.rmse("label", "prediction"), 4).alias("rmse"))
