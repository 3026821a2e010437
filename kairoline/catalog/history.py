"""Order-dependent queries: differences, splits, autocorrelation, ARIMA."""

from pyspark.sql import functions as F

from kairoline.catalog import query
from kairoline.catalog.gaps import GRID_NULL, grid_null
from kairoline.catalog.views import DAILY, GRID, daily, orthogonal, panel_grid, r, table
from kairoline.functions.scalars import rounded
from kairoline.operators import arima, autocorr, fill, profile, rank, split
from kairoline.operators.order import positions, previous
from kairoline.plans import presets, search

DAY = 24
_SERIES = """ff AS (SELECT user_id, t, last_value(v IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY t) AS y FROM grid)"""


USER = ["user_id"]


def _changes(spark, sf):
    filled = fill.forward_fill(panel_grid(spark, sf), USER, "t", "v", "y")
    return arima.lagged_changes(filled, USER, "t", "y")


@query("first_diff", f"WITH {DAILY}, x AS (SELECT d, y - lag(y) OVER (ORDER BY d) AS diff FROM daily) SELECT d, {r('diff', 3)} AS diff FROM x WHERE diff IS NOT NULL")
def first_diff(spark, sf):
    return arima.difference(daily(spark, sf), [], "d", "y", "diff", DAY).select("d", rounded("diff", 3).alias("diff"))


@query("inverse_diff", f"""WITH {DAILY} SELECT d, {r('y', 3)} AS y FROM daily WHERE d > (SELECT min(d) FROM daily)""")
def inverse_diff(spark, sf):
    y = daily(spark, sf)
    diffs = arima.difference(y, [], "d", "y", "diff", DAY).select("d", "diff")
    starts = y.agg(F.min_by("y", "d").alias("start"))
    return arima.undifference(diffs, starts, [], "d", "diff", "y", DAY).select("d", rounded("y", 3).alias("y"))


@query("time_split", """WITH o AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS pos, count(*) OVER () AS n FROM orders),
f AS (SELECT o.*, fold, n - (5 - fold) * (n // 6) AS start FROM o, range(5) r(fold))
SELECT o_orderkey, pos, fold::INT AS fold, CASE WHEN pos < start THEN 'train' ELSE 'test' END AS role FROM f WHERE pos < start + n // 6""")
def time_split(spark, sf):
    df = table(spark, sf, "orders").select("o_orderdate", "o_orderkey")
    return split.expanding_split(df, ["o_orderdate", "o_orderkey"], 5).select("o_orderkey", "pos", "fold", "role")


@query("holdout_split", """WITH o AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS pos, count(*) OVER () AS n FROM orders)
SELECT o_orderkey, pos, CASE WHEN pos >= n - ceil(n * 0.2) THEN 'validation' ELSE 'train' END AS role FROM o""")
def holdout_split(spark, sf):
    df = table(spark, sf, "orders").select("o_orderdate", "o_orderkey")
    return split.holdout(df, ["o_orderdate", "o_orderkey"], 0.2).select("o_orderkey", "pos", "role")


@query("row_index", "SELECT event_id, row_number() OVER (ORDER BY ts, event_id) - 1 AS pos FROM events")
def row_index(spark, sf):
    return positions(table(spark, sf, "events").select("ts", "event_id"), ["ts", "event_id"]).select("event_id", "pos")


@query("avg_rank", "SELECT event_id, value, rank() OVER (ORDER BY value) + (count(*) OVER (PARTITION BY value) - 1) / 2 AS \"rank\" FROM events")
def avg_rank(spark, sf):
    return rank.average_rank(table(spark, sf, "events").select("event_id", "value"), "value")


_DIFF = f"""{DAILY}, df AS (SELECT d, y - lag(y) OVER (ORDER BY d) AS y FROM daily),
z AS (SELECT row_number() OVER (ORDER BY d) AS i, y - avg(y) OVER () AS c FROM df WHERE y IS NOT NULL)"""


def _diffed(spark, sf):
    return arima.difference(daily(spark, sf), [], "d", "y", "diff", DAY).select("d", "diff")


@query("acf", f"""WITH {_DIFF}, lags AS (SELECT unnest(range(501)) AS lag),
s AS (SELECT lag, sum(a.c * b.c) AS s FROM lags JOIN z a ON true JOIN z b ON b.i = a.i - lag GROUP BY lag)
SELECT lag::INT AS lag, {r('s / (SELECT s FROM s WHERE lag = 0)')} AS acf FROM s""")
def acf(spark, sf):
    return autocorr.acf(_diffed(spark, sf), ["d"], "diff", 500).select("lag", rounded("acf").alias("acf"))


@query("pacf", f"""WITH RECURSIVE {_DIFF}, lags AS (SELECT unnest(range(101)) AS lag),
s AS (SELECT lag, sum(a.c * b.c) AS s FROM lags JOIN z a ON true JOIN z b ON b.i = a.i - lag GROUP BY lag),
rho AS (SELECT list(s / (SELECT s FROM s WHERE lag = 0) ORDER BY lag) AS r FROM s),
dl(k, phi, last) AS (
  SELECT 1, [r[2]], r[2] FROM rho
  UNION ALL
  SELECT k + 1, list_append(list_transform(range(1, k + 1), lambda j: phi[j] - q * phi[k + 1 - j]), q), q FROM (
    SELECT k, phi, (r[k + 2] - list_sum(list_transform(range(1, k + 1), lambda j: phi[j] * r[k + 2 - j])))
      / (1 - list_sum(list_transform(range(1, k + 1), lambda j: phi[j] * r[j + 1]))) AS q FROM dl, rho WHERE k < 100))
SELECT 0 AS lag, 1.0::DOUBLE AS pacf UNION ALL SELECT k::INT, {r('last')} FROM dl""")
def pacf(spark, sf):
    return autocorr.pacf(_diffed(spark, sf), ["d"], "diff", 100).select("lag", rounded("pacf").alias("pacf"))


_ADF_LAGS = 27  # ceil(12 (n / 100) ^ 0.25) for the 2,398 daily changes
_LAGGED = [f"d{k}" for k in range(1, _ADF_LAGS + 1)]
_ADF_ROWS = f"""{DAILY}, ch AS (SELECT d, y - lag(y) OVER (ORDER BY d) AS y FROM daily),
base AS (SELECT row_number() OVER (ORDER BY d) - 1 AS pos, y - lag(y) OVER (ORDER BY d) AS d0, lag(y) OVER (ORDER BY d) AS level FROM ch WHERE y IS NOT NULL),
rowset AS MATERIALIZED (SELECT pos, d0, level, {', '.join(f'lag(d0, {k}) OVER (ORDER BY pos) AS d{k}' for k in range(1, _ADF_LAGS + 1))} FROM base),
common AS (SELECT * FROM rowset WHERE pos > {_ADF_LAGS})"""


def _adf_aic(p: int) -> str:
    """Errors left after the level and p lags: the target less its part along each column."""
    left = " - ".join(["yy", *[f"p_{c}" for c in ("level", *_LAGGED[:p])]])
    return f"SELECT {p} AS p, n * (ln(({left}) / n) + ln(2 * pi()) + 1) + 2 * ({p} + 2) AS aic FROM along"


@query("adf_stat", f"""WITH {_ADF_ROWS}, {orthogonal('parts', 'common', ['level', *_LAGGED], ['d0'])},
along AS (SELECT count(*) AS n, sum((d0 - m) ** 2) AS yy, {', '.join(f'sum(d0 * {c}) ** 2 / sum({c} * {c}) AS p_{c}' for c in ('level', *_LAGGED))}
  FROM parts, (SELECT avg(d0) AS m FROM parts)),
best AS MATERIALIZED (SELECT arg_min(p, aic) AS p FROM ({' UNION ALL '.join(_adf_aic(p) for p in range(_ADF_LAGS + 1))})),
own AS (SELECT d0, level, {', '.join(f'CASE WHEN p >= {k} THEN d{k} ELSE 0 END AS d{k}' for k in range(1, _ADF_LAGS + 1))} FROM rowset, best WHERE pos > p),
{orthogonal('last', 'own', [*_LAGGED, 'level', 'd0'])},
lv AS (SELECT level AS x, d0 + w * level AS y, d0 AS e FROM last, (SELECT w_d0 AS w FROM last_w{_ADF_LAGS})),
t AS (SELECT sum(x * y) / sum(x * x) / sqrt(sum(e * e) / (count(*) - (SELECT p FROM best) - 2) / sum(x * x)) AS statistic, count(*) AS nobs FROM lv)
SELECT {r('statistic', 5)} AS statistic, (SELECT p FROM best)::INT AS used_lag, nobs FROM t""")
def adf_stat(spark, sf):
    a = autocorr.adf(_diffed(spark, sf), ["d"], "diff")
    return a.select(rounded("statistic", 5).alias("statistic"), "used_lag", "nobs")


@query("adf_test")
def adf_test(spark, sf):
    """With p-value and critical values, which come from published tables."""
    return autocorr.adf(_diffed(spark, sf), ["d"], "diff")


_D1 = f"""{GRID}, {_SERIES}, a AS (SELECT *, y - lag(y) OVER w AS d FROM ff WINDOW w AS (PARTITION BY user_id ORDER BY t)),
b AS (SELECT *, lag(d) OVER (PARTITION BY user_id ORDER BY t) AS d1 FROM a WHERE d IS NOT NULL)"""
_AR = "ar AS (SELECT user_id, regr_intercept(d, d1) AS const, regr_slope(d, d1) AS phi, count(*) AS n FROM b WHERE d1 IS NOT NULL GROUP BY 1)"


@query("ar1_fit", f"WITH {_D1}, {_AR} SELECT user_id, {r('const')} AS const, {r('phi')} AS phi, n FROM ar")
def ar1_fit(spark, sf):
    f = arima.fit_ar1(_changes(spark, sf), USER)
    return f.select("user_id", rounded("const").alias("const"), rounded("phi").alias("phi"), "n")


_MA = """mu AS (SELECT user_id, avg(d) AS mean, count(*) AS n FROM b GROUP BY 1),
rr AS (SELECT b.user_id, any_value(mean) AS mean, any_value(n) AS n, sum((d - mean) * (d1 - mean)) / sum((d - mean) * (d - mean)) AS r
  FROM b JOIN mu ON b.user_id = mu.user_id GROUP BY b.user_id),
ma AS (SELECT user_id, mean, n, CASE WHEN abs(r) >= 0.5 THEN sign(r) WHEN r = 0 THEN 0 ELSE (1 - sqrt(1 - 4 * r * r)) / (2 * r) END AS theta FROM rr)"""


@query("ma1_fit", f"WITH {_D1}, {_MA} SELECT user_id, {r('mean')} AS mean, {r('theta', 5)} AS theta, n FROM ma")
def ma1_fit(spark, sf):
    f = arima.fit_ma1(_changes(spark, sf), USER)
    return f.select("user_id", rounded("mean").alias("mean"), rounded("theta", 5).alias("theta"), "n")


@query("arima_predict", f"""WITH {_D1}, {_AR}, p AS (
  SELECT b.user_id, b.t, b.y, coalesce(const + phi * d1, const / (1 - phi)) AS step FROM b JOIN ar ON b.user_id = ar.user_id),
s AS (SELECT user_id, arg_min(y, t) AS y0 FROM ff GROUP BY 1)
SELECT p.user_id, t, {r('y0 + sum(step) OVER (PARTITION BY p.user_id ORDER BY t)', 5)} AS prediction FROM p JOIN s ON p.user_id = s.user_id""")
def arima_predict(spark, sf):
    c = _changes(spark, sf)
    f = arima.fit_ar1(c, USER)
    p = arima.predict_ar1(c, f, USER, "t", "y")
    return p.select("user_id", "t", rounded("prediction", 5).alias("prediction"))


@query("arima_forecast", f"""WITH RECURSIVE {_D1}, {_AR}, e AS (SELECT user_id, arg_max(y, t) AS y, arg_max(d, t) AS d FROM b GROUP BY 1),
f(user_id, h, y, d, const, phi) AS (
  SELECT e.user_id, 1, y + const + phi * d, const + phi * d, const, phi FROM e JOIN ar ON e.user_id = ar.user_id
  UNION ALL SELECT user_id, h + 1, y + const + phi * d, const + phi * d, const, phi FROM f WHERE h < 8)
SELECT user_id, h, {r('y', 5)} AS forecast FROM f""")
def arima_forecast(spark, sf):
    c = _changes(spark, sf)
    f = arima.fit_ar1(c, USER)
    p = arima.forecast_ar1(c, f, USER, "t", "y", 8)
    return p.select("user_id", "h", rounded("forecast", 5).alias("forecast"))


@query("ma_forecast", f"""WITH {_D1}, {_MA}, e AS (SELECT user_id, max(t) AS te, arg_max(y, t) AS ye FROM b GROUP BY 1),
w AS (SELECT b.user_id, any_value(ye) AS ye, any_value(mean) AS mean, any_value(theta) AS theta,
  sum(power(-theta, date_diff('hour', t, te) / 3) * (d - mean)) AS res FROM b JOIN e ON b.user_id = e.user_id JOIN ma ON b.user_id = ma.user_id GROUP BY b.user_id)
SELECT user_id, h::INT AS h, {r('ye + theta * res + h * mean', 5)} AS forecast FROM w, range(1, 9) s(h)""")
def ma_forecast(spark, sf):
    c = _changes(spark, sf)
    f = arima.fit_ma1(c, USER)
    p = arima.forecast_ma1(c, f, USER, "t", "y", 8)
    return p.select("user_id", "h", rounded("forecast", 5).alias("forecast"))


@query("actual_vs_pred", f"""WITH {DAILY}, x AS (SELECT d, y - lag(y) OVER (ORDER BY d) AS diff FROM daily),
p AS (SELECT d, diff AS actual, lag(diff) OVER (ORDER BY d) AS predicted FROM x WHERE diff IS NOT NULL)
SELECT d, {r('actual', 3)} AS actual, {r('predicted', 3)} AS predicted, (SELECT min(actual) < 0 AND max(actual) > 0 FROM p) AS crosses_zero
FROM p WHERE predicted IS NOT NULL""")
def actual_vs_pred(spark, sf):
    """Daily changes beside the change of the day before."""
    actual = _diffed(spark, sf)
    predicted = previous(actual, [], "d", "diff", "before", DAY).where("before IS NOT NULL").select("d", "before")
    both = profile.actual_vs_predicted(actual, predicted, ["d"], "diff", "before")
    return both.select("d", rounded("actual", 3).alias("actual"), rounded("predicted", 3).alias("predicted"), "crosses_zero")


_TE = "date_diff('hour', te, c.t) / 3"


@query("arima_cv", f"""WITH {GRID}, {_SERIES}, o AS (SELECT *, row_number() OVER (ORDER BY t, user_id) - 1 AS pos, count(*) OVER () AS n FROM ff),
sg AS (SELECT *, CASE WHEN pos < n - 5 * (n // 6) THEN 0 ELSE 1 + (pos - (n - 5 * (n // 6))) // (n // 6) END AS seg FROM o),
c AS (SELECT *, lag(d) OVER (PARTITION BY user_id ORDER BY t) AS d1 FROM (
  SELECT *, y - lag(y) OVER (PARTITION BY user_id ORDER BY t) AS d FROM sg) WHERE d IS NOT NULL),
tr AS (SELECT c.*, fold FROM c JOIN range(5) q(fold) ON seg <= fold),
fit AS (SELECT user_id, fold, coalesce(regr_slope(d, d1), 0) AS phi, avg(d) AS mean, coalesce(regr_intercept(d, d1), avg(d)) AS const,
  max(t) AS te, arg_max(y, t) AS ye, arg_max(d, t) AS de FROM tr GROUP BY 1, 2),
rr AS (SELECT user_id, fold, CASE WHEN sum((d - mean) ** 2) > 0 THEN sum((d - mean) * (d1 - mean)) / sum((d - mean) ** 2) ELSE 0 END AS r
  FROM tr JOIN fit USING (user_id, fold) GROUP BY 1, 2),
th AS (SELECT user_id, fold, CASE WHEN abs(r) >= 0.5 THEN sign(r) WHEN r = 0 OR r IS NULL THEN 0 ELSE (1 - sqrt(1 - 4 * r * r)) / (2 * r) END AS theta FROM rr),
re AS (SELECT user_id, fold, any_value(theta) AS theta, sum(power(-theta, date_diff('hour', t, te) / 3) * (d - mean)) AS e
  FROM tr JOIN fit USING (user_id, fold) JOIN th USING (user_id, fold) GROUP BY 1, 2),
e AS (SELECT f.fold, c.y, ye + {_TE} * const / (1 - phi) + (de - const / (1 - phi)) * phi * (1 - power(phi, {_TE})) / (1 - phi) AS ar,
    ye + theta * e + {_TE} * mean AS ma
  FROM c JOIN fit f ON f.user_id = c.user_id AND f.fold = c.seg - 1 JOIN re ON re.user_id = c.user_id AND re.fold = f.fold)
SELECT 'AR' AS model_type, fold::INT AS fold, {r('sqrt(avg((y - ar) ** 2))', 4)} AS rmse FROM e GROUP BY fold
UNION ALL SELECT 'MA1', fold::INT, {r('sqrt(avg((y - ma) ** 2))', 4)} FROM e GROUP BY fold""")
def arima_cv(spark, sf):
    """Series models on the folds of the search: all users and folds from one set of sums."""
    filled = fill.forward_fill(panel_grid(spark, sf), USER, "t", "v", "y")
    folds = search.make_folds(filled, ["t", "user_id"], [], "y", series=USER)
    rows = [(c.type, f, e) for c in presets.ARIMA for f, e in enumerate(search.fold_errors(folds, c))]
    folds.release()
    return spark.createDataFrame(rows, "model_type string, fold int, rmse double").select(
        "model_type", "fold", rounded("rmse", 4).alias("rmse"))


_D1_NULL = _D1.replace(GRID, GRID_NULL)


@query("first_diff_null_series", f"WITH {_D1_NULL} SELECT user_id, t, {r('d')} AS d FROM a WHERE d IS NOT NULL")
def first_diff_null_series(spark, sf):
    filled = fill.forward_fill(grid_null(spark, sf), USER, "t", "v", "y")
    return arima.difference(filled.select("user_id", "t", "y"), USER, "t", "y").select("user_id", "t", rounded("d").alias("d"))


@query("arima_predict_null_series", f"""WITH {_D1_NULL}, {_AR}, p AS (
  SELECT b.user_id, b.t, b.y, coalesce(const + phi * d1, const / (1 - phi)) AS step FROM b JOIN ar ON b.user_id IS NOT DISTINCT FROM ar.user_id),
s AS (SELECT user_id, arg_min(y, t) AS y0 FROM ff GROUP BY 1)
SELECT p.user_id, t, {r('y0 + sum(step) OVER (PARTITION BY p.user_id ORDER BY t)', 5)} AS prediction
FROM p JOIN s ON p.user_id IS NOT DISTINCT FROM s.user_id""")
def arima_predict_null_series(spark, sf):
    filled = fill.forward_fill(grid_null(spark, sf), USER, "t", "v", "y")
    c = arima.lagged_changes(filled, USER, "t", "y")
    p = arima.predict_ar1(c, arima.fit_ar1(c, USER), USER, "t", "y")
    return p.select("user_id", "t", rounded("prediction", 5).alias("prediction"))
