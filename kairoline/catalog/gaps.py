"""Filling and imputation queries."""

from pyspark.sql import functions as F

from kairoline.catalog import query
from kairoline.catalog.views import GRID, KINDS, WIDE, panel, panel_grid, r, table, wide
from kairoline.functions import calendar
from kairoline.functions.scalars import rounded
from kairoline.operators import fill, impute, knn
from kairoline.operators.grid import bucket_mean, regularise

KEYS = ["user_id"]
_HDM = "hour(t) AS h, isodow(t) - 1 AS d, month(t) AS m"


def _out(df, places=6):
    return df.select("user_id", "t", rounded("v_imp", places).alias("v_imp"))


def _select(expr, places=6):
    return f"SELECT user_id, t, {r(expr, places)} AS v_imp"


@query("impute_group_median", f"""WITH {GRID}, k AS (SELECT *, {_HDM} FROM grid),
s AS (SELECT h, d, m, median(v) AS med FROM k GROUP BY 1, 2, 3)
{_select('coalesce(k.v, s.med)')} FROM k LEFT JOIN s ON k.h = s.h AND k.d = s.d AND k.m = s.m""")
def impute_group_median(spark, sf):
    return _out(impute.impute_group_median(panel_grid(spark, sf), "t", "v", "v_imp", panel(spark, sf)))


_LEVELS = """hd AS (SELECT h, d, median(v) AS med FROM k GROUP BY 1, 2), hh AS (SELECT h, median(v) AS med FROM k GROUP BY 1),
dd AS (SELECT d, median(v) AS med FROM k GROUP BY 1), gg AS (SELECT median(v) AS med FROM k)"""


@query("impute_pattern", f"""WITH {GRID}, k AS (SELECT *, {_HDM} FROM grid), {_LEVELS}
{_select('coalesce(k.v, hd.med, hh.med, dd.med, gg.med)')}
FROM k LEFT JOIN hd ON k.h = hd.h AND k.d = hd.d LEFT JOIN hh ON k.h = hh.h LEFT JOIN dd ON k.d = dd.d CROSS JOIN gg""")
def impute_pattern(spark, sf):
    return _out(impute.impute_pattern(panel_grid(spark, sf), "t", "v", "v_imp", panel(spark, sf)))


_NEAR = """near AS (SELECT *,
  last_value(CASE WHEN v IS NOT NULL THEN t END IGNORE NULLS) OVER b AS pt, last_value(v IGNORE NULLS) OVER b AS pv,
  first_value(CASE WHEN v IS NOT NULL THEN t END IGNORE NULLS) OVER f AS nt, first_value(v IGNORE NULLS) OVER f AS nv
  FROM grid WINDOW b AS (PARTITION BY user_id ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
    f AS (PARTITION BY user_id ORDER BY t ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))"""
_LINE = "pv + (nv - pv) * date_diff('second', pt, t) / date_diff('second', pt, nt)"
_LINED = f"""lined AS (SELECT *, coalesce(v, CASE WHEN date_diff('second', pt, nt) - 10800 <= 86400 THEN {_LINE} END) AS l,
  hour(t) AS h, isodow(t) - 1 AS d FROM near)"""


@query("impute_interpolate", f"""WITH {GRID}, {_NEAR}, {_LINED}, k AS (SELECT *, {_HDM} FROM grid), {_LEVELS}
{_select('coalesce(x.l, hh.med, dd.med, gg.med)', 7)}
FROM lined x LEFT JOIN hh ON x.h = hh.h LEFT JOIN dd ON x.d = dd.d CROSS JOIN gg""")
def impute_interpolate(spark, sf):
    return _out(impute.impute_interpolate(panel_grid(spark, sf), KEYS, "t", "v", "v_imp", fit_on=panel(spark, sf)), 7)


@query("interpolate_only", f"""WITH {GRID}, {_NEAR}, {_LINED} {_select('l', 7)} FROM lined""")
def interpolate_only(spark, sf):
    return _out(fill.interpolate(panel_grid(spark, sf), KEYS, "t", "v", "v_imp"), 7)


@query("gap_islands", f"""WITH {GRID}, {_NEAR}
SELECT user_id, min(t) AS gap_start, max(t) AS gap_end, count(*) AS gap_steps FROM near
WHERE v IS NULL AND pt IS NOT NULL AND nt IS NOT NULL GROUP BY user_id, pt, nt""")
def gap_islands(spark, sf):
    return fill.gap_islands(panel_grid(spark, sf), KEYS, "t", "v")


@query("impute_mean", f"""WITH {GRID} {_select('coalesce(v, (SELECT avg(v) FROM grid))')} FROM grid""")
def impute_mean(spark, sf):
    return _out(impute.impute_column(panel_grid(spark, sf), "v", "v_imp", "mean"))


@query("impute_median", f"""WITH {GRID} {_select('coalesce(v, (SELECT median(v) FROM grid))')} FROM grid""")
def impute_median(spark, sf):
    return _out(impute.impute_column(panel_grid(spark, sf), "v", "v_imp", "median"))


@query("fill_linear", f"""WITH {GRID}, {_NEAR} {_select(f'coalesce(v, {_LINE}, pv)', 7)} FROM near""")
def fill_linear(spark, sf):
    return _out(fill.linear_fill(panel_grid(spark, sf), KEYS, "t", "v", "v_imp"), 7)


@query("fill_forward", f"""WITH {GRID}, {_NEAR} {_select('pv')} FROM near""")
def fill_forward(spark, sf):
    return _out(fill.forward_fill(panel_grid(spark, sf), KEYS, "t", "v", "v_imp"))


@query("fill_backward", f"""WITH {GRID}, {_NEAR} {_select('nv')} FROM near""")
def fill_backward(spark, sf):
    return _out(fill.backward_fill(panel_grid(spark, sf), KEYS, "t", "v", "v_imp"))


@query("fill_zero", f"""WITH {GRID} {_select('coalesce(v, 0)')} FROM grid""")
def fill_zero(spark, sf):
    return _out(fill.zero_fill(panel_grid(spark, sf), "v", "v_imp"))


# Every fifth user lost its id: those readings are one series, with a mean per step.
_SOME = "nullif(user_id, user_id // 5 * 5)"
GRID_NULL = f"""panel AS (
  SELECT {_SOME} AS user_id, time_bucket(INTERVAL 3 HOURS, ts) AS t, avg(value) AS v FROM events GROUP BY 1, 2),
bounds AS (SELECT user_id, min(t) AS lo, max(t) AS hi FROM panel GROUP BY 1),
steps AS (SELECT user_id, unnest(generate_series(lo, hi, INTERVAL 3 HOURS)) AS t FROM bounds),
grid AS (SELECT s.user_id, s.t, p.v FROM steps s LEFT JOIN panel p ON s.user_id IS NOT DISTINCT FROM p.user_id AND s.t = p.t)"""


def grid_null(spark, sf):
    some = F.when(F.col("user_id") % 5 != 0, F.col("user_id"))
    return regularise(bucket_mean(table(spark, sf, "events").withColumn("user_id", some), KEYS, "ts", "value"), KEYS, "t")


_NULL_FILLS = {"forward": "pv", "backward": "nv", "linear": f"coalesce(v, {_LINE}, pv)"}
_NULL_FNS = {"forward": fill.forward_fill, "backward": fill.backward_fill, "linear": fill.linear_fill}
for _name, _sql in _NULL_FILLS.items():
    query(f"fill_{_name}_null_series", f"WITH {GRID_NULL}, {_NEAR} {_select(_sql, 7)} FROM near")(
        lambda spark, sf, fn=_NULL_FNS[_name]: _out(fn(grid_null(spark, sf), KEYS, "t", "v", "v_imp"), 7))


@query("interpolate_null_series", f"""WITH {GRID_NULL}, {_NEAR}, {_LINED} {_select('l', 7)} FROM lined""")
def interpolate_null_series(spark, sf):
    return _out(fill.interpolate(grid_null(spark, sf), KEYS, "t", "v", "v_imp"), 7)


@query("gap_islands_null_series", f"""WITH {GRID_NULL}, {_NEAR}
SELECT user_id, min(t) AS gap_start, max(t) AS gap_end, count(*) AS gap_steps FROM near
WHERE v IS NULL AND pt IS NOT NULL AND nt IS NOT NULL GROUP BY user_id, pt, nt""")
def gap_islands_null_series(spark, sf):
    return fill.gap_islands(grid_null(spark, sf), KEYS, "t", "v")


# Fills of the steps that have no reading in any column, all columns at once.
_STEPS6 = f"""{WIDE}, bounds AS (SELECT user_id, min(t) AS lo, max(t) AS hi FROM wide GROUP BY 1),
steps AS (SELECT user_id, unnest(generate_series(lo, hi, INTERVAL 6 HOURS)) AS t FROM bounds),
g AS (SELECT s.user_id, s.t, {', '.join(KINDS)}, row_number() OVER (PARTITION BY s.user_id ORDER BY s.t) AS i,
  {' AND '.join(f'{k} IS NULL' for k in KINDS)} AS empty FROM steps s LEFT JOIN wide w ON s.user_id = w.user_id AND s.t = w.t)"""
_B, _A = "OVER (PARTITION BY user_id ORDER BY t)", "OVER (PARTITION BY user_id ORDER BY t ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"


#: Added before rounding: a line across 16 or 32 steps often ends on a half of the last digit, which two engines round apart.
_OFF_HALF = 3.3e-9


def _wide_fill(mode: str) -> str:
    def one(k: str) -> str:
        before, after = f"last_value({k} IGNORE NULLS) {_B}", f"first_value({k} IGNORE NULLS) {_A}"
        at, to = (f"{f}(CASE WHEN {k} IS NOT NULL THEN i END IGNORE NULLS) {w}" for f, w in (("last_value", _B), ("first_value", _A)))
        line = f"coalesce({before} + ({after} - {before}) * (i - {at}) / ({to} - {at}), {before})"
        value = {"ffill": before, "bfill": after, "zero": "0", "interpolate": line}[mode]
        return f"{r(f'CASE WHEN empty THEN {value} ELSE {k} END + {_OFF_HALF}', 7)} AS {k}"
    return f"WITH {_STEPS6} SELECT user_id, t, {', '.join(map(one, KINDS))} FROM g"


for _mode in fill.MODES:
    query(f"grid_fill_{_mode}", _wide_fill(_mode))(lambda spark, sf, mode=_mode: fill.regularise_and_fill(
        wide(spark, sf), KEYS, "t", KINDS, mode, 6).select("user_id", "t", *[rounded(F.col(k) + F.lit(_OFF_HALF), 7).alias(k) for k in KINDS]))


_OTHERS = [k for k in KINDS if k != "click"]
_CYC = {
    "hour_sin": "sin(2 * pi() * hour(t) / 24)", "hour_cos": "cos(2 * pi() * hour(t) / 24)",
    "dow_sin": "sin(2 * pi() * (isodow(t) - 1) / 7)", "dow_cos": "cos(2 * pi() * (isodow(t) - 1) / 7)",
    "month_sin": "sin(2 * pi() * month(t) / 12)", "month_cos": "cos(2 * pi() * month(t) / 12)",
}
_COORDS = [*_CYC, *_OTHERS]
_FEATS = f"""feats AS (SELECT *, {', '.join(f'{e} AS {n}' for n, e in _CYC.items())} FROM wide)"""
_SQUARES = " + ".join(f"coalesce((a.{c} - b.{c}) * (a.{c} - b.{c}), 0)" for c in _COORDS)
_SHARED = " + ".join(f"(a.{c} IS NOT NULL AND b.{c} IS NOT NULL)::INT" for c in _COORDS)
_PAIRS = f"""pairs AS (SELECT a.user_id, a.t, b.t AS bt, b.user_id AS bu, b.click AS y,
  round(sqrt({len(_COORDS) + 1} / ({_SHARED}) * ({_SQUARES})), 9) AS dist
  FROM feats a, feats b WHERE a.click IS NULL AND b.click IS NOT NULL AND ({_SHARED}) > 0),
best AS (SELECT user_id, t, y, row_number() OVER (PARTITION BY user_id, t ORDER BY dist, bt, bu) AS rk FROM pairs),
means AS (SELECT user_id, t, avg(y) AS knn FROM best WHERE rk <= 5 GROUP BY 1, 2)"""


@query("impute_knn", f"""WITH {WIDE}, {_FEATS}, {_PAIRS}
SELECT w.user_id, w.t, {r('coalesce(w.click, m.knn, (SELECT avg(click) FROM wide))')} AS v_imp
FROM wide w LEFT JOIN means m ON w.user_id = m.user_id AND w.t = m.t""")
def impute_knn(spark, sf):
    return _out(impute.impute_knn(wide(spark, sf), "t", "click", "v_imp", ["t", "user_id"], KINDS))
