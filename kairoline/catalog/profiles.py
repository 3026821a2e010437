"""Profile, distribution and scaling queries."""

from pyspark.sql import functions as F

from kairoline.catalog import query
from kairoline.catalog.gaps import _LEVELS, _HDM
from kairoline.catalog.views import GRID, KINDS, REG, WIDE, panel, panel_grid, r, reg, table, wide
from kairoline.functions.scalars import rounded
from kairoline.operators import impute, profile, quantiles, scale

FEATURES = ("quantity", "discount", "tax", "dow_sin", "dow_cos", "month_sin", "month_cos", "year")


@query("standard_scale", f"""WITH s AS (SELECT avg(l_quantity) AS mq, stddev_pop(l_quantity) AS sq, avg(l_discount) AS md, stddev_pop(l_discount) AS sd,
  avg(l_tax) AS mt, stddev_pop(l_tax) AS st FROM lineitem)
SELECT l_orderkey, l_linenumber, {r('(l_quantity - mq) / sq')} AS l_quantity, {r('(l_discount - md) / sd')} AS l_discount,
  {r('(l_tax - mt) / st')} AS l_tax FROM lineitem, s""")
def standard_scale(spark, sf):
    df = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax")
    cols = ["l_quantity", "l_discount", "l_tax"]
    scaled = scale.standardise(df, cols, scale.moments(df, cols))
    return scaled.select("l_orderkey", "l_linenumber", *[rounded(c).alias(c) for c in cols])


@query("column_profile", f"WITH {WIDE} " + " UNION ALL ".join(
    f"""SELECT '{k}' AS "column", count(*) - count({k}) AS missing, {r(f'(count(*) - count({k})) * 100.0 / count(*)')} AS missing_pct,
  {r(f'avg({k})')} AS mean, {r(f'median({k})')} AS median, {r(f'stddev_samp({k})')} AS std, {r(f'min({k})')} AS min, {r(f'max({k})')} AS max FROM wide"""
    for k in KINDS))
def column_profile(spark, sf):
    p = profile.column_profile(wide(spark, sf), KINDS)
    return p.select("column", "missing", *[rounded(s).alias(s) for s in profile.STATS if s != "missing"])


_FILLED = f"""{GRID}, k AS (SELECT *, {_HDM} FROM grid), {_LEVELS}, filled AS (
  SELECT k.t, k.v, coalesce(k.v, hd.med, hh.med, dd.med, gg.med) AS v_imp
  FROM k LEFT JOIN hd ON k.h = hd.h AND k.d = hd.d LEFT JOIN hh ON k.h = hh.h LEFT JOIN dd ON k.d = dd.d CROSS JOIN gg)"""
_STATS = {"missing": "count(*) - count({c})", "missing_pct": "(count(*) - count({c})) * 100.0 / count(*)", "mean": "avg({c})",
          "median": "median({c})", "std": "stddev_samp({c})", "min": "min({c})", "max": "max({c})"}


def _filled(spark, sf):
    return impute.impute_pattern(panel_grid(spark, sf), "t", "v", "v_imp", panel(spark, sf))


@query("imputation_report", f"WITH {_FILLED}, b AS (" + " UNION ALL ".join(
    f"SELECT '{s}' AS stat, ({e.format(c='v')})::DOUBLE AS before, ({e.format(c='v_imp')})::DOUBLE AS after FROM filled" for s, e in _STATS.items())
    + f""") SELECT stat, {r('before')} AS before, {r('after')} AS after, {r('after - before')} AS change,
  {r('CASE WHEN before <> 0 THEN (after - before) / abs(before) * 100 END')} AS change_pct FROM b""")
def imputation_report(spark, sf):
    rep = profile.imputation_report(_filled(spark, sf), "v", "v_imp")
    return rep.select("stat", *[rounded(c).alias(c) for c in ("before", "after", "change", "change_pct")])


_SEASON = " UNION ALL ".join(
    f"SELECT '{p}' AS period, ({e})::BIGINT AS key, avg(v) AS v, avg(v_imp) AS v_imp FROM filled GROUP BY 2"
    for p, e in (("hour", "hour(t)"), ("dow", "isodow(t) - 1"), ("month", "month(t)")))


@query("seasonal_profile", f"WITH {_FILLED}, s AS ({_SEASON}) SELECT period, key, {r('v')} AS v, {r('v_imp')} AS v_imp FROM s")
def seasonal_profile(spark, sf):
    p = profile.seasonal_profile(_filled(spark, sf), "t", ["v", "v_imp"])
    return p.select("period", F.col("key").cast("bigint").alias("key"), rounded("v").alias("v"), rounded("v_imp").alias("v_imp"))


@query("profile_diff", f"""WITH {_FILLED}, s AS ({_SEASON}) SELECT period, {r('avg(abs(v_imp - v))')} AS mean_abs_diff,
  {r('max(abs(v_imp - v))')} AS max_abs_diff FROM s GROUP BY period""")
def profile_diff(spark, sf):
    p = profile.profile_difference(_filled(spark, sf), "t", "v", "v_imp")
    return p.select("period", rounded("mean_abs_diff").alias("mean_abs_diff"), rounded("max_abs_diff").alias("max_abs_diff"))


@query("corr_target", f"WITH {REG} " + " UNION ALL ".join(
    f"SELECT '{f}' AS feature, {r(f'corr({f}, label)')} AS corr FROM reg" for f in FEATURES))
def corr_target(spark, sf):
    c = profile.correlations(reg(spark, sf), FEATURES, "label")
    return c.select("feature", rounded("corr").alias("corr")).orderBy("corr")


@query("histogram", f"""WITH e AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem),
b AS (SELECT least(floor((l_extendedprice - lo) / ((hi - lo) / 30)), 29)::BIGINT AS bin, lo, hi FROM lineitem, e)
SELECT bin, {r('lo + bin * ((hi - lo) / 30)', 4)} AS left_edge, count(*) AS n FROM b GROUP BY bin, lo, hi""")
def histogram(spark, sf):
    h = profile.histogram(table(spark, sf, "lineitem"), "l_extendedprice", 30)
    return h.select("bin", rounded("left_edge", 4).alias("left_edge"), "n")


@query("box_summary", f"""WITH q AS (SELECT l_returnflag, quantile_cont(l_extendedprice, 0.25) AS q1, quantile_cont(l_extendedprice, 0.5) AS q2,
  quantile_cont(l_extendedprice, 0.75) AS q3 FROM lineitem GROUP BY 1),
j AS (SELECT l.l_returnflag, l_extendedprice AS x, q1, q2, q3, l_extendedprice BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS ok
  FROM lineitem l JOIN q USING (l_returnflag))
SELECT l_returnflag, {r('q1', 4)} AS q1, {r('q2', 4)} AS median, {r('q3', 4)} AS q3, min(x) FILTER (ok) AS whisker_low,
  max(x) FILTER (ok) AS whisker_high, count(*) FILTER (NOT ok) AS outliers FROM j GROUP BY l_returnflag, q1, q2, q3""")
def box_summary(spark, sf):
    b = profile.box_summary(table(spark, sf, "lineitem"), "l_extendedprice", ["l_returnflag"])
    return b.select("l_returnflag", *[rounded(c, 4).alias(c) for c in ("q1", "median", "q3")],
                    "whisker_low", "whisker_high", "outliers")


@query("approx_medians", """SELECT event_type, count(*) AS "rows", true AS inside FROM events GROUP BY 1""")
def approx_medians(spark, sf):
    """Medians from one pass of mergeable summaries; ``inside``: the rank is within the stated error of the middle."""
    error = 0.005
    events = table(spark, sf, "events").select("event_type", "value")
    both = events.join(F.broadcast(quantiles.medians(events, ["event_type"], "value", "m", error=error)), "event_type")
    below, upto = (F.count(F.when(c, 1)) / F.count(F.lit(1)) for c in (F.col("value") < F.col("m"), F.col("value") <= F.col("m")))
    return both.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("rows"), ((below <= 0.5 + error) & (upto >= 0.5 - error)).alias("inside"))
