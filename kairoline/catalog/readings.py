"""Parsing, projection, grid and calendar queries."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from kairoline.catalog import query
from kairoline.catalog.views import DAILY, GRID, KINDS, PANEL, WIDE, daily, panel, panel_grid, r, table, wide
from kairoline.functions import calendar, scalars
from kairoline.operators import contract, grid, impute
from kairoline.sources import readers

rounded = scalars.rounded


@query("parse_props", "SELECT event_id, (props::JSON ->> 'k')::BIGINT AS k FROM events")
def parse_props(spark, sf):
    schema = T.StructType([T.StructField("k", T.LongType())])
    return readers.parse_json(table(spark, sf, "events"), "props", schema).select("event_id", "k")


@query("strip_codes", "SELECT p_partkey, replace(p_brand, 'Brand#', '')::DOUBLE AS brand FROM part")
def strip_codes(spark, sf):
    return table(spark, sf, "part").select("p_partkey", scalars.strip_prefix("p_brand", "Brand#").alias("brand"))


@query("strip_codes_int", """SELECT p_partkey, try_cast(replace(p_brand, 'Brand#', '') AS BIGINT) AS p_brand_cat,
  try_cast(replace(p_name, 'small ', '') AS BIGINT) AS p_name_cat FROM part""")
def strip_codes_int(spark, sf):
    df = table(spark, sf, "part").select("p_partkey", "p_brand", "p_name")
    for name, prefix in (("p_brand", "Brand#"), ("p_name", "small ")):
        df = df.withColumn(f"{name}_cat", scalars.strip_prefix_int(name, prefix).cast("bigint")).drop(name)
    return df


@query("parse_time", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')::TIMESTAMP AS t, "
       "try_cast(o_orderpriority AS TIMESTAMP) AS bad FROM orders")
def parse_time(spark, sf):
    text = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    return table(spark, sf, "orders").select(
        "o_orderkey", scalars.parse_time(text).alias("t"), scalars.parse_time("o_orderpriority").alias("bad"))


@query("project_target", "SELECT l_orderkey, l_linenumber, l_quantity, l_discount, l_tax, l_extendedprice AS label FROM lineitem")
def project_target(spark, sf):
    df = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax", "l_extendedprice")
    features, label = readers.split_target(df, "l_extendedprice")
    return df.select(*features, F.col(label).alias("label"))


@query("drop_bookkeeping", "SELECT c_custkey, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def drop_bookkeeping(spark, sf):
    return table(spark, sf, "customer").drop("Unnamed: 0", "c_name", "time")


@query("rename_alias", 'SELECT s_suppkey AS "Unnamed_0", s_name, s_nationkey::BIGINT AS s_nationkey, s_acctbal FROM supplier')
def rename_alias(spark, sf):
    raw = table(spark, sf, "supplier").withColumnRenamed("s_suppkey", "Unnamed: 0")
    return raw.withColumnRenamed("Unnamed: 0", "Unnamed_0").withColumn("s_nationkey", F.col("s_nationkey").cast("bigint"))


@query("numeric_columns", "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count({c}) AS filled, {r(f'avg({c})', 3)} AS mean FROM lineitem"
    for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax")) + ")")
def numeric_columns(spark, sf):
    """The columns that count as numeric, with their values."""
    df = table(spark, sf, "lineitem")
    names = impute.numeric_columns(df)
    means = contract.long_form(df.agg(*[F.avg(c).alias(c) for c in names]), [(c,) for c in names], names, ("column",), "mean")
    return contract.fill_counts(df, names).join(means, "column").select("column", "filled", rounded("mean", 3).alias("mean"))


@query("first_n", "SELECT o_orderkey, o_orderdate, o_totalprice FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 100")
def first_n(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_totalprice").orderBy(
        "o_orderdate", "o_orderkey").limit(100)


@query("grid_regularise", f"WITH {GRID} SELECT user_id, t, {r('v')} AS v FROM grid")
def grid_regularise(spark, sf):
    return panel_grid(spark, sf).select("user_id", "t", rounded("v").alias("v"))


_SPARSE = """sparse AS (SELECT user_id, time_bucket(INTERVAL 1 HOURS, ts) AS t, avg(CASE WHEN event_type = 'click' THEN value END) AS click,
  avg(CASE WHEN event_type = 'view' THEN value END) AS view FROM events GROUP BY 1, 2)"""


def _hourly(spark, sf):
    return grid.bucket_pivot(table(spark, sf, "events"), ["user_id"], "ts", "event_type", ["click", "view"], "value", hours=1)


@query("grid_filter_fused", f"""WITH {_SPARSE}, lo AS (SELECT user_id, min(t) AS lo FROM sparse GROUP BY 1)
SELECT s.user_id, s.t, {r('click')} AS click, {r('view')} AS view FROM sparse s JOIN lo USING (user_id)
WHERE date_diff('hour', lo, t) % 3 = 0 AND (click IS NOT NULL OR view IS NOT NULL)""")
def grid_filter_fused(spark, sf):
    kept = grid.on_grid(_hourly(spark, sf), ["user_id"], "t", ["click", "view"], hours=3)
    return kept.select("user_id", "t", rounded("click").alias("click"), rounded("view").alias("view"))


@query("drop_all_null", f"""WITH {_SPARSE} SELECT user_id, t, {r('click')} AS click, {r('view')} AS view FROM sparse
WHERE click IS NOT NULL OR view IS NOT NULL""")
def drop_all_null(spark, sf):
    kept = grid.drop_all_null(_hourly(spark, sf), ["click", "view"])
    return kept.select("user_id", "t", rounded("click").alias("click"), rounded("view").alias("view"))


@query("duplicate_steps", """SELECT user_id, time_bucket(INTERVAL 3 HOURS, ts) AS t, count(*) AS n FROM events
GROUP BY 1, 2 HAVING count(*) > 1""")
def duplicate_steps(spark, sf):
    stepped = table(spark, sf, "events").select("user_id", F.window("ts", "3 hours").start.alias("t"))
    return grid.duplicate_steps(stepped, ["user_id"], "t")


@query("classify_rule", """SELECT event_id, CASE WHEN value / 100 > 0.5 THEN 500 WHEN value > 80 THEN 804 WHEN value > 50 THEN 803
  WHEN value > 20 THEN 802 ELSE 800 END AS code FROM events""")
def classify_rule(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", scalars.weather_code(F.col("value") / 100, "value").alias("code"))


@query("clamp", """SELECT c_custkey, greatest(c_acctbal, 0) AS floored,
  greatest(least(c_acctbal, 5000), -100) AS clipped FROM customer""")
def clamp(spark, sf):
    return table(spark, sf, "customer").select(
        "c_custkey", scalars.clamp("c_acctbal", lo=0).alias("floored"), scalars.clamp("c_acctbal", -100, 5000).alias("clipped"))


@query("elapsed_hours", """SELECT event_id, (epoch_us(ts) - epoch_us(TIMESTAMP '2018-01-01')) // 3600000000 + 8760 AS hours FROM events""")
def elapsed_hours(spark, sf):
    return table(spark, sf, "events").select("event_id", scalars.elapsed_hours("ts").alias("hours"))


def _filled_sql(name, columns):
    return " UNION ALL ".join(f"SELECT '{c}' AS c, count({c}) AS filled FROM {name}" for c in columns)


_ORDER_COLUMNS = ("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
_LINE_COLUMNS = ("l_orderkey", "l_quantity", "o_orderdate")


@query("column_set_diff", f"""WITH x AS (SELECT l_orderkey, l_quantity, l_shipdate AS o_orderdate FROM lineitem),
a AS ({_filled_sql('orders', _ORDER_COLUMNS)}), b AS ({_filled_sql('x', _LINE_COLUMNS)})
SELECT c AS "column", 'left' AS side, filled FROM a WHERE c NOT IN (SELECT c FROM b)
UNION ALL SELECT c, 'right', filled FROM b WHERE c NOT IN (SELECT c FROM a)""")
def column_set_diff(spark, sf):
    train = table(spark, sf, "orders").select(*_ORDER_COLUMNS)
    test = table(spark, sf, "lineitem").select("l_orderkey", "l_quantity", F.col("l_shipdate").alias("o_orderdate"))
    counts = contract.fill_counts(train, train.columns).withColumn("side", F.lit("left")).unionByName(
        contract.fill_counts(test, test.columns).withColumn("side", F.lit("right")))
    return contract.column_diff(train, test).join(counts, ["column", "side"])


@query("distinct_encodings", f"""SELECT DISTINCT month(o_orderdate)::BIGINT AS month, {r('sin(2 * pi() * month(o_orderdate) / 12)')} AS month_sin,
  {r('cos(2 * pi() * month(o_orderdate) / 12)')} AS month_cos FROM orders ORDER BY month""")
def distinct_encodings(spark, sf):
    cyc = calendar.cyclical("o_orderdate")
    return table(spark, sf, "orders").select(
        F.month("o_orderdate").cast("bigint").alias("month"), rounded(cyc["month_sin"]).alias("month_sin"),
        rounded(cyc["month_cos"]).alias("month_cos")).distinct().orderBy("month")


def _cyc_sql(ts):
    parts = {"hour": (f"hour({ts})", 24), "dow": (f"(isodow({ts}) - 1)", 7), "month": (f"month({ts})", 12)}
    made = [f"{r(f'{fn}(2 * pi() * {e} / {p})')} AS {n}_{fn}" for n, (e, p) in parts.items() for fn in ("sin", "cos")]
    return ", ".join([*made, f"year({ts})::BIGINT AS year"])


@query("calendar_cyclical", f"SELECT event_id, {_cyc_sql('ts')} FROM events")
def calendar_cyclical(spark, sf):
    cyc = calendar.cyclical("ts")
    return table(spark, sf, "events").select(
        "event_id", *[rounded(c).alias(n) for n, c in cyc.items() if n != "year"], cyc["year"].cast("bigint").alias("year"))


_HOT = [("hour", "hour(ts)", range(24)), ("dow", "isodow(ts) - 1", range(7)), ("month", "month(ts)", range(1, 13))]


@query("calendar_onehot", "SELECT event_id, " + ", ".join(
    f"({e} = {v})::INT AS {n}_{v}" for n, e, voc in _HOT for v in list(voc)[1:]) + ", year(ts)::BIGINT AS year FROM events")
def calendar_onehot(spark, sf):
    hot = calendar.onehot("ts", drop_first=True)
    return table(spark, sf, "events").select(
        "event_id", *[c.cast("bigint" if n == "year" else "int").alias(n) for n, c in hot.items()])


@query("calendar_keys", """SELECT o_orderkey, hour(o_orderdate)::BIGINT AS hour, isodow(o_orderdate) - 1 AS dow,
  month(o_orderdate)::BIGINT AS month, year(o_orderdate)::BIGINT AS year FROM orders""")
def calendar_keys(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", *[c.cast("bigint").alias(n) for n, c in calendar.keys("o_orderdate").items()])


_LISTED = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
           "l_returnflag", "l_linestatus")
_MADE = {"hour_sin": "sin(2 * pi() * hour(l_shipdate) / 24)", "hour_cos": "cos(2 * pi() * hour(l_shipdate) / 24)",
         "dow_sin": "sin(2 * pi() * (isodow(l_shipdate) - 1) / 7)", "dow_cos": "cos(2 * pi() * (isodow(l_shipdate) - 1) / 7)",
         "month_sin": "sin(2 * pi() * month(l_shipdate) / 12)", "month_cos": "cos(2 * pi() * month(l_shipdate) / 12)",
         "year": "year(l_shipdate)"}


@query("feature_list", "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT {i}::BIGINT AS position, '{n}' AS feature, count({e}) AS filled, count(DISTINCT round({e}, 9))::BIGINT AS kinds FROM lineitem"
    if n in _MADE else f"SELECT {i}::BIGINT AS position, '{n}' AS feature, count({e}) AS filled, count(DISTINCT {e})::BIGINT AS kinds FROM lineitem"
    for i, (n, e) in enumerate([*((c, c) for c in _LISTED), *_MADE.items()])) + ")")
def feature_list(spark, sf):
    """Names of the features that the calendar leaves and adds, with the values each of them really has."""
    df = table(spark, sf, "lineitem")
    names = calendar.feature_list(df.columns, "cyclical", removed=["l_shipdate"])
    made = calendar.add_calendar(df, "l_shipdate", "cyclical")
    one = {n: F.round(F.col(n), 9) if n in _MADE else F.col(n) for n in names}
    counts = made.agg(*[F.count(n).alias(f"f_{n}") for n in names], *[F.count_distinct(one[n]).alias(f"k_{n}") for n in names])
    filled = contract.long_form(counts.select(*[f"f_{n}" for n in names]), list(enumerate(names)), [f"f_{n}" for n in names],
                                ("position", "feature"), "filled")
    kinds = contract.long_form(counts.select(*[f"k_{n}" for n in names]), [(n,) for n in names], [f"k_{n}" for n in names], ("feature",), "kinds")
    return filled.join(kinds, "feature").select(F.col("position").cast("bigint").alias("position"), "feature", "filled", "kinds")


@query("distinct_encodings_full", f"""SELECT DISTINCT hour(ts)::BIGINT AS hour, isodow(ts) - 1 AS dow, month(ts)::BIGINT AS month,
  {", ".join(f"{r(f'{fn}(2 * pi() * {e} / {p})')} AS {n}_{fn}" for n, e, p in (('hour', 'hour(ts)', 24), ('dow', '(isodow(ts) - 1)', 7), ('month', 'month(ts)', 12))
             for fn in ('sin', 'cos'))} FROM events""")
def distinct_encodings_full(spark, sf):
    """Every calendar cell that occurs, by hour, weekday and month, with its encodings."""
    keys, cyc = calendar.keys("ts"), calendar.cyclical("ts")
    cells = table(spark, sf, "events").select(
        *[keys[k].cast("bigint").alias(k) for k in ("hour", "dow", "month")], *[rounded(c).alias(n) for n, c in cyc.items() if n != "year"])
    return cells.distinct().orderBy("hour", "dow", "month")


@query("wide_pivot", f"WITH {WIDE} SELECT user_id, t, " + ", ".join(f"{r(k)} AS {k}" for k in KINDS) + " FROM wide")
def wide_pivot(spark, sf):
    return wide(spark, sf).select("user_id", "t", *[rounded(k).alias(k) for k in KINDS])


@query("panel_mean", f"WITH {PANEL} SELECT user_id, t, {r('v')} AS v FROM panel")
def panel_mean(spark, sf):
    return panel(spark, sf).select("user_id", "t", rounded("v").alias("v"))


@query("daily_total", f"WITH {DAILY} SELECT d, {r('y', 3)} AS y FROM daily")
def daily_total(spark, sf):
    return daily(spark, sf).select("d", rounded("y", 3).alias("y"))
