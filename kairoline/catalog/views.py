"""Base views on the given tables, in DataFrame and in SQL form."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kairoline.operators.grid import bucket_mean, bucket_pivot, regularise
from kairoline.operators.impute import knn_coordinates

KINDS = ("click", "error", "purchase", "signup", "view")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean event value per user and 3 h step; users skip steps, so gaps are natural."""
    return bucket_mean(table(spark, sf_dir, "events"), ["user_id"], "ts", "value")


def panel_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return regularise(panel(spark, sf_dir), ["user_id"], "t")


def wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One column per event type, per user and 6 h step."""
    return bucket_pivot(table(spark, sf_dir, "events"), ["user_id"], "ts", "event_type", KINDS,
                        "value", hours=6)


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order value per day."""
    return table(spark, sf_dir, "orders").groupBy(F.col("o_orderdate").alias("d")).agg(
        F.sum("o_totalprice").alias("y"))


def reg(spark: SparkSession, sf_dir: str, ids: Sequence[str] = ()) -> DataFrame:
    """Line items as a regression table, with the ``ids`` columns kept in front."""
    cyc = knn_coordinates("l_shipdate")
    return table(spark, sf_dir, "lineitem").select(
        *ids, F.col("l_extendedprice").alias("label"), F.col("l_quantity").alias("quantity"),
        F.col("l_discount").alias("discount"), F.col("l_tax").alias("tax"),
        *[cyc[f"_{n}"].alias(n) for n in ("dow_sin", "dow_cos", "month_sin", "month_cos")],
        F.year("l_shipdate").cast("double").alias("year"))


PANEL = """panel AS (
  SELECT user_id, time_bucket(INTERVAL 3 HOURS, ts) AS t, avg(value) AS v FROM events GROUP BY 1, 2)"""
GRID = PANEL + """,
bounds AS (SELECT user_id, min(t) AS lo, max(t) AS hi FROM panel GROUP BY 1),
steps AS (SELECT user_id, unnest(generate_series(lo, hi, INTERVAL 3 HOURS)) AS t FROM bounds),
grid AS (SELECT s.user_id, s.t, p.v FROM steps s LEFT JOIN panel p ON s.user_id = p.user_id AND s.t = p.t)"""
WIDE = "wide AS (\n  SELECT user_id, time_bucket(INTERVAL 6 HOURS, ts) AS t,\n" + ",\n".join(
    f"    avg(CASE WHEN event_type = '{k}' THEN value END) AS {k}" for k in KINDS
) + "\n  FROM events GROUP BY 1, 2)"
DAILY = "daily AS (SELECT o_orderdate AS d, sum(o_totalprice) AS y FROM orders GROUP BY 1)"
REG = """reg AS (
  SELECT l_extendedprice AS label, l_quantity AS quantity, l_discount AS discount, l_tax AS tax,
    sin(2 * pi() * (isodow(l_shipdate) - 1) / 7) AS dow_sin, cos(2 * pi() * (isodow(l_shipdate) - 1) / 7) AS dow_cos,
    sin(2 * pi() * month(l_shipdate) / 12) AS month_sin, cos(2 * pi() * month(l_shipdate) / 12) AS month_cos,
    year(l_shipdate)::DOUBLE AS year
  FROM lineitem)"""


def r(sql: str, places: int = 6) -> str:
    return f"round({sql}, {places}) + 0.0"


def orthogonal(name: str, source: str, columns: Sequence[str], keep: Sequence[str] = ()) -> str:
    """CTEs that make ``columns`` of ``source`` orthogonal one after the other (means removed).

    The last CTE is called ``name``; its columns keep their names. A column that depends on
    earlier ones becomes zero. Least squares in SQL: each coefficient is a ratio of two sums.
    """
    rest = ", ".join(keep)
    lead = f"{rest}, " if keep else ""
    out = [f"{name}_0 AS MATERIALIZED (SELECT {lead}" + ", ".join(f"{c} - avg({c}) OVER () AS {c}" for c in columns) + f" FROM {source})"]
    for i, pivot in enumerate(columns[:-1]):
        done, todo = columns[: i + 1], columns[i + 1 :]
        ratios = ", ".join(f"coalesce(sum({c} * {pivot}) / nullif(sum({pivot} * {pivot}), 0), 0) AS w_{c}" for c in todo)
        out.append(f"{name}_w{i} AS MATERIALIZED (SELECT {ratios} FROM {name}_{i})")
        kept = ", ".join([*keep, *done, *[f"{c} - w_{c} * {pivot} AS {c}" for c in todo]])
        target = name if i == len(columns) - 2 else f"{name}_{i + 1}"
        out.append(f"{target} AS MATERIALIZED (SELECT {kept} FROM {name}_{i}, {name}_w{i})")
    return ",\n".join(out)
