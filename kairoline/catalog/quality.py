"""Contract and completeness queries."""

from pyspark.sql import functions as F

from kairoline.catalog import query
from kairoline.catalog.views import KINDS, WIDE, table, wide
from kairoline.operators import contract, profile
from kairoline.operators.contract import Field

CUSTOMER = (
    Field("c_custkey", "bigint"), Field("c_name", "string"), Field("c_acctbal", "double", rule="non_negative"),
    Field("c_mktsegment", "double"), Field("c_nationkey", "string"), Field("c_phone", "string"),
)
SUPPLIER = (Field("s_suppkey", "bigint", rule="non_negative"), Field("s_acctbal", "double", rule="positive"))


@query("contract_report", """WITH x AS (SELECT count(*) AS n, count(*) FILTER (c_acctbal < 0) AS neg,
  count(*) FILTER (c_mktsegment IS NOT NULL AND try_cast(c_mktsegment AS DOUBLE) IS NULL) AS txt, count(c_nationkey) AS num FROM customer)
SELECT u.rule, u."column", u.violations::BIGINT AS violations, n AS "rows" FROM x, LATERAL (VALUES
  ('whole_number', 'c_custkey', 0), ('type', 'c_name', 0), ('non_negative', 'c_acctbal', neg), ('type', 'c_mktsegment', txt),
  ('type', 'c_nationkey', num), ('missing', 'c_phone', n)) u(rule, "column", violations)""")
def contract_report(spark, sf):
    return contract.report(table(spark, sf, "customer"), CUSTOMER)


@query("contract_quarantine", """SELECT s_suppkey, s_acctbal,
  CASE WHEN s_acctbal <= 0 THEN 'positive:s_acctbal' ELSE '' END AS errors FROM supplier""")
def contract_quarantine(spark, sf):
    valid, held = contract.split(table(spark, sf, "supplier"), SUPPLIER)
    good = valid.select("s_suppkey", "s_acctbal", F.lit("").alias("errors"))
    return good.unionByName(held.select("s_suppkey", "s_acctbal", F.concat_ws(",", "errors").alias("errors")))


@query("non_negative_rule", "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal < 0")
def non_negative_rule(spark, sf):
    rule = (Field("c_acctbal", "double", rule="non_negative"),)
    return contract.split(table(spark, sf, "customer"), rule)[1].select("c_custkey", "c_acctbal")


@query("positive_rule", "SELECT event_id, value FROM events WHERE value <= 0.05")
def positive_rule(spark, sf):
    shifted = table(spark, sf, "events").withColumn("above", F.col("value") - 0.05)
    return contract.split(shifted, (Field("above", "double", rule="positive"),))[1].select("event_id", "value")


@query("unknown_columns", """SELECT 's_name' AS "column", count(s_name) AS filled FROM supplier
UNION ALL SELECT 's_nationkey', count(s_nationkey) FROM supplier""")
def unknown_columns(spark, sf):
    return contract.unknown_columns(table(spark, sf, "supplier"), SUPPLIER)


@query("missing_profile", f"WITH {WIDE} " + " UNION ALL ".join(
    f"SELECT '{k}' AS \"column\", count(*) - count({k}) AS missing FROM wide HAVING count(*) > count({k})" for k in KINDS))
def missing_profile(spark, sf):
    return profile.missing_profile(wide(spark, sf), KINDS)


@query("size_metrics", "SELECT count(*) AS \"rows\", count(DISTINCT user_id) AS series, min(ts) AS first_ts, max(ts) AS last_ts FROM events")
def size_metrics(spark, sf):
    return table(spark, sf, "events").agg(
        F.count("*").alias("rows"), F.countDistinct("user_id").alias("series"),
        F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))
