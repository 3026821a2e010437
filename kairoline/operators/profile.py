"""Profiles: missing values, column statistics, seasonal means, correlation, histograms, boxes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kairoline.functions import calendar
from kairoline.operators.contract import long_form
from kairoline.operators.grid import with_nulls
from kairoline.operators.quantiles import IN_MEMORY_ROWS, medians, quantiles

STATS = ("missing", "missing_pct", "mean", "median", "std", "min", "max")


def missing_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Null count per column that has any."""
    row = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return long_form(row, [(c,) for c in columns], list(columns), ("column",), "missing").where("missing > 0")


def melt(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Wide to long: ``column``, ``value``."""
    items = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns])
    return df.select(*keep, F.explode(items).alias("_i")).select(*keep, "_i.*")


def column_profile(df: DataFrame, columns: Sequence[str], limit: int = IN_MEMORY_ROWS) -> DataFrame:
    """Missing count and share, mean, median, sample deviation, minimum and maximum per column."""
    long = melt(df, columns)
    moments = long.groupBy("column").agg(
        F.count_if(F.col("value").isNull()).alias("missing"),
        (F.count_if(F.col("value").isNull()) * 100.0 / F.count("*")).alias("missing_pct"),
        F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"),
    )
    mids = medians(long, ["column"], "value", "median", limit)
    return moments.join(mids, "column", "left").select("column", *STATS)


def imputation_report(df: DataFrame, before: str, after: str, limit: int = IN_MEMORY_ROWS) -> DataFrame:
    """Each statistic before and after filling, with the change and the change in percent."""
    stats = long_form(
        column_profile(df, [before, after], limit).select("column", *[F.col(s).cast("double").alias(s) for s in STATS]),
        [(s,) for s in STATS], list(STATS), ("stat",), "value")
    sides = stats.groupBy("stat").agg(
        F.max(F.when(F.col("column") == before, F.col("value"))).alias("before"),
        F.max(F.when(F.col("column") == after, F.col("value"))).alias("after"),
    )
    change = F.col("after") - F.col("before")
    pct = F.when(F.col("before") != 0, change / F.abs("before") * 100)
    return sides.select("stat", "before", "after", change.alias("change"), pct.alias("change_pct"))


def seasonal_profile(df: DataFrame, ts: str, values: Sequence[str],
                     keys: Sequence[str] = ("hour", "dow", "month")) -> DataFrame:
    """Means by hour, weekday and month in one pass: ``period``, ``key``, one column per value."""
    parts = calendar.keys(ts)
    cells = F.array(*[F.struct(F.lit(k).alias("period"), parts[k].alias("key")) for k in keys])
    return df.select(F.explode(cells).alias("_c"), *values).select("_c.*", *values).groupBy("period", "key").agg(
        *[F.avg(v).alias(v) for v in values])


def profile_difference(df: DataFrame, ts: str, before: str, after: str) -> DataFrame:
    """Mean and largest absolute difference of the seasonal means before and after filling."""
    gap = F.abs(F.col(after) - F.col(before))
    return seasonal_profile(df, ts, [before, after]).groupBy("period").agg(
        F.avg(gap).alias("mean_abs_diff"), F.max(gap).alias("max_abs_diff"))


def correlations(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """Pearson correlation of every feature with the label over pairwise complete rows."""
    row = df.agg(*[F.corr(f, label).alias(f) for f in features])
    return long_form(row, [(f,) for f in features], list(features), ("feature",), "corr")


def histogram(df: DataFrame, value: str, bins: int = 30, by: Sequence[str] = ()) -> DataFrame:
    """Equal-width counts between the column's minimum and maximum; the maximum joins the last bin."""
    edges = df.agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"))
    width = (F.col("_hi") - F.col("_lo")) / F.lit(bins)
    slot = F.when(width == 0, F.lit(0)).otherwise(F.least(F.floor((F.col(value) - F.col("_lo")) / width), F.lit(bins - 1)))
    return (
        df.where(F.col(value).isNotNull()).join(F.broadcast(edges), F.lit(True))
        .groupBy(*by, slot.cast("bigint").alias("bin"), "_lo", width.alias("_width"))
        .agg(F.count("*").alias("n"))
        .select(*by, "bin", (F.col("_lo") + F.col("bin") * F.col("_width")).alias("left_edge"), "n")
    )


def box_summary(df: DataFrame, value: str, by: Sequence[str] = (), limit: int = IN_MEMORY_ROWS) -> DataFrame:
    """Quartiles, whiskers (last readings within 1.5 IQR) and the number of outliers; a null key is a group."""
    by = list(by)
    quart = quantiles(df, by, value, {"q1": 0.25, "median": 0.5, "q3": 0.75}, limit)
    iqr = F.col("q3") - F.col("q1")
    source = df.select(*by, value)
    joined = with_nulls(source, quart, by) if by else source.join(F.broadcast(quart), F.lit(True))
    inside = (F.col(value) >= F.col("q1") - 1.5 * iqr) & (F.col(value) <= F.col("q3") + 1.5 * iqr)
    return joined.groupBy(*by, "q1", "median", "q3").agg(
        F.min(F.when(inside, F.col(value))).alias("whisker_low"),
        F.max(F.when(inside, F.col(value))).alias("whisker_high"),
        F.count_if(~inside).alias("outliers"))


def rmse(actual: Column | str, predicted: Column | str) -> Column:
    actual = F.col(actual) if isinstance(actual, str) else actual
    predicted = F.col(predicted) if isinstance(predicted, str) else predicted
    return F.sqrt(F.avg((actual - predicted) * (actual - predicted)))


def actual_vs_predicted(actual: DataFrame, predicted: DataFrame, on: Sequence[str], y: str, p: str) -> DataFrame:
    """Both series side by side, with a flag telling whether the actual one crosses zero."""
    span = actual.agg((F.coalesce((F.min(y) < 0) & (F.max(y) > 0), F.lit(False))).alias("crosses_zero"))
    return (
        actual.select(*on, F.col(y).alias("actual"))
        .join(predicted.select(*on, F.col(p).alias("predicted")), list(on))
        .join(F.broadcast(span), F.lit(True))
    )
