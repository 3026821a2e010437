"""First-order autoregressive and moving-average models of the differenced series, per series.

Estimates are sums over each series: conditional least squares for AR(1), the lag-1 moment for
MA(1). They run as grouped aggregates, so any number of series is fitted in one job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kairoline.functions.scalars import HOUR_US, epoch_us
from kairoline.operators.grid import with_nulls
from kairoline.operators.order import previous, running_sum
from kairoline.session import settle


def difference(df: DataFrame, series: Sequence[str], ts: str, value: str, out: str = "d",
               hours: float = 3) -> DataFrame:
    """y(t) - y(t-1); only the first row of a series is dropped, next to a gap the difference is null."""
    lagged = previous(df.withColumn("_at", F.struct(value)), series, ts, "_at", "_before", hours)
    return lagged.where(F.col("_before").isNotNull()).select(
        *df.columns, (F.col(value) - F.col(f"_before.{value}")).alias(out))


def undifference(df: DataFrame, starts: DataFrame, series: Sequence[str], ts: str, diff: str,
                 out: str = "y", hours: float = 3) -> DataFrame:
    """start + running sum of differences; ``starts`` has one ``start`` per series."""
    summed = running_sum(df, series, ts, diff, "_sum", hours)
    on = list(series)
    joined = with_nulls(summed, starts, on) if on else summed.join(F.broadcast(starts), F.lit(True))
    return joined.select(*df.columns, (F.col("start") + F.col("_sum")).alias(out))


def lagged_changes(df: DataFrame, series: Sequence[str], ts: str, value: str, hours: float = 3,
                   difference_order: int = 1, keep: Sequence[str] = ()) -> DataFrame:
    """Change ``d`` and preceding change ``d1`` (null in the first row) beside the value.

    Fits, predictions and forecasts all start here, so the changes are written once.
    """
    base = df.select(*series, ts, value, *keep)
    if difference_order == 0:
        changes = base.withColumn("d", F.col(value))
    elif difference_order == 1:
        changes = difference(base, series, ts, value, "d", hours)
    else:
        raise ValueError("difference order must be 0 or 1")
    return previous(settle(changes), series, ts, "d", "d1", hours)


def fit_ar1(changes: DataFrame, series: Sequence[str]) -> DataFrame:
    """``const``, ``phi``, ``n`` per series; phi is null where the lagged change never varies."""
    return changes.where(F.col("d1").isNotNull()).groupBy(*series).agg(
        F.regr_intercept("d", "d1").alias("const"), F.regr_slope("d", "d1").alias("phi"), F.count("*").alias("n"))


def ma_theta(r: Column) -> Column:
    """Invertible root of r = theta / (1 + theta^2); beyond |r| = 1/2 the nearest value is +-1."""
    return (
        F.when(F.abs(r) >= 0.5, F.signum(r)).when(r == 0, F.lit(0.0))
        .otherwise((1 - F.sqrt(1 - 4 * r * r)) / (2 * r))
    )


def fit_ma1(changes: DataFrame, series: Sequence[str]) -> DataFrame:
    """``mean``, ``theta``, ``n`` per series from the lag-1 autocorrelation of the changes."""
    sums = changes.groupBy(*series).agg(
        F.count("d").alias("n"), F.avg("d").alias("mean"), F.sum(F.col("d") * F.col("d")).alias("_dd"),
        F.sum(F.col("d") * F.col("d1")).alias("_d01"), F.sum(F.when(F.col("d1").isNotNull(), F.col("d"))).alias("_d0"),
        F.sum("d1").alias("_d1"), F.count("d1").alias("_m"))
    m = F.col("mean")
    c0 = F.col("_dd") - F.col("n") * m * m
    c1 = F.col("_d01") - m * (F.col("_d0") + F.col("_d1")) + F.col("_m") * m * m
    return sums.withColumn("_r", F.when(c0 > 0, c1 / c0)).select(
        *series, "mean", ma_theta(F.col("_r")).alias("theta"), "n")


def _with_fit(df: DataFrame, fitted: DataFrame, series: Sequence[str]) -> DataFrame:
    return with_nulls(df, fitted, list(series)) if series else df.join(F.broadcast(fitted), F.lit(True))


def predict_ar1(changes: DataFrame, fitted: DataFrame, series: Sequence[str], ts: str, value: str,
                out: str = "prediction", hours: float = 3) -> DataFrame:
    """In-sample one-step changes added up from the first value of each series.

    The first change has no predecessor and is predicted by the long-run mean.
    """
    on = list(series)
    joined = _with_fit(changes, fitted.select(*on, "const", "phi"), on)
    step = F.coalesce(F.col("const") + F.col("phi") * F.col("d1"), F.col("const") / (1 - F.col("phi")))
    starts = changes.groupBy(*on).agg(F.min_by(F.col(value) - F.col("d"), ts).alias("start"))
    stepped = joined.select(*on, ts, value, step.alias("_step"))
    return undifference(stepped, starts, on, ts, "_step", out, hours).select(*on, ts, value, out)


def _ahead(steps: int):
    return F.explode(F.sequence(F.lit(1), F.lit(steps))).alias("h")


def forecast_ar1(changes: DataFrame, fitted: DataFrame, series: Sequence[str], ts: str, value: str,
                 steps: int) -> DataFrame:
    """``h`` = 1..steps ahead of each series: the AR recursion on the last change, added up from
    the last value."""
    on = list(series)
    last = changes.groupBy(*on).agg(F.max_by(value, ts).alias("_y"), F.max_by("d", ts).alias("_d"))
    joined = _with_fit(last, fitted.select(*on, "const", "phi"), on)
    start = F.struct(F.col("_y").alias("y"), F.col("_d").alias("d"))

    def step(acc, _):
        d = F.col("const") + F.col("phi") * acc["d"]
        return F.struct((acc["y"] + d).alias("y"), d.alias("d"))

    path = F.aggregate(F.sequence(F.lit(1), F.col("h")), start, step, lambda acc: acc["y"])
    return joined.select("*", _ahead(steps)).select(*on, "h", path.alias("forecast"))


def forecast_ma1(changes: DataFrame, fitted: DataFrame, series: Sequence[str], ts: str, value: str,
                 steps: int, hours: float = 3) -> DataFrame:
    """MA(1) forecasts: the last residual acts one step ahead, the mean change afterwards.

    The residual recursion e(t) = d(t) - mean - theta e(t-1) is unrolled per series as a
    weighted sum whose weights fall geometrically in the distance from the end.
    """
    on = list(series)
    ends = changes.groupBy(*on).agg(F.max(ts).alias("_end"), F.max_by(value, ts).alias("_y"))
    joined = _with_fit(_with_fit(changes, ends, on), fitted.select(*on, "mean", "theta"), on)
    age = F.round((epoch_us("_end") - epoch_us(ts)) / F.lit(hours * HOUR_US))
    resid = joined.groupBy(*on).agg(
        F.sum(F.pow(-F.col("theta"), age) * (F.col("d") - F.col("mean"))).alias("_e"), F.first("_y").alias("_y"),
        F.first("mean").alias("mean"), F.first("theta").alias("theta"))
    path = F.col("_y") + F.col("theta") * F.col("_e") + F.col("h") * F.col("mean")
    return resid.select("*", _ahead(steps)).select(*on, "h", path.alias("forecast"))
