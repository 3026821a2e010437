"""First-order series models on expanding training parts.

Sums per series and segment are taken once; a fold's training part is the segments up to its own, so adding them up over
segments gives the fits of all series and folds together. Test rows are forecast from the last training row of their
series. Series ids may be null: those rows are a series of their own. A series without a change in its training part
has no forecast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kairoline.functions.scalars import HOUR_US, epoch_us
from kairoline.operators.arima import ma_theta
from kairoline.operators.grid import with_nulls

_SUMS = ("n", "s", "ss", "m", "s0", "s1", "s01", "s11")


def segment_sums(changes: DataFrame, series: Sequence[str], ts: str, value: str, segment: str = "segment") -> DataFrame:
    """One row per series and segment: sums of the changes ``d`` and of pairs with the change before (``d1``), and the
    last row with a value."""
    pair = F.col("d").isNotNull() & F.col("d1").isNotNull()
    d, d1 = F.when(pair, F.col("d")), F.when(pair, F.col("d1"))
    last = F.struct(F.col(ts).alias("t"), F.col(value).alias("y"), F.col("d").alias("d"))
    sums = {"n": F.count("d"), "s": F.sum("d"), "ss": F.sum(F.col("d") * F.col("d")), "m": F.count(d1), "s0": F.sum(d), "s1": F.sum(d1),
            "s01": F.sum(d * d1), "s11": F.sum(d1 * d1)}
    return changes.groupBy(*series, segment).agg(
        *[F.coalesce(x, F.lit(0)).alias(f"_{name}") for name, x in sums.items()],
        F.max_by(last, F.when(F.col(value).isNotNull(), F.col(ts))).alias("_last"))


def _folds(rows: DataFrame, k: int, segment: str = "segment") -> DataFrame:
    """Every row once per fold that trains on it."""
    return rows.filter(F.col(segment) < k).withColumn("fold", F.explode(F.sequence(F.col(segment), F.lit(k - 1))))


def _ar(c: dict[str, Column]) -> tuple[Column, Column]:
    """Constant and slope of ``d`` on ``d1``; a lagged change that does not vary has slope 0."""
    spread = c["m"] * c["s11"] - c["s1"] * c["s1"]
    slope = F.when(spread > 1e-12 * c["m"] * c["s11"], (c["m"] * c["s01"] - c["s0"] * c["s1"]) / spread).otherwise(0.0)
    return F.when(c["m"] > 0, (c["s0"] - slope * c["s1"]) / c["m"]).otherwise(c["s"] / c["n"]), slope


def _ma(c: dict[str, Column]) -> tuple[Column, Column]:
    """Mean change and the moving-average weight from the lag-1 autocorrelation; changes that do not vary have weight 0."""
    mean = c["s"] / c["n"]
    c0 = c["ss"] - c["n"] * mean * mean
    c1 = c["s01"] - mean * (c["s0"] + c["s1"]) + c["m"] * mean * mean
    return mean, F.when(c0 > 1e-12 * c["ss"], ma_theta(c1 / c0)).otherwise(0.0)


def fold_fits(changes: DataFrame, sums: DataFrame, kind: str, series: Sequence[str], ts: str, k: int,
              hours: float = 3) -> DataFrame:
    """Per series and fold: ``_level`` (constant or mean), ``_weight`` (slope or moving average), the last training row
    ``_t, _y, _d``, and its residual ``_e`` (moving average only)."""
    keys = [*series, "fold"]
    total = _folds(sums, k).groupBy(*keys).agg(
        *[F.sum(f"_{c}").alias(f"_{c}") for c in _SUMS], F.max_by("_last", "_last.t").alias("_last"))
    total = total.filter((F.col("_n") > 0) & F.col("_last").isNotNull())
    level, weight = {"ar": _ar, "ma": _ma}[kind]({c: F.col(f"_{c}") for c in _SUMS})
    fits = total.select(*keys, level.alias("_level"), weight.alias("_weight"), *[F.col(f"_last.{c}").alias(f"_{c}") for c in ("t", "y", "d")])
    if kind == "ar":
        return fits.withColumn("_e", F.lit(0.0))
    # the residual recursion, unrolled: weights fall geometrically with the distance from the last training row
    rows = with_nulls(_folds(changes, k).select(*keys, F.col(ts).alias("_at"), F.col("d").alias("_change")), fits, list(series), ["fold"])
    age = F.round((epoch_us("_t") - epoch_us("_at")) / F.lit(hours * HOUR_US))
    weighed = F.pow(-F.col("_weight"), age) * (F.col("_change") - F.col("_level"))
    ends = rows.filter(age >= 0).groupBy(*keys).agg(F.sum(weighed).alias("_e"))
    return with_nulls(fits, ends, list(series), ["fold"], "left").withColumn("_e", F.coalesce("_e", F.lit(0.0)))


def ahead(kind: str, h: Column, order: int = 1) -> Column:
    """Forecast ``h`` steps after the last training row, from the columns of ``fold_fits``."""
    level, weight, y, last_d, e = (F.col(f"_{c}") for c in ("level", "weight", "y", "d", "e"))
    if kind == "ma":
        return y + weight * e + h * level if order else level + F.when(h == 1, weight * e).otherwise(0.0)
    rest = 1 - weight
    mean = level / rest
    if order == 0:
        return F.when(F.abs(rest) < 1e-9, y + h * level).otherwise(mean + F.pow(weight, h) * (y - mean))
    d = F.coalesce(last_d, mean)
    drift = y + h * d + level * h * (h + 1) / 2
    return F.when(F.abs(rest) < 1e-9, drift).otherwise(y + h * mean + (d - mean) * weight * (1 - F.pow(weight, h)) / rest)


def forecast(rows: DataFrame, fits: DataFrame, kind: str, series: Sequence[str], ts: str, keys: Sequence[str] = ("fold",),
             hours: float = 3, order: int = 1, out: str = "prediction") -> DataFrame:
    """``rows`` with a forecast; null at or before the last training row and for series without a fit."""
    joined = with_nulls(rows, fits, list(series), list(keys), "left")
    h = F.round((epoch_us(ts) - epoch_us("_t")) / F.lit(hours * HOUR_US))
    return joined.select(*[F.col(f"`{c}`") for c in rows.columns], F.when(h > 0, ahead(kind, h, order)).alias(out))


def fold_errors(changes: DataFrame, fits: DataFrame, kind: str, series: Sequence[str], ts: str, value: str, k: int,
                hours: float = 3, order: int = 1) -> DataFrame:
    """``fold``, ``rmse`` and the number of test ``rows`` with a value and a forecast."""
    tests = changes.filter(F.col("segment") > 0).select(
        *series, F.col(ts).alias("_when"), F.col(value).alias("_truth"), (F.col("segment") - 1).alias("fold"))
    error = F.col("prediction") - F.col("_truth")
    return forecast(tests, fits, kind, series, "_when", ("fold",), hours, order).groupBy("fold").agg(
        F.sqrt(F.avg(error * error)).alias("rmse"), F.count(error).alias("rows"))
