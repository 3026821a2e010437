"""Autocorrelation, partial autocorrelation and the augmented Dickey-Fuller statistic.

Spark does the sums over the series; what reaches the driver has the size of the lag range.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kairoline.operators import gram
from kairoline.operators.order import positions

CHUNK = 8192


def _lagged_chunks(placed: DataFrame, value: str, lags: int, chunk: int) -> DataFrame:
    """Rows grouped into position chunks; the ``lags`` rows before a chunk are added to it."""
    own = F.floor(F.col("pos") / F.lit(chunk)).cast("bigint")
    last = F.floor((F.col("pos") + F.lit(lags)) / F.lit(chunk)).cast("bigint")
    return placed.select("pos", F.col(value).cast("double").alias("v"), F.explode(F.sequence(own, last)).alias("chunk"))


def lag_products(placed: DataFrame, value: str, lags: int, chunk: int = CHUNK) -> DataFrame:
    """``lag``, ``s``: sum of v(t) * v(t - lag) over a table with positions ``pos``.

    A group holds at most ``chunk + lags`` rows.
    """

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        start = key[0] * chunk
        pdf = pdf.sort_values("pos")
        v, own = pdf["v"].to_numpy(), int((pdf["pos"] >= start).sum())
        now = len(v) - own
        sums = [float(v[max(now, k):] @ v[max(now, k) - k : len(v) - k]) if len(v) > k else 0.0
                for k in range(lags + 1)]
        return pd.DataFrame({"lag": range(lags + 1), "part": sums})

    parts = _lagged_chunks(placed, value, lags, chunk).groupBy("chunk").applyInPandas(run, "lag int, part double")
    return parts.groupBy("lag").agg(F.sum("part").alias("s"))


def acf(df: DataFrame, order: Sequence[str], value: str, lags: int = 500, chunk: int = CHUNK) -> DataFrame:
    """Autocorrelation for lags 0..``lags``, products divided by the full sum of squares."""
    placed = positions(df.select(*order, value).where(F.col(value).isNotNull()), order)
    mean = placed.agg(F.avg(value)).first()[0]
    centred = placed.select("pos", (F.col(value) - F.lit(mean)).alias("_c"))
    sums = lag_products(centred, "_c", lags, chunk)
    whole = sums.where("lag = 0").select(F.col("s").alias("_s0"))
    return sums.join(F.broadcast(whole), F.lit(True)).select("lag", (F.col("s") / F.col("_s0")).alias("acf"))


def pacf(df: DataFrame, order: Sequence[str], value: str, lags: int = 100, chunk: int = CHUNK) -> DataFrame:
    """Partial autocorrelation: Yule-Walker on the biased ACF through Durbin-Levinson."""
    rows = acf(df, order, value, lags, chunk).orderBy("lag").collect()  # lags + 1 numbers
    rho = np.array([r["acf"] for r in rows])
    out, phi = [1.0], np.zeros(0)
    for k in range(1, len(rho)):
        top = rho[k] - phi @ rho[1:k][::-1]
        bottom = 1.0 - phi @ rho[1:k]
        last = top / bottom
        phi = np.append(phi - last * phi[::-1], last)
        out.append(last)
    return df.sparkSession.createDataFrame(list(enumerate(map(float, out))), "lag int, pacf double")


# MacKinnon (1994, 2010) tables for one variable with a constant.
_CRITICAL = {"1%": (-3.43035, -6.5393, -16.786, -79.433), "5%": (-2.86154, -2.8903, -4.234, -40.040),
             "10%": (-2.56677, -1.5384, -2.809, 0.0)}
_TAU_MAX, _TAU_MIN, _TAU_STAR = 2.74, -18.83, -1.61
_SMALL_P, _LARGE_P = (2.1659, 1.4412, 0.038269), (1.7339, 0.93202, -0.12745, -0.010368)


def _p_value(tau: float) -> float:
    if tau > _TAU_MAX:
        return 1.0
    if tau < _TAU_MIN:
        return 0.0
    poly = _SMALL_P if tau <= _TAU_STAR else _LARGE_P
    z = sum(c * tau**i for i, c in enumerate(poly))
    return 0.5 * math.erfc(-z / math.sqrt(2))


def adf(df: DataFrame, order: Sequence[str], value: str, max_lag: int | None = None) -> DataFrame:
    """Augmented Dickey-Fuller test with a constant and AIC lag choice: one row."""
    placed = positions(df.select(*order, value).where(F.col(value).isNotNull()), order)
    n = placed.count()
    if max_lag is None:
        max_lag = min(int(math.ceil(12 * (n / 100) ** 0.25)), n // 2 - 2)
    design = _lag_design(placed, value, max_lag)
    names = ["level", *[f"d{k}" for k in range(1, max_lag + 1)]]
    common = gram.accumulate(design.where(F.col("pos") > max_lag), names, "d0")
    best, best_aic = 0, math.inf
    for p in range(max_lag + 1):
        rss, size = gram.ols(common, names[: p + 1]).rss, common.n
        aic = size * (math.log(rss / size) + math.log(2 * math.pi) + 1) + 2 * (p + 2)
        if aic < best_aic:
            best, best_aic = p, aic
    used = names[: best + 1]
    final = gram.accumulate(design.where(F.col("pos") > best), used, "d0")
    fit = gram.ols(final, used)
    tau = fit.coef[0] / fit.std_error[0]
    crit = {k: sum(c / final.n**i for i, c in enumerate(v)) for k, v in _CRITICAL.items()}
    return df.sparkSession.createDataFrame(
        [(float(tau), float(_p_value(tau)), best, int(final.n), *[float(v) for v in crit.values()])],
        "statistic double, p_value double, used_lag int, nobs long, crit_1 double, crit_5 double, crit_10 double")


def _lag_design(placed: DataFrame, value: str, max_lag: int) -> DataFrame:
    """Columns d0 (first difference), level (previous value) and d1..d``max_lag`` (lagged
    differences), by position chunks with the rows before them added."""
    chunk, need = CHUNK, max_lag + 1
    names = ["level", "d0", *[f"d{k}" for k in range(1, max_lag + 1)]]

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        start = key[0] * chunk
        pdf = pdf.sort_values("pos").reset_index(drop=True)
        diff = pdf["v"].diff()
        out = pd.DataFrame({"pos": pdf["pos"], "level": pdf["v"].shift(1), "d0": diff,
                            **{f"d{k}": diff.shift(k) for k in range(1, max_lag + 1)}})
        return out[(out["pos"] >= start) & (out["pos"] > 0)].fillna(0.0)

    return _lagged_chunks(placed, value, need, chunk).groupBy("chunk").applyInPandas(
        run, "pos long, " + ", ".join(f"{n} double" for n in names))
