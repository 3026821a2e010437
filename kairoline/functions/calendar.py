"""Calendar features. Monday is 0; every output schema depends on arguments only."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kairoline.functions.scalars import as_col

BOOKKEEPING = ("Unnamed: 0", "load_shortfall_3h", "time")
CYCLICAL = ("hour_sin", "hour_cos", "dow_sin", "dow_cos", "month_sin", "month_cos", "year")
_CYCLES = {"hour": 24, "dow": 7, "month": 12}
_VOCABULARY = {"hour": range(24), "dow": range(7), "month": range(1, 13)}


def keys(ts: Column | str) -> dict[str, Column]:
    ts = as_col(ts)
    return {"hour": F.hour(ts), "dow": F.weekday(ts), "month": F.month(ts), "year": F.year(ts)}


def cyclical(ts: Column | str) -> dict[str, Column]:
    """Sine and cosine of hour, weekday and month, plus the raw year: seven columns."""
    parts = keys(ts)
    out: dict[str, Column] = {}
    for name, period in _CYCLES.items():
        angle = parts[name] * F.lit(2 * math.pi) / F.lit(period)
        out[f"{name}_sin"] = F.sin(angle)
        out[f"{name}_cos"] = F.cos(angle)
    out["year"] = parts["year"]
    return out


def onehot(ts: Column | str, drop_first: bool = False) -> dict[str, Column]:
    """0/1 columns over the full vocabulary, so unseen hours still have a column."""
    parts = keys(ts)
    out = {
        f"{name}_{v}": (parts[name] == v).cast("int")
        for name, vocabulary in _VOCABULARY.items()
        for v in list(vocabulary)[1 if drop_first else 0 :]
    }
    out["year"] = parts["year"]
    return out


def add_calendar(df: DataFrame, ts: str, mode: str | None, drop_first: bool = False) -> DataFrame:
    if mode is None:
        return df
    if mode == "cyclical":
        return df.withColumns(cyclical(ts))
    if mode == "onehot":
        return df.withColumns(onehot(ts, drop_first))
    raise ValueError(f"unknown calendar mode: {mode}")


def feature_list(columns: Sequence[str], mode: str | None, drop_first: bool = False,
                 removed: Sequence[str] = BOOKKEEPING) -> list[str]:
    """Output feature names in input order, generated ones last."""
    kept = [c for c in columns if c not in removed]
    if mode == "cyclical":
        made = list(CYCLICAL)
    elif mode == "onehot":
        skip = 1 if drop_first else 0
        made = [f"{n}_{v}" for n, voc in _VOCABULARY.items() for v in list(voc)[skip:]] + ["year"]
    else:
        made = []
    return [c for c in kept if c not in made] + made
