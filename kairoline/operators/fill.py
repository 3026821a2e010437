"""Gap filling along time: forward, backward, zero, by position and by elapsed time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kairoline.functions.scalars import HOUR_US
from kairoline.operators.grid import grid_of, with_nulls
from kairoline.operators.order import US, neighbours, neighbours_of


def forward_fill(df: DataFrame, series: Sequence[str], ts: str, value: str, out: str,
                 hours: float = 3, **kw) -> DataFrame:
    near = neighbours(df, series, ts, value, hours, **kw)
    return near.select(*df.columns, F.col("prev_v").alias(out))


def backward_fill(df: DataFrame, series: Sequence[str], ts: str, value: str, out: str,
                  hours: float = 3, **kw) -> DataFrame:
    near = neighbours(df, series, ts, value, hours, **kw)
    return near.select(*df.columns, F.col("next_v").alias(out))


def zero_fill(df: DataFrame, value: str, out: str) -> DataFrame:
    return df.withColumn(out, F.coalesce(F.col(value), F.lit(0.0)))


def gap_hours(hours: float) -> Column:
    """Length of the run of missing steps around a row, in hours (needs ``neighbours``)."""
    return (F.col("next_us") - F.col("prev_us")) / F.lit(HOUR_US) - F.lit(float(hours))


def _between(value: str) -> Column:
    share = (F.col(US) - F.col("prev_us")) / (F.col("next_us") - F.col("prev_us"))
    line = F.col("prev_v") + (F.col("next_v") - F.col("prev_v")) * share
    return F.coalesce(F.col(value), line)


def linear_fill(df: DataFrame, series: Sequence[str], ts: str, value: str, out: str,
                hours: float = 3, **kw) -> DataFrame:
    """Straight line between neighbours; on a regular grid position and time agree.

    Leading gaps stay null and trailing gaps keep the last reading, as a forward linear fill does.
    """
    near = neighbours(df, series, ts, value, hours, **kw)
    line = F.coalesce(_between(value), F.col("prev_v"))
    return near.select(*df.columns, line.alias(out))


def interpolate(df: DataFrame, series: Sequence[str], ts: str, value: str, out: str,
                max_gap: float = 24, hours: float = 3, **kw) -> DataFrame:
    """Time-weighted line inside gaps of at most ``max_gap`` hours; edges are not extended."""
    near = neighbours(df, series, ts, value, hours, **kw)
    inside = F.col(value).isNotNull() | (gap_hours(hours) <= F.lit(float(max_gap)))
    return near.select(*df.columns, F.when(inside, _between(value)).alias(out))


def gap_islands(df: DataFrame, series: Sequence[str], ts: str, value: str, hours: float = 3,
                **kw) -> DataFrame:
    """One row per run of missing steps that has readings on both sides."""
    near = neighbours(df, series, ts, value, hours, **kw)
    return (
        near.where(F.col(value).isNull() & F.col("prev_us").isNotNull() & F.col("next_us").isNotNull())
        .groupBy(*series, "prev_us", "next_us")
        .agg(F.min(ts).alias("gap_start"), F.max(ts).alias("gap_end"), F.count("*").alias("gap_steps"))
        .select(*series, "gap_start", "gap_end", "gap_steps")
    )


MODES = ("interpolate", "ffill", "bfill", "zero")


def regularise_and_fill(df: DataFrame, series: Sequence[str], ts: str, values: Sequence[str], mode: str,
                        hours: int = 3, **kw) -> DataFrame:
    """Readings on their grid; rows in which every one of ``values`` is missing are filled, all columns from one scan.

    Such rows are steps without a reading and readings without a value. Other rows stay as they are, with
    their own nulls. ``interpolate`` draws a line per column and keeps the last value after the end; ``ffill`` and ``bfill``
    take the value before or after, ``zero`` takes 0. Where a column has nothing to take, it stays null.
    """
    if mode not in MODES:
        raise ValueError(f"unknown fill mode: {mode}; choose one of {', '.join(MODES)}")
    values = list(values)
    held = df.select(*series, ts, *values)
    placed = with_nulls(grid_of(df, series, ts, hours), held, list(series), [ts], "left")
    if mode == "zero":
        near, fills = placed, {c: F.lit(0.0) for c in values}
    else:
        near, fills = neighbours_of(placed, series, ts, values, hours, **kw), {}
        for i, c in enumerate(values):
            prev, after = F.col(f"_prev{i}"), F.col(f"_next{i}")
            share = (F.col(US) - prev["t"]) / (after["t"] - prev["t"])
            line = F.coalesce(prev["v"] + (after["v"] - prev["v"]) * share, prev["v"])
            fills[c] = {"ffill": prev["v"], "bfill": after["v"], "interpolate": line}[mode]
    empty = F.lit(True)
    for c in values:
        empty = empty & F.col(f"`{c}`").isNull()
    return near.select(*series, ts, *[F.when(empty, fills[c]).otherwise(F.col(f"`{c}`")).alias(c) for c in values])
