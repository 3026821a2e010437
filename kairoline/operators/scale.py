"""Standardisation with population deviation, as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Moments = dict[str, tuple[float, float]]


def moments(df: DataFrame, columns: Sequence[str]) -> Moments:
    """Mean and population deviation per column in one pass, nulls ignored; a zero (or unknown)
    deviation counts as 1. The result is two numbers per column, whatever the table size."""
    row = df.agg(*[F.avg(c).alias(f"{c}_m") for c in columns],
                 *[F.stddev_pop(c).alias(f"{c}_s") for c in columns]).first()
    return {c: (row[f"{c}_m"] if row[f"{c}_m"] is not None else 0.0, row[f"{c}_s"] or 1.0) for c in columns}


def standardise(df: DataFrame, columns: Sequence[str], fitted: Moments) -> DataFrame:
    return df.withColumns({
        c: (F.col(c) - F.lit(float(fitted[c][0]))) / F.lit(float(fitted[c][1])) for c in columns
    })
