"""Seasonal-median, mean and nearest-neighbour imputation.

Fitted state is a table keyed by calendar cell: at most 24 x 7 x 12 rows whatever the input size,
which is why those tables may be broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kairoline.functions import calendar
from kairoline.operators import fill, knn
from kairoline.operators.grid import with_nulls
from kairoline.operators.quantiles import IN_MEMORY_ROWS, medians

ALL_KEYS = ("hour", "dow", "month")


def _keyed(df: DataFrame, ts: str, value: str, keys: Sequence[str]) -> DataFrame:
    parts = calendar.keys(ts)
    return df.select(*[parts[k].alias(f"_{k}") for k in keys], F.col(value).alias("_value"))


def _held(state: DataFrame) -> DataFrame:
    """Fitted medians as a local table: at most 24 x 7 x 12 calendar cells per level."""
    return state.sparkSession.createDataFrame(state.collect(), state.schema)


def seasonal_medians(df: DataFrame, ts: str, value: str, keys: Sequence[str] = ALL_KEYS,
                     limit: int = IN_MEMORY_ROWS, error: float | None = None) -> DataFrame:
    """Median (within a rank ``error``, if given) of ``value`` per calendar cell: columns ``_hour``, ``_dow``, ... and ``_median``."""
    return _held(medians(_keyed(df, ts, value, keys), [f"_{k}" for k in keys], "_value", "_median", limit, error=error))


def level_medians(df: DataFrame, ts: str, value: str, levels: Sequence[Sequence[str]],
                  limit: int = IN_MEMORY_ROWS, error: float | None = None) -> DataFrame:
    """Medians of several calendar groupings in one table; ``_level`` is the index in ``levels``.

    Every row is expanded once per level, as ``GROUPING SETS`` does, so the input is read once.
    """
    keys = sorted({k for level in levels for k in level})
    rows = _keyed(df, ts, value, keys).where(F.col("_value").isNotNull())
    n = rows.count() if error is None else None  # no group is larger than the table
    expanded = rows.select("_value", F.explode(F.array(*[
        F.struct(F.lit(i).alias("_level"),
                 *[(F.col(f"_{k}") if k in level else F.lit(None).cast("int")).alias(f"_{k}")
                   for k in keys])
        for i, level in enumerate(levels)
    ])).alias("_cell")).select("_value", "_cell.*")
    return _held(medians(expanded, ["_level", *[f"_{k}" for k in keys]], "_value", "_median", limit,
                         n if n is not None and n <= limit else None, error))


def fill_from_medians(df: DataFrame, ts: str, value: str, out: str, state: DataFrame,
                      keys: Sequence[str] = ALL_KEYS) -> DataFrame:
    """Null cells take the median of their own calendar cell; unmatched ones stay null."""
    parts = calendar.keys(ts)
    left = df.withColumns({f"_{k}": parts[k] for k in keys})
    joined = left.join(F.broadcast(state), [f"_{k}" for k in keys], "left")
    return joined.select(*df.columns, F.coalesce(value, "_median").alias(out))


def fill_from_levels(df: DataFrame, ts: str, value: str, out: str, state: DataFrame,
                     levels: Sequence[Sequence[str]]) -> DataFrame:
    """Null cells take the first known median going down ``levels``."""
    parts = calendar.keys(ts)
    keys = sorted({k for level in levels for k in level})
    joined = df.withColumns({f"_{k}": parts[k] for k in keys})
    found = []
    for i, level in enumerate(levels):
        one = state.where(F.col("_level") == i).select(
            *[F.col(f"_{k}") for k in level], F.col("_median").alias(f"_m{i}")
        )
        on = [f"_{k}" for k in level]
        one = F.broadcast(one)
        joined = joined.join(one, on, "left") if on else joined.join(one, F.lit(True), "left")
        found.append(f"_m{i}")
    return joined.select(*df.columns, F.coalesce(value, *found).alias(out))


PATTERN_LEVELS = (("hour", "dow"), ("hour",), ("dow",), ())
FALLBACK_LEVELS = (("hour",), ("dow",), ())


def impute_group_median(df: DataFrame, ts: str, value: str, out: str,
                        fit_on: DataFrame | None = None, limit: int = IN_MEMORY_ROWS, error: float | None = None) -> DataFrame:
    state = seasonal_medians(fit_on if fit_on is not None else df, ts, value, ALL_KEYS, limit, error)
    return fill_from_medians(df, ts, value, out, state)


def impute_pattern(df: DataFrame, ts: str, value: str, out: str,
                   fit_on: DataFrame | None = None, limit: int = IN_MEMORY_ROWS, error: float | None = None) -> DataFrame:
    """(hour, weekday) median, then hour, then weekday, then overall."""
    state = level_medians(fit_on if fit_on is not None else df, ts, value, PATTERN_LEVELS, limit, error)
    return fill_from_levels(df, ts, value, out, state, PATTERN_LEVELS)


def impute_interpolate(df: DataFrame, series: Sequence[str], ts: str, value: str, out: str,
                       max_gap: float = 24, hours: float = 3, fit_on: DataFrame | None = None,
                       limit: int = IN_MEMORY_ROWS) -> DataFrame:
    """Time interpolation in short gaps; hour, weekday and overall medians elsewhere."""
    state = level_medians(fit_on if fit_on is not None else df, ts, value, FALLBACK_LEVELS, limit)
    lined = fill.interpolate(df, series, ts, value, "_line", max_gap, hours)
    done = fill_from_levels(lined, ts, "_line", out, state, FALLBACK_LEVELS)
    return done.drop("_line")


def impute_column(df: DataFrame, value: str, out: str, strategy: str = "mean",
                  fit_on: DataFrame | None = None, limit: int = IN_MEMORY_ROWS) -> DataFrame:
    """Column mean or median, held in a one-row table."""
    source = fit_on if fit_on is not None else df
    if strategy == "mean":
        state = source.agg(F.avg(value).alias("_stat"))
    elif strategy == "median":
        state = medians(source, [], value, "_stat", limit)
    else:
        raise ValueError(f"unknown strategy: {strategy}")
    joined = df.join(F.broadcast(state), F.lit(True), "left")
    return joined.select(*df.columns, F.coalesce(value, "_stat").alias(out))


def knn_coordinates(ts: str) -> dict:
    """The six cyclic coordinates that join the numeric columns in the distance."""
    cyc = calendar.cyclical(ts)
    return {f"_{k}": v for k, v in cyc.items() if k != "year"}


def numeric_columns(df: DataFrame, skip: Sequence[str] = ()) -> list[str]:
    """Names of the double and long columns, in schema order (int columns such as year are out)."""
    return [f.name for f in df.schema.fields
            if f.dataType.typeName() in ("double", "long") and f.name not in skip]


def impute_knn(df: DataFrame, ts: str, value: str, out: str, row_id: Sequence[str],
               columns: Sequence[str], k: int = 5, donors: DataFrame | None = None,
               **limits) -> DataFrame:
    """Mean of the ``k`` nearest donors that have a value; donor mean where none is comparable.

    Distance is Euclidean over the coordinates both rows have, scaled up by the share of missing
    ones. The imputed column itself counts as one (always missing) coordinate of the receiver.
    Ties go to the donor that comes first by ``row_id``.
    """
    cyc = knn_coordinates(ts)
    others = [c for c in columns if c != value]
    coords = [*cyc, *others]
    source = donors if donors is not None else df
    donor_rows = source.where(F.col(value).isNotNull()).select(
        *row_id, F.col(value).cast("double").alias("_y"),
        *[c.alias(n) for n, c in cyc.items()], *[F.col(c).cast("double").alias(c) for c in others])
    receivers = df.where(F.col(value).isNull()).select(
        *row_id, *[c.alias(n) for n, c in cyc.items()],
        *[F.col(c).cast("double").alias(c) for c in others])
    near = knn.nearest(receivers, donor_rows, row_id, row_id, coords, k, payload="_y",
                       coordinate_count=len(coords) + 1, **limits)
    means = near.groupBy(*row_id).agg(F.avg("_y").alias("_knn"))
    overall = donor_rows.agg(F.avg("_y").alias("_mean"))
    joined = with_nulls(df, means, list(row_id), how="left").join(F.broadcast(overall), F.lit(True), "left")
    return joined.select(*df.columns, F.coalesce(F.col(value), "_knn", "_mean").alias(out))
