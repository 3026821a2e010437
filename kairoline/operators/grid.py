"""Fixed time grids: bucketing, regularisation and the fused on-grid filter."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kairoline.functions.scalars import HOUR_US, epoch_us, from_epoch_us

CHUNK_STEPS = 4096


def bucket_mean(df: DataFrame, series: Sequence[str], ts: str, value: str, hours: int = 3,
                t: str = "t", v: str = "v") -> DataFrame:
    """Mean reading per series and step. Partial sums run before the shuffle, so a series
    that holds most rows still sends one row per step and input partition."""
    step = F.window(F.col(ts), f"{hours} hours").start
    return df.groupBy(*series, step.alias(t)).agg(F.avg(value).alias(v))


def bucket_pivot(df: DataFrame, series: Sequence[str], ts: str, kind: str, kinds: Sequence[str],
                 value: str, hours: int = 3, t: str = "t") -> DataFrame:
    """One row per series and step, one column per kind (means; null where none was read)."""
    step = F.window(F.col(ts), f"{hours} hours").start
    means = [F.avg(F.when(F.col(kind) == k, F.col(value))).alias(k) for k in kinds]
    return df.groupBy(*series, step.alias(t)).agg(*means)


def _bounds(df: DataFrame, series: Sequence[str], ts: str) -> DataFrame:
    return df.groupBy(*series).agg(F.min(ts).alias("_lo"), F.max(ts).alias("_hi"))


def grid_of(df: DataFrame, series: Sequence[str], ts: str, hours: int = 3) -> DataFrame:
    """Every step between the first and last reading of each series.

    Stretches of ``CHUNK_STEPS`` steps are listed and spread first and opened afterwards, so a
    single very long series is generated by many tasks. The few stretches make Spark estimate the grid far too low;
    without the hint an inner join (also a left one whose missing steps are dropped later) broadcasts all of it.
    """
    step = hours * HOUR_US
    stretch = step * CHUNK_STEPS
    lo, hi = epoch_us("_lo"), epoch_us("_hi")
    spread = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    stretches = (
        _bounds(df, series, ts)
        .where(F.col("_lo").isNotNull())
        .select(*series, hi.alias("_end"), F.explode(F.sequence(lo, hi, F.lit(stretch))).alias("_from"))
        .repartition(spread, *series, "_from")
    )
    stop = F.least(F.col("_from") + F.lit(stretch - step), F.col("_end"))
    opened = stretches.select(*series, F.explode(F.sequence("_from", stop, F.lit(step))).alias("_us"))
    return opened.select(*series, from_epoch_us("_us").alias(ts)).hint("merge")


def with_nulls(left: DataFrame, right: DataFrame, keys: Sequence[str], exact: Sequence[str] = (),
               how: str = "inner") -> DataFrame:
    """Join on ``keys``, where a null key matches a null key, and on ``exact``; columns as in a join by name."""
    named = right.withColumnsRenamed({c: f"_r_{c}" for c in (*keys, *exact)})
    same = F.lit(True)
    for c in keys:
        same = same & F.col(f"`{c}`").eqNullSafe(F.col(f"`_r_{c}`"))
    for c in exact:
        same = same & (F.col(f"`{c}`") == F.col(f"`_r_{c}`"))
    return left.join(named, same, how).drop(*[f"_r_{c}" for c in (*keys, *exact)])


def regularise(df: DataFrame, series: Sequence[str], ts: str, hours: int = 3) -> DataFrame:
    """Left-join readings onto their grid: missing steps appear, off-grid rows vanish. Readings without
    a series id are a series of their own."""
    return with_nulls(grid_of(df, series, ts, hours), df, series, [ts], "left")


def single_steps(df: DataFrame, series: Sequence[str], ts: str, duplicates: str = "error") -> DataFrame:
    """One row per series and step. With ``error`` a step that is read twice fails the job that reads it, with its series
    and time; ``first`` keeps the row that comes first by its values; ``keep`` leaves all."""
    if duplicates not in ("error", "first", "keep"):
        raise ValueError("duplicates must be 'error', 'first' or 'keep'")
    if duplicates == "keep":
        return df
    step = Window.partitionBy(*[F.col(f"`{c}`") for c in series], F.col(f"`{ts}`"))
    if duplicates == "first":
        order = [F.col(f"`{c}`") for c in df.columns if c not in (*series, ts)]
        numbered = df.withColumn("_copy", F.row_number().over(step.orderBy(*(order or [F.lit(0)]))))
        return numbered.where("_copy = 1").drop("_copy")
    what = F.concat(F.lit("a step is read more than once: "), F.to_json(F.struct(*[F.col(f"`{c}`") for c in (*series, ts)])))
    counted = df.withColumn("_copies", F.count(F.lit(1)).over(step))
    return counted.where(F.when(F.col("_copies") == 1, True).otherwise(F.raise_error(what))).drop("_copies")


def drop_all_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.na.drop("all", subset=list(columns))


def on_grid(df: DataFrame, series: Sequence[str], ts: str, columns: Sequence[str],
            hours: int = 3) -> DataFrame:
    """Regularise and drop fully missing rows in one filter, with no grid to build.

    Keeps readings whose distance from the first one of their series is a whole number of steps
    and that have at least one value. Readings without a series id are a series of their own.
    """
    lo = df.groupBy(*series).agg(F.min(ts).alias("_lo"))
    joined = with_nulls(df, lo, series) if series else df.join(F.broadcast(lo))
    fits = (epoch_us(ts) - epoch_us("_lo")) % F.lit(hours * HOUR_US) == 0
    return drop_all_null(joined.where(fits).drop("_lo"), columns)


def duplicate_steps(df: DataFrame, series: Sequence[str], ts: str) -> DataFrame:
    """Steps read more than once, with their counts."""
    return df.groupBy(*series, ts).agg(F.count("*").alias("n")).where("n > 1")
