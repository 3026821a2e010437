"""Exact group quantiles that stay exact when a group does not fit into one task."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kairoline.session import settle

# Spark's exact percentile keeps one entry per distinct value of a group in memory. Groups above
# this many rows take the sorting path instead.
IN_MEMORY_ROWS = 1_000_000


def largest_group(df: DataFrame, keys: Sequence[str]) -> int:
    sizes = df.groupBy(*keys).agg(F.count("*").alias("n"))
    return sizes.agg(F.max("n")).first()[0] or 0


def quantiles(df: DataFrame, keys: Sequence[str], value: str, probs: dict[str, float],
              limit: int = IN_MEMORY_ROWS, known_rows: int | None = None) -> DataFrame:
    """Linear-interpolated quantiles per group; ``probs`` maps output names to probabilities.

    Nulls and NaN are skipped. Small groups use the built-in aggregate; when a group is larger
    than ``limit`` rows, the values are range-sorted and only the partitions holding the wanted
    ranks are looked at again. ``known_rows`` is an upper bound of the group size, if the caller
    has one; otherwise the groups are counted.
    """
    clean = df.select(*keys, F.col(value).cast("double").alias("_v")).where(
        F.col("_v").isNotNull() & ~F.isnan("_v")
    )
    if (known_rows is not None and known_rows <= limit) or largest_group(clean, keys) <= limit:
        wanted = F.percentile("_v", F.array(*[F.lit(float(p)) for p in probs.values()])).alias("_q")
        return clean.groupBy(*keys).agg(wanted).select(
            *keys, *[F.col("_q")[i].alias(n) for i, n in enumerate(probs)]
        )
    return _by_sorting(clean, list(keys), probs)


def _by_sorting(clean: DataFrame, keys: list[str], probs: dict[str, float]) -> DataFrame:
    counted = clean.groupBy(*keys, "_v").agg(F.count("*").alias("_c"))
    rows = settle(
        counted.repartitionByRange(*keys, "_v").withColumn("_part", F.spark_partition_id())
    )
    pieces = rows.groupBy(*keys, "_part").agg(F.sum("_c").alias("_n"))
    by_group = Window.partitionBy(*keys).orderBy("_part")
    whole = Window.partitionBy(*keys)
    pieces = pieces.select(
        *keys, "_part",
        (F.sum("_n").over(by_group) - F.col("_n")).alias("_start"),
        F.col("_n"),
        F.sum("_n").over(whole).alias("_total"),
    )
    names = list(probs)
    wanted = F.array(*[
        F.struct(F.lit(n).alias("name"), (F.lit(p) * (F.col("_total") - 1)).alias("rank"))
        for n, p in probs.items()
    ])
    pieces = pieces.select("*", F.explode(wanted).alias("_w")).select(
        *keys, "_part", "_start", F.col("_w.name").alias("_name"), F.col("_w.rank").alias("_rank"), "_n"
    ).where(
        (F.ceil("_rank") >= F.col("_start")) & (F.floor("_rank") < F.col("_start") + F.col("_n"))
    )
    # Grouping keys may be null, so they are compared null-safely under other names.
    wanted = pieces.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
        F.col("_part").alias("_wpart"), "_start", "_name", "_rank",
    )
    needed = wanted.drop("_name", "_rank").distinct()
    same = F.col("_part") == F.col("_wpart")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    near = rows.join(needed, same).select(*keys, "_part", "_v", "_c", "_start")
    # Bounded by one range partition, however large the group is.
    upto = Window.partitionBy(*keys, "_part").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    near = near.withColumn("_end", F.col("_start") + F.sum("_c").over(upto)).drop("_start")
    lo, hi = F.floor("_rank"), F.ceil("_rank")
    begin = F.col("_end") - F.col("_c")
    picked = near.join(wanted.drop("_start"), same).select(
        *keys, "_name", "_rank",
        F.when((begin <= lo) & (lo < F.col("_end")), F.col("_v")).alias("_a"),
        F.when((begin <= hi) & (hi < F.col("_end")), F.col("_v")).alias("_b"),
    )
    ends = picked.groupBy(*keys, "_name", "_rank").agg(F.max("_a").alias("_a"), F.max("_b").alias("_b"))
    share = F.col("_rank") - F.floor("_rank")
    value = F.col("_a") + share * (F.col("_b") - F.col("_a"))
    return ends.groupBy(*keys).agg(*[F.max(F.when(F.col("_name") == n, value)).alias(n) for n in names])


def medians(df: DataFrame, keys: Sequence[str], value: str, out: str = "median",
            limit: int = IN_MEMORY_ROWS, known_rows: int | None = None, error: float | None = None) -> DataFrame:
    """Exact, or within a rank ``error`` (a share of the group's rows) from one pass."""
    if error is not None:
        return sketched(df, keys, value, {out: 0.5}, error)
    return quantiles(df, keys, value, {out: 0.5}, limit, known_rows)


def sketched(df: DataFrame, keys: Sequence[str], value: str, probs: dict[str, float], error: float = 1e-3) -> DataFrame:
    """Approximate quantiles per group in one pass: values of the data whose rank is off by at most ``error`` times the rows of
    the group. Tasks send mergeable summaries, whose size depends on ``error`` and not on the rows."""
    if not 0 < error < 0.5:
        raise ValueError("error must lie between 0 and 0.5")
    clean = df.select(*keys, F.col(value).cast("double").alias("_v")).where(F.col("_v").isNotNull() & ~F.isnan("_v"))
    wanted = F.percentile_approx("_v", [float(p) for p in probs.values()], math.ceil(1 / error)).alias("_q")
    return clean.groupBy(*keys).agg(wanted).select(*keys, *[F.col("_q")[i].alias(n) for i, n in enumerate(probs)])
