"""Ranks with shared ties, and combined feature ranking."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kairoline.session import settle


def average_rank(df: DataFrame, value: str, out: str = "rank") -> DataFrame:
    """Rank from 1 in ascending order; ties share the mean of their places.

    Ties are counted first, so a value held by a third of all rows is one row in the sort.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(value).agg(F.count("*").alias("_n"))
    placed = settle(counts.repartitionByRange(value).sortWithinPartitions(value).withColumn("_part", F.spark_partition_id()))
    pieces = placed.groupBy("_part").agg(F.sum("_n").alias("_size"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = pieces.select("_part", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy("_part").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    last = F.col("_offset") + F.sum("_n").over(inside)
    ranks = placed.join(F.broadcast(offsets), "_part").select(value, (last - (F.col("_n") - 1) / 2).alias(out))
    return df.join(ranks, value, "left").select(*df.columns, out)


def combined_rank(parts: dict[str, DataFrame], key: str = "feature", ranked: Sequence[str] | None = None,
                  top: int = 50) -> DataFrame:
    """Outer-join score tables (``key`` plus one score each), score 0 where a table has no row,
    and add up the average ranks of the ``ranked`` scores.

    There is one row per feature here, so the window over all of them is small.
    """
    joined = None
    for name, part in parts.items():
        part = part.select(key, F.col(part.columns[-1]).alias(name))
        joined = part if joined is None else joined.join(part, key, "full")
    joined = joined.na.fill(0.0, list(parts))
    total = F.lit(0.0)
    for name in ranked or parts:
        order, peers = Window.orderBy(F.abs(name)), Window.partitionBy(F.abs(name))
        total = total + F.rank().over(order) + (F.count("*").over(peers) - 1) / 2
    return joined.withColumn("score", total).orderBy(F.desc("score"), key).limit(top)
