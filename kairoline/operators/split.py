"""Time-ordered splits over global row positions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kairoline.operators.order import positions


def fold_starts(n: int, k: int) -> list[int]:
    """First test position of each fold; every fold tests ``n // (k + 1)`` rows."""
    size = n // (k + 1)
    if size == 0:
        raise ValueError(f"{n} rows are too few for {k} folds")
    return [n - (k - f) * size for f in range(k)]


def segment(pos: Column, n: int, k: int) -> Column:
    """0 for rows that are only trained on, f+1 for the test rows of fold f.

    Fold f trains on all segments up to f, so one pass that groups by segment serves every fold.
    """
    out = F.lit(0)
    for start in fold_starts(n, k):
        out = out + (pos >= F.lit(start)).cast("int")
    return out


def with_segments(df: DataFrame, order: Sequence[str], k: int = 5, out: str = "segment",
                  pos: str = "pos") -> DataFrame:
    """Positions and segments of a table in time order (``order`` should identify a row)."""
    placed = positions(df, order, pos)
    return placed.withColumn(out, segment(F.col(pos), placed.count(), k))


def expanding_split(df: DataFrame, order: Sequence[str], k: int = 5) -> DataFrame:
    """Long form: every row once per fold that uses it, with ``fold`` and ``role``."""
    placed = with_segments(df, order, k, "_segment")
    fold = F.explode(F.sequence(F.greatest(F.col("_segment") - 1, F.lit(0)), F.lit(k - 1))).alias("fold")
    rows = placed.select("*", fold)
    role = F.when(F.col("fold") == F.col("_segment") - 1, "test").otherwise("train")
    return rows.withColumn("role", role).drop("_segment")


def fold_frames(placed: DataFrame, fold: int, segment_col: str = "segment") -> tuple[DataFrame, DataFrame]:
    """(train, test) rows of one fold."""
    s = F.col(segment_col)
    return placed.where(s <= fold), placed.where(s == fold + 1)


def holdout(df: DataFrame, order: Sequence[str], share: float = 0.2) -> DataFrame:
    """Mark the last ``share`` of the rows (rounded up) as validation."""
    placed = positions(df, order)
    n = placed.count()
    cut = n - int(-(-n * share // 1))
    return placed.withColumn("role", F.when(F.col("pos") >= cut, "validation").otherwise("train"))
