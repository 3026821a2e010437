"""Small helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kairoline.session import checkpoint_root

#: Word separators of the word rule ``[^\x20\x09-\x0D]+``.
SEPARATORS = " \t\n\x0b\x0c\r"
#: A table of at most this many rows may be broadcast; beyond it a shuffle join is used.
BROADCAST_ROWS = 100_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that ``df`` does not have yet, whatever their case."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, even where a lambda inside ``body`` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column) -> Column:
    """Words of a text (null: none), split at ASCII white space only."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[ \t-\r]+"), "")


def settled(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder: later jobs reread it instead of computing it again."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def sized(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Mark a settled table for broadcast if a count proves that it is small; otherwise leave it to a shuffle join."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def col(name: str) -> Column:
    """A column by its exact name, also with dots in it."""
    return F.col("`" + name.replace("`", "``") + "`")
