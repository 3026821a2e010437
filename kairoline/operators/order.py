"""Order-dependent building blocks that never put a whole series into one task.

Two tools are offered. *Stretch scans* cut a series at fixed time boundaries, work inside each
stretch, and carry a small per-stretch summary across the cuts. *Positions* number all rows in a
global order through a range shuffle and per-partition offsets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kairoline.functions.scalars import HOUR_US, epoch_us
from kairoline.operators.grid import CHUNK_STEPS
from kairoline.session import settle

STRETCH, US, KEY = "_stretch", "_us", "_series"


def with_stretch(df: DataFrame, series: Sequence[str], ts: str, hours: float,
                 steps: int = CHUNK_STEPS) -> DataFrame:
    """Tag rows with their time (``_us``), time stretch and series, and co-locate each (series, stretch).

    The series is one struct, which is never null itself: rows with a null in their id are a series like any other.
    """
    timed = df.withColumn(US, epoch_us(ts))
    stretch = F.floor(F.col(US) / F.lit(int(hours * HOUR_US * steps))).cast("bigint")
    keyed = timed.withColumn(KEY, F.struct(*[F.col(f"`{c}`") for c in series])) if series else timed
    return keyed.withColumn(STRETCH, F.coalesce(stretch, F.lit(0))).repartition(*_key(series), STRETCH)


def _key(series: Sequence[str]) -> list[str]:
    return [KEY] if series else []


# A scan has two branches: the rows, and one summary row per stretch. Both start from the same
# shuffle. Spark runs it once if both ask for the same columns and the same rows, so summaries are
# taken from whole rows (``_row``), and neither the stretch nor the series is ever null.
# Callers should pass the columns they need and no more.


def _row(df: DataFrame) -> Column:
    return F.struct(*[F.col(f"`{c}`") for c in df.columns])


def _before(key: Sequence[str], by: str):
    return Window.partitionBy(*key).orderBy(by).rowsBetween(Window.unboundedPreceding, -1)


def _after(key: Sequence[str], by: str):
    # In descending order: a frame that reaches to the end would be summed anew per row.
    return Window.partitionBy(*key).orderBy(F.desc(by)).rowsBetween(Window.unboundedPreceding, -1)


def _carry(summary: DataFrame, key: list[str], last: Sequence[str] = (), first: Sequence[str] = (),
           total: Sequence[str] = (), steps: int = CHUNK_STEPS) -> DataFrame:
    """Per stretch what the others of its series hand to it: the nearest ``last`` before it, the nearest ``first`` after it,
    the sum of ``total`` before it; under the same names.

    Stretches are themselves cut into stretches of ``steps``, so that not even the summaries of a series meet in one task;
    what meets there is one row per ``steps`` x ``steps`` readings.
    """
    group = "_stretches"
    cut = summary.withColumn(group, F.floor(F.col(STRETCH) / F.lit(steps)).cast("bigint")).repartition(*key, group)
    ends = cut.groupBy(*key, group).agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), F.col(STRETCH))).alias(c) for c in last],
        *[F.min_by(c, F.when(F.col(c).isNotNull(), F.col(STRETCH))).alias(c) for c in first],
        *[F.sum(c).alias(c) for c in total])
    back, ahead = _before(key, group), _after(key, group)
    far = ends.select(*key, group, *[F.last(c, True).over(back).alias(f"_far{c}") for c in last],
                      *[F.last(c, True).over(ahead).alias(f"_far{c}") for c in first],
                      *[F.coalesce(F.sum(c).over(back), F.lit(0.0)).alias(f"_far{c}") for c in total])
    inside = [*key, group]
    back, ahead = _before(inside, STRETCH), _after(inside, STRETCH)
    near = cut.select(*inside, STRETCH, *[F.last(c, True).over(back).alias(c) for c in last],
                      *[F.last(c, True).over(ahead).alias(c) for c in first],
                      *[F.coalesce(F.sum(c).over(back), F.lit(0.0)).alias(c) for c in total])
    joined = near.join(far, inside)
    return joined.select(*key, STRETCH, *[F.coalesce(c, f"_far{c}").alias(c) for c in (*last, *first)],
                         *[(F.col(c) + F.col(f"_far{c}")).alias(c) for c in total])


def neighbours_of(df: DataFrame, series: Sequence[str], ts: str, values: Sequence[str], hours: float = 3,
                  steps: int = CHUNK_STEPS) -> DataFrame:
    """For each of several columns its nearest readings at or before and at or after every row, from one scan.

    Column i of ``values`` gives the structs ``_prev{i}`` and ``_next{i}`` of time ``t`` (microseconds since 1970) and
    value ``v``, null where there is none; stretches without a reading are looked across. ``_us`` is the time of the row itself.
    """
    key = _key(series)
    tagged = with_stretch(df, series, ts, hours, steps)
    numbered = list(enumerate(values))
    has = {i: F.when(F.col(c).isNotNull(), F.col(US)) for i, c in numbered}
    summary = tagged.groupBy(*key, STRETCH).agg(*[f(_row(tagged), has[i]).alias(f"{name}{i}") for i, _ in numbered for f, name in (
        (F.max_by, "_end"), (F.min_by, "_start"))])
    carry = _carry(summary, key, [f"_end{i}" for i, _ in numbered], [f"_start{i}" for i, _ in numbered], steps=steps)
    inside = Window.partitionBy(*key, STRETCH)
    back = inside.orderBy(US).rowsBetween(Window.unboundedPreceding, 0)
    ahead = inside.orderBy(F.desc(US)).rowsBetween(Window.unboundedPreceding, 0)

    def near(i: int, c: str, window, side: str) -> Column:
        seen = F.when(F.col(c).isNotNull(), F.struct(F.col(US).alias("t"), F.col(c).alias("v")))
        far = F.col(f"{side}{i}")
        carried = F.when(far.isNotNull(), F.struct(far[US].alias("t"), far[c].alias("v")))
        return F.coalesce(F.last(seen, ignorenulls=True).over(window), carried)

    return tagged.join(carry, [*key, STRETCH]).select(
        *[F.col(f"`{c}`") for c in df.columns], US, *[near(i, c, back, "_end").alias(f"_prev{i}") for i, c in numbered],
        *[near(i, c, ahead, "_start").alias(f"_next{i}") for i, c in numbered])


def neighbours(df: DataFrame, series: Sequence[str], ts: str, value: str, hours: float = 3,
               steps: int = CHUNK_STEPS) -> DataFrame:
    """Add the nearest readings at or before (``prev_us, prev_v``) and at or after
    (``next_us, next_v``) every row, and the time of the row itself (``_us``)."""
    near = neighbours_of(df, series, ts, [value], hours, steps)
    return near.select(*[F.col(f"`{c}`") for c in df.columns], US, F.col("_prev0.t").alias("prev_us"), F.col("_prev0.v").alias("prev_v"),
                       F.col("_next0.t").alias("next_us"), F.col("_next0.v").alias("next_v"))


def previous(df: DataFrame, series: Sequence[str], ts: str, value: str, out: str = "prev_v",
             hours: float = 3, steps: int = CHUNK_STEPS) -> DataFrame:
    """Value of the preceding row of the series (``lag``), also across stretch cuts."""
    key = _key(series)
    tagged = with_stretch(df, series, ts, hours, steps)
    carry = _carry(tagged.groupBy(*key, STRETCH).agg(F.max_by(_row(tagged), US).alias("_end")), key, ["_end"], steps=steps)
    inside = Window.partitionBy(*key, STRETCH).orderBy(US)
    lagged = F.when(F.row_number().over(inside) == 1, F.col(f"_end.{value}")).otherwise(F.lag(value).over(inside))
    return tagged.join(carry, [*key, STRETCH]).select(*[F.col(f"`{c}`") for c in df.columns], lagged.alias(out))


def running_sum(df: DataFrame, series: Sequence[str], ts: str, value: str, out: str = "total",
                hours: float = 3, steps: int = CHUNK_STEPS) -> DataFrame:
    """Cumulative sum in time order; nulls count as zero."""
    key = _key(series)
    tagged = with_stretch(df, series, ts, hours, steps)
    summary = tagged.groupBy(*key, STRETCH).agg(
        F.when(F.max_by(_row(tagged), US).isNotNull(), F.sum(value)).alias("_sum"))
    carry = _carry(summary, key, total=["_sum"], steps=steps)
    inside = Window.partitionBy(*key, STRETCH).orderBy(US).rowsBetween(Window.unboundedPreceding, 0)
    return tagged.join(carry, [*key, STRETCH]).select(
        *[F.col(f"`{c}`") for c in df.columns],
        (F.col("_sum") + F.coalesce(F.sum(value).over(inside), F.lit(0.0))).alias(out))


def positions(df: DataFrame, order: Sequence[str | Column], out: str = "pos") -> DataFrame:
    """Number rows 0..n-1 in the given order, with no single-partition window.

    One range shuffle sorts the rows; the sorted rows are settled on reliable storage so the
    numbers cannot move when a task is rerun. ``order`` should identify a row: it fixes the order
    of ties and lets the range shuffle split a hot key.
    """
    low_bits = (1 << 33) - 1
    order = [F.col(c) if isinstance(c, str) else c for c in order]
    sorted_rows = settle(
        df.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("_slot", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_slot", 33))
    )
    counts = sorted_rows.groupBy("_part").agg(F.count("*").alias("_n"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset")
    )  # one row per partition of the range shuffle
    return sorted_rows.join(F.broadcast(offsets), "_part").select(
        *df.columns, (F.col("_offset") + F.col("_slot").bitwiseAND(F.lit(low_bits))).alias(out)
    )
