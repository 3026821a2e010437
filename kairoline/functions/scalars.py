"""Scalar column expressions: parsing, cleaning, clamping and rule classes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"
HOUR_US = 3_600_000_000


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def rounded(c: Column | str, places: int = 6) -> Column:
    """Round for comparison; adding zero keeps a negative zero from showing."""
    return F.round(as_col(c), places) + F.lit(0.0)


def nan_to_null(c: Column | str) -> Column:
    c = as_col(c)
    return F.when(~F.isnan(c), c)


def strip_prefix(c: Column | str, prefix: str) -> Column:
    """``level_8`` -> 8.0; text that is not a number (or is NaN) becomes null."""
    return nan_to_null(F.replace(as_col(c), F.lit(prefix), F.lit("")).try_cast("double"))


def strip_prefix_int(c: Column | str, prefix: str) -> Column:
    return F.replace(as_col(c), F.lit(prefix), F.lit("")).try_cast("int")


def parse_time(c: Column | str) -> Column:
    """Zone-free timestamp; malformed text becomes null instead of failing the job."""
    return as_col(c).try_cast("timestamp_ntz")


def epoch_us(ts: Column | str) -> Column:
    """Microseconds since 1970 of a zone-free timestamp, whatever the session zone.

    Built from calendar fields: time differences would first cast to a zoned timestamp.
    """
    ts = as_col(ts)
    minutes = (F.unix_date(ts.cast("date")).cast("bigint") * 24 + F.hour(ts)) * 60 + F.minute(ts)
    return minutes * F.lit(60_000_000) + (F.extract(F.lit("SECOND"), ts) * 1_000_000).cast("bigint")


def from_epoch_us(us: Column | str) -> Column:
    return F.timestamp_add("MICROSECOND", as_col(us), F.expr(EPOCH))


def clamp(c: Column | str, lo: float | None = None, hi: float | None = None) -> Column:
    """Limit to ``[lo, hi]``; null stays null (``least``/``greatest`` alone would skip it)."""
    c = as_col(c)
    out = c
    if hi is not None:
        out = F.least(out, F.lit(float(hi)))
    if lo is not None:
        out = F.greatest(out, F.lit(float(lo)))
    return F.when(c.isNotNull(), out)


# Weather condition codes and their thresholds.
RAIN_CODE, OVERCAST_CODE, BROKEN_CODE, SCATTERED_CODE, CLEAR_CODE = 500, 804, 803, 802, 800
RAIN_ABOVE, OVERCAST_ABOVE, BROKEN_ABOVE, SCATTERED_ABOVE = 0.5, 80.0, 50.0, 20.0


def weather_code(rain: Column | str, clouds: Column | str) -> Column:
    """Condition code from rain and cloud cover; rain wins, then the thickest cloud class."""
    rain, clouds = as_col(rain), as_col(clouds)
    return (
        F.when(rain > RAIN_ABOVE, RAIN_CODE)
        .when(clouds > OVERCAST_ABOVE, OVERCAST_CODE)
        .when(clouds > BROKEN_ABOVE, BROKEN_CODE)
        .when(clouds > SCATTERED_ABOVE, SCATTERED_CODE)
        .otherwise(CLEAR_CODE)
    )


def elapsed_hours(ts: Column | str, origin: str = "2018-01-01 00:00:00", base: int = 8760) -> Column:
    """Whole hours since ``origin`` (floored, also before it) plus ``base``."""
    us = epoch_us(ts) - epoch_us(F.expr(f"TIMESTAMP_NTZ'{origin}'"))
    return F.floor(us / F.lit(HOUR_US)).cast("bigint") + F.lit(base)
