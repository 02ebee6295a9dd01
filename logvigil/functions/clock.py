"""Time parts taken from ``ts_us`` (microseconds since the epoch, UTC).

Integer arithmetic keeps them independent of the session time zone and inside codegen.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

US_PER_SECOND = 1_000_000
US_PER_MINUTE = 60 * US_PER_SECOND
US_PER_HOUR = 60 * US_PER_MINUTE
US_PER_DAY = 24 * US_PER_HOUR


def div(left: Column, right) -> Column:
    """Integer division of non-negative longs."""
    return F.call_function("div", left, right if isinstance(right, Column) else F.lit(right))


def second_of(ts_us: Column) -> Column:
    return div(ts_us, US_PER_SECOND)


def day_of(ts_us: Column) -> Column:
    return div(ts_us, US_PER_DAY)


def minute_of_day(ts_us: Column) -> Column:
    return div(ts_us % US_PER_DAY, US_PER_MINUTE)


def hour_of_day(ts_us: Column) -> Column:
    """Hour with the minute as fraction; seconds dropped."""
    minute = minute_of_day(ts_us)
    return div(minute, 60) + (minute % 60) / F.lit(60.0)


def exact_hour(ts_us: Column) -> Column:
    """Hour with minute and whole second as fraction."""
    second = div(ts_us % US_PER_DAY, US_PER_SECOND)
    return div(second, 3600) + (div(second, 60) % 60) / F.lit(60.0) + (second % 60) / F.lit(3600.0)


def hour_sin(ts_us: Column) -> Column:
    return F.sin(exact_hour(ts_us) * (2.0 * math.pi) / 24.0)


def hour_cos(ts_us: Column) -> Column:
    return F.cos(exact_hour(ts_us) * (2.0 * math.pi) / 24.0)


def day_of_week(ts_us: Column) -> Column:
    """Monday is 0 (the epoch fell on a Thursday)."""
    return (day_of(ts_us) + 3) % 7


def is_weekend(ts_us: Column) -> Column:
    return (day_of_week(ts_us) >= 5).cast("int")


def wall_clock(ts_us: Column) -> Column:
    """UTC wall clock as a zone-free timestamp."""
    return F.timestamp_add("MICROSECOND", ts_us, F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'"))


def iso_text(ts_us: Column) -> Column:
    """ISO-8601 text with microseconds and Z."""
    return F.date_format(wall_clock(ts_us), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def parse_iso(text: Column) -> Column:
    """ISO-8601 text (offset or Z; none means UTC) to ``ts_us``; unreadable text gives NULL."""
    zoned = F.when(text.rlike(r"(Z|[+-]\d{2}:?\d{2})$"), text).otherwise(F.concat(text, F.lit("Z")))
    return F.unix_micros(zoned.try_cast("timestamp"))
