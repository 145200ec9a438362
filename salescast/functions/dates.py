"""Date/time column builders.

All timestamps in the test data are TIMESTAMP_NTZ; ``timestampdiff`` works on
NTZ while ``unix_micros`` does not, hence the MICROSECOND differences below.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_DAY = 86_400_000_000
MICROS_PER_HOUR = 3_600_000_000


def micros_between(start: Column | str, end: Column | str) -> Column:
    """end - start in microseconds (works on NTZ and LTZ)."""
    s = F.col(start) if isinstance(start, str) else start
    e = F.col(end) if isinstance(end, str) else end
    return F.timestamp_diff("MICROSECOND", s, e)


def floor_days(start: Column | str, end: Column | str) -> Column:
    """X17 / trap T1: whole days of (end - start), *floored* like a timedelta's days.

    A sale at 14:00 on the event day against a midnight start gives -1.
    """
    return F.floor(micros_between(start, end) / F.lit(MICROS_PER_DAY))


def fractional_days(start: Column | str, end: Column | str) -> Column:
    """Fractional days between two timestamps."""
    return micros_between(start, end) / F.lit(float(MICROS_PER_DAY))


def fractional_hours(start: Column | str, end: Column | str) -> Column:
    """Fractional hours between two timestamps."""
    return micros_between(start, end) / F.lit(float(MICROS_PER_HOUR))


def parse_ts(c: Column, fmt: str | None = None) -> Column:
    """Parse-or-null (never raises under ANSI)."""
    if fmt:
        return F.try_to_timestamp(c, F.lit(fmt))
    return F.try_to_timestamp(c)


def to_midnight(c: Column) -> Column:
    """X11: normalise a timestamp to midnight (keeps the timestamp type)."""
    return F.date_trunc("day", c)


def weekday_mon0(c: Column) -> Column:
    """X13 / trap T6: day of week with Monday = 0."""
    return F.weekday(c)


def season(c: Column) -> Column:
    """Meteorological season index month % 12 // 3 + 1."""
    return F.floor((F.month(c) % 12) / 3).cast("int") + 1


def calendar_exprs(c: Column) -> dict[str, Column]:
    """X13 + X14 + X15: dow (Mon=0), month, year with -1 for missing dates,
    weekend flag and the sin/cos encodings, keyed by output name."""
    dow = F.coalesce(weekday_mon0(c), F.lit(-1))
    month = F.coalesce(F.month(c), F.lit(-1))
    year = F.coalesce(F.year(c), F.lit(-1))
    two_pi = 2 * math.pi
    return {
        "day_of_week": dow,
        "event_month": month,
        "event_year": year,
        "is_weekend": F.when(dow.isin(5, 6), 1).otherwise(0),
        "month_sin": F.sin(F.lit(two_pi) * month / 12),
        "month_cos": F.cos(F.lit(two_pi) * month / 12),
        "day_of_week_sin": F.sin(F.lit(two_pi) * dow / 7),
        "day_of_week_cos": F.cos(F.lit(two_pi) * dow / 7),
    }


def add_hours(c: Column, hours: Column) -> Column:
    return F.timestamp_add("HOUR", hours, c)


def add_days(c: Column, days: Column | int) -> Column:
    d = F.lit(days) if isinstance(days, int) else days
    return F.timestamp_add("DAY", d, c)


def event_duration_hours(start: Column | str, end: Column | str, mode: str = "batch") -> Column:
    """Event duration in hours.  batch: null outside [0, 720] (filled by the
    caller with the median over events, else 4); live: clipped to [1, 720],
    4 when missing."""
    h = fractional_hours(start, end)
    if mode == "live":
        return F.coalesce(F.least(F.greatest(h, F.lit(1.0)), F.lit(720.0)), F.lit(4.0))
    return F.when((h < 0) | (h > 720), F.lit(None)).otherwise(h)
