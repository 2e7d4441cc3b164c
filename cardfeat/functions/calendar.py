"""Calendar, lag and holiday columns over dates and zone-free timestamps."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_MICROS = 86_400_000_000

DayLike = str | dt.date | Column


def _day(value: DayLike) -> Column:
    return F.to_date(value) if isinstance(value, Column) else F.lit(str(value)).cast("date")


def month_number(ts: Column) -> Column:
    """Months since year 0, the scale on which month lags are differences."""
    return F.year(ts) * 12 + F.month(ts)


def parse_month(text: Column) -> Column:
    """``yyyy-MM`` text as the first day of that month; bad or null text gives null."""
    return F.try_to_timestamp(text, F.lit("yyyy-MM")).cast("date")


def parse_timestamp(text: Column, pattern: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """Text as a timestamp without zone; bad or null text gives null."""
    return F.try_to_timestamp(text, F.lit(pattern)).cast("timestamp_ntz")


def micros(ts: Column) -> Column:
    """Microseconds since 1970 (session zone UTC)."""
    return F.unix_micros(ts.cast("timestamp"))


def epoch_seconds(ts: Column) -> Column:
    return micros(ts) / F.lit(1e6)


def weekday(ts: Column) -> Column:
    """Monday is 0."""
    return F.weekday(ts)


def is_weekend(ts: Column) -> Column:
    return (F.weekday(ts) >= 5).cast("int")


def day_lag(base: DayLike, ts: Column) -> Column:
    """Calendar days from ``ts`` to the base day; negative for later purchases."""
    return F.date_diff(_day(base), F.to_date(ts))


def floor_months(days: Column) -> Column:
    """Whole 30-day months, rounded down also below zero."""
    return F.floor(days / F.lit(30))


def month_diff(base: DayLike, ts: Column, month_lag: Column) -> Column:
    return floor_months(day_lag(base, ts)) + month_lag


def approximate_days(month_lag: Column) -> Column:
    """A month lag as days, counted backwards (-13 gives 390)."""
    return month_lag.cast("int") * -30


def shifted_month(ts: Column, month_lag: Column) -> Column:
    """Month of the purchase plus its lag."""
    return F.month(ts) + month_lag


def whole_days(later: Column, earlier: Column) -> Column:
    """Whole days between two timestamps, rounded down also below zero."""
    return F.floor((micros(later) - micros(earlier)) / F.lit(DAY_MICROS))


def holiday_distance(holiday: str | dt.date, ts: Column, period: int = 100) -> Column:
    """Whole days until the holiday, held between 0 and ``period``; null stays null."""
    days = whole_days(_day(holiday), ts)
    return F.when(ts.isNotNull(), F.greatest(F.least(days, F.lit(period)), F.lit(0)))
