"""Calendar parts and keys. Time is wall clock: nothing here depends on the session zone."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def iso_weekday(ts: Column) -> Column:
    """Monday 1 to Sunday 7."""
    return F.weekday(ts) + F.lit(1)


def week_of_month(day: Column) -> Column:
    """Days 1-7 are week 1, 8-14 week 2, and so on: not the ISO week."""
    return F.call_function("div", day - F.lit(1), F.lit(7)).cast("int") + F.lit(1)


def month_key(year: Column, month: Column) -> Column:
    """``yyyymm`` from two numbers."""
    return F.concat(year.cast("string"), F.lpad(month.cast("string"), 2, "0"))


def month_key_of(ts: Column) -> Column:
    return month_key(F.year(ts), F.month(ts))


def clock_text(ts: Column) -> Column:
    """``YYYY-MM-DD HH:MM:SS`` of a zone-free timestamp."""
    return F.substring(ts.cast("string"), 1, 19)


def day_window(year: int, month: int, day_start: int = 1, day_end: int = 31) -> tuple[dt.datetime, dt.datetime]:
    """Half-open bounds of days ``day_start`` to ``day_end`` of one month, clipped to the month."""
    first = dt.datetime(year, month, 1)
    following = dt.datetime(year + month // 12, month % 12 + 1, 1)
    lower = first + dt.timedelta(days=max(day_start, 1) - 1)
    upper = first + dt.timedelta(days=max(day_end, 0))
    return min(lower, following), min(upper, following)


def in_day_window(ts: Column, year: int, month: int, day_start: int = 1, day_end: int = 31) -> Column:
    """One range test, which a typed source pushes into its scan.

    ``between`` evaluates its argument once; two comparisons would parse a text time twice.
    """
    lower, upper = day_window(year, month, day_start, day_end)
    last = upper - dt.timedelta(microseconds=1)
    bounds = [F.lit(at.isoformat(sep=" ", timespec="microseconds")).cast("timestamp_ntz") for at in (lower, last)]
    return F.call_function("between", ts, *bounds)


def hour_bit(hour: Column) -> Column:
    """Bit ``hour`` of an integer: a day's hours fit into one 24-bit mask."""
    return F.call_function("shiftleft", F.lit(1), hour)


def wall_clock_instant(ts: Column) -> Column:
    """The instant at which clocks in UTC show this wall clock: watermarks need instants."""
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", _epoch(), ts))


def instant_wall_clock(at: Column) -> Column:
    """Inverse of :func:`wall_clock_instant`, whatever the session zone."""
    return _epoch() + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.unix_seconds(at).cast("decimal(18,6)"))


def _epoch() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
