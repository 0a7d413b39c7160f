"""Text to typed values; whatever does not parse becomes NULL and never fails the job.

ANSI mode is on by default, so a plain cast of a dirty field would raise. The patterns keep out
text the cast itself would take: a trailing ``d`` or ``f``, ``NaN``, ``Infinity``, a bare date.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gantrylake.functions.text import strip

# --- fixed values: accepted text forms ---------------------------------------------------
NUMBER_PATTERN = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
WHOLE_PATTERN = r"^([+-]?[0-9]+)(?:\.0+)?$"
CLOCK_PATTERN = r"^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}"


def to_number(text: Column) -> Column:
    """A decimal number, NULL where the text is anything else."""
    bare = strip(text)
    return F.when(bare.rlike(NUMBER_PATTERN), bare.try_cast("double"))


def to_whole_number(text: Column) -> Column:
    """An integer code; ``31`` and ``31.0`` are the same code, ``31.5`` is none.

    Nearly every value is plain digits, which the integer cast settles. What it refuses goes
    through a decimal, whose cast takes ``31.0`` and ``3.1e1`` but neither ``31d`` nor ``NaN``.
    """
    bare = strip(text)
    decimal = bare.try_cast("decimal(38,18)").cast("string")
    return F.coalesce(bare.try_cast("int"), F.regexp_extract(decimal, WHOLE_PATTERN, 1).try_cast("int"))


def to_wall_clock(text: Column) -> Column:
    """``YYYY-MM-DD HH:MM:SS`` as a zone-free timestamp; text behind the seconds is ignored."""
    bare = strip(text)
    return F.when(bare.rlike(CLOCK_PATTERN), F.substring(bare, 1, 19).try_cast("timestamp_ntz"))


def to_calendar_date(yyyymm: Column, day: Column) -> Column:
    """Date from a month key and a day number, NULL where the month has no such day."""
    digits = F.lpad(day.cast("string"), 2, "0")
    text = F.concat_ws("-", F.substring(yyyymm, 1, 4), F.substring(yyyymm, 5, 2), digits)
    return F.when(day.between(1, 31), text.try_cast("date"))
