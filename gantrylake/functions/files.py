"""File names that carry a date and an hour."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: hourly file names ``<PREFIX>_yyyymmdd_HH0000.csv`` ---------------------
FILE_STAMP_PATTERN = r"([0-9]{8})_([0-9]{2})0000\.csv"


def file_day(name: Column) -> Column:
    """``yyyymmdd`` from a file name, NULL where the name has none."""
    return F.nullif(F.regexp_extract(name, FILE_STAMP_PATTERN, 1), F.lit(""))


def file_hour(name: Column) -> Column:
    return F.regexp_extract(name, FILE_STAMP_PATTERN, 2).try_cast("int")


def hourly_file_name(prefix: str, day: Column, hour: Column) -> Column:
    """Inverse of :func:`file_day` and :func:`file_hour`."""
    return F.concat(F.lit(prefix + "_"), day, F.lit("_"), F.lpad(hour.cast("string"), 2, "0"), F.lit("0000.csv"))


def day_text_to_date(yyyymmdd: Column) -> Column:
    parts = F.concat_ws(
        "-", F.substring(yyyymmdd, 1, 4), F.substring(yyyymmdd, 5, 2), F.substring(yyyymmdd, 7, 2)
    )
    return parts.try_cast("date")
