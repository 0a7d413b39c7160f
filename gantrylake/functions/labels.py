"""Code to label lookups as literal maps: no join for a handful of fixed codes."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from gantrylake.functions.literals import literal_map
from gantrylake.schemas import VEHICLE_LABELS, WEEKDAY_LABELS


def label(code: Column, labels: Mapping[int | str, str], default: Column) -> Column:
    return F.coalesce(F.try_element_at(literal_map(labels), code), default)


def vehicle_label(code: Column) -> Column:
    """``VT=31(Sedan)``; an unknown code shows a question mark."""
    return F.concat(F.lit("VT="), code.cast("string"), F.lit("("), label(code, VEHICLE_LABELS, F.lit("?")), F.lit(")"))


def weekday_label(weekday: Column) -> Column:
    return label(weekday, WEEKDAY_LABELS, weekday.cast("string"))
