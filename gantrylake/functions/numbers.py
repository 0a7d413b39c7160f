"""Rounding that agrees with IEEE half-to-even on the scaled value."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_even(value: Column, places: int) -> Column:
    """Scale, round to the nearest integer (ties to even), scale back.

    Spark's ``round`` takes ties away from zero on the printed decimal; this form works on the
    binary value, as numeric array libraries do.
    """
    scale = float(10**places)
    return F.rint(value * F.lit(scale)) / F.lit(scale)


def ratio(part: Column, whole: Column) -> Column:
    """Double division that yields 0 for an empty whole."""
    share = part.cast("double") / F.nullif(whole, F.lit(0)).cast("double")
    return F.coalesce(share, F.lit(0.0))
