"""Column functions on text."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: characters that count as white space ----------------------------------
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0 "
    "           "
    "    　"
)
FIELD_BLANKS = " \t\n\r\x0b\x0c"
WHITESPACE_CLASS = r"[\t-\r\x1c-\x20\x85\p{Z}]"
FENCE_PATTERN = r"```[\p{L}\p{N}_]*\n?"


def strip(field: Column) -> Column:
    """Remove blanks, tabs and line ends around a field (Spark's plain trim removes blanks only).

    The short ASCII set matters: the trimming loop searches it for every outer character.
    """
    return F.btrim(field, F.lit(FIELD_BLANKS))


def strip_prose(text: Column) -> Column:
    """Remove white space of any kind, the wide and typographic ones too, from both ends."""
    return F.btrim(text, F.lit(WHITESPACE))


def blank_to_null(field: Column) -> Column:
    return F.nullif(strip(field), F.lit(""))


def collapse_spaces(text: Column) -> Column:
    """Every run of white space becomes one blank."""
    return F.regexp_replace(text, WHITESPACE_CLASS + "+", " ")


def drop_trailing_number(text: Column) -> Column:
    """Remove a page number left at the end of a line."""
    return F.regexp_replace(text, WHITESPACE_CLASS + "*[0-9]+" + WHITESPACE_CLASS + "*$", "")


def tidy_label(text: Column) -> Column:
    """The form a name has after extraction: one-line, no page number, no outer blanks."""
    return strip_prose(drop_trailing_number(strip_prose(collapse_spaces(text))))


def drop_lead_in(text: Column, phrases: Sequence[str]) -> Column:
    """Remove the first listed phrase the text opens with, and the white space behind it."""
    opening = "|".join(re.escape(phrase) for phrase in phrases)
    return F.regexp_replace(strip_prose(text), f"^(?:{opening}){WHITESPACE_CLASS}*", "")


def drop_fences(text: Column) -> Column:
    """Remove code-fence markers, keep what they enclose."""
    return F.regexp_replace(text, FENCE_PATTERN, "")


def normalise(text: Column, phrases: Sequence[str]) -> Column:
    """Text without a stock opening phrase and without code-fence markers."""
    return drop_fences(drop_lead_in(F.coalesce(text, F.lit("")), phrases))
