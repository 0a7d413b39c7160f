"""Fixed lists and maps as one SQL expression each, instead of one driver call per entry."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def literal(value: int | str) -> str:
    """A number or a quoted text."""
    if isinstance(value, int):
        return str(value)
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def name(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def literal_array(values: Iterable[int | str]) -> Column:
    return F.expr(f"array({', '.join(map(literal, values))})")


def literal_map(pairs: Mapping[int | str, int | str]) -> Column:
    return F.expr(f"map({', '.join(literal(part) for item in pairs.items() for part in item)})")
