"""Dense grids and pivots without joins.

A dense axis (24 hours, 7 weekdays, a list of codes) is a fixed set of conditional sums. One
aggregation yields every cell, empty ones included; a second grouping per pivot value, a calendar
table and a join against it are not needed.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gantrylake.functions.literals import literal, name
from gantrylake.schemas import HOURS, WEEKDAYS


def cell_sum(axis: str, value: int | str, measure: str = "counts") -> str:
    """SQL: sum of the measure where the axis has this value, NULL where no row does."""
    return f"sum(CASE WHEN {name(axis)} = {literal(value)} THEN {name(measure)} END)"


def cells(rows: Iterable[Mapping[str, str]]) -> Column:
    """An array with one struct per row of the grid, each field a SQL expression."""
    structs = ["struct(" + ", ".join(f"{sql} AS {name(n)}" for n, sql in row.items()) + ")" for row in rows]
    return F.expr(f"array({', '.join(structs)})").alias("cells")


def pivot_sums(
    table: DataFrame,
    keys: Sequence[str],
    axis: str,
    values: Iterable[int | str],
    names: Sequence[str],
    measure: str = "counts",
) -> DataFrame:
    """One column per listed value, in the listed order, 0 where nothing was counted."""
    sums = [F.expr(f"coalesce({cell_sum(axis, v, measure)}, 0) AS {name(n)}") for v, n in zip(values, names)]
    return table.groupBy(*keys).agg(*sums)


def dense_axis(
    table: DataFrame,
    keys: Sequence[str],
    axis: str,
    values: Iterable[int],
    measure: str = "counts",
    result: str = "counts",
) -> DataFrame:
    """One row per key and axis value; values that never occur count 0."""
    grid = cells({axis: literal(v), result: f"coalesce({cell_sum(axis, v, measure)}, 0)"} for v in values)
    return table.groupBy(*keys).agg(grid).select(*keys, F.inline("cells"))


def dense_pivot(
    table: DataFrame,
    keys: Sequence[str],
    rows: str,
    row_values: Iterable[int],
    columns: str,
    column_values: Sequence[int | str],
    names: Sequence[str],
    measure: str = "counts",
) -> DataFrame:
    """Pivot with every listed row and column present, 0 in empty cells."""

    def cell(row: int, column: int | str) -> str:
        hit = f"{name(rows)} = {literal(row)} AND {name(columns)} = {literal(column)}"
        return f"coalesce(sum(CASE WHEN {hit} THEN {name(measure)} END), 0)"

    grid = cells({rows: literal(r), **{n: cell(r, c) for c, n in zip(column_values, names)}} for r in row_values)
    return table.groupBy(*keys).agg(grid).select(*keys, F.inline("cells"))


def hour_grid(hourly: DataFrame, keys: Sequence[str] = ("gantry_id_o", "year", "month", "day")) -> DataFrame:
    """24 hours for every gantry and day that has data."""
    return dense_axis(hourly, list(keys), "hour_0", HOURS)


def hour_day_pivot(hourly: DataFrame) -> DataFrame:
    """Hours down, days of the month across, per gantry and month."""
    return pivot_sums(
        hour_grid(hourly),
        ["gantry_id_o", "year", "month", "hour_0"],
        "day",
        range(1, 32),
        [f"day_{d:02d}" for d in range(1, 32)],
    )


def weekday_vehicle_totals(hourly: DataFrame, codes: Sequence[int]) -> DataFrame:
    """Weekdays down, vehicle types across, total counts, per gantry."""
    return dense_pivot(
        hourly, ["gantry_id_o"], "weekday", WEEKDAYS, "vehicle_type", codes, [f"vt_{c}" for c in codes]
    )


def month_gantry_pivot(hourly: DataFrame, gantries: Sequence[str]) -> DataFrame:
    return pivot_sums(hourly, ["yyyymm"], "gantry_id_o", gantries, [f"g_{g}" for g in gantries])


def month_vehicle_pivot(hourly: DataFrame, codes: Sequence[int]) -> DataFrame:
    return pivot_sums(hourly, ["yyyymm"], "vehicle_type", codes, [f"vt_{c}" for c in codes])
