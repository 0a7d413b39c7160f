"""Five-minute station flow to hourly flow, and the four reconciliation reports on it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gantrylake.schemas import PARTITION_KEY


def hourly_flow(flow: DataFrame, stations: Sequence[str]) -> DataFrame:
    """Vehicles and five-minute slots per hour, station, direction, type and month.

    The station filter reaches the scan. Keys are typed before grouping: a date and an integer
    hash faster than two substrings.
    """
    slots = flow.where(F.col("gantry_id").isin(list(stations))).select(
        F.substring("time_interval", 1, 10).cast("date").alias("dt"),
        F.substring("time_interval", 12, 2).cast("int").alias("hour"),
        "gantry_id",
        "direction",
        "vehicle_type",
        "flow",
        PARTITION_KEY,
    )
    return slots.groupBy("dt", "hour", "gantry_id", "direction", "vehicle_type", PARTITION_KEY).agg(
        F.sum("flow").alias("hourly_flow"),
        F.count(F.lit(1)).alias("slot_count"),
    )


def month_totals(hourly: DataFrame) -> DataFrame:
    """Rows, stations, days and vehicles per month.

    Grouping by month, station and day first leaves the two distinct counts a table of one row
    per station and day, however many hours and types a month has.
    """
    daily = hourly.groupBy(PARTITION_KEY, "gantry_id", "dt").agg(
        F.count(F.lit(1)).alias("n"), F.sum("hourly_flow").alias("flow")
    )
    return daily.groupBy(PARTITION_KEY).agg(
        F.sum("n").alias("rows"),
        F.countDistinct("gantry_id").alias("gantries"),
        F.countDistinct("dt").alias("days"),
        F.sum("flow").alias("total_flow"),
    )


def station_completeness(hourly: DataFrame, yyyymm: str) -> DataFrame:
    """Days, rows, vehicles and slot range per station and direction within one month."""
    daily = (
        hourly.where(F.col(PARTITION_KEY) == yyyymm)
        .groupBy("gantry_id", "direction", "dt")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("hourly_flow").alias("flow"),
            F.min("slot_count").alias("low"),
            F.max("slot_count").alias("high"),
        )
    )
    return daily.groupBy("gantry_id", "direction").agg(
        F.count("dt").alias("days"),
        F.sum("n").alias("hourly_rows"),
        F.sum("flow").alias("total_flow"),
        F.min("low").alias("min_slots"),
        F.max("high").alias("max_slots"),
    )


def slot_distribution(hourly: DataFrame) -> DataFrame:
    """How many hourly rows have how many slots."""
    return hourly.groupBy("slot_count").agg(F.count(F.lit(1)).alias("n"))


def period_totals(hourly: DataFrame, first_month: str, last_month: str) -> DataFrame:
    """Vehicles per station over a range of months; the range is a partition filter on a table."""
    period = hourly.where(F.col(PARTITION_KEY).between(first_month, last_month))
    return period.groupBy("gantry_id").agg(F.sum("hourly_flow").alias("total_flow"))
