"""Trip paths, origin-destination pairs and the holiday calendar.

A path is ``gantry;time`` stops joined by ``|``. It lies in one row, so order and neighbours need no
shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gantrylake.functions.calendar import clock_text
from gantrylake.functions.coercion import to_wall_clock
from gantrylake.operators.clean import TRIP_TIME, count_sound


def strict_crossing(trips: DataFrame, entry: str, exit: str, path: str = "TripInformation") -> DataFrame:
    """Trips whose path passes the entry gantry and later the exit gantry.

    A stop opens with its gantry between ``|`` and ``;``, so two text searches decide.
    """
    stops = F.concat(F.lit("|"), F.replace(F.col(path), F.lit(" "), F.lit("")))
    first_entry = F.instr(stops, f"|{entry};")
    later_exit = F.call_function("locate", F.lit(f"|{exit};"), stops, first_entry + 1)
    return trips.where((first_entry > 0) & (later_exit > 0))


def path_segments(trips: DataFrame, keys: list[str], path: str = "TripInformation") -> DataFrame:
    """One row per pair of neighbouring stops with the seconds between them.

    The stop list is zipped with itself one place on; parsing happens after the pairs are rows, in
    generated code, not inside an array function.
    """
    stops = F.filter(F.split(path, r"\|"), lambda p: p != "")
    pairs = F.greatest(F.size("stops") - 1, F.lit(0))
    zipped = F.arrays_zip(F.slice("stops", F.lit(1), pairs).alias("a"), F.slice("stops", F.lit(2), pairs).alias("b"))
    legs = trips.select(*keys, stops.alias("stops")).where(F.size("stops") > 1).select(
        *keys, F.posexplode(zipped).alias("segment", "leg")
    )
    gantry = lambda stop: F.trim(F.substring_index(stop, ";", 1))
    passed = lambda stop: to_wall_clock(F.substring_index(stop, ";", -1))
    before, after = F.col("leg")["a"], F.col("leg")["b"]
    return legs.select(
        *keys,
        "segment",
        gantry(before).alias("from_gantry"),
        gantry(after).alias("to_gantry"),
        F.timestamp_diff("SECOND", passed(before), passed(after)).alias("seconds"),
    )


def segment_averages(segments: DataFrame) -> DataFrame:
    return segments.groupBy("from_gantry", "to_gantry").agg(
        F.count("seconds").alias("passes"), F.sum("seconds").alias("seconds")
    )


def od_pairs(trips: DataFrame, width: str = "5 minutes") -> DataFrame:
    """Sound trips per origin, destination and vehicle type in tumbling windows, from coerced rows."""
    slot = F.window(TRIP_TIME, width)
    counted = trips.groupBy(slot.alias("slot"), "GantryID_O", "GantryID_D", "VehicleType").agg(
        count_sound().alias("trips")
    ).where("trips > 0")
    return counted.select(
        clock_text(F.col("slot.start")).alias("slot_start"), "GantryID_O", "GantryID_D", "VehicleType", "trips"
    )


def holiday_flag(daily: DataFrame, holidays: DataFrame, date: str = "date") -> DataFrame:
    """Day rows with the holiday's name, empty on working days. The calendar has a row per holiday: it is broadcast."""
    marked = daily.join(F.broadcast(holidays.select(date, "holiday")), date, "left")
    return marked.withColumns(
        {"is_holiday": F.col("holiday").isNotNull(), "holiday": F.coalesce("holiday", F.lit(""))}
    )
