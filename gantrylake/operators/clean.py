"""Raw trip rows to typed trips that touch a chosen set of gantries."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gantrylake.functions.calendar import in_day_window, iso_weekday
from gantrylake.functions.coercion import to_number, to_wall_clock, to_whole_number
from gantrylake.functions.text import blank_to_null
from gantrylake.schemas import RAW_TRIP_COLUMNS

TRIP_TIME = "trip_time"
#: Ids of a list that is broadcast, a few hundred kB, and parts that a longer list's trips are dealt over.
LIST_ROWS, SALTS = 20_000, 32


def coerce_trips(raw: DataFrame) -> DataFrame:
    """Typed fields under their own names; a field that does not parse is NULL."""
    return raw.withColumns(
        {
            "VehicleType": to_whole_number(F.col("VehicleType")),
            "TripLength": to_number(F.col("TripLength")),
            TRIP_TIME: to_wall_clock(F.col("DetectionTime_O")),
            "GantryID_O": blank_to_null(F.col("GantryID_O")),
            "GantryID_D": blank_to_null(F.col("GantryID_D")),
        }
    )


def reject_reason() -> Column:
    """Which required field of a coerced row is missing, NULL for a sound row."""
    return (
        F.when(F.col(TRIP_TIME).isNull(), "detection_time")
        .when(F.col("GantryID_O").isNull(), "gantry_id")
        .when(F.col("VehicleType").isNull(), "vehicle_type")
    )


def count_sound() -> Column:
    """Aggregate: rows whose required fields are all there.

    Counting only those, and dropping groups of none, spares a filter that would parse twice.
    """
    return F.call_function("count", F.col(TRIP_TIME), F.col("GantryID_O"), F.col("VehicleType"))


def in_list(gantry: Column, gantries: Sequence[str]) -> Column:
    """Membership that is false, not NULL, for a missing id."""
    return F.coalesce(gantry.isin(list(gantries)), F.lit(False))


def touches(gantries: Sequence[str], of: Callable[[Column], Column] = lambda gantry: gantry) -> Column:
    """Origin or destination is listed; an empty list keeps everything.

    ``of`` prepares the id, for rows that are still raw.
    """
    if not gantries:
        return F.lit(True)
    return in_list(of(F.col("GantryID_O")), gantries) | in_list(of(F.col("GantryID_D")), gantries)


def target_gantry(gantries: Sequence[str]) -> Column:
    """The gantry a trip counts for, once: its origin if listed, else its destination."""
    if not gantries:
        return F.col("GantryID_D")
    return F.when(in_list(F.col("GantryID_O"), gantries), F.col("GantryID_O")).otherwise(F.col("GantryID_D"))


def keep_condition(
    gantries: Sequence[str],
    year: int | None = None,
    month: int | None = None,
    day_start: int = 1,
    day_end: int = 31,
) -> Column:
    """True for coerced rows the cleaning keeps, never NULL.

    Tests run in this order and stop at the first that fails: the id lists reject most rows at the
    price of a trim, so times and codes are parsed for few.
    """
    time = F.col(TRIP_TIME)
    bounded = year is not None and month is not None
    in_time = in_day_window(time, year, month, day_start, day_end) if bounded else time.isNotNull()
    kept = touches(gantries) & F.col("GantryID_O").isNotNull() & in_time & F.col("VehicleType").isNotNull()
    return F.coalesce(kept, F.lit(False))


def add_calendar(trips: DataFrame, time: str = TRIP_TIME) -> DataFrame:
    """Year, Month, Day, Hour_0 and ISO Weekday of a timestamp column."""
    ts = F.col(time)
    return trips.withColumns(
        {
            "Year": F.year(ts),
            "Month": F.month(ts),
            "Day": F.dayofmonth(ts),
            "Hour_0": F.hour(ts),
            "Weekday": iso_weekday(ts),
        }
    )


def clean_trips(
    raw: DataFrame,
    gantries: Sequence[str],
    year: int | None = None,
    month: int | None = None,
    day_start: int = 1,
    day_end: int = 31,
) -> DataFrame:
    """Coerce, drop unsound rows, keep the day window and the listed gantries, attribute each trip.

    A narrow transformation from end to end: no shuffle, and columns nobody asks for are pruned.
    """
    kept = coerce_trips(raw).where(keep_condition(gantries, year, month, day_start, day_end))
    return add_calendar(kept).withColumn("TargetGantry", target_gantry(gantries))


def quarantine(raw: DataFrame) -> DataFrame:
    """The raw rows that cleaning cannot use, unchanged, each with the field at fault."""
    reason = "reject_reason"
    marked = raw.withColumn("_raw", F.struct(*raw.columns))
    return (
        coerce_trips(marked)
        .withColumn(reason, reject_reason())
        .where(F.col(reason).isNotNull())
        .select("_raw.*", reason)
    )


def clean_trips_by_table(raw: DataFrame, gantry_table: DataFrame, gantry: str = "gantry_id") -> DataFrame:
    """As :func:`clean_trips` for a gantry list that arrives as a table, one left join per endpoint.

    The list is counted first. Up to ``LIST_ROWS`` ids it is broadcast, and no raw row is shuffled. A longer one
    is joined by id and salt: the trips of a hot gantry are dealt over ``SALTS`` parts, and the list is
    repeated once per part.
    """
    listed = gantry_table.select(F.col(gantry).alias("listed")).dropna().distinct()
    trips = coerce_trips(raw).where(reject_reason().isNull())
    if listed.limit(LIST_ROWS + 1).count() <= LIST_ROWS:
        small = F.broadcast(listed)
        marked = trips.join(small.withColumnRenamed("listed", "hit_o"), F.col("GantryID_O") == F.col("hit_o"), "left")
        marked = marked.join(small.withColumnRenamed("listed", "hit_d"), F.col("GantryID_D") == F.col("hit_d"), "left")
    else:
        salt = F.pmod(F.xxhash64(*RAW_TRIP_COLUMNS[3:], TRIP_TIME), F.lit(SALTS))
        parts = listed.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)).cast("array<bigint>")))
        marked = trips.withColumn("salt", salt)
        for end, hit in (("GantryID_O", "hit_o"), ("GantryID_D", "hit_d")):
            side = parts.select(F.col("listed").alias(hit), "part")
            marked = marked.join(side, (F.col(end) == F.col(hit)) & (F.col("salt") == F.col("part")), "left").drop("part")
        marked = marked.drop("salt")
    target = marked.withColumn("TargetGantry", F.coalesce("hit_o", "hit_d")).where(F.col("TargetGantry").isNotNull())
    return add_calendar(target.drop("hit_o", "hit_d"))
