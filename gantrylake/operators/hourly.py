"""Trips per hour, gantry and vehicle type."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gantrylake.functions.calendar import month_key, week_of_month
from gantrylake.functions.text import blank_to_null
from gantrylake.operators.clean import add_calendar, coerce_trips, keep_condition, target_gantry, touches
from gantrylake.schemas import HOURLY_CSV_COLUMNS, HOURLY_KEYS, LAKE_COLUMNS, PARTITION_KEY


def count_hourly(cleaned: DataFrame, keys: Sequence[str] = HOURLY_KEYS) -> DataFrame:
    """One row per key with its number of trips.

    The map side counts first, so a gantry that holds a third of all trips sends one row per
    hour and type out of each task.
    """
    return count_keyed(cleaned.withColumn("GantryID_O", F.col("TargetGantry")), keys)


def count_keyed(trips: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Count per key; rows with a NULL key belong to no group.

    They are left out by what was counted, not by a filter on the keys: that filter would move
    below the aggregate and parse every time field again for each key derived from it.
    """
    counted = F.call_function("count", *[F.col(k) for k in keys])
    return trips.groupBy(*keys).agg(counted.alias("counts")).where("counts > 0")


def merge_hourly(parts: DataFrame, *more: DataFrame, keys: Sequence[str] = HOURLY_KEYS) -> DataFrame:
    """Add up partial counts. Order and split of the parts do not matter."""
    for part in more:
        parts = parts.unionByName(part)
    whole = F.call_function("count", *[F.col(k) for k in keys])
    merged = parts.groupBy(*keys).agg(F.sum("counts").alias("counts"), whole.alias("whole"))
    return merged.where("whole > 0").drop("whole")


def add_week_index(hourly: DataFrame) -> DataFrame:
    return hourly.withColumn("WeekIndex", week_of_month(F.col("Day")))


def in_canonical_order(hourly: DataFrame) -> DataFrame:
    """Ascending by time, gantry and vehicle type; year and month lead so that months stay apart."""
    names = {c.lower(): c for c in hourly.columns}
    keys = ["year", "month", "day", "hour_0", "gantry_id_o", "gantryid_o", "vehicle_type", "vehicletype"]
    return hourly.orderBy(*[names[k] for k in keys if k in names])


def to_lake_rows(hourly: DataFrame) -> DataFrame:
    """The nine lake columns in order with their narrow types, plus the partition key."""
    renamed = hourly.withColumnsRenamed(dict(zip(HOURLY_CSV_COLUMNS, LAKE_COLUMNS)))
    typed = [
        F.col(c).cast("string" if c == "gantry_id_o" else "int").alias(c) for c in LAKE_COLUMNS
    ]
    return renamed.select(*typed, month_key(F.col("year"), F.col("month")).alias(PARTITION_KEY))


def to_text_layout(lake_rows: DataFrame) -> DataFrame:
    """Lake columns back under the names of the CSV form."""
    return lake_rows.withColumnsRenamed(dict(zip(LAKE_COLUMNS, HOURLY_CSV_COLUMNS))).select(*HOURLY_CSV_COLUMNS)


def keyed_trips(
    raw: DataFrame,
    gantries: Sequence[str],
    year: int | None = None,
    month: int | None = None,
    day_start: int = 1,
    day_end: int = 31,
) -> DataFrame:
    """Raw rows with the verdict of the cleaning and, where it keeps a row, the hourly key."""
    kept = keep_condition(gantries, year, month, day_start, day_end)
    trips = add_calendar(coerce_trips(raw).withColumn("kept", kept)).withColumn(
        "GantryID_O", target_gantry(gantries)
    )
    return trips.withColumns({c: F.when(F.col("kept"), F.col(c)) for c in HOURLY_KEYS})


def hourly_counts(
    raw: DataFrame,
    gantries: Sequence[str],
    year: int | None = None,
    month: int | None = None,
    day_start: int = 1,
    day_end: int = 31,
) -> DataFrame:
    """Raw trips to lake rows: one scan, one exchange of already counted rows.

    Rows touching no listed gantry leave by a filter on two trimmed ids; only the rest has its
    time and codes parsed, in a projection, where each is evaluated once.
    """
    near = raw.where(touches(gantries, blank_to_null))
    keyed = keyed_trips(near, gantries, year, month, day_start, day_end)
    return to_lake_rows(add_week_index(count_keyed(keyed, HOURLY_KEYS)))


def tally_trips(
    raw: DataFrame,
    gantries: Sequence[str],
    year: int | None = None,
    month: int | None = None,
    day_start: int = 1,
    day_end: int = 31,
    file_column: str = "file_name",
) -> DataFrame:
    """Everything one pass over the raw rows can tell: scanned and cleaned rows per file and key.

    Rows the cleaning drops share a NULL key. The hourly table, the run counters and the retained
    share all follow from this small table, so the raw files are read once. Where the rows come with
    a ``verdict`` per file, it stands with the file's NULL key. A maximum over text is not kept by hash: Spark would
    sort a task's raw rows for it. So the verdict is a key while rows are counted, and is folded in among counted rows.
    """
    keyed = keyed_trips(raw, gantries, year, month, day_start, day_end)
    counted = [F.count(F.lit(1)).alias("scanned"), F.count_if("kept").alias("cleaned")]
    if "verdict" not in raw.columns:
        return keyed.groupBy(file_column, *HOURLY_KEYS).agg(*counted)
    counted[0] = F.count_if(F.col("verdict").isNull()).alias("scanned")
    parts = keyed.groupBy(file_column, "verdict", *HOURLY_KEYS).agg(*counted)
    folded = [F.sum("scanned").alias("scanned"), F.sum("cleaned").alias("cleaned"), F.max("verdict").alias("verdict")]
    return parts.groupBy(file_column, *HOURLY_KEYS).agg(*folded)


def judged_tally(tally: DataFrame, sound: str, file_column: str = "file_name") -> tuple[DataFrame, DataFrame]:
    """(the tally of sound files, name and reason of the others) of a written tally with verdicts."""
    bad = tally.where(F.col("verdict") != sound).select(file_column, F.col("verdict").alias("reason"))
    return tally.drop("verdict").join(bad.select(file_column), file_column, "left_anti"), bad


def hourly_from_tally(tally: DataFrame) -> DataFrame:
    return merge_hourly(tally.withColumnRenamed("cleaned", "counts"))


def counters_from_tally(tally: DataFrame, file_column: str = "file_name") -> DataFrame:
    """One row: scanned and cleaned rows, hourly rows, files."""
    total = lambda column: F.coalesce(F.sum(column), F.lit(0))
    return tally.agg(
        total("scanned").alias("scanned_rows"),
        total("cleaned").alias("cleaned_rows"),
        F.countDistinct(*HOURLY_KEYS).alias("hourly_rows"),
        F.countDistinct(file_column).alias("file_count"),
    )
