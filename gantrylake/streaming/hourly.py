"""Hourly counting of files as they land.

The stream keeps no state. Each micro-batch is counted on its own and written as one partial
table; a list of folders, replaced in one step, says which partials count, and the hourly table is their sum.
A batch that is replayed after a failure takes its own entry's place, so counting is exact, and a file that arrives
late is merged like any other, without a watermark and however late it is. Partials are merged into one table from
time to time, so that their number stays small.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from gantrylake.functions.calendar import clock_text, instant_wall_clock, wall_clock_instant
from gantrylake.functions.text import blank_to_null
from gantrylake.operators.clean import TRIP_TIME, coerce_trips, count_sound, quarantine, touches
from gantrylake.operators.hourly import count_keyed, hourly_from_tally, judged_tally, keyed_trips, merge_hourly, tally_trips
from gantrylake.schemas import HOURLY_COLUMNS, HOURLY_KEYS
from gantrylake.sinks.heads import Heads, new_version
from gantrylake.session import fresh_path
from gantrylake.sinks.lake import drop_folder, materialise
from gantrylake.sources.trips import SOUND, read_checked

_KINDS = {"GantryID_O": T.StringType(), "counts": T.LongType()}
PARTIAL_SCHEMA = T.StructType([T.StructField(c, _KINDS.get(c, T.IntegerType())) for c in HOURLY_COLUMNS])


#: Partial tables that a root holds before a batch's writer merges them.
PARTIALS = 64


def covered(heads: dict[str, str], batch_id: int) -> str | None:
    """The entry that holds a batch: its own, or one of several merged batches."""
    for name in heads:
        first, _, last = name.partition("-")
        if int(first) <= batch_id <= int(last or first):
            return name
    return None


def write_partial(root: str, partials: int = PARTIALS) -> Callable[[DataFrame, int], None]:
    """Batch writer of keyed trips. What a batch wrote counts from its commit on, and counts once.

    A batch that is replayed takes the place of its first writing; one that has been merged with others
    since is left alone. Counted rows are few; adaptive execution gathers them into as many files as their size asks for.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        heads = Heads(spark, root)
        if (covered(heads.read() or {}, batch_id) or str(batch_id)) != str(batch_id):
            return
        folder = f"batch={batch_id}/{new_version()}"
        count_keyed(batch, HOURLY_KEYS).write.parquet(heads.path(folder))
        now = heads.commit(lambda held: held | {str(batch_id): folder} if covered(held, batch_id) in (None, str(batch_id)) else held)
        if len(now) > partials:
            compact_partials(spark, root, batch_id - 1)

    return write


def start_hourly_stream(
    raw_stream: DataFrame,
    root: str,
    checkpoint: str,
    gantries: Sequence[str],
    year: int | None = None,
    month: int | None = None,
) -> StreamingQuery:
    """Clean and count whatever has landed, then stop; the checkpoint remembers what was read.

    The source's ``files_per_trigger`` sets the size of a batch. A damaged file fails the stream, as it
    fails a batch run, and nothing of its batch is counted.
    """
    near = raw_stream.where(touches(gantries, blank_to_null))
    keyed = keyed_trips(near, gantries, year, month).select(*HOURLY_KEYS)
    return (
        keyed.writeStream.foreachBatch(write_partial(root))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def write_checked(
    root: str, gantries: Sequence[str], year: int | None = None, month: int | None = None, partials: int = PARTIALS
) -> Callable[[DataFrame, int], None]:
    """Batch writer of landed files (``file_name``): each is read once and counted if it is sound.

    A file that is not is read a second time; if that fails too, it is set aside under ``damaged``, by name,
    reason and attempts, and the stream goes on. A replayed batch writes the same names again.
    """

    def tallied(files: DataFrame, folder: str) -> tuple[DataFrame, DataFrame]:
        return judged_tally(materialise(tally_trips(read_checked(files), gantries, year, month), folder), SOUND)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        heads = Heads(spark, root)
        if (covered(heads.read() or {}, batch_id) or str(batch_id)) != str(batch_id):
            return
        scratch = fresh_path(spark, "landed")
        sound, bad = tallied(batch, f"{scratch}/first")
        mended, worse = tallied(bad, f"{scratch}/second")
        worse.select("file_name", "reason", F.lit(2).alias("attempts")).write.mode("overwrite").parquet(f"{root}/damaged/batch={batch_id}")
        folder = f"batch={batch_id}/{new_version()}"
        hourly_from_tally(sound.unionByName(mended)).select(*PARTIAL_SCHEMA.names).write.parquet(heads.path(folder))
        now = heads.commit(lambda held: held | {str(batch_id): folder} if covered(held, batch_id) in (None, str(batch_id)) else held)
        drop_folder(spark, scratch)
        if len(now) > partials:
            compact_partials(spark, root, batch_id - 1)

    return write


def start_checked_stream(
    files: DataFrame, root: str, checkpoint: str, gantries: Sequence[str], year: int | None = None, month: int | None = None
) -> StreamingQuery:
    """Count whatever files have landed (see ``sources.trips.file_stream``) and stop; damaged ones don't hold it up."""
    return (
        files.writeStream.foreachBatch(write_checked(root, gantries, year, month))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def set_aside(spark: SparkSession, root: str) -> DataFrame:
    """Files that a checked stream could not read: ``file_name``, ``reason``, ``attempts``, ``batch``."""
    schema = "file_name string, reason string, attempts int, batch long"
    return spark.read.schema(schema).parquet(f"{root}/damaged")


def read_partials(spark: SparkSession, root: str, names: Sequence[str] | None = None) -> DataFrame:
    """Rows of all committed partials, or of those of some entries."""
    heads = Heads(spark, root)
    held = heads.read() or {}
    folders = [heads.path(folder) for name, folder in held.items() if names is None or name in names]
    if not folders:
        return spark.createDataFrame([], PARTIAL_SCHEMA)
    return spark.read.schema(PARTIAL_SCHEMA).parquet(*folders)


def compact_partials(spark: SparkSession, root: str, through: int) -> None:
    """Merge the partials of all batches up to ``through`` into one.

    The merged table is written to a folder of its own; one commit puts it in the place of what it holds. Broken
    off anywhere, the partials count as before or as after. If an entry changes meanwhile, nothing is merged.
    """
    heads = Heads(spark, root)
    held = heads.read() or {}
    low = {name: folder for name, folder in held.items() if int(name.rpartition("-")[2]) <= through}
    if len(low) < 2:
        return
    first = min(int(name.partition("-")[0]) for name in low)
    last = max(int(name.rpartition("-")[2]) for name in low)
    name, folder = f"{first}-{last}", f"merged/{new_version()}"
    merge_hourly(read_partials(spark, root, list(low))).write.parquet(heads.path(folder))

    def merged(now: dict[str, str]) -> dict[str, str]:
        if any(now.get(one) != path for one, path in low.items()):
            return now
        return {one: path for one, path in now.items() if one not in low} | {name: folder}

    if heads.commit(merged).get(name) != folder:
        drop_folder(spark, heads.path(folder))


def streamed_hourly(spark: SparkSession, root: str) -> DataFrame:
    """The hourly table so far: partials added up."""
    return merge_hourly(read_partials(spark, root))


def start_quarantine_stream(raw_stream: DataFrame, root: str, checkpoint: str) -> StreamingQuery:
    """Rows the cleaning cannot use, set aside unchanged with the field at fault."""
    return (
        quarantine(raw_stream)
        .writeStream.format("parquet")
        .option("path", root)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def hourly_windows(raw: DataFrame, late_by: str | None = None) -> DataFrame:
    """Sound trips per tumbling hour of event time and vehicle type, batch or stream.

    With ``late_by`` a stream may emit and forget hours the watermark has passed; without it every
    hour stays open, which a batch always has.
    """
    trips = coerce_trips(raw)
    if late_by is not None:
        instant = wall_clock_instant(F.col(TRIP_TIME))
        trips = trips.withColumn(TRIP_TIME, instant).withWatermark(TRIP_TIME, late_by)
    counted = trips.groupBy(F.window(TRIP_TIME, "1 hour").alias("hour"), "VehicleType").agg(
        count_sound().alias("trips")
    ).where("trips > 0")
    shown = (lambda at: clock_text(instant_wall_clock(at))) if late_by is not None else clock_text
    return counted.select(
        shown(F.col("hour.start")).alias("window_start"),
        shown(F.col("hour.end")).alias("window_end"),
        F.col("VehicleType").alias("vehicle_type"),
        "trips",
    )
