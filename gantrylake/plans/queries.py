"""One named query per operator, each over whole driver tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gantrylake.functions.calendar import clock_text
from gantrylake.functions.files import file_day
from gantrylake.functions.text import normalise
from gantrylake.operators import clean, dims, flow, grids, hourly, paths, profile, quality
from gantrylake.plans import fixtures as fx
from gantrylake.plans.month import MonthRun, run_month
from gantrylake.schemas import HOURLY_CSV_COLUMNS, KNOWLEDGE_SCHEMA, RAW_TRIP_COLUMNS, VEHICLE_CODES
from gantrylake.session import fresh_path
from gantrylake.sinks.lake import create_table_as, materialise, month_folder, register_lake, replace_days, write_lake
from gantrylake.sinks.text import write_hourly_csv, write_layer_csv, write_layers
from gantrylake.sources.documents import json_number, read_dictionary
from gantrylake.sources.hourly import coerce_hourly, read_hourly_csv, read_lake, tag_month, union_months
from gantrylake.sources.inventory import read_inventory
from gantrylake.sources.trips import SOUND, checked_trip_months, damaged_files, file_stream, read_trip_months, read_trips, with_file_name
from gantrylake.streaming.hourly import compact_partials, hourly_windows, start_checked_stream, start_hourly_stream, streamed_hourly

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(function: Query) -> Query:
    REGISTRY[function.__name__] = function
    return function


# --- cleaning ------------------------------------------------------------------------------


@query
def hourly_counts(spark, sf):
    """Flagship: trips per hour, target gantry and vehicle type."""
    return fx.hourly(spark, sf).drop("yyyymm")


@query
def hourly_ordered(spark, sf):
    """The flagship in report order."""
    return hourly.in_canonical_order(fx.hourly(spark, sf).drop("yyyymm"))


@query
def raw_scan(spark, sf):
    """Trips written as gzip text under a month folder and read back, all text, blanks as NULL."""
    path = fresh_path(spark, "raw")
    month = F.substring(file_day(F.col("file_name")), 1, 6).alias("yyyymm")
    landed = fx.trips(spark, sf).select(*RAW_TRIP_COLUMNS, month)
    (
        landed.write.mode("overwrite")
        .option("compression", "gzip")
        .option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", "false")
        .option("ignoreTrailingWhiteSpace", "false")
        .partitionBy("yyyymm")
        .csv(path)
    )
    return read_trip_months(spark, path)


def _landed(spark, sf, **options):
    """All trips as packed text files below a fresh folder."""
    path = fresh_path(spark, "raw")
    writer = fx.trips(spark, sf).select(*RAW_TRIP_COLUMNS).write.option("compression", "gzip").option("emptyValue", "")
    writer.option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").csv(path)
    return path


@query
def nested_files(spark, sf):
    """Trips read back from packed files in nested folders, counted per vehicle code."""
    path = fresh_path(spark, "nested")
    trips = fx.trips(spark, sf).select(*RAW_TRIP_COLUMNS, F.substring("DetectionTime_D", 1, 7).alias("part"))
    trips.write.option("compression", "gzip").partitionBy("part").csv(path)
    return read_trips(spark, path).groupBy("VehicleType").agg(F.count(F.lit(1)).alias("rows"))


@query
def skipped_files(spark, sf):
    """Trips of sound files only: a second, damaged landing of the same trips is left out whole."""
    path = _landed(spark, sf)
    fx.damaged_copies(spark, path, f"{path}/damaged")
    bad = damaged_files(spark, path)
    tally = hourly.tally_trips(with_file_name(read_trips(spark, path, tolerant=True)), fx.TARGETS, fx.YEAR, fx.MONTH)
    sound = tally.join(F.broadcast(bad.select("file_name")), "file_name", "left_anti")
    return hourly.to_lake_rows(hourly.add_week_index(hourly.hourly_from_tally(sound))).drop("yyyymm")


@query
def month_folder_skips(spark, sf):
    """Month folders, a second and damaged landing in each: rows and verdicts come from one read of every file."""
    path = fresh_path(spark, "months")
    key = F.lit(f"{fx.YEAR:04d}{fx.MONTH:02d}").alias("yyyymm")
    landed = fx.trips(spark, sf).select(*RAW_TRIP_COLUMNS, key).write.option("compression", "gzip").option("emptyValue", "")
    landed.option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").partitionBy("yyyymm").csv(path)
    fx.cut_copies(spark, sf, f"{path}/yyyymm={fx.YEAR:04d}{fx.MONTH:02d}")
    tally = hourly.tally_trips(checked_trip_months(spark, path, [f"{fx.YEAR:04d}{fx.MONTH:02d}"]), fx.TARGETS, fx.YEAR, fx.MONTH)
    sound, _ = hourly.judged_tally(materialise(tally, fresh_path(spark, "tally")), SOUND)
    return hourly.to_lake_rows(hourly.add_week_index(hourly.hourly_from_tally(sound))).drop("yyyymm")


@query
def incremental_month(spark, sf):
    """A month run three times over four folders of files, one of which is written again in between."""
    path, home = fresh_path(spark, "raw"), fresh_path(spark, "incremental")
    trips = fx.trips(spark, sf)
    run = MonthRun("month", fx.YEAR, fx.MONTH, fx.TARGETS, path, f"{home}/lake", f"{home}/records", tally_path=f"{home}/tallies")

    def land(part, rows):
        writer = rows.select(*RAW_TRIP_COLUMNS).write.mode("overwrite").option("compression", "gzip").option("emptyValue", "")
        writer.option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").csv(f"{path}/{part}")

    for part in range(4):
        mine = trips.where(F.col("event_id") % 4 == part)
        land(part, mine.unionByName(mine) if part == 3 else mine)
    run_month(spark, run)
    land(3, trips.where(F.col("event_id") % 4 == 3))
    run_month(spark, run)
    run_month(spark, run)
    return read_lake(spark, f"{home}/lake").drop("yyyymm")


@query
def clean_trips(spark, sf):
    cleaned = clean.clean_trips(fx.trips(spark, sf), fx.TARGETS, fx.YEAR, fx.MONTH)
    return cleaned.select(
        "event_id", "VehicleType", "TripLength", "Year", "Month", "Day", "Hour_0", "Weekday",
        "GantryID_O", "GantryID_D", "TargetGantry",
    )


@query
def endpoint_filter(spark, sf):
    """Trips of any month that touch a listed gantry, by endpoint."""
    cleaned = clean.clean_trips(fx.trips(spark, sf), fx.TARGETS)
    hit_o = clean.in_list(F.col("GantryID_O"), fx.TARGETS)
    hit_d = clean.in_list(F.col("GantryID_D"), fx.TARGETS)
    return cleaned.groupBy(hit_o.alias("hit_o"), hit_d.alias("hit_d"), "TargetGantry").agg(
        F.count(F.lit(1)).alias("trips")
    )


@query
def endpoint_filter_table(spark, sf):
    """The same with the list as a table."""
    listed = spark.createDataFrame([(g,) for g in fx.TARGETS], "gantry_id string")
    cleaned = clean.clean_trips_by_table(fx.trips(spark, sf), listed)
    return cleaned.groupBy("TargetGantry", "VehicleType").agg(F.count(F.lit(1)).alias("trips"))


@query
def date_window(spark, sf):
    """Days 5 to 20 and all gantries: an empty list keeps every trip and counts it at its destination."""
    cleaned = clean.clean_trips(fx.trips(spark, sf), [], fx.YEAR, fx.MONTH, 5, 20)
    return cleaned.groupBy("Day", "TargetGantry").agg(F.count(F.lit(1)).alias("trips"))


@query
def quarantine_rows(spark, sf):
    bad = clean.quarantine(fx.trips(spark, sf))
    return bad.select("event_id", "VehicleType", "DetectionTime_O", "GantryID_O", "reject_reason")


@query
def run_summary(spark, sf):
    tally = hourly.tally_trips(fx.trips(spark, sf), fx.TARGETS, fx.YEAR, fx.MONTH)
    return quality.run_summary(hourly.counters_from_tally(tally))


@query
def merge_partials(spark, sf):
    """Counts per source file, then added up: the same table as counting at once."""
    partials = hourly.tally_trips(fx.trips(spark, sf), fx.TARGETS, fx.YEAR, fx.MONTH)
    return hourly.to_lake_rows(hourly.add_week_index(hourly.hourly_from_tally(partials))).drop("yyyymm")


@query
def domain_check(spark, sf):
    trips = clean.coerce_trips(fx.trips(spark, sf))
    ts = F.col(clean.TRIP_TIME)
    return quality.domain_check(trips, quality.domain_rules(F.year(ts), F.month(ts), F.col("GantryID_O")))


# --- station flow --------------------------------------------------------------------------


def _flow(spark, sf):
    return flow.hourly_flow(fx.flow_5min(spark, sf), fx.STATIONS)


@query
def flow_hourly(spark, sf):
    return _flow(spark, sf).withColumn("dt", F.col("dt").cast("string"))


@query
def flow_ctas(spark, sf):
    """The hourly flow as a partitioned catalog table."""
    path = fresh_path(spark, "flow")
    name = "flow_" + path.rsplit("-", 1)[-1]
    return create_table_as(_flow(spark, sf), name, path).withColumn("dt", F.col("dt").cast("string"))


@query
def flow_q1(spark, sf):
    return flow.month_totals(_flow(spark, sf)).orderBy("yyyymm")


@query
def flow_q2(spark, sf):
    return flow.station_completeness(_flow(spark, sf), "202401").orderBy("gantry_id")


@query
def flow_q3(spark, sf):
    return flow.slot_distribution(_flow(spark, sf)).orderBy("slot_count", ascending=False)


@query
def flow_q4(spark, sf):
    return flow.period_totals(_flow(spark, sf), "202401", "202412").orderBy("gantry_id")


# --- profiles ------------------------------------------------------------------------------


@query
def daily_total(spark, sf):
    return profile.daily_total(fx.hourly(spark, sf))


@query
def day_hour_total(spark, sf):
    return profile.day_hour_total(fx.hourly(spark, sf))


@query
def hour_profile(spark, sf):
    return profile.hour_profile(fx.hourly(spark, sf))


@query
def peak_hours(spark, sf):
    return profile.peak_hours(fx.hourly(spark, sf))


@query
def vehicle_share(spark, sf):
    return profile.vehicle_share(fx.hourly(spark, sf))


@query
def vehicle_total(spark, sf):
    return profile.vehicle_total(fx.hourly(spark, sf))


@query
def weekday_avg(spark, sf):
    return profile.weekday_average(fx.hourly(spark, sf))


@query
def vt_weekday_avg(spark, sf):
    return profile.vehicle_weekday_average(fx.hourly(spark, sf))


@query
def mean_24h(spark, sf):
    return profile.mean_24h(fx.hourly(spark, sf))


@query
def gantry_stats(spark, sf):
    return profile.gantry_stats(fx.hourly(spark, sf))


@query
def gantry_availability(spark, sf):
    requested = spark.createDataFrame([(g,) for g in fx.REQUESTED], "gantry_id string")
    return profile.gantry_availability(fx.hourly(spark, sf), requested)


@query
def anomaly_days(spark, sf):
    return profile.anomaly_days(fx.hourly(spark, sf))


@query
def global_stats(spark, sf):
    stats = profile.global_stats(fx.hourly(spark, sf))
    return stats.select("total_rows", F.array_join("days_covered", ",").alias("days_covered"))


@query
def stats_json(spark, sf):
    return profile.stats_documents(fx.hourly(spark, sf))


@query
def stats_requested(spark, sf):
    """Documents for a list of requested gantries, one of them without data."""
    requested = spark.createDataFrame([(g, f"gantry {g}") for g in fx.REQUESTED], "gantry_id string, label string")
    named = requested.withColumn("label", F.when(F.col("gantry_id") != fx.REQUESTED[1], F.col("label")))
    return profile.requested_documents(fx.hourly(spark, sf), named)


@query
def stats_global(spark, sf):
    return profile.global_document(fx.hourly(spark, sf))


# --- grids and pivots ----------------------------------------------------------------------


@query
def hour_grid(spark, sf):
    return grids.hour_grid(fx.hourly(spark, sf))


@query
def hour_day_pivot(spark, sf):
    return grids.hour_day_pivot(fx.hourly(spark, sf))


@query
def weekday_vt_total(spark, sf):
    return grids.weekday_vehicle_totals(fx.hourly(spark, sf), VEHICLE_CODES)


@query
def month_gantry_pivot(spark, sf):
    return grids.month_gantry_pivot(fx.hourly_multi(spark, sf), fx.TARGETS)


@query
def month_vt_pivot(spark, sf):
    return grids.month_vehicle_pivot(fx.hourly_multi(spark, sf), VEHICLE_CODES)


# --- many months and the lake --------------------------------------------------------------


@query
def multi_month_union(spark, sf):
    january = tag_month(fx.hourly(spark, sf).drop("yyyymm"), "202401")
    return union_months(fx.hourly_multi(spark, sf), january)


@query
def daily_date(spark, sf):
    daily = profile.daily_total_by_date(fx.hourly_multi(spark, sf))
    return daily.withColumn("date", F.col("date").cast("string"))


@query
def lake_rows(spark, sf):
    return fx.hourly(spark, sf)


@query
def lake_roundtrip(spark, sf):
    """Many months written to the lake, one written again, then read through the catalog."""
    path = fresh_path(spark, "lake")
    name = "lake_" + path.rsplit("-", 1)[-1]
    write_lake(fx.hourly_multi(spark, sf), path)
    write_lake(fx.hourly(spark, sf), path)
    write_lake(fx.hourly(spark, sf), path)
    return register_lake(spark, name, path)


@query
def month_window_run(spark, sf):
    """A month, then its days 5 to 9 again from other trips, then day 30 without any: the other days stay."""
    path = fresh_path(spark, "window")
    trips = fx.trips(spark, sf)
    replace_days(fx.hourly(spark, sf), path, fx.YEAR, fx.MONTH)
    sedans = trips.where(F.col("VehicleType") == "31")
    replace_days(hourly.hourly_counts(sedans, fx.TARGETS, fx.YEAR, fx.MONTH, 5, 9), path, fx.YEAR, fx.MONTH, 5, 9)
    replace_days(fx.hourly(spark, sf).limit(0), path, fx.YEAR, fx.MONTH, 30, 30)
    return read_lake(spark, path)


@query
def month_swap(spark, sf):
    """A registered month replaced twice; a writer that never commits leaves rows that don't count."""
    path = fresh_path(spark, "swap")
    name = "swap_" + path.rsplit("-", 1)[-1]
    month = f"{fx.YEAR:04d}{fx.MONTH:02d}"
    replace_days(fx.hourly(spark, sf).where(F.col("day") != 5), path, fx.YEAR, fx.MONTH)
    register_lake(spark, name, path)
    fx.hourly(spark, sf).drop("yyyymm").write.parquet(f"{path}/{month_folder(month, 'abandoned')}")
    replace_days(fx.hourly(spark, sf), path, fx.YEAR, fx.MONTH)
    return register_lake(spark, name, path)


def _layers(spark, sf):
    path = fresh_path(spark, "layers")
    write_layers(fx.hourly(spark, sf), path)
    return spark.read.schema(fx.hourly(spark, sf).schema).parquet(path)


@query
def week_layer(spark, sf):
    """The second week's layer, read by its folder."""
    return _layers(spark, sf).where("week_index = 2")


@query
def day_layer(spark, sf):
    """The layer of day 17, read by its folder."""
    return _layers(spark, sf).where("day = 17")


@query
def layer_csv(spark, sf):
    """Month, week and day layers in the CSV form, each read back whole."""
    rows = []
    for layer in ("month", "week", "day"):
        path = fresh_path(spark, f"{layer}-csv")
        write_layer_csv(fx.hourly(spark, sf), path, layer)
        rows.append(read_hourly_csv(spark, path).select(F.lit(layer).alias("layer"), *HOURLY_CSV_COLUMNS))
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


@query
def hourly_reload(spark, sf):
    """The CSV form written and read back; rows whose count is no number are dropped."""
    path = fresh_path(spark, "hourly-csv")
    text = hourly.to_text_layout(fx.hourly(spark, sf))
    spoiled = F.when((F.col("Day") % 11 == 0) & (F.col("Hour_0") == 5), "n/a").otherwise(F.col("counts").cast("string"))
    write_hourly_csv(text.withColumn("counts", spoiled), path)
    return read_hourly_csv(spark, path)


# --- files, reconciliation, run records -----------------------------------------------------


def _calendar(spark):
    return quality.day_calendar(spark, fx.FIRST_DAY, fx.LAST_DAY)


@query
def file_manifest(spark, sf):
    return quality.files_per_day(fx.remote_files(spark, sf))


@query
def month_bytes(spark, sf):
    return quality.files_per_month(fx.remote_files(spark, sf))


@query
def missing_hours(spark, sf):
    gaps = quality.missing_hours(fx.local_files(spark, sf), _calendar(spark))
    return gaps.withColumn("date", F.col("date").cast("string"))


@query
def month_complete(spark, sf):
    return quality.month_completeness(fx.local_files(spark, sf), _calendar(spark))


@query
def day_complete(spark, sf):
    days = quality.day_completeness(fx.local_files(spark, sf), _calendar(spark))
    return days.withColumn("date", F.col("date").cast("string"))


@query
def manifest_pending(spark, sf):
    return quality.pending_files(fx.remote_files(spark, sf), fx.local_files(spark, sf))


@query
def inventory_sizes(spark, sf):
    """Files of a landing by whether they hold anything; an empty one is among them."""
    path = fresh_path(spark, "inventory")
    fx.write_daily_files(spark, sf, path)
    filled = (F.col("size") > 0).alias("filled")
    return read_inventory(spark, path, "*.csv").groupBy(filled).agg(F.countDistinct("path").alias("files"))


def _two_layers(spark, sf):
    """Daily layers, and a copy with a lost day, a changed day and a day too many."""
    expected = fx.hourly(spark, sf).drop("yyyymm")
    changed = F.when((F.col("day") == 3) & (F.col("hour_0") == 8), F.col("counts") + 1).otherwise(F.col("counts"))
    moved = F.when(F.col("day") == 9, F.lit(31)).otherwise(F.col("day")).cast("int")
    return expected, expected.where(F.col("day") != 5).withColumns({"counts": changed, "day": moved})


@query
def reconcile(spark, sf):
    """Daily layers against a copy with a lost day, a changed day and a day too many."""
    expected, actual = _two_layers(spark, sf)
    return quality.reconcile(expected, actual, ["week_index", "day"])


@query
def reconcile_rows(spark, sf):
    """The rows by which the same two tables differ."""
    expected, actual = _two_layers(spark, sf)
    return quality.reconcile_rows(expected, actual, ["week_index", "day"])


@query
def latest_status(spark, sf):
    last = quality.latest_status(fx.run_log(spark, sf), order=("at", "event_id"))
    return last.select("job_id", clock_text(F.col("at")).alias("at"), "event_id", "status")


# --- dimension and text ---------------------------------------------------------------------


@query
def dim_enrich(spark, sf):
    return dims.enrich_dimension(
        fx.new_dimension(spark, sf),
        fx.old_dimension(spark, sf),
        fx.dimension_defaults(spark, sf),
        fx.dimension_overrides(spark, sf),
    )


@query
def version_diff(spark, sf):
    return dims.version_diff(fx.old_dimension(spark, sf), fx.new_dimension(spark, sf), "gantry_id", "section")


@query
def top_changes(spark, sf):
    return dims.top_changes(version_diff(spark, sf), "gantry_id")


@query
def dim_group_count(spark, sf):
    return dims.group_count(fx.new_dimension(spark, sf))


@query
def id_extract(spark, sf):
    entries = dims.extract_entries(fx.manual_texts(spark, sf), "text", ["doc_id"])
    return dims.entry_names(dims.first_seen(entries, "gantry_id", ["doc_id", "entry_pos"]))


@query
def entry_routes(spark, sf):
    """Every entry of the manual with the route of the section it stands in."""
    found = dims.entry_routes(fx.routed_texts(spark, sf), "text", ["doc_id"], fx.ROUTES)
    return dims.entry_names(found).drop("start_pos", "entry_pos")


@query
def both_directions(spark, sf):
    parts = fx.table(spark, sf, "part").select(F.col("p_partkey").alias("part"), F.format_string("%06d", "p_partkey").alias("base_id"))
    return dims.both_directions(parts)


@query
def dictionary_rows(spark, sf):
    """The part table as a JSON dictionary per brand, written and read back."""
    path = fresh_path(spark, "dictionary")
    fx.write_dictionaries(spark, sf, path)
    return read_dictionary(spark, path).select("gantry_id", "section", "county")


@query
def section_bounds(spark, sf):
    return dims.section_bounds(fx.table(spark, sf, "pages"), "html", ["page_id"], fx.MARKERS)


@query
def text_normalise(spark, sf):
    return fx.chat_texts(spark, sf).select("conv_id", "turn", normalise(F.col("text"), fx.LEAD_INS).alias("text"))


@query
def concat_chunks(spark, sf):
    parsed = F.from_json("document", KNOWLEDGE_SCHEMA)
    chunks = fx.knowledge_texts(spark, sf).select("doc_id", parsed.alias("knowledge"))
    return chunks.select("doc_id", dims.join_chunks(F.col("knowledge.rag_chunks")).alias("summary"))


@query
def json_props(spark, sf):
    events = fx.table(spark, sf, "events")
    k = json_number(F.col("props"), "k")
    return events.groupBy("event_type").agg(
        F.count(k).alias("n"), F.sum(k).alias("sum_k"), F.min(k).alias("min_k"), F.max(k).alias("max_k")
    )


# --- streaming -------------------------------------------------------------------------------


@query
def hourly_window(spark, sf):
    return hourly_windows(fx.trips(spark, sf))


@query
def stream_equals_batch(spark, sf):
    """The events read as a stream of eight files, two to a batch, partials added up and some merged on the way."""
    root = fresh_path(spark, "stream")
    events = fx.table(spark, sf, "events")
    events.repartition(8, "event_id").write.parquet(f"{root}/in")
    source = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 2).parquet(f"{root}/in")
    stream = fx.trips_raw(source)
    start_hourly_stream(stream, f"{root}/partials", f"{root}/checkpoint", fx.TARGETS, fx.YEAR, fx.MONTH).awaitTermination()
    compact_partials(spark, f"{root}/partials", 1)
    counted = hourly.add_week_index(streamed_hourly(spark, f"{root}/partials"))
    return hourly.to_lake_rows(counted).drop("yyyymm")


@query
def stream_skips_damaged(spark, sf):
    """Packed files and damaged copies read as a stream of four files to a batch: sound files count, others are set aside."""
    root = fresh_path(spark, "checked")
    landed = fx.trips(spark, sf).select(*RAW_TRIP_COLUMNS).repartition(6, "TripInformation").write
    landed = landed.option("compression", "gzip").option("emptyValue", "").option("ignoreLeadingWhiteSpace", "false")
    landed.option("ignoreTrailingWhiteSpace", "false").csv(f"{root}/in/good")
    fx.cut_copies(spark, sf, f"{root}/in/bad")
    files = file_stream(spark, f"{root}/in", files_per_trigger=4)
    start_checked_stream(files, f"{root}/partials", f"{root}/checkpoint", fx.TARGETS, fx.YEAR, fx.MONTH).awaitTermination()
    counted = hourly.add_week_index(streamed_hourly(spark, f"{root}/partials"))
    return hourly.to_lake_rows(counted).drop("yyyymm")


# --- paths and calendar ------------------------------------------------------------------------


@query
def strict_crossing(spark, sf):
    crossing = paths.strict_crossing(fx.trips(spark, sf), fx.GANTRIES[0], fx.GANTRIES[2])
    return crossing.select("event_id", "TripInformation")


@query
def segment_times(spark, sf):
    return paths.path_segments(fx.trips(spark, sf), ["event_id"])


@query
def od_pairs(spark, sf):
    return paths.od_pairs(clean.coerce_trips(fx.trips(spark, sf)))


@query
def holiday_flag(spark, sf):
    daily = profile.daily_total_by_date(fx.hourly(spark, sf))
    holidays = spark.createDataFrame(fx.HOLIDAYS, "date date, holiday string")
    marked = paths.holiday_flag(daily, holidays)
    return marked.select(F.col("date").cast("string").alias("date"), "gantry_id_o", "total", "is_holiday", "holiday")
