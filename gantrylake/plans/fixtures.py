"""Trips, flows, inventories and dimension versions derived from the driver's tables.

Each function reads whole tables and is a narrow projection or one grouping, so the data it yields
grows with its input. Dirt (bad codes, bad times, blank ids, gaps) is put in on purpose.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gantrylake.functions.calendar import clock_text, month_key_of
from gantrylake.functions.files import hourly_file_name
from gantrylake.functions.literals import literal_array, literal_map
from gantrylake.operators.hourly import hourly_counts
from gantrylake.schemas import RAW_TRIP_COLUMNS

# --- fixed values of the fixtures ---------------------------------------------------------
GANTRIES = ["01F2930N", "01F2930S", "01F3019N", "01F3019S", "01F3083N", "01F3083S", "05F0287N", "05F0055N"]
TARGETS = GANTRIES[:4]
STATIONS = ["05F0287N", "05F0055N", "01F2930N", "01F2930S"]
REQUESTED = [*GANTRIES, "03F9999N"]
VEHICLES = {"view": 31, "click": 32, "signup": 41, "purchase": 42, "error": 5}
PRIORITIES = {"1": 31, "2": 32, "3": 41, "4": 42, "5": 5}
YEAR, MONTH = 2024, 1
FIRST_DAY, LAST_DAY = dt.date(2024, 1, 1), dt.date(2024, 1, 31)
FILE_PREFIX = "TRIPS"
LEAD_INS = ["Sure, here is", "Sure,", "Here is", "Certainly", "No problem,"]
ROUTES = ["Route A", "Route B", "Route C"]
MARKERS = ["<head", "<nav", "<article", "<table", "<footer", "</body"]
HOLIDAYS = [(dt.date(2024, 1, 1), "New Year"), (dt.date(2024, 1, 15), "Founding Day"), (dt.date(2024, 2, 10), "Lunar New Year")]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def gantry(n: Column) -> Column:
    return F.get(literal_array(GANTRIES), n.cast("int"))


def vehicle(event_type: Column) -> Column:
    return F.try_element_at(literal_map(VEHICLES), event_type)


def trips_raw(events: DataFrame) -> DataFrame:
    """Eight text fields per event, with its id and its hourly file."""
    event, user, ts = F.col("event_id"), F.col("user_id"), F.col("ts")
    origin, destination = gantry(user % 8), gantry((user + event) % 8)
    later = lambda minutes: clock_text(ts + F.expr(f"INTERVAL {minutes} MINUTES"))
    stop = lambda code, time: F.concat(code, F.lit(";"), time)
    return events.select(
        event,
        F.when(event % 97 == 0, "abc").otherwise(vehicle(F.col("event_type")).cast("string")).alias("VehicleType"),
        F.when(event % 101 == 0, "invalid").otherwise(clock_text(ts)).alias("DetectionTime_O"),
        F.when(event % 103 == 0, "")
        .when(event % 7 == 0, F.concat(F.lit(" "), origin, F.lit(" ")))
        .otherwise(origin)
        .alias("GantryID_O"),
        later(20).alias("DetectionTime_D"),
        destination.alias("GantryID_D"),
        F.col("value").cast("string").alias("TripLength"),
        F.lit("Y").alias("TripEnd"),
        F.concat_ws(
            "|",
            stop(origin, clock_text(ts)),
            stop(gantry((user + event * 3) % 8), later(10)),
            stop(destination, later(20)),
        ).alias("TripInformation"),
        hourly_file_name(FILE_PREFIX, F.regexp_replace(F.substring(ts.cast("string"), 1, 10), "-", ""), F.hour(ts)).alias(
            "file_name"
        ),
    )


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips_raw(table(spark, sf_dir, "events"))


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lake rows of the month, targets only."""
    return hourly_counts(trips(spark, sf_dir), TARGETS, YEAR, MONTH)


def flow_5min(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    slot = F.col("ts").cast("string")
    minute = F.call_function("div", F.minute("ts"), F.lit(5)) * 5
    interval = F.concat(F.substring(slot, 1, 14), F.lpad(minute.cast("string"), 2, "0"), F.lit(":00"))
    code = gantry(F.col("user_id") % 8)
    cells = events.select(
        interval.alias("time_interval"),
        code.alias("gantry_id"),
        vehicle(F.col("event_type")).alias("vehicle_type"),
        month_key_of(F.col("ts")).alias("yyyymm"),
    )
    return (
        cells.groupBy("time_interval", "gantry_id", "vehicle_type", "yyyymm")
        .agg(F.count(F.lit(1)).cast("int").alias("flow"))
        .select(
            "time_interval", "gantry_id", F.substring("gantry_id", -1, 1).alias("direction"), "vehicle_type", "flow", "yyyymm"
        )
    )


def hourly_multi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lake rows over all order months."""
    orders = table(spark, sf_dir, "orders")
    ts = F.col("o_orderdate")
    day = F.dayofmonth(ts)
    rows = orders.select(
        F.year(ts).alias("year"),
        F.month(ts).alias("month"),
        day.alias("day"),
        (F.weekday(ts) + 1).alias("weekday"),
        F.hour(ts).alias("hour_0"),
        gantry(F.col("o_custkey") % 4).alias("gantry_id_o"),
        F.try_element_at(literal_map(PRIORITIES), F.substring("o_orderpriority", 1, 1)).alias("vehicle_type"),
        (F.call_function("div", day - 1, F.lit(7)) + 1).cast("int").alias("week_index"),
        month_key_of(ts).alias("yyyymm"),
    )
    return rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).cast("int").alias("counts"))


def remote_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    day_text = F.regexp_replace(F.substring(F.col("ts").cast("string"), 1, 10), "-", "")
    files = events.groupBy(day_text.alias("day_text"), F.dayofmonth("ts").alias("day"), F.hour("ts").alias("hour_0")).agg(
        F.sum(F.length("props")).alias("size")
    )
    return files.withColumn("file_name", hourly_file_name(FILE_PREFIX, F.col("day_text"), F.col("hour_0")))


def local_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The remote listing with some hours absent and some sizes off by one."""
    place = F.col("day") * 24 + F.col("hour_0")
    off = F.when(place % 19 == 0, 1).otherwise(0)
    return remote_files(spark, sf_dir).where(place % 17 != 0).withColumn("size", F.col("size") + off)


def _part(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("gantry_id"),
        F.col("p_brand").alias("route"),
        F.col("p_name").alias("section"),
        F.col("p_type").alias("county"),
    )


def old_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("gantry_id")
    return _part(spark, sf_dir).where(key % 50 != 0).withColumns(
        {
            "county": F.when(key % 3 == 0, "").otherwise(F.col("county")),
            "city": F.lit("city"),
            "note": F.when(key % 5 == 0, "check").otherwise(""),
        }
    )


def new_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("gantry_id")
    renamed = F.when(key % 13 == 0, F.concat("section", F.lit(" v2"))).otherwise(F.col("section"))
    return _part(spark, sf_dir).where(key % 49 != 0).select("gantry_id", "route", renamed.alias("section"))


def dimension_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Patches for listed ids, read off the part table."""
    part = _part(spark, sf_dir).where("gantry_id BETWEEN 1 AND 20")
    return part.select("gantry_id", F.lit("assumed").alias("county"), F.lit("assumed city").alias("city"))


def dimension_overrides(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = _part(spark, sf_dir).where("gantry_id BETWEEN 10 AND 20")
    return part.select("gantry_id", F.lit("").alias("note"))


def manual_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as manual pages: every line opens with a gantry id and closes with a number."""
    doc = F.col("doc_id")

    def entry(line: Column, i: Column) -> Column:
        area = F.lpad((doc % 12).cast("string"), 2, "0")
        place = F.lpad((i % 10000).cast("string"), 4, "0")
        way = F.when((doc + i) % 2 == 0, "N").otherwise("S")
        return F.concat(area, F.lit("F"), place, way, F.lit("  "), line, F.lit("  "), i.cast("string"))

    lines = F.transform(F.split("text", "\n"), entry)
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(lines, "\n").alias("text"))


def routed_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manual pages whose lines stand under route headings; what precedes the first heading has no route."""
    heading = lambda i: F.concat(F.get(literal_array(ROUTES), ((F.col("doc_id") + F.call_function("div", i, F.lit(4))) % 3).cast("int")), F.lit("\n"))
    headed = F.transform(F.split("text", "\n"), lambda line, i: F.when(i % 4 == 2, F.concat(heading(i), line)).otherwise(line))
    return manual_texts(spark, sf_dir).select("doc_id", F.array_join(headed, "\n").alias("text"))


def damaged_copies(spark: SparkSession, landed: str, target: str) -> None:
    """Plain copies of landed text under names that say they are packed."""
    spark.read.text(landed).write.text(target)
    path = spark._jvm.org.apache.hadoop.fs.Path(target)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in system.listStatus(path):
        name = status.getPath().getName()
        if name.startswith("part-"):
            system.rename(status.getPath(), spark._jvm.org.apache.hadoop.fs.Path(f"{target}/{name}.csv.gz"))


def cut_copies(spark: SparkSession, sf_dir: str, folder: str) -> None:
    """Trips again, as packed files that break off after half of their bytes; their first rows can be read."""
    target = f"{folder}-whole"
    trips(spark, sf_dir).select(*RAW_TRIP_COLUMNS).repartition(2, "TripInformation").write.option("compression", "gzip").csv(target)
    hadoop = spark._jvm.org.apache.hadoop.fs
    path = hadoop.Path(target)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    copy = spark._jvm.org.apache.commons.io.IOUtils.copyLarge
    for status in system.listStatus(path):
        if status.getPath().getName().startswith("part-"):
            source, out = system.open(status.getPath()), system.create(hadoop.Path(f"{folder}/cut-{status.getPath().getName()}"))
            copy(source, out, 0, status.getLen() // 2)
            source.close()
            out.close()
    system.delete(path, True)


def write_daily_files(spark: SparkSession, sf_dir: str, target: str) -> None:
    """One file of trips per day, and an empty one."""
    days = trips(spark, sf_dir).select(F.substring("DetectionTime_D", 1, 10).alias("day"), "VehicleType", "GantryID_D")
    days.repartition("day").write.partitionBy("day").csv(target)
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{target}/day=none/empty.csv")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path).close()


def write_dictionaries(spark: SparkSession, sf_dir: str, target: str) -> None:
    """The part table as JSON dictionaries of a thousand ids each, a file per dictionary."""
    ids = F.format_string("P%07d", "gantry_id")
    entry = F.struct(ids.alias("key"), F.struct("section", "county").alias("value"))
    part = F.call_function("div", F.col("gantry_id"), F.lit(1000)).alias("part")
    books = _part(spark, sf_dir).groupBy(part).agg(F.to_json(F.map_from_entries(F.collect_list(entry))).alias("value"))
    books.repartition("part").write.partitionBy("part").text(target)


def knowledge_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as knowledge JSON, one chunk per line."""
    chunk = lambda line, i: F.struct(
        F.concat(F.lit("line "), (i + 1).cast("string")).alias("title"), line.alias("text")
    )
    document = F.struct(
        F.col("source").alias("route_name"), F.transform(F.split("text", "\n"), chunk).alias("rag_chunks")
    )
    return table(spark, sf_dir, "documents").select("doc_id", F.to_json(document).alias("document"))


def chat_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns, some opening with a stock phrase or enclosed in a code fence."""
    conv = F.col("conv_id")
    phrase = F.get(literal_array(LEAD_INS), (conv % 7).cast("int"))
    body = F.when(conv % 3 == 0, F.concat(F.lit("```text\n"), F.col("text"), F.lit("\n```"))).otherwise(F.col("text"))
    opened = F.concat(F.lit(" "), F.coalesce(phrase, F.lit("")), F.lit("\n "), body, F.lit("\t"))
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", opened.alias("text"))


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("job_id"), F.col("ts").alias("at"), "event_id", F.col("event_type").alias("status")
    )
