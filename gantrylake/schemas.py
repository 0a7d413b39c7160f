"""Table layouts and the fixed values every module shares."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: column names and their order in files ---------------------------------
RAW_TRIP_COLUMNS = [
    "VehicleType",
    "DetectionTime_O",
    "GantryID_O",
    "DetectionTime_D",
    "GantryID_D",
    "TripLength",
    "TripEnd",
    "TripInformation",
]
HOURLY_COLUMNS = ["Year", "Month", "Day", "Weekday", "Hour_0", "GantryID_O", "VehicleType", "counts"]
HOURLY_CSV_COLUMNS = [*HOURLY_COLUMNS, "WeekIndex"]
LAKE_COLUMNS = ["year", "month", "day", "weekday", "hour_0", "gantry_id_o", "vehicle_type", "counts", "week_index"]

# --- fixed values: code lists ------------------------------------------------------------
VEHICLE_CODES = [31, 32, 41, 42, 5]
VEHICLE_LABELS = {31: "Sedan", 32: "Pickup", 41: "Bus", 42: "Truck", 5: "Trailer"}
WEEKDAY_LABELS = {1: "Mon", 2: "Tue", 3: "Wed", 4: "Thu", 5: "Fri", 6: "Sat", 7: "Sun"}
HOURS = list(range(24))
WEEKDAYS = list(range(1, 8))
FILES_PER_DAY = 24

# --- fixed values: thresholds and patterns -----------------------------------------------
ANOMALY_Z = "2.0"
GANTRY_ID_PATTERN = r"[0-9]{2}[A-Za-z]{1,2}[0-9]{3,4}[NS]"

# --- keys --------------------------------------------------------------------------------
HOURLY_KEYS = HOURLY_COLUMNS[:-1]
DATE_KEYS = ["year", "month", "day"]
PARTITION_KEY = "yyyymm"

RAW_TRIP_SCHEMA = T.StructType([T.StructField(name, T.StringType()) for name in RAW_TRIP_COLUMNS])

HOURLY_TEXT_SCHEMA = T.StructType([T.StructField(name, T.StringType()) for name in HOURLY_CSV_COLUMNS])

LAKE_SCHEMA = T.StructType(
    [
        T.StructField(name, T.StringType() if name == "gantry_id_o" else T.IntegerType())
        for name in LAKE_COLUMNS
    ]
    + [T.StructField(PARTITION_KEY, T.StringType())]
)

FLOW_SCHEMA = T.StructType(
    [
        T.StructField("time_interval", T.StringType()),
        T.StructField("gantry_id", T.StringType()),
        T.StructField("direction", T.StringType()),
        T.StructField("vehicle_type", T.IntegerType()),
        T.StructField("flow", T.IntegerType()),
        T.StructField(PARTITION_KEY, T.StringType()),
    ]
)

# --- fixed values: field names of the dimension dictionary ---------------------------------
DIMENSION_ATTRIBUTES = T.StructType(
    [T.StructField(name, T.StringType()) for name in ["section", "county", "city", "note", "route"]]
)

# --- fixed values: field names of the knowledge documents ---------------------------------
CHUNK_SCHEMA = T.ArrayType(
    T.StructType([T.StructField("title", T.StringType()), T.StructField("text", T.StringType())])
)
KNOWLEDGE_SCHEMA = T.StructType(
    [
        T.StructField("route_name", T.StringType()),
        T.StructField(
            "target_gantries",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("id", T.StringType()),
                        T.StructField("direction", T.StringType()),
                        T.StructField("segment", T.StringType()),
                    ]
                )
            ),
        ),
        T.StructField("rag_chunks", CHUNK_SCHEMA),
    ]
)
