"""The CSV form of the hourly table and its three layers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gantrylake.functions.calendar import month_key
from gantrylake.operators.hourly import to_text_layout
from gantrylake.schemas import HOURLY_CSV_COLUMNS, PARTITION_KEY

# --- fixed value: the byte order mark that opens every file -------------------------------
BYTE_ORDER_MARK = "﻿"

ORDER = ["Year", "Month", "Day", "Hour_0", "GantryID_O", "VehicleType"]


def write_hourly_csv(hourly: DataFrame, path: str, mark: bool = True) -> None:
    """Nine columns under a header, CRLF line ends, byte order mark in front.

    The header line is the only place a file's first bytes can be set, so the mark rides on the
    first column name. Rows are dealt to files by ranges of the order, so the files read one after
    the other by name are in order; their number follows the data.
    """
    first, *rest = HOURLY_CSV_COLUMNS
    rows = hourly.select(*HOURLY_CSV_COLUMNS).repartitionByRange(*ORDER).sortWithinPartitions(*ORDER)
    if mark:
        rows = rows.select(F.col(first).alias(BYTE_ORDER_MARK + first), *rest)
    rows.write.mode("overwrite").option("header", "true").option("lineSep", "\r\n").csv(path)


def write_layers(lake_rows: DataFrame, root: str) -> None:
    """Month, week and day layers as one partitioned write.

    ``yyyymm=…/week_index=…/day=…``: a month, a week or a day of the table is a folder, and
    reading one is partition pruning. Nothing is written three times.
    """
    layers = [PARTITION_KEY, "week_index", "day"]
    (
        lake_rows.repartition(*layers)
        .sortWithinPartitions(*layers, "hour_0", "gantry_id_o", "vehicle_type")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*layers)
        .parquet(root)
    )


#: Folders of each CSV layer.
LAYER_FOLDERS = {"month": ["yyyymm"], "week": ["yyyymm", "week"], "day": ["week", "date"]}


def write_layer_csv(lake_rows: DataFrame, root: str, layer: str = "day") -> None:
    """One layer in the CSV form: a folder per month, per month and week, or per week and day."""
    folders = LAYER_FOLDERS[layer]
    month = month_key(F.col("Year"), F.col("Month"))
    text = to_text_layout(lake_rows).withColumns({"yyyymm": month, "week": F.col("WeekIndex"), "date": F.col("Day")})
    order = [*folders, *ORDER]
    dealt = text.repartitionByRange(*order).sortWithinPartitions(*order)
    named = dealt.select(F.col("Year").alias(BYTE_ORDER_MARK + "Year"), *HOURLY_CSV_COLUMNS[1:], *folders)
    named.write.mode("overwrite").option("header", "true").option("lineSep", "\r\n").partitionBy(*folders).csv(root)
