"""Hourly count tables: the text form and the partitioned lake form."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gantrylake.functions.coercion import to_whole_number
from gantrylake.schemas import HOURLY_TEXT_SCHEMA, LAKE_SCHEMA, PARTITION_KEY
from gantrylake.sinks.heads import Heads

#: The folder level below a month.
VERSION = "version"
REQUIRED = ["Day", "Hour_0", "VehicleType", "counts"]


def coerce_hourly(text: DataFrame) -> DataFrame:
    """Numeric columns from text; rows lacking a day, hour, vehicle type or count are dropped."""
    numeric = [c for c in text.columns if c != "GantryID_O"]
    typed = text.withColumns({c: to_whole_number(F.col(c)) for c in numeric})
    return typed.dropna(subset=REQUIRED)


def read_hourly_csv(spark: SparkSession, path: str) -> DataFrame:
    """Hourly counts from CSV with a header line; column order is fixed, so nothing is inferred."""
    text = spark.read.schema(HOURLY_TEXT_SCHEMA).option("header", "true").option("recursiveFileLookup", "true").csv(path)
    return coerce_hourly(text)


def lake_folders(spark: SparkSession, root: str) -> dict[str, str] | None:
    """Path of each month's current folder, None for a lake whose months are plain folders."""
    heads = Heads(spark, root)
    folders = heads.read()
    return None if folders is None else {month: heads.path(folder) for month, folder in sorted(folders.items())}


def read_lake(spark: SparkSession, root: str, months: list[str] | None = None) -> DataFrame:
    """The month-partitioned lake table as last committed. The explicit schema keeps ``yyyymm`` a text column.

    Months that are not asked for are not even listed.
    """
    folders = lake_folders(spark, root)
    if folders is None:
        lake = spark.read.schema(LAKE_SCHEMA).parquet(root)
    else:
        paths = [path for month, path in folders.items() if months is None or month in months]
        if not paths:
            return spark.createDataFrame([], LAKE_SCHEMA)
        lake = spark.read.schema(LAKE_SCHEMA).option("basePath", root).parquet(*paths).drop(VERSION)
    return lake if months is None else lake.where(F.col(PARTITION_KEY).isin(months))


def tag_month(month_table: DataFrame, yyyymm: str) -> DataFrame:
    return month_table.withColumn(PARTITION_KEY, F.lit(yyyymm))


def union_months(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Bag union of monthly tables by column name."""
    for other in others:
        first = first.unionByName(other)
    return first
