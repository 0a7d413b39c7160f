"""Month-partitioned Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gantrylake.functions.literals import literal, name as quoted
from gantrylake.schemas import LAKE_COLUMNS, LAKE_SCHEMA, PARTITION_KEY
from gantrylake.session import fresh_path
from gantrylake.sinks.heads import Heads, file_system, new_version
from gantrylake.sources.hourly import VERSION, lake_folders, read_lake


def write_lake(lake_rows: DataFrame, root: str) -> None:
    """Write lake rows, replacing exactly the months they hold, all of them in one step.

    Rows are spread by month and day: a month is written by several tasks, each day by one, and
    every file is sorted. A month without rows here stays as it is; :func:`replace_days` empties it too.
    """
    adopt(lake_rows.sparkSession, root)
    _write_months(lake_rows, root)


def adopt(spark: SparkSession, root: str) -> None:
    """Give versions to a lake whose months are plain folders of files; nobody else may write to it meanwhile."""
    system, plain = file_system(spark, f"{root}/{PARTITION_KEY}=*/*.parquet")
    if Heads(spark, root).read() is None and system.globStatus(plain):
        _write_months(spark.read.schema(LAKE_SCHEMA).parquet(root), root)


def _write_months(lake_rows: DataFrame, root: str) -> None:
    spark = lake_rows.sparkSession
    version = new_version()
    (
        lake_rows.select(*LAKE_COLUMNS, PARTITION_KEY, F.lit(version).alias(VERSION))
        .repartition(PARTITION_KEY, "day")
        .sortWithinPartitions(PARTITION_KEY, "day", "hour_0", "gantry_id_o", "vehicle_type")
        .write.mode("append")
        .partitionBy(PARTITION_KEY, VERSION)
        .parquet(root)
    )
    system, written = file_system(spark, f"{root}/{PARTITION_KEY}=*/{VERSION}={version}")
    months = [status.getPath().getParent().getName().partition("=")[2] for status in system.globStatus(written)]
    Heads(spark, root).commit(lambda heads: heads | {month: month_folder(month, version) for month in months})


def month_folder(month: str, version: str) -> str:
    return f"{PARTITION_KEY}={month}/{VERSION}={version}"


def replace_days(lake_rows: DataFrame, root: str, year: int, month: int, day_start: int = 1, day_end: int = 31) -> None:
    """Replace a window of days of one month; its other days stay as they are.

    The month's other days and the new rows are written to a folder of their own, which takes the old one's
    place in one step (see :mod:`gantrylake.sinks.heads`): the month can be read all the while, and a run that dies
    leaves the old rows. Without new rows the window is empty afterwards. Should another run replace days
    of the month meanwhile, the work is done over on its rows.
    """
    spark = lake_rows.sparkSession
    key = f"{year:04d}{month:02d}"
    adopt(spark, root)
    heads = Heads(spark, root)
    folder = fresh_path(spark, "month")
    new = materialise(lake_rows.select(*LAKE_COLUMNS), folder)
    while True:
        old = (heads.read() or {}).get(key)
        whole = new
        if old is not None:
            before = spark.read.schema(new.schema).parquet(heads.path(old))
            whole = before.where(~F.col("day").between(day_start, day_end)).unionByName(new)
        version = new_version()
        ordered = whole.repartition("day").sortWithinPartitions("day", "hour_0", "gantry_id_o", "vehicle_type")
        ordered.write.parquet(heads.path(month_folder(key, version)))

        def put(now: dict[str, str]) -> dict[str, str]:
            unchanged = now.get(key) in (None, old)
            return now | {key: month_folder(key, version)} if unchanged else now

        if heads.commit(put).get(key) == month_folder(key, version):
            break
        drop_folder(spark, heads.path(month_folder(key, version)))
    drop_folder(spark, folder)


def folder_exists(spark: SparkSession, folder: str) -> bool:
    system, path = file_system(spark, folder)
    return system.exists(path)


def drop_folder(spark: SparkSession, folder: str) -> None:
    """Remove an intermediate folder that this library wrote."""
    system, path = file_system(spark, folder)
    system.delete(path, True)


def materialise(table: DataFrame, path: str) -> DataFrame:
    """Write a table to the shared folder and go on from the files.

    Lineage ends there: a lost executor costs a re-read, not a recomputation from the raw files.
    """
    table.write.mode("overwrite").parquet(path)
    return table.sparkSession.read.schema(table.schema).parquet(path)


def register_lake(spark: SparkSession, name: str, root: str) -> DataFrame:
    """Catalog table over the lake; each month is a partition that lies where the month's current folder is.

    Called again after a run, it moves the partitions of replaced months and adds new ones.
    """
    columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in LAKE_SCHEMA)
    table = table_name(name)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING PARQUET PARTITIONED BY ({PARTITION_KEY}) LOCATION {literal(root)}"
    )
    folders = lake_folders(spark, root)
    if folders is None:
        spark.catalog.recoverPartitions(table)
    else:
        for month, path in folders.items():
            part = f"PARTITION ({PARTITION_KEY} = {literal(month)})"
            spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {part} LOCATION {literal(path)}")
            spark.sql(f"ALTER TABLE {table} {part} SET LOCATION {literal(path)}")
    spark.catalog.refreshTable(table)
    return spark.table(table)


def table_name(name: str) -> str:
    """Each part of a dotted name quoted."""
    return ".".join(quoted(part) for part in name.split("."))


def create_table_as(query: DataFrame, name: str, root: str, partition: str = PARTITION_KEY) -> DataFrame:
    """Partitioned Parquet table from a query; a table of that name and its rows are replaced."""
    spark = query.sparkSession
    table = table_name(name)
    ordered = [*(c for c in query.columns if c != partition), partition]
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    query.select(*map(quoted, ordered)).write.mode("overwrite").partitionBy(partition).option("path", root).saveAsTable(table)
    return spark.table(table)
