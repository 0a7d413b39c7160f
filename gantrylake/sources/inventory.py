"""File listings as tables."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gantrylake.session import fresh_path
from gantrylake.sources.storage import glob_pattern, listed

_ENTRY = "path string, folder boolean, size long, changed long"


def path_key(path: Column) -> Column:
    """A path under which the ways of writing one agree: slashes after the scheme differ between listings."""
    return F.regexp_replace(path, "^([A-Za-z0-9]+):/+", "$1:/")


def list_folders(folders: DataFrame) -> DataFrame:
    """What the folders (column ``path``) hold, each listed by the task that has its row."""

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for folder in batch.column("path").to_pylist():
                found = listed(folder)
                columns = [pa.array([one[n] for one in found], kind) for n, kind in enumerate((pa.string(), pa.bool_(), pa.int64(), pa.int64()))]
                yield pa.record_batch(columns, ["path", "folder", "size", "changed"])

    return folders.select("path").mapInArrow(entries, _ENTRY)


def read_inventory(spark: SparkSession, path: str, files: str = "*") -> DataFrame:
    """Name, byte size, path and time of change (microseconds) of the files below a folder, empty ones too.

    Folders are listed level by level, those of a level by parallel tasks; what they hold is written to the shared
    folder and never passes the driver. Hidden names are left out, as in a scan.
    """
    root = fresh_path(spark, "listing")
    system = spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    start = system.makeQualified(spark._jvm.org.apache.hadoop.fs.Path(path)).toString()
    folders, levels = spark.createDataFrame([(start,)], "path string"), []
    while not levels or folders.limit(1).count():
        target = f"{root}/{len(levels)}"
        list_folders(folders.repartition(spark.sparkContext.defaultParallelism, "path")).write.parquet(target)
        levels.append(spark.read.schema(_ENTRY).parquet(target))
        folders = levels[-1].where("folder")
    every = reduce(DataFrame.unionByName, levels).where("NOT folder")
    name = F.element_at(F.split("path", "/"), -1)
    return every.where(name.rlike(glob_pattern(files))).select(name.alias("file_name"), "size", "path", "changed")
