"""Intermediate tables of one operator call, in one folder that goes when its result stands."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from gantrylake.session import fresh_path
from gantrylake.sinks.lake import drop_folder


#: Rows that go to a Python worker at a time where each may hold two texts.
BATCH_ROWS = 1000


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Fewer rows in each Arrow batch of the jobs inside: executor and worker both hold a batch, beside what they work on."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(BATCH_ROWS, int(before)) if int(before) > 0 else BATCH_ROWS))
    try:
        yield
    finally:
        spark.conf.set(name, before)


class Scratch:
    """A folder below the shared one, where every table that cuts lineage is written."""

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark, self.name = spark, name
        self.folder = fresh_path(spark, name)
        self.count = 0

    def write(self, frame: DataFrame, name: str) -> DataFrame:
        """Write a table and go on from its files."""
        self.count += 1
        return self._written(frame, f"{self.folder}/{self.count}-{name}")

    def finish(self, result: DataFrame) -> DataFrame:
        """Write the result beside the folder, drop the folder, and return the result."""
        kept = self._written(result, fresh_path(self.spark, f"{self.name}-result"))
        drop_folder(self.spark, self.folder)
        return kept

    def drop(self) -> None:
        """Drop the folder; nothing may read its tables any more."""
        drop_folder(self.spark, self.folder)

    def _written(self, frame: DataFrame, path: str) -> DataFrame:
        frame.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(frame.schema).parquet(path)
