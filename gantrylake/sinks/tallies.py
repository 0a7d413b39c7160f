"""Tallies kept between runs, per file, so that a run over a month scans new and changed files only.

A run's tally is one generation: a folder of rows per file and hourly key. A list of files says which generation
holds each file, as which size and change. Rows of a file that was read again since, or is gone, belong
to no entry of the list and count no more. List and generations are committed together.
"""

from __future__ import annotations

import hashlib
import json
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gantrylake.sinks.heads import Heads, new_version

FILE_SCHEMA = T.StructType(
    [
        T.StructField("file_name", T.StringType()),
        T.StructField("size", T.LongType()),
        T.StructField("changed", T.LongType()),
        T.StructField("generation", T.StringType()),
    ]
)
#: Generations that are held before their rows are written as one.
MOST = 16


class TallyStore:
    """Tallies of one question: a list of gantries and a window of days."""

    def __init__(self, spark: SparkSession, root: str, question: object, schema: T.StructType) -> None:
        asked = hashlib.sha256(json.dumps(question, sort_keys=True).encode()).hexdigest()[:32]
        self.spark, self.schema = spark, schema
        self.heads = Heads(spark, f"{root}/{asked}")
        self.held = self.heads.read() or {}

    def files(self) -> DataFrame:
        """Files that count: name, size, time of change, generation."""
        if "files" not in self.held:
            return self.spark.createDataFrame([], FILE_SCHEMA)
        return self.spark.read.schema(FILE_SCHEMA).parquet(self.heads.path(self.held["files"]))

    def compare(self, inventory: DataFrame) -> tuple[DataFrame, DataFrame]:
        """(files that are as they were, files to read) of a listing with ``file_name``, ``size`` and ``changed``."""
        same = ["file_name", "size", "changed"]
        kept = self.files().join(inventory.select(*same), same, "left_semi")
        return kept, inventory.join(kept.select(*same), same, "left_anti")

    def generation(self, tally: DataFrame) -> tuple[str, DataFrame]:
        """Write a new generation, which does not count yet."""
        name = new_version()
        tally.write.parquet(self.heads.path(name))
        return name, self.spark.read.schema(tally.schema).parquet(self.heads.path(name))

    def commit(self, files: DataFrame, generation: str) -> None:
        """Put a list of files, and the generation that its new files are in, in force."""
        before, listing = self.held.get("files"), f"files-{new_version()}"
        files.select(*FILE_SCHEMA.names).write.parquet(self.heads.path(listing))
        entries = self.held | {"files": listing, generation: generation}
        after = self.heads.commit(lambda now: entries if now.get("files") == before else now)
        if after.get("files") != listing:
            raise RuntimeError("another run has changed the tallies meanwhile")
        self.held = after
        if len(after) > MOST + 1:
            self._merge()

    def tally(self) -> DataFrame:
        """Rows of every file in the list, from the generation that holds it."""
        names = [name for name in self.held if name != "files"]
        if not names:
            return self.spark.createDataFrame([], self.schema)
        parts = [
            self.spark.read.schema(self.schema).parquet(self.heads.path(self.held[name])).withColumn("generation", F.lit(name)) for name in names
        ]
        rows = reduce(DataFrame.unionByName, parts)
        return rows.join(self.files().select("file_name", "generation"), ["file_name", "generation"], "left_semi").drop("generation")

    def _merge(self) -> None:
        name, _ = self.generation(self.tally())
        listing = f"files-{new_version()}"
        self.files().withColumn("generation", F.lit(name)).write.parquet(self.heads.path(listing))
        before = self.held["files"]
        self.held = self.heads.commit(lambda now: {"files": listing, name: name} if now.get("files") == before else now)
