"""Run records: appended, never updated; readers take the last one per job. Old ones are merged into one file."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gantrylake.operators.quality import latest_status
from gantrylake.sinks.heads import Log

RECORD_SCHEMA = T.StructType(
    [
        T.StructField("job_id", T.StringType(), False),
        T.StructField("at", T.TimestampNTZType(), False),
        T.StructField("status", T.StringType(), False),
        T.StructField("scanned_rows", T.LongType()),
        T.StructField("cleaned_rows", T.LongType()),
        T.StructField("hourly_rows", T.LongType()),
        T.StructField("file_count", T.LongType()),
        T.StructField("note", T.StringType()),
    ]
)
COUNTERS = ["scanned_rows", "cleaned_rows", "hourly_rows", "file_count"]


def append_record(spark: SparkSession, path: str, job_id: str, status: str, note: str | None = None) -> None:
    """One state of a run without counters."""
    row = (job_id, dt.datetime.now(dt.timezone.utc).replace(tzinfo=None), status, None, None, None, None, note)
    Log(spark, path).append(spark.createDataFrame([row], RECORD_SCHEMA).coalesce(1))


def append_skipped(damaged: DataFrame, path: str, job_id: str) -> None:
    """One record for each file that was left out, with its name and the reason."""
    at = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None).isoformat(sep=" ")
    record = damaged.select(
        F.lit(job_id).alias("job_id"),
        F.lit(at).cast("timestamp_ntz").alias("at"),
        F.lit("skipped").alias("status"),
        *[F.lit(None).cast("long").alias(name) for name in COUNTERS],
        F.concat_ws(": ", "file_name", "reason").alias("note"),
    )
    Log(record.sparkSession, path).append(record.select(*[F.col(f.name).cast(f.dataType) for f in RECORD_SCHEMA]))


def append_counters(
    counters: DataFrame, path: str, job_id: str, status: str = "done", skipped: int = 0, remark: str | None = None
) -> None:
    """The closing record with its counters, written by Spark from the one-row table.

    No matching rows is a normal outcome: the record says so in its note, and how many files were skipped.
    """
    left_out = F.lit(f"{skipped} damaged files skipped" if skipped else None)
    matched = F.when(F.col("hourly_rows") == 0, F.lit("no matching rows"))
    note = F.nullif(F.concat_ws("; ", matched, left_out, F.lit(remark)), F.lit(""))
    record = counters.select(
        F.lit(job_id).alias("job_id"),
        F.lit(dt.datetime.now(dt.timezone.utc).replace(tzinfo=None).isoformat(sep=" ")).cast("timestamp_ntz").alias("at"),
        F.lit(status).alias("status"),
        *COUNTERS,
        note.alias("note"),
    )
    Log(record.sparkSession, path).append(record.select(*[F.col(f.name).cast(f.dataType) for f in RECORD_SCHEMA]))


def read_records(spark: SparkSession, path: str) -> DataFrame:
    return Log(spark, path).rows(RECORD_SCHEMA)


def read_latest(spark: SparkSession, path: str) -> DataFrame:
    return latest_status(read_records(spark, path))
