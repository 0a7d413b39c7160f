"""Whole runs: raw files to lake, lake to statistics, station flow to reports."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gantrylake.operators.flow import (
    hourly_flow,
    month_totals,
    period_totals,
    slot_distribution,
    station_completeness,
)
from gantrylake.operators.hourly import (
    add_week_index,
    counters_from_tally,
    hourly_from_tally,
    judged_tally,
    tally_trips,
    to_lake_rows,
)
from gantrylake.operators.profile import global_document, stats_documents
from gantrylake.operators.quality import run_summary
from gantrylake.session import fresh_path
from gantrylake.sinks.lake import create_table_as, drop_folder, materialise, replace_days
from gantrylake.sinks.records import append_counters, append_record, append_skipped
from gantrylake.sources.hourly import read_lake
from gantrylake.sinks.tallies import TallyStore
from gantrylake.sources.inventory import path_key, read_inventory
from gantrylake.sources.trips import (
    ANY_FILES,
    PACKED_FILES,
    PLAIN_FILES,
    SOUND,
    file_list,
    read_checked,
    read_trips,
    require_rows,
    with_file_name,
)


@dataclass(frozen=True)
class MonthRun:
    """What to clean and where to put it."""

    job_id: str
    year: int
    month: int
    gantries: Sequence[str]
    raw_path: str
    lake_path: str
    record_path: str
    day_start: int = 1
    day_end: int = 31
    skip_damaged: bool = False
    tally_path: str | None = None


class DamagedFiles(Exception):
    """Files that could not be read to their end."""


def _tally(spark: SparkSession, run: MonthRun, raw: DataFrame) -> DataFrame:
    return tally_trips(raw, run.gantries, run.year, run.month, run.day_start, run.day_end)


def _checked(spark: SparkSession, run: MonthRun) -> DataFrame:
    """All trip rows: packed files with a verdict each, plain ones, which cannot be cut short unseen, as they are."""
    packed = read_checked(file_list(spark, run.raw_path, PACKED_FILES))
    plain = with_file_name(read_trips(spark, run.raw_path, PLAIN_FILES)).withColumn("verdict", F.lit(None).cast("string"))
    return packed.unionByName(plain)


def _whole_tally(spark: SparkSession, run: MonthRun, folder: str) -> tuple[DataFrame, DataFrame | None, str | None]:
    """(tally of sound files, damaged files, remark) after one read of all files."""
    if not run.skip_damaged:
        raw = with_file_name(read_trips(spark, run.raw_path))
        return materialise(_tally(spark, run, raw), folder), None, None
    return *judged_tally(materialise(_tally(spark, run, _checked(spark, run)), folder), SOUND), None


def _changed_tally(spark: SparkSession, run: MonthRun) -> tuple[DataFrame, DataFrame, str]:
    """The same from the tallies of earlier runs, after one read of files that are new or have changed.

    Damaged files enter no list, so the next run tries them again.
    """
    question = [sorted(run.gantries), run.year, run.month, run.day_start, run.day_end]
    inventory = read_inventory(spark, run.raw_path, ANY_FILES).select(path_key(F.col("path")).alias("file_name"), "size", "changed")
    empty = _tally(spark, run, read_checked(inventory.limit(0)))
    store = TallyStore(spark, run.tally_path, question, empty.schema)
    kept, todo = store.compare(inventory)
    folder = fresh_path(spark, "todo")
    todo = materialise(todo, folder)
    spread = todo.where("size > 0").repartition(max(1, min(todo.count(), spark.sparkContext.defaultParallelism * 4)), "file_name")
    name, fresh = store.generation(_tally(spark, run, read_checked(spread)))
    bad = materialise(judged_tally(fresh, SOUND)[1], f"{folder}-bad")
    if not run.skip_damaged and (first := bad.head(3)):
        raise DamagedFiles("; ".join(f"{row['file_name']}: {row['reason']}" for row in first))
    read = todo.join(bad, "file_name", "left_anti").withColumn("generation", F.lit(name))
    store.commit(kept.unionByName(read), name)
    remark = f"{todo.count()} of {store.files().count() + bad.count()} files read"
    drop_folder(spark, folder)
    return store.tally().drop("verdict"), bad, remark


def run_month(spark: SparkSession, run: MonthRun) -> DataFrame:
    """Clean one month into the lake and return its run summary.

    The raw files are scanned once, into a tally in the shared folder; hourly rows and counters
    both come from that tally. Counters are read off written rows, so a retried task cannot count
    twice. The run replaces its days and leaves the month's other days alone. A damaged file fails
    the run; with ``skip_damaged`` it is left out whole, by the verdict of the read that gave its rows, each under a
    record of its own. With ``tally_path`` the tally of every file is kept there, and the next run of the same
    question reads new and changed files only. Any error is recorded under the job, in full, before it is raised.
    """
    if not run.gantries:
        raise ValueError("a job needs at least one gantry")
    append_record(spark, run.record_path, run.job_id, "cleaning")
    folder = fresh_path(spark, "tally")
    try:
        tally, damaged, remark = _changed_tally(spark, run) if run.tally_path else _whole_tally(spark, run, folder)
        skipped = damaged.count() if damaged is not None else 0
        if skipped:
            append_skipped(damaged, run.record_path, run.job_id)
        require_rows(tally.where("scanned > 0"))
        hourly = to_lake_rows(add_week_index(hourly_from_tally(tally)))
        replace_days(hourly, run.lake_path, run.year, run.month, run.day_start, run.day_end)
        files = read_inventory(spark, run.raw_path, ANY_FILES).count() - skipped
        counters = counters_from_tally(tally).withColumn("file_count", F.lit(files).cast("long"))
        counters = materialise(counters, fresh_path(spark, "counters"))
        append_counters(counters, run.record_path, run.job_id, skipped=skipped, remark=remark)
        drop_folder(spark, folder)
    except Exception as error:
        append_record(spark, run.record_path, run.job_id, "error", str(error))
        raise
    return run_summary(counters)


def run_statistics(spark: SparkSession, lake_path: str, out_path: str, months: list[str] | None = None) -> None:
    """JSON statistics as text files: a document per gantry in ``gantries``, one over all in ``all``."""
    lake = read_lake(spark, lake_path, months)
    stats_documents(lake).select("document").write.mode("overwrite").text(f"{out_path}/gantries")
    global_document(lake).write.mode("overwrite").text(f"{out_path}/all")


def run_flow(
    flow: DataFrame, stations: Sequence[str], table: str, root: str, month: str, first: str, last: str
) -> dict[str, DataFrame]:
    """Hourly flow as a catalog table and the four reports on it."""
    hourly = create_table_as(hourly_flow(flow, stations), table, root)
    return {
        "month_totals": month_totals(hourly).orderBy("yyyymm"),
        "station_completeness": station_completeness(hourly, month).orderBy("gantry_id"),
        "slot_distribution": slot_distribution(hourly).orderBy("slot_count", ascending=False),
        "period_totals": period_totals(hourly, first, last).orderBy("gantry_id"),
    }
