"""Completeness, reconciliation, run counters and run records."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gantrylake.functions.calendar import hour_bit
from gantrylake.functions.files import day_text_to_date, file_day, file_hour
from gantrylake.functions.literals import literal_array
from gantrylake.functions.numbers import ratio, round_half_even
from gantrylake.operators.clean import LIST_ROWS
from gantrylake.schemas import FILES_PER_DAY, GANTRY_ID_PATTERN, HOURS
from gantrylake.session import fresh_path
from gantrylake.sinks.lake import materialise

#: Decimal digits that the values of a type take, and the least value.
ORDER_DIGITS = {
    "int": (10, -(2**31)),
    "bigint": (20, -(2**63)),
    "timestamp": (18, -(10**17)),
}


def day_calendar(spark: SparkSession, first: dt.date, last: dt.date) -> DataFrame:
    """One row per day of a period, both ends included."""
    days = F.sequence(F.lit(first), F.lit(last))
    return spark.range(1).select(F.explode(days).alias("date"))


def dated_files(inventory: DataFrame) -> DataFrame:
    """Inventory rows with the day and hour their names carry; other names are left out."""
    stamped = inventory.withColumns(
        {"yyyymmdd": file_day(F.col("file_name")), "hour_0": file_hour(F.col("file_name"))}
    )
    return stamped.where(F.col("yyyymmdd").isNotNull())


def files_per_day(inventory: DataFrame) -> DataFrame:
    """Files, non-empty files and bytes per day."""
    return dated_files(inventory).groupBy("yyyymmdd").agg(
        F.count(F.lit(1)).alias("files"),
        F.count_if(F.col("size") > 0).alias("non_empty_files"),
        F.sum("size").alias("bytes"),
    )


def files_per_month(inventory: DataFrame) -> DataFrame:
    return dated_files(inventory).groupBy(F.substring("yyyymmdd", 1, 6).alias("yyyymm")).agg(
        F.count(F.lit(1)).alias("files"), F.sum("size").alias("bytes")
    )


def day_completeness(inventory: DataFrame, calendar: DataFrame, files_expected: int = FILES_PER_DAY) -> DataFrame:
    """Every calendar day with its non-empty files; a day without any file counts 0."""
    counted = files_per_day(inventory).select(
        day_text_to_date(F.col("yyyymmdd")).alias("date"), "non_empty_files"
    )
    joined = calendar.join(counted, "date", "left")
    files = F.coalesce("non_empty_files", F.lit(0))
    return joined.select("date", files.alias("files"), (files >= files_expected).alias("is_complete"))


def month_completeness(inventory: DataFrame, calendar: DataFrame, files_expected: int = FILES_PER_DAY) -> DataFrame:
    """A month is complete when each of its calendar days is."""
    days = day_completeness(inventory, calendar, files_expected)
    per_month = days.groupBy(F.date_format(F.col("date"), "yyyyMM").alias("yyyymm")).agg(
        F.sum("files").alias("files"),
        (F.count(F.lit(1)) * F.lit(files_expected)).alias("expected_files"),
        F.count_if("is_complete").alias("complete_days"),
        F.count(F.lit(1)).alias("days"),
        F.bool_and("is_complete").alias("is_complete"),
    )
    return per_month


def missing_hours(inventory: DataFrame, calendar: DataFrame) -> DataFrame:
    """Every day and hour of the calendar without a non-empty file.

    A day's hours travel as one 24-bit mask, so the join is day against day and the gaps are read
    off the mask.
    """
    present = dated_files(inventory).where((F.col("size") > 0) & F.col("hour_0").between(0, 23))
    masks = present.groupBy(day_text_to_date(F.col("yyyymmdd")).alias("date")).agg(
        F.bit_or(hour_bit(F.col("hour_0"))).alias("mask")
    )
    hours = literal_array(HOURS)
    return (
        calendar.join(masks, "date", "left")
        .withColumn("mask", F.coalesce("mask", F.lit(0)))
        .select("date", F.explode(F.filter(hours, lambda h: F.bit_get(F.col("mask"), h) == 0)).alias("hour_0"))
    )


def pending_files(remote: DataFrame, local: DataFrame) -> DataFrame:
    """Remote files to fetch: absent locally, or there under another size."""
    have = local.select("file_name", F.col("size").alias("local_size"))
    joined = remote.select("file_name", "size").join(have, "file_name", "left")
    reason = F.when(F.col("local_size").isNull(), "absent").when(F.col("local_size") != F.col("size"), "size")
    return joined.withColumn("reason", reason).where("reason IS NOT NULL").select("file_name", "size", "reason")


def row_digest(columns: Sequence[str]) -> Column:
    """Sum of row hashes: equal for equal bags of rows in any order, duplicates included."""
    return F.sum(F.xxhash64(*columns).cast("decimal(28,0)"))


def reconcile(expected: DataFrame, actual: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per key: PASS, FAIL, MISSING or EXTRA by row count and order-free digest.

    Each side shrinks to one row per key before the full join.
    """
    columns = sorted(expected.columns)

    def digest(table: DataFrame, side: str) -> DataFrame:
        return table.groupBy(*keys).agg(
            F.count(F.lit(1)).alias(f"{side}_rows"), row_digest(columns).alias(f"{side}_digest")
        )

    both = digest(expected, "expected").join(digest(actual, "actual"), list(keys), "full_outer")
    same = (F.col("expected_rows") == F.col("actual_rows")) & (F.col("expected_digest") == F.col("actual_digest"))
    status = (
        F.when(F.col("actual_rows").isNull(), "MISSING")
        .when(F.col("expected_rows").isNull(), "EXTRA")
        .when(same, "PASS")
        .otherwise("FAIL")
    )
    rows = [F.coalesce(c, F.lit(0)).alias(c) for c in ("expected_rows", "actual_rows")]
    return both.select(*keys, *rows, status.alias("status"))


def reconcile_rows(expected: DataFrame, actual: DataFrame, keys: Sequence[str], buckets: int = 64) -> DataFrame:
    """The rows by which two tables differ: ``side`` (``MISSING`` or ``EXTRA``), ``copies``, and the row.

    Both sides shrink to a digest per key and bucket of rows, hashed by content. Only rows of buckets whose digests
    differ go on to be compared; the list of those buckets is broadcast up to a counted size, so
    rows of equal buckets are never shuffled, and a key that holds a third of all rows is spread over its buckets.
    """
    columns = sorted(expected.columns)
    bucket = F.pmod(F.xxhash64(*columns), F.lit(buckets)).cast("int").alias("_bucket")

    def digests(table: DataFrame, sign: int) -> DataFrame:
        rows = table.select(*columns, bucket).groupBy(*keys, "_bucket").agg(F.count(F.lit(1)).alias("n"), row_digest(columns).alias("digest"))
        return rows.select(*keys, "_bucket", (F.col("n") * sign).alias("n"), (F.col("digest") * sign).alias("digest"))

    sums = digests(expected, 1).unionByName(digests(actual, -1)).groupBy(*keys, "_bucket").agg(F.sum("n").alias("n"), F.sum("digest").alias("digest"))
    folder = fresh_path(expected.sparkSession, "uneven")
    uneven = materialise(sums.where("n != 0 OR digest != 0").select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("_bucket").alias("_at")), folder)
    few = uneven.count() <= LIST_ROWS

    def open_rows(table: DataFrame, sign: int) -> DataFrame:
        rows = table.select(*columns, bucket)
        same = rows["_bucket"] == uneven["_at"]
        for key in keys:
            same &= rows[key].eqNullSafe(uneven[f"_{key}"])
        return rows.join(F.broadcast(uneven) if few else uneven, same, "left_semi").select(*columns, F.lit(sign).alias("_sign"))

    left = open_rows(expected, 1).unionByName(open_rows(actual, -1)).groupBy(*columns).agg(F.sum("_sign").alias("_sign"))
    side = F.when(F.col("_sign") > 0, "MISSING").otherwise("EXTRA").alias("side")
    return left.where("_sign != 0").select(side, F.abs("_sign").alias("copies"), *columns)


def run_summary(counters: DataFrame) -> DataFrame:
    """Run counters with the share of rows kept and the share of hourly rows, in percent."""
    percent = lambda part, whole: round_half_even(ratio(F.col(part), F.col(whole)) * F.lit(100.0), 2)
    return counters.select(
        "scanned_rows",
        "cleaned_rows",
        "hourly_rows",
        "file_count",
        percent("cleaned_rows", "scanned_rows").alias("retained_pct"),
        percent("hourly_rows", "cleaned_rows").alias("hourly_pct"),
    )


def packed_order(records: DataFrame, order: Sequence[str]) -> Column:
    """One number that orders rows as the columns do, the first one first; NULL precedes all values."""
    kinds, number, used = dict(records.dtypes), F.lit(0).cast("decimal(38,0)"), 0
    for name in order:
        width, least = ORDER_DIGITS[kinds[name].removesuffix("_ntz")]
        used += width
        value = F.col(name)
        if kinds[name].startswith("timestamp"):
            value = F.unix_micros(value.cast("timestamp"))
        place = F.coalesce(value.cast("decimal(38,0)") + F.lit(str(1 - least)).cast("decimal(38,0)"), F.lit("0").cast("decimal(38,0)"))
        number = (number * F.lit(str(10**width)).cast("decimal(38,0)") + place).cast("decimal(38,0)")
    if used > 38:
        raise ValueError("the order columns do not fit one number")
    return number


def _greatest(rows: DataFrame, job: str, number: Column) -> DataFrame:
    """Rows whose number is their job's greatest; jobs meet by hash, a job's rows spread by their numbers."""
    numbered = rows.withColumn("_number", number)
    last = numbered.groupBy(job).agg(F.max("_number").alias("_last")).withColumnRenamed(job, "_job")
    newest = numbered[job].eqNullSafe(last["_job"]) & (numbered["_number"] == last["_last"])
    return numbered.join(last, newest, "left_semi").drop("_number")


def latest_status(records: DataFrame, job: str = "job_id", order: Sequence[str] = ("at",)) -> DataFrame:
    """The last record of every job; of different records that tie in every order column, one chosen by hash.

    Numbers are compared, never text: each task keeps one number per job by hash, and the record itself
    is fetched by job and number. Neither step sorts a job's records or brings them to one place.
    """
    rest = [c for c in records.columns if c not in (job, *order)]
    newest = _greatest(records, job, packed_order(records, order))
    return _greatest(newest, job, F.xxhash64(*rest, F.lit(0))).distinct().select(job, *order, *rest)


def domain_rules(
    year: Column, month: Column, gantry: Column, first_year: int = 2020, last_year: int = 2099
) -> dict[str, Column]:
    """Named row checks; each is true for a violation and never NULL."""
    violated = lambda sound: ~F.coalesce(sound, F.lit(False))
    return {
        "year": violated(year.between(first_year, last_year)),
        "month": violated(month.between(1, 12)),
        "gantry_id": violated(gantry.rlike(f"^{GANTRY_ID_PATTERN}$")),
    }


def domain_check(table: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Rows and violations per rule, all rules in one pass."""
    counted = [F.struct(F.lit(n).alias("rule"), F.count_if(c).alias("violations")) for n, c in rules.items()]
    return table.agg(F.count(F.lit(1)).alias("rows"), F.array(*counted).alias("counted")).select(
        F.inline("counted"), "rows"
    )


def id_list(text: Column) -> Column:
    """A comma-separated list as trimmed, non-empty ids."""
    return F.filter(F.transform(F.split(text, ","), lambda p: F.btrim(p)), lambda p: p != "")
