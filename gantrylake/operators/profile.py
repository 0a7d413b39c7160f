"""Statistics per gantry on the hourly table.

Inputs are already counted rows, so a group is bounded by the calendar: a gantry has at most
hours × vehicle types rows per day, however many trips it saw. Where a statistic needs several
levels (day totals, then their mean) the levels nest; the hourly table is read once.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gantrylake.functions.calendar import hour_bit
from gantrylake.functions.coercion import to_calendar_date
from gantrylake.functions.labels import vehicle_label, weekday_label
from gantrylake.functions.numbers import round_half_even
from gantrylake.operators.grids import cell_sum, cells
from gantrylake.schemas import ANOMALY_Z, DATE_KEYS, HOURS, VEHICLE_CODES, WEEKDAYS

GANTRY = "gantry_id_o"


def daily_total(hourly: DataFrame) -> DataFrame:
    return hourly.groupBy(GANTRY, *DATE_KEYS).agg(F.sum("counts").alias("total"))


def daily_total_by_date(hourly: DataFrame) -> DataFrame:
    """Day totals over many months with a real date; NULL where month and day do not fit."""
    daily = hourly.groupBy("yyyymm", "day", GANTRY).agg(F.sum("counts").alias("total"))
    return daily.withColumn("date", to_calendar_date(F.col("yyyymm"), F.col("day")))


def day_hour_total(hourly: DataFrame) -> DataFrame:
    return hourly.groupBy(GANTRY, *DATE_KEYS, "hour_0").agg(F.sum("counts").alias("total"))


def vehicle_total(hourly: DataFrame) -> DataFrame:
    """Rows and trips per vehicle type: the acceptance check of a finished table."""
    return hourly.groupBy("vehicle_type").agg(F.count(F.lit(1)).alias("rows"), F.sum("counts").alias("total"))


def vehicle_share(hourly: DataFrame) -> DataFrame:
    """Percent of a gantry's trips per vehicle type, two places."""
    totals = hourly.groupBy(GANTRY, "vehicle_type").agg(F.sum("counts").alias("total"))
    whole = F.sum("total").over(Window.partitionBy(GANTRY))
    return totals.select(
        GANTRY,
        "vehicle_type",
        vehicle_label(F.col("vehicle_type")).alias("label"),
        "total",
        round_half_even(F.col("total").cast("double") / whole * F.lit(100.0), 2).alias("share_pct"),
    )


def weekday_average(hourly: DataFrame) -> DataFrame:
    """Mean of the day totals per weekday; only days with data of that weekday count."""
    daily = hourly.groupBy(GANTRY, "weekday", *DATE_KEYS).agg(F.sum("counts").alias("total"))
    means = daily.groupBy(GANTRY, "weekday").agg(
        F.count(F.lit(1)).alias("days"), F.sum("total").alias("total")
    )
    return means.select(
        GANTRY,
        "weekday",
        weekday_label(F.col("weekday")).alias("label"),
        "days",
        round_half_even(F.col("total").cast("double") / F.col("days"), 1).alias("daily_avg"),
    )


def vehicle_weekday_average(hourly: DataFrame, codes: Sequence[int] = VEHICLE_CODES) -> DataFrame:
    """Mean day total per vehicle type and weekday for known codes; weekdays without data are 0."""
    daily = (
        hourly.where(F.col("vehicle_type").isin(list(codes)))
        .groupBy(GANTRY, "vehicle_type", "weekday", *DATE_KEYS)
        .agg(F.sum("counts").alias("total"))
    )
    grid = cells({"weekday": str(w), "daily_avg": _mean_where("weekday", w)} for w in WEEKDAYS)
    return daily.groupBy(GANTRY, "vehicle_type").agg(grid).select(GANTRY, "vehicle_type", F.inline("cells"))


def mean_24h(hourly: DataFrame) -> DataFrame:
    """Mean over the day-hours that exist, per hour; an hour that never occurs is 0."""
    grid = cells({"hour_0": str(h), "mean": _mean_where("hour_0", h)} for h in HOURS)
    return day_hour_total(hourly).groupBy(GANTRY).agg(grid).select(GANTRY, F.inline("cells"))


def _mean_where(axis: str, value: int) -> str:
    hit = f"CASE WHEN {axis} = {value} THEN total END"
    return f"coalesce(CAST(sum({hit}) AS DOUBLE) / nullif(count({hit}), 0), 0.0D)"


def gantry_days(hourly: DataFrame) -> DataFrame:
    """One row per gantry and day: total, 24 hour sums (NULL where absent), hours observed."""
    hour_sums = F.expr(f"array({', '.join(cell_sum('hour_0', h) for h in HOURS)})")
    return hourly.groupBy(GANTRY, *DATE_KEYS).agg(
        F.sum("counts").alias("total"),
        hour_sums.alias("hours"),
        F.bit_count(F.bit_or(hour_bit(F.col("hour_0")))).alias("observed_hours"),
    )


def gantry_summary(hourly: DataFrame) -> DataFrame:
    """Per gantry: days with data, sum and sum of squares of day totals, sums of occurring hours."""
    hour_sums = cells({"hour_0": str(h), "total": f"sum(hours[{h}])"} for h in HOURS)
    square = F.col("total").cast("decimal(19,0)") * F.col("total").cast("decimal(19,0)")
    per_gantry = gantry_days(hourly).groupBy(GANTRY).agg(
        F.count(F.lit(1)).alias("days"),
        F.sum("total").alias("total"),
        F.sum(square.cast("decimal(38,0)")).alias("squares"),
        hour_sums.alias("hours"),
    )
    return per_gantry.withColumn("hours", F.filter("hours", lambda h: h["total"].isNotNull()))


def hour_profile(hourly: DataFrame) -> DataFrame:
    """Sum per hour over the number of days with data (not the days having that hour)."""
    return gantry_summary(hourly).select(GANTRY, "days", F.inline("hours")).select(
        GANTRY, "hour_0", "total", "days", (F.col("total").cast("double") / F.col("days")).alias("hour_avg")
    )


def spread(n: Column, total: Column, squares: Column) -> Column:
    """n·Σt² − (Σt)²: n² times the population variance, exact."""
    s = total.cast("decimal(19,0)")
    return (n.cast("decimal(9,0)") * squares).cast("decimal(38,0)") - (s * s).cast("decimal(38,0)")


def _offset(n: Column, day_total: Column, total: Column) -> Column:
    """n·t − Σt: n times the distance of a day from the mean, exact."""
    scaled = (n.cast("decimal(9,0)") * day_total.cast("decimal(19,0)")).cast("decimal(38,0)")
    return (scaled - total.cast("decimal(38,0)")).cast("decimal(19,0)")


def _squared(threshold: str) -> Column:
    return F.lit(Decimal(threshold) ** 2).cast("decimal(6,4)")


def gantry_stats(hourly: DataFrame) -> DataFrame:
    """Days, mean and population deviation of day totals, busiest and quietest hour.

    Mean and deviation are truncated to integers; a zero deviation reads 1. Among equal hours the
    smallest wins.
    """
    per_gantry = gantry_summary(hourly)
    days = F.col("days")
    deviation = F.sqrt(spread(days, F.col("total"), F.col("squares")).cast("double")) / days
    peak = F.array_max(F.transform("hours", lambda h: F.struct(h["total"], -h["hour_0"])))
    off = F.array_min(F.transform("hours", lambda h: F.struct(h["total"], h["hour_0"])))
    average = lambda total: round_half_even(total.cast("double") / days, 1)
    return per_gantry.withColumns({"peak": peak, "off": off}).select(
        GANTRY,
        days.alias("days_with_data"),
        F.call_function("div", F.col("total"), days).alias("daily_total_mean"),
        F.when(deviation > 0, deviation).otherwise(F.lit(1.0)).cast("bigint").alias("daily_total_std"),
        (-F.col("peak.col2")).alias("peak_hour"),
        average(F.col("peak.total")).alias("peak_hour_avg"),
        F.col("off.hour_0").alias("off_hour"),
        average(F.col("off.total")).alias("off_hour_avg"),
    )


def peak_hours(hourly: DataFrame) -> DataFrame:
    return gantry_stats(hourly).select(GANTRY, "peak_hour", "peak_hour_avg", "off_hour", "off_hour_avg")


def anomaly_days(hourly: DataFrame, threshold: str = ANOMALY_Z) -> DataFrame:
    """Days whose total lies at least ``threshold`` population deviations from the gantry's mean.

    The test runs in integers, (n·t − S)² ≥ z²·(n·Q − S²), so no rounding decides it; a gantry
    without variance has no anomaly. ``observed_hours`` tells a gap in the input from real traffic.
    """
    whole = Window.partitionBy(GANTRY)
    t = F.col("total").cast("decimal(19,0)")
    days = (
        hourly.groupBy(GANTRY, *DATE_KEYS)
        .agg(
            F.sum("counts").alias("total"),
            F.bit_count(F.bit_or(hour_bit(F.col("hour_0")))).alias("observed_hours"),
        )
        .withColumn("n", F.count(F.lit(1)).over(whole))
        .withColumn("s", F.sum("total").over(whole))
        .withColumn("q", F.sum((t * t).cast("decimal(38,0)")).over(whole))
    )
    measured = days.withColumns(
        {
            "spread": spread(F.col("n"), F.col("s"), F.col("q")),
            "offset": _offset(F.col("n"), F.col("total"), F.col("s")),
        }
    )
    far = F.col("offset") * F.col("offset") >= _squared(threshold) * F.col("spread").cast("decimal(31,0)")
    z = F.col("offset").cast("double") / F.sqrt(F.col("spread").cast("double"))
    return measured.where((F.col("spread") > 0) & far).select(
        GANTRY, *DATE_KEYS, "total", "observed_hours", round_half_even(z, 2).alias("z")
    )


def gantry_availability(hourly: DataFrame, requested: DataFrame) -> DataFrame:
    """Every requested gantry with its row count, flagged when it has none."""
    present = hourly.groupBy(F.col(GANTRY)).agg(F.count(F.lit(1)).alias("n"))
    joined = requested.join(present, requested["gantry_id"] == present[GANTRY], "left")
    return joined.select(
        "gantry_id", F.coalesce("n", F.lit(0)).alias("rows"), F.col("n").isNotNull().alias("available")
    )


def global_stats(hourly: DataFrame) -> DataFrame:
    """Row count and the sorted days of the month that occur (at most 31)."""
    per_day = hourly.groupBy("day").agg(F.count(F.lit(1)).alias("n"))
    return per_day.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
        F.sort_array(F.collect_list("day")).alias("days_covered"),
    )


def global_document(hourly: DataFrame) -> DataFrame:
    """One JSON document over all gantries: rows and the days of the month that occur."""
    return global_stats(hourly).select(F.to_json(F.struct("total_rows", "days_covered")).alias("document"))


def requested_documents(hourly: DataFrame, requested: DataFrame, threshold: str = ANOMALY_Z) -> DataFrame:
    """A document for every requested gantry with its label; one without data says so.

    ``requested`` has the columns ``gantry_id`` and ``label``; a gantry without label has none in its document.
    """
    stats = stats_structs(hourly, threshold).select(F.col(GANTRY).alias("gantry_id"), "stats")
    parts = [F.col(f"stats.{name}") for name in stats.schema["stats"].dataType.names if name not in ("gantry_id", "available")]
    document = F.struct("label", "gantry_id", F.col("stats").isNotNull().alias("available"), *parts)
    return requested.join(stats, "gantry_id", "left").select("gantry_id", F.to_json(document).alias("document"))


def stats_documents(hourly: DataFrame, threshold: str = ANOMALY_Z) -> DataFrame:
    """One JSON document per gantry, its id inside."""
    return stats_structs(hourly, threshold).select(GANTRY, F.to_json("stats").alias("document"))


def stats_structs(hourly: DataFrame, threshold: str = ANOMALY_Z) -> DataFrame:
    """The statistics of each gantry as one struct, from a single pass over the hourly table.

    Three grouping sets (day, hour, vehicle type) share one exchange; what then meets per gantry is
    a row per calendar day, 24 hours and the vehicle types, never the trips themselves.
    """
    sets = [[GANTRY, *DATE_KEYS, "weekday"], [GANTRY, "hour_0"], [GANTRY, "vehicle_type"]]
    columns = [GANTRY, *DATE_KEYS, "weekday", "hour_0", "vehicle_type"]
    cells = hourly.groupingSets([[F.col(c) for c in s] for s in sets], *columns).agg(
        F.sum("counts").alias("total"),
        F.grouping("day").alias("no_day"),
        F.grouping("hour_0").alias("no_hour"),
        F.grouping("vehicle_type").alias("no_type"),
    )
    is_day = F.col("no_day") == 0
    day_total = F.when(is_day, F.col("total").cast("decimal(19,0)"))
    gathered = cells.groupBy(GANTRY).agg(
        F.count(F.when(is_day, F.lit(1))).alias("n"),
        F.sum(F.when(is_day, F.col("total"))).alias("total"),
        F.sum((day_total * day_total).cast("decimal(38,0)")).alias("squares"),
        _sorted_list(is_day, "year", "month", "day", "weekday", "total").alias("days"),
        _sorted_list(F.col("no_hour") == 0, "hour_0", "total").alias("hours"),
        _sorted_list(F.col("no_type") == 0, "vehicle_type", "total").alias("types"),
    )
    measured = gathered.withColumns(
        {
            "spread": spread(F.col("n"), F.col("total"), F.col("squares")),
            "peak": F.array_max(F.transform("hours", lambda h: F.struct(h["total"], -h["hour_0"]))),
            "off": F.array_min(F.transform("hours", lambda h: F.struct(h["total"], h["hour_0"]))),
        }
    ).withColumn("root", F.sqrt(F.col("spread").cast("double")))
    n, root = F.col("n"), F.col("root")
    average = lambda total: round_half_even(total.cast("double") / n, 1)
    document = F.struct(
        F.col(GANTRY).alias("gantry_id"),
        F.lit(True).alias("available"),
        n.alias("days_with_data"),
        F.call_function("div", F.col("total"), n).alias("daily_total_mean"),
        F.when(root > 0, root / n).otherwise(F.lit(1.0)).cast("bigint").alias("daily_total_std"),
        (-F.col("peak.col2")).alias("peak_hour"),
        average(F.col("peak.total")).alias("peak_hour_avg"),
        F.col("off.hour_0").alias("off_hour"),
        average(F.col("off.total")).alias("off_hour_avg"),
        _share_map().alias("vehicle_share_pct"),
        _weekday_map().alias("weekday_daily_avg"),
        _anomaly_list(threshold).alias("anomaly_days"),
    )
    return measured.select(GANTRY, document.alias("stats"))


def _sorted_list(condition: Column, *fields: str) -> Column:
    return F.sort_array(F.collect_list(F.when(condition, F.struct(*fields))))


def _share_map() -> Column:
    share = lambda v: v["total"].cast("double") / F.col("total") * F.lit(100.0)
    return F.map_from_entries(
        F.transform("types", lambda v: F.struct(vehicle_label(v["vehicle_type"]), round_half_even(share(v), 2)))
    )


def _weekday_map() -> Column:
    def entry(weekday: int) -> Column:
        hits = F.filter("days", lambda d: d["weekday"] == weekday)
        total = F.aggregate(hits, F.lit(0).cast("bigint"), lambda a, d: a + d["total"])
        mean = total.cast("double") / F.nullif(F.size(hits), F.lit(0))
        return F.struct(weekday_label(F.lit(weekday)).alias("key"), round_half_even(mean, 1).alias("value"))

    entries = F.array(*[entry(w) for w in WEEKDAYS])
    return F.map_from_entries(F.filter(entries, lambda e: e["value"].isNotNull()))


def _anomaly_list(threshold: str) -> Column:
    limit = _squared(threshold) * F.col("spread").cast("decimal(31,0)")
    offset = lambda d: _offset(F.col("n"), d["total"], F.col("total"))
    far = F.filter("days", lambda d: (F.col("spread") > 0) & (offset(d) * offset(d) >= limit))
    return F.transform(
        far,
        lambda d: F.struct(
            *[d[c].alias(c) for c in (*DATE_KEYS, "total")],
            round_half_even(offset(d).cast("double") / F.col("root"), 2).alias("z"),
        ),
    )
