"""Statistics against plain Python over the same rows."""

import json
import math
import random
import statistics
from collections import defaultdict

import pytest

from gantrylake.operators import grids, profile
from gantrylake.schemas import VEHICLE_CODES


@pytest.fixture(scope="module")
def cells():
    rng = random.Random(7)
    rows = []
    for gantry, scale in (("a", 50), ("b", 5)):
        for day in range(1, 29):
            for hour in rng.sample(range(24), 8):
                for code in (31, 5, 99):
                    rows.append((day, hour, gantry, code, rng.randint(1, scale) * (12 if day == 13 else 1)))
    return rows


def sums(cells, key):
    out = defaultdict(int)
    for day, hour, gantry, code, counts in cells:
        out[key(day, hour, gantry, code)] += counts
    return out


def test_gantry_stats_and_anomalies(lake, cells):
    hourly = lake(cells)
    daily, by_hour = sums(cells, lambda d, h, g, c: (g, d)), sums(cells, lambda d, h, g, c: (g, h))
    stats = {r.gantry_id_o: r for r in profile.gantry_stats(hourly).collect()}
    odd = {(r.gantry_id_o, r.day): r.z for r in profile.anomaly_days(hourly).collect()}
    for g in "ab":
        totals = {d: t for (q, d), t in daily.items() if q == g}
        hours = {h: t for (q, h), t in by_hour.items() if q == g}
        mean, std = statistics.mean(totals.values()), statistics.pstdev(totals.values())
        row = stats[g]
        assert (row.days_with_data, row.daily_total_mean, row.daily_total_std) == (len(totals), int(mean), int(std))
        peak = min(hours, key=lambda h: (-hours[h], h))
        off = min(hours, key=lambda h: (hours[h], h))
        assert (row.peak_hour, row.off_hour) == (peak, off)
        assert row.peak_hour_avg == round(hours[peak] / len(totals), 1)
        want = {(g, d): round((t - mean) / std, 2) for d, t in totals.items() if abs((t - mean) / std) >= 2}
        assert {k: v for k, v in odd.items() if k[0] == g} == pytest.approx(want)
        assert (g, 13) in want


def test_documents_agree_with_the_tables(lake, cells):
    hourly = lake(cells)
    stats = {r.gantry_id_o: r.asDict() for r in profile.gantry_stats(hourly).collect()}
    shares = {(r.gantry_id_o, r.label): r.share_pct for r in profile.vehicle_share(hourly).collect()}
    weekdays = {(r.gantry_id_o, r.label): r.daily_avg for r in profile.weekday_average(hourly).collect()}
    odd = {(r.gantry_id_o, r.day, r.total, r.z) for r in profile.anomaly_days(hourly).collect()}
    for row in profile.stats_documents(hourly).collect():
        g, document = row.gantry_id_o, json.loads(row.document)
        assert {k: document[k] for k in stats[g] if k != "gantry_id_o"} == {k: v for k, v in stats[g].items() if k != "gantry_id_o"}
        assert document["vehicle_share_pct"] == {label: v for (q, label), v in shares.items() if q == g}
        assert document["weekday_daily_avg"] == {label: v for (q, label), v in weekdays.items() if q == g}
        assert {(g, a["day"], a["total"], a["z"]) for a in document["anomaly_days"]} == {o for o in odd if o[0] == g}
        assert "VT=99(?)" in document["vehicle_share_pct"]


def test_shares_sum_to_hundred(lake, cells):
    total = defaultdict(float)
    for r in profile.vehicle_share(lake(cells)).collect():
        total[r.gantry_id_o] += r.share_pct
    assert all(math.isclose(t, 100, abs_tol=0.05) for t in total.values())


def test_no_variance_means_no_anomaly_and_deviation_one(lake):
    flat = lake([(d, 8, "a", 31, 10) for d in range(1, 8)])
    assert profile.anomaly_days(flat).count() == 0
    assert profile.gantry_stats(flat).first().daily_total_std == 1


def test_missing_hours_show_in_an_anomalous_day(lake):
    rows = [(d, h, "a", 31, 100) for d in range(1, 11) for h in range(24) if not (d == 6 and 15 <= h <= 17)]
    (day,) = profile.anomaly_days(lake(rows)).collect()
    assert (day.day, day.observed_hours) == (6, 21)


def test_equal_hours_take_the_smallest(lake):
    row = profile.peak_hours(lake([(1, h, "a", 31, 5) for h in (3, 9, 21)])).first()
    assert (row.peak_hour, row.off_hour) == (3, 3)


def test_denominators_differ_by_statistic(lake):
    rows = lake([(1, 8, "a", 31, 10), (2, 9, "a", 31, 30), (8, 8, "a", 31, 20)])
    by_days = {r.hour_0: r.hour_avg for r in profile.hour_profile(rows).collect()}
    assert by_days == {8: 10.0, 9: 10.0}
    by_cells = {r.hour_0: r.mean for r in profile.mean_24h(rows).collect()}
    assert (by_cells[8], by_cells[9], by_cells[0], len(by_cells)) == (15.0, 30.0, 0.0, 24)
    assert {r.weekday: r.daily_avg for r in profile.weekday_average(rows).collect()} == {7: 15.0, 1: 30.0}
    filled = {r.weekday: r.daily_avg for r in profile.vehicle_weekday_average(rows).collect()}
    assert (filled[7], filled[1], filled[3], len(filled)) == (15.0, 30.0, 0.0, 7)


def test_rounding_takes_ties_to_even(spark):
    from pyspark.sql import functions as F

    from gantrylake.functions.numbers import round_half_even

    frame = spark.createDataFrame([(v,) for v in (0.125, 0.375, 3.125, 2.675)], "v double")
    assert [r[0] for r in frame.select(round_half_even(F.col("v"), 2)).collect()] == [0.12, 0.38, 3.12, 2.68]


def test_grids_are_dense(lake, cells):
    hourly = lake(cells)
    want = sums(cells, lambda d, h, g, c: (g, d, h))
    grid = {(r.gantry_id_o, r.day, r.hour_0): r.counts for r in grids.hour_grid(hourly).collect()}
    assert len(grid) == 2 * 28 * 24
    assert {k: v for k, v in grid.items() if v} == dict(want)
    pivot = grids.hour_day_pivot(hourly).collect()
    assert len(pivot) == 48
    assert all(r[f"day_{d:02d}"] == want.get((r.gantry_id_o, d, r.hour_0), 0) for r in pivot for d in range(1, 32))
    weekdays = grids.weekday_vehicle_totals(lake([(1, 0, "a", 31, 4)]), VEHICLE_CODES).collect()
    assert [(r.weekday, r.vt_31, r.vt_5) for r in weekdays] == [(w, 4 if w == 7 else 0, 0) for w in range(1, 8)]


def test_profiles_read_the_hourly_table_once(lake, cells, spark, tmp_path):
    lake(cells).write.parquet(str(tmp_path / "h"))
    hourly = spark.read.parquet(str(tmp_path / "h"))
    for function in (
        profile.gantry_stats, profile.hour_profile, profile.anomaly_days, profile.stats_documents,
        profile.vehicle_share, profile.mean_24h, grids.hour_day_pivot,
    ):
        plan = function(hourly)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan") == 1
        assert "Join" not in plan


def test_unavailable_gantries_are_listed(spark, lake):
    requested = spark.createDataFrame([("a",), ("z",)], "gantry_id string")
    rows = profile.gantry_availability(lake([(1, 0, "a", 31, 1)]), requested).collect()
    assert sorted((r.gantry_id, r.rows, r.available) for r in rows) == [("a", 1, True), ("z", 0, False)]
