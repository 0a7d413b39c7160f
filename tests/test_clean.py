import datetime as dt

import pytest
from sample_trips import TARGETS, raw_row
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gantrylake.functions.calendar import day_window, week_of_month
from gantrylake.functions.coercion import to_calendar_date, to_number, to_wall_clock, to_whole_number
from gantrylake.operators import clean, hourly


def values(spark, function, texts):
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r[0] for r in frame.orderBy("i").select(function(F.col("t"))).collect()]


def test_codes(spark):
    texts = ["31", " 31 ", "31.0", "3.1e1", "+31", "31abc", "31d", "31.5", "NaN", "Infinity", "", None, "abc", "0x1F"]
    assert values(spark, to_whole_number, texts) == [31] * 5 + [None] * 9


def test_numbers(spark):
    texts = ["10.5", "-1", ".5", "5.", "1e3", "10.5f", "NaN", "inf", "", None, "1,5", "\t7\n"]
    assert values(spark, to_number, texts) == [10.5, -1.0, 0.5, 5.0, 1000.0, None, None, None, None, None, None, 7.0]


def test_times(spark):
    good = dt.datetime(2026, 3, 1, 8, 0, 0)
    texts = [
        "2026-03-01 08:00:00", " 2026-03-01 08:00:00", "2026-03-01 08:00:00.5", "2026-03-01 08:00:00 junk",
        "2026-03-01", "2026-03-31 25:99:99", "2026-02-31 00:00:00", "2026-3-1 08:00:00", "2026-03-01T08:00:00",
        "invalid", "", None,
    ]
    assert values(spark, to_wall_clock, texts) == [good] * 4 + [None] * 8


def test_times_do_not_follow_the_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert values(spark, to_wall_clock, ["2026-03-08 02:30:00"]) == [dt.datetime(2026, 3, 8, 2, 30)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_dates_from_pieces(spark):
    frame = spark.createDataFrame([("202602", 28), ("202602", 30), ("202603", 131), ("202603", 1)], "m string, d int")
    got = [r[0] for r in frame.select(to_calendar_date(F.col("m"), F.col("d"))).collect()]
    assert got == [dt.date(2026, 2, 28), None, None, dt.date(2026, 3, 1)]


def cleaned(raw, *rows, gantries=TARGETS, **window):
    window = {"year": 2026, "month": 3, **window}
    return clean.clean_trips(raw(*rows), gantries, **window)


def test_origin_wins_then_destination(raw):
    rows = [
        raw_row(),
        raw_row(GantryID_O="05F0055N", GantryID_D="01F3019S"),
        raw_row(GantryID_O="01F2930S", GantryID_D="01F3019S"),
        raw_row(GantryID_O="05F0055N", GantryID_D="05F0287N"),
        raw_row(GantryID_O="05F0055N", GantryID_D=None),
    ]
    assert [r.TargetGantry for r in cleaned(raw, *rows).collect()] == ["01F2930N", "01F3019S", "01F2930S"]


@pytest.mark.parametrize(
    "fields",
    [
        {"DetectionTime_O": "2025-03-01 08:00:00"},
        {"DetectionTime_O": "2026-04-01 00:00:00"},
        {"DetectionTime_O": "2026-02-28 23:59:59"},
        {"DetectionTime_O": "invalid"},
        {"VehicleType": "abc"},
        {"GantryID_O": ""},
        {"GantryID_O": "   ", "GantryID_D": "01F2930N"},
        {"GantryID_O": None, "GantryID_D": "01F2930N"},
    ],
)
def test_dropped(raw, fields):
    assert cleaned(raw, raw_row(**fields)).count() == 0
    assert hourly.hourly_counts(raw(raw_row(**fields)), TARGETS, 2026, 3).count() == 0


def test_ids_are_trimmed_and_length_may_be_missing(raw):
    row = cleaned(raw, raw_row(GantryID_O=" 01F2930N\t", TripLength="n/a")).first()
    assert (row.GantryID_O, row.TripLength) == ("01F2930N", None)


@pytest.mark.parametrize("day, weekday", [(1, 7), (2, 1), (7, 6)])
def test_weekday_is_iso(raw, day, weekday):
    assert cleaned(raw, raw_row(DetectionTime_O=f"2026-03-{day:02d} 00:00:00")).first().Weekday == weekday


def test_day_range(raw):
    rows = [raw_row(DetectionTime_O=f"2026-03-{d:02d} 23:59:59") for d in (1, 5, 15, 20, 31)]
    kept = cleaned(raw, *rows, day_start=5, day_end=20).select("Day").collect()
    assert sorted(r.Day for r in kept) == [5, 15, 20]
    assert cleaned(raw, *rows).count() == 5


@given(st.integers(2020, 2099), st.integers(1, 12), st.integers(1, 31), st.integers(1, 31))
def test_day_window_is_half_open_within_the_month(year, month, start, end):
    lower, upper = day_window(year, month, start, end)
    day = dt.datetime(year, month, 1)
    while day.month == month:
        assert (lower <= day < upper) == (start <= day.day <= end)
        day += dt.timedelta(days=1)
    assert not lower <= day < upper


def test_empty_list_keeps_all_and_counts_at_destination(raw):
    rows = [raw_row(GantryID_O="05F0055N", GantryID_D="05F0287N"), raw_row(GantryID_D=None)]
    assert [r.TargetGantry for r in cleaned(raw, *rows, gantries=[]).collect()] == ["05F0287N", None]
    assert [r.gantry_id_o for r in hourly.hourly_counts(raw(*rows), [], 2026, 3).collect()] == ["05F0287N"]


def test_list_as_table_agrees_with_list(spark, raw):
    rows = [
        raw_row(), raw_row(GantryID_O="05F0055N", GantryID_D="01F3019S"), raw_row(GantryID_O="x", GantryID_D="y"),
        raw_row(GantryID_D=None), raw_row(VehicleType="abc"),
    ]
    listed = spark.createDataFrame([(g,) for g in [*TARGETS, TARGETS[0]]], "gantry_id string")
    by_table = clean.clean_trips_by_table(raw(*rows), listed).groupBy("TargetGantry").count()
    by_list = clean.clean_trips(raw(*rows), TARGETS).groupBy("TargetGantry").count()
    assert sorted(by_table.collect()) == sorted(by_list.collect())


def test_quarantine_keeps_the_raw_row(raw):
    rows = [raw_row(), raw_row(VehicleType="abc"), raw_row(GantryID_O=" "), raw_row(DetectionTime_O="x", VehicleType="y")]
    bad = clean.quarantine(raw(*rows)).collect()
    assert [(r.VehicleType, r.GantryID_O, r.reject_reason) for r in bad] == [
        ("abc", "01F2930N", "vehicle_type"), ("31", " ", "gantry_id"), ("y", "01F2930N", "detection_time"),
    ]


def test_counting_merging_and_order(raw):
    rows = [raw_row(), raw_row(), raw_row(VehicleType="5"), raw_row(DetectionTime_O="2026-03-01 07:10:00")]
    whole = hourly.count_hourly(cleaned(raw, *rows))
    key = lambda r: (r.Hour_0, r.VehicleType, r.counts)
    assert [key(r) for r in hourly.in_canonical_order(whole).collect()] == [(7, 31, 1), (8, 5, 1), (8, 31, 2)]
    parts = [hourly.count_hourly(cleaned(raw, *part)) for part in (rows[:1], rows[1:2], rows[2:])]
    assert sorted(map(key, hourly.merge_hourly(*parts).collect())) == sorted(map(key, whole.collect()))


def test_both_ways_of_counting_agree(raw):
    rows = [raw_row(), raw_row(GantryID_O="q"), raw_row(VehicleType="abc"), raw_row(GantryID_O="q", GantryID_D="01F3019N")]
    direct = hourly.hourly_counts(raw(*rows), TARGETS, 2026, 3)
    by_rows = hourly.to_lake_rows(hourly.add_week_index(hourly.count_hourly(cleaned(raw, *rows))))
    assert sorted(direct.collect()) == sorted(by_rows.collect())
    assert direct.dtypes == by_rows.dtypes


@pytest.mark.parametrize("day, week", [(1, 1), (7, 1), (8, 2), (31, 5)])
def test_week_of_month(spark, day, week):
    assert spark.range(1).select(week_of_month(F.lit(day))).first()[0] == week


def test_hot_gantry_leaves_the_map_side_counted(spark):
    """A third of all trips on one gantry and hour: the exchange sees key rows, not trips."""
    trips = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, "01F2930N").otherwise(F.concat(F.lit("g"), F.col("id") % 50)).alias("TargetGantry"),
        *[F.lit(v).alias(k) for k, v in {"Year": 2026, "Month": 3, "Day": 1, "Weekday": 7, "Hour_0": 8, "VehicleType": 31}.items()],
    )
    counts = hourly.count_hourly(trips)
    assert counts.where("GantryID_O = '01F2930N'").first().counts == 10000
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_count") > plan.index("Exchange")
