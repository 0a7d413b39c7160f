import datetime as dt

import pytest
from pyspark.sql import functions as F

from gantrylake.functions.text import normalise, tidy_label
from gantrylake.operators import dims, paths, quality


def inventory(spark, entries):
    return spark.createDataFrame(
        [(f"TRIPS_{day}_{hour:02d}0000.csv", size) for day, hour, size in entries], "file_name string, size bigint"
    )


@pytest.fixture
def february(spark):
    return quality.day_calendar(spark, dt.date(2026, 2, 1), dt.date(2026, 2, 28))


def full_month():
    return [(f"202602{d:02d}", h, 10) for d in range(1, 29) for h in range(24)]


def month_row(spark, calendar, entries):
    return quality.month_completeness(inventory(spark, entries), calendar).first()


def test_full_month_is_complete(spark, february):
    row = month_row(spark, february, full_month())
    assert (row.files, row.expected_files, row.complete_days, row.is_complete) == (672, 672, 28, True)
    assert quality.missing_hours(inventory(spark, full_month()), february).count() == 0


def test_one_missing_or_empty_hour_breaks_the_month(spark, february):
    short = [e for e in full_month() if e[:2] != ("20260215", 16)]
    empty = [(d, h, 0 if (d, h) == ("20260215", 16) else s) for d, h, s in full_month()]
    for entries in (short, empty):
        assert not month_row(spark, february, entries).is_complete
        gaps = quality.missing_hours(inventory(spark, entries), february).collect()
        assert [(g.date, g.hour_0) for g in gaps] == [(dt.date(2026, 2, 15), 16)]


def test_days_without_any_file_count(spark, february):
    entries = [("20260201", h, 1) for h in range(24)]
    assert month_row(spark, february, entries).complete_days == 1
    assert quality.missing_hours(inventory(spark, entries), february).count() == 27 * 24


def test_foreign_names_are_left_out(spark):
    names = spark.createDataFrame([("readme.txt", 5), ("TRIPS_20260201_050000.csv", 7)], "file_name string, size bigint")
    (row,) = quality.files_per_day(names).collect()
    assert (row.yyyymmdd, row.files, row.bytes) == ("20260201", 1, 7)


def test_pending_files(spark):
    remote = inventory(spark, [("20260201", 0, 5), ("20260201", 1, 5), ("20260201", 2, 5)])
    local = inventory(spark, [("20260201", 0, 5), ("20260201", 1, 4)])
    rows = quality.pending_files(remote, local).collect()
    assert sorted((r.file_name[-10:-8], r.reason) for r in rows) == [("01", "size"), ("02", "absent")]


def test_reconcile_sees_duplicates_and_order_does_not_matter(spark):
    table = lambda rows: spark.createDataFrame(rows, "day int, v int")
    expected = table([(1, 1), (1, 2), (2, 5), (2, 5), (3, 1), (4, 1), (6, 1), (6, 1)])
    actual = table([(1, 2), (1, 1), (2, 5), (2, 6), (3, 1), (5, 1), (6, 2), (6, 2)])
    status = {r.day: r.status for r in quality.reconcile(expected, actual, ["day"]).collect()}
    assert status == {1: "PASS", 2: "FAIL", 3: "PASS", 4: "MISSING", 5: "EXTRA", 6: "FAIL"}


def test_latest_record_breaks_ties(spark):
    rows = [("a", 1, 1, "x"), ("a", 2, 1, "y"), ("a", 2, 2, "z"), ("b", 0, 0, "w")]
    latest = quality.latest_status(spark.createDataFrame(rows, "job_id string, at int, n int, status string"), order=("at", "n"))
    assert sorted((r.job_id, r.status) for r in latest.collect()) == [("a", "z"), ("b", "w")]


def test_run_summary_of_nothing(spark):
    counters = spark.createDataFrame([(0, 0, 0, 0)], "scanned_rows bigint, cleaned_rows bigint, hourly_rows bigint, file_count bigint")
    assert quality.run_summary(counters).first()[4:] == (0.0, 0.0)


def test_domain_rules(spark):
    rows = [(2026, 3, "01F2930N"), (2019, 13, "05FR113S"), (None, None, None), (2026, 1, "1F2930N")]
    table = spark.createDataFrame(rows, "y int, m int, g string")
    counted = quality.domain_check(table, quality.domain_rules(F.col("y"), F.col("m"), F.col("g"))).collect()
    assert {r.rule: r.violations for r in counted} == {"year": 2, "month": 2, "gantry_id": 2}


def test_id_list(spark):
    frame = spark.createDataFrame([(" 01F2930N , ,01F2930S,",)], "ids string")
    assert frame.select(quality.id_list(F.col("ids"))).first()[0] == ["01F2930N", "01F2930S"]


@pytest.fixture
def versions(spark):
    schema = "gantry_id string, route string, section string, county string, city string, note string"
    old = [("a", "r1", "s", "c", "", "n"), ("b", "r1", "s", "", "", ""), ("x", "r2", "s", "c", "", "")]
    new = [("a", "r1", "s"), ("b", "r1", "t"), ("c", "r2", "s"), ("d", "r2", "s")]
    return spark.createDataFrame(old, schema), spark.createDataFrame(new, "gantry_id string, route string, section string")


def test_enrichment(spark, versions):
    old, new = versions
    defaults = spark.createDataFrame([("b", "D", "E", "F"), ("a", "D", "E", "F")], "gantry_id string, county string, city string, note string")
    overrides = spark.createDataFrame([("a", "")], "gantry_id string, note string")
    rows = {r.gantry_id: (r.county, r.city, r.note) for r in dims.enrich_dimension(new, old, defaults, overrides).collect()}
    assert rows == {"a": ("c", "E", ""), "b": ("D", "E", "F"), "c": ("", "", ""), "d": ("", "", "")}


def test_versions(versions):
    old, new = versions
    diff = dims.version_diff(old, new, "gantry_id", "section")
    assert sorted((r.gantry_id, r.change) for r in diff.collect()) == [
        ("b", "changed"), ("c", "added"), ("d", "added"), ("x", "removed"),
    ]
    assert [tuple(r) for r in dims.top_changes(diff, "gantry_id", 1).collect()] == [("b", "s", "t", 0)]
    assert [r.more for r in dims.top_changes(diff, "gantry_id", 0).collect()] == [1]


def test_entries_first_seen_and_tidied(spark):
    text = "01F0001N  North  Gate  12\n05FR113S South\n01F0001N Again\n1F0001N no\n99H0200S x\n"
    documents = spark.createDataFrame([(2, "01F0001N later"), (1, text)], "doc int, text string")
    entries = dims.extract_entries(documents, "text", ["doc"])
    first = dims.entry_names(dims.first_seen(entries, "gantry_id", ["doc", "entry_pos"]))
    assert sorted((r.gantry_id, r.doc, r.section) for r in first.collect()) == [
        ("01F0001N", 1, "North Gate"), ("05FR113S", 1, "South"),
    ]


def test_sections_end_where_the_next_begins(spark):
    documents = spark.createDataFrame([(1, "..T2 b T1 aa T2 again"), (2, "none")], "doc int, text string")
    rows = dims.section_bounds(documents, "text", ["doc"], ["T1", "T2", "T3"]).collect()
    assert [tuple(r) for r in rows] == [(1, "T2", 3, 8), (1, "T1", 8, 22)]


def test_chunks_and_directions(spark):
    chunks = F.array(F.struct(F.lit("t").alias("title"), F.lit("x").alias("text")), F.struct(F.lit("u").alias("title"), F.lit("y").alias("text")))
    assert spark.range(1).select(dims.join_chunks(chunks)).first()[0] == "- t：x\n- u：y"
    bases = spark.createDataFrame([("01F2930",)], "base_id string")
    assert [r.gantry_id for r in dims.both_directions(bases).collect()] == ["01F2930N", "01F2930S"]


@pytest.mark.parametrize(
    "text, want",
    [
        (" Sure, here is 報告", "報告"), ("Sure, Sure, x", "Sure, x"), ("x Sure,", "x Sure,"), ("```json\n{}\n```", "{}\n"),
        ("\u3000\u2003 Here is\n a ", "a"), (None, ""), ("```程式\ny```", "y"),
    ],
)
def test_normalise(spark, text, want):
    frame = spark.createDataFrame([(text,)], "t string")
    assert frame.select(normalise(F.col("t"), ["Sure, here is", "Sure,", "Here is"])).first()[0] == want


def test_tidy_label(spark):
    frame = spark.createDataFrame([("  a \t b　c  42 ",)], "t string")
    assert frame.select(tidy_label(F.col("t"))).first()[0] == "a b c"


def test_paths(spark):
    rows = [
        (1, "A;2026-03-01 08:00:00|B;2026-03-01 08:10:00|C;2026-03-01 08:30:00"), (2, "C;2026-03-01 08:00:00|A;2026-03-01 08:01:00"),
        (3, "A;2026-03-01 08:00:00"), (4, None), (6, "AA;2026-03-01 08:00:00| A;x| C ;2026-03-01 09:00:00"), (7, "C;x|AA;y|CC;z"), (5, "C;x|A;y|C;2026-03-01 09:00:00"),
    ]
    trips = spark.createDataFrame(rows, "id int, TripInformation string")
    assert sorted(r.id for r in paths.strict_crossing(trips, "A", "C").collect()) == [1, 5, 6]
    trips = trips.where("id < 6")
    segments = paths.path_segments(trips, ["id"]).collect()
    assert [(r.id, r.segment, r.from_gantry, r.to_gantry, r.seconds) for r in segments] == [
        (1, 0, "A", "B", 600), (1, 1, "B", "C", 1200), (2, 0, "C", "A", 60), (5, 0, "C", "A", None), (5, 1, "A", "C", None),
    ]
    average = {(r.from_gantry, r.to_gantry): (r.passes, r.seconds) for r in paths.segment_averages(paths.path_segments(trips, ["id"])).collect()}
    assert average[("A", "B")] == (1, 600) and average[("C", "A")] == (1, 60)


def test_paths_shuffle_nothing(spark):
    trips = spark.createDataFrame([(1, "A;2026-03-01 08:00:00|B;2026-03-01 08:10:00")], "id int, TripInformation string")
    for table in (paths.path_segments(trips, ["id"]), paths.strict_crossing(trips, "A", "B")):
        assert "Exchange" not in table._jdf.queryExecution().executedPlan().toString()
