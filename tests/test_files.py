import datetime as dt
import gzip
import json
import os

import pytest
from sample_trips import TARGETS

from gantrylake.operators import hourly
from gantrylake.plans.month import MonthRun, run_flow, run_month, run_statistics
from gantrylake.schemas import FLOW_SCHEMA, RAW_TRIP_COLUMNS
from gantrylake.sinks.lake import materialise, register_lake, write_lake
from gantrylake.sinks.records import append_record, read_latest, read_records
from gantrylake.sinks.text import write_hourly_csv, write_layer_csv, write_layers
from gantrylake.sources.documents import read_dictionary, read_knowledge
from gantrylake.sources.hourly import read_hourly_csv, read_lake, tag_month, union_months
from gantrylake.sources.inventory import read_inventory
from gantrylake.sources.trips import damaged_files, read_trip_months, read_trips, require_rows

LINE = "31,2026-03-01 08:00:00,01F2930N,2026-03-01 08:20:00,01F3083N,10.5,Y,info"


def put(folder, name, text, zipped=False):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    data = text.encode()
    path.write_bytes(gzip.compress(data) if zipped else data)
    return path


def files_below(root, ending):
    return [os.path.join(d, f) for d, _, names in os.walk(root) for f in names if f.endswith(ending)]


def test_reads_nested_files_of_any_case_and_gzip(spark, tmp_path):
    put(tmp_path, "a/x.csv", "0,1,2,3,4,5,6,7\n" + LINE + "\n")
    put(tmp_path, "b/c/Y.CSV", LINE + "\n" + LINE + "\n")
    put(tmp_path, "z.csv.gz", LINE + "\n", zipped=True)
    put(tmp_path, "empty.csv", "")
    put(tmp_path, "notes.txt", LINE + "\n")
    rows = read_trips(spark, str(tmp_path)).collect()
    assert len(rows) == 4
    assert rows[0].asDict() == dict(zip(RAW_TRIP_COLUMNS, LINE.split(",")))


def test_short_long_and_quoted_rows(spark, tmp_path):
    put(tmp_path, "x.csv", "31,2026-03-01 08:00:00,A\n" + LINE + ",more,more\n" + '"31",b,"c,c",d,e,f,g,h\n')
    short, long, quoted = read_trips(spark, str(tmp_path)).collect()
    assert (short.GantryID_O, short.DetectionTime_D, short.TripInformation) == ("A", None, None)
    assert long.TripInformation == "info"
    assert (quoted.VehicleType, quoted.GantryID_O) == ("31", "c,c")


def cut_gzip(path, rows):
    """A gzip file that breaks off: its first rows can still be read."""
    whole = gzip.compress("".join(f"{LINE}{n}\n" for n in range(rows)).encode())
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(whole[: len(whole) * 6 // 10])


def test_damaged_gzip_fails_or_is_named(spark, tmp_path):
    put(tmp_path, "good.csv.gz", LINE + "\n", zipped=True)
    put(tmp_path, "two.csv.gz", "", zipped=False).write_bytes(gzip.compress(LINE.encode()) + gzip.compress(b"\n" + LINE.encode()))
    cut_gzip(tmp_path / "bad.csv.gz", 20000)
    put(tmp_path, "false.csv.gz", LINE + "\n")
    with pytest.raises(Exception):  # noqa: B017  Spark wraps the reader's error
        read_trips(spark, str(tmp_path)).count()
    bad = {os.path.basename(r.file_name): r.reason for r in damaged_files(spark, str(tmp_path)).collect()}
    assert set(bad) == {"bad.csv.gz", "false.csv.gz"}
    assert bad["bad.csv.gz"] == "the file ends early"


def test_month_run_fails_on_or_leaves_out_a_damaged_file(spark, tmp_path):
    put(tmp_path / "raw", "a.csv.gz", LINE + "\n" + LINE + "\n", zipped=True)
    put(tmp_path / "raw", "empty.csv", "")
    cut_gzip(tmp_path / "raw" / "bad.csv.gz", 20000)
    with pytest.raises(Exception):  # noqa: B017
        run_month(spark, month_run(tmp_path))
    (failed,) = read_latest(spark, str(tmp_path / "records")).collect()
    assert failed.status == "error" and len(failed.note) > 0
    (summary,) = run_month(spark, month_run(tmp_path, skip_damaged=True)).collect()
    assert (summary.scanned_rows, summary.cleaned_rows, summary.file_count) == (2, 2, 2)
    records = read_records(spark, str(tmp_path / "records"))
    (skipped,) = records.where("status = 'skipped'").collect()
    assert skipped.note.endswith("bad.csv.gz: the file ends early")
    assert read_latest(spark, str(tmp_path / "records")).first().note == "1 damaged files skipped"


def test_day_window_keeps_the_other_days(spark, tmp_path):
    lines = [LINE.replace("2026-03-01", f"2026-03-{day:02d}") for day in (1, 5, 9) for _ in range(2)]
    put(tmp_path / "raw", "a.csv", "\n".join(lines) + "\n")
    days = lambda: sorted((r.day, r.counts) for r in read_lake(spark, str(tmp_path / "lake")).collect())
    run_month(spark, month_run(tmp_path))
    assert days() == [(1, 2), (5, 2), (9, 2)]
    run_month(spark, month_run(tmp_path, day_start=5, day_end=5))
    assert days() == [(1, 2), (5, 2), (9, 2)]
    run_month(spark, month_run(tmp_path, gantries=["05F0055N"], day_start=5, day_end=9))
    assert days() == [(1, 2)]
    run_month(spark, month_run(tmp_path, gantries=["05F0055N"]))
    assert days() == []


def test_canonical_order_over_several_files(spark, lake, tmp_path):
    rows = hourly.to_text_layout(lake([(d, h, "a", v, 1) for v in (5, 31) for h in range(24) for d in range(1, 29)]).repartition(7))
    write_hourly_csv(rows, str(tmp_path / "out"), mark=False)
    text = "".join(open(path).read().split("\n", 1)[1] for path in sorted(files_below(tmp_path / "out", ".csv")))
    keys = [tuple(int(x) for x in (line.split(",")[2], line.split(",")[4], line.split(",")[6])) for line in text.splitlines()]
    assert len(keys) == 28 * 24 * 2 and keys == sorted(keys)


def test_nothing_to_read_is_an_error(spark, tmp_path):
    put(tmp_path, "x.csv", "0,1,2,3,4,5,6,7\n")
    with pytest.raises(FileNotFoundError):
        require_rows(read_trips(spark, str(tmp_path)))


def test_month_folders(spark, tmp_path):
    put(tmp_path, "yyyymm=202603/a.csv.gz", LINE + "\n", zipped=True)
    put(tmp_path, "yyyymm=202604/a.csv.gz", LINE + "\n" + LINE + "\n", zipped=True)
    trips = read_trip_months(spark, str(tmp_path), ["202604"])
    assert dict(trips.dtypes)["yyyymm"] == "string"
    assert trips.count() == 2
    plan = trips._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(yyyymm" in plan


def test_lake_replaces_only_the_months_written(spark, lake, tmp_path):
    root = str(tmp_path / "lake")
    march = lake([(1, 8, "a", 31, 5), (2, 8, "a", 31, 6)])
    april = march.selectExpr("year", "4 AS month", "day", "weekday", "hour_0", "gantry_id_o", "vehicle_type", "counts", "week_index", "'202604' AS yyyymm")
    write_lake(march, root)
    write_lake(april, root)
    write_lake(lake([(3, 9, "b", 5, 1)]), root)
    rows = read_lake(spark, root)
    assert dict(rows.dtypes) == dict(lake([]).dtypes)
    assert sorted((r.yyyymm, r.day) for r in rows.collect()) == [("202603", 3), ("202604", 1), ("202604", 2)]
    assert read_lake(spark, root, ["202603"]).count() == 1
    pruned = read_lake(spark, root, ["202603"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(yyyymm" in pruned
    table = register_lake(spark, "lake_test", root)
    assert table.where("yyyymm = '202604'").count() == 2
    spark.sql("DROP TABLE lake_test")


def test_layers_partition_the_month(spark, lake, tmp_path):
    rows = lake([(d, h, "a", 31, d + h) for d in range(1, 32) for h in (0, 8, 23)])
    write_layers(rows, str(tmp_path))
    back = spark.read.schema(rows.schema).parquet(str(tmp_path))
    month = rows.count()
    assert back.groupBy("week_index").count().agg({"count": "sum"}).first()[0] == month
    assert back.groupBy("day").count().agg({"count": "sum"}).first()[0] == month
    assert sorted(back.select(*rows.columns).collect()) == sorted(rows.collect())
    assert len(list((tmp_path / "yyyymm=202603" / "week_index=5").glob("day=*"))) == 3


def test_csv_form_byte_for_byte(spark, lake, tmp_path):
    rows = hourly.to_text_layout(lake([(1, 1, "01F2930N", 31, 7), (1, 0, "01F2930N", 31, 324)])).coalesce(1)
    write_hourly_csv(rows, str(tmp_path / "out"))
    (path,) = files_below(tmp_path / "out", ".csv")
    with open(path, "rb") as f:
        assert f.read() == (
            b"\xef\xbb\xbfYear,Month,Day,Weekday,Hour_0,GantryID_O,VehicleType,counts,WeekIndex\r\n"
            b"2026,3,1,7,0,01F2930N,31,324,1\r\n2026,3,1,7,1,01F2930N,31,7,1\r\n"
        )
    assert sorted(read_hourly_csv(spark, str(tmp_path / "out")).collect()) == sorted(rows.collect())
    write_layer_csv(lake([(1, 0, "a", 31, 1), (9, 0, "a", 31, 2)]), str(tmp_path / "layers"))
    (second,) = files_below(tmp_path / "layers" / "week=2" / "date=9", ".csv")
    with open(second, "rb") as f:
        assert f.read().endswith(b"WeekIndex\r\n2026,3,9,1,0,a,31,2,2\r\n")


def test_month_union(spark, lake):
    march = lake([(1, 0, "a", 31, 1)]).drop("yyyymm")
    both = union_months(tag_month(march, "202603"), tag_month(march, "202604"))
    assert sorted(r.yyyymm for r in both.collect()) == ["202603", "202604"]


def test_inventory_reads_no_content(spark, tmp_path):
    put(tmp_path, "m/TRIPS_20260301_080000.csv", LINE)
    put(tmp_path, "m/TRIPS_20260301_090000.csv", "")
    listing = read_inventory(spark, str(tmp_path))
    assert sorted((r.file_name, r.size) for r in listing.select("file_name", "size").collect()) == [
        ("TRIPS_20260301_080000.csv", len(LINE)),
        ("TRIPS_20260301_090000.csv", 0),
    ]
    assert "content" not in listing._jdf.queryExecution().optimizedPlan().toString().split("Relation")[0]


def test_json_inputs(spark, tmp_path):
    put(tmp_path, "k.json", '{"route_name": "r",\n "rag_chunks": [{"title": "t", "text": "x"}, {"title": "u", "text": "y"}]}')
    (document,) = read_knowledge(spark, str(tmp_path / "k.json")).collect()
    assert [c.title for c in document.rag_chunks] == ["t", "u"]
    put(tmp_path, "d.json", '{"_meta": {"note": "n"}, "01F2930N": {"section": "s", "county": "c"}}')
    (entry,) = read_dictionary(spark, str(tmp_path / "d.json")).collect()
    assert (entry.gantry_id, entry.section, entry.city) == ("01F2930N", "s", None)


def test_materialise_ends_the_lineage(spark, lake, tmp_path):
    table = materialise(lake([(1, 0, "a", 31, 1)]).groupBy("day").count(), str(tmp_path / "t"))
    assert "Aggregate" not in table._jdf.queryExecution().optimizedPlan().toString()
    assert table.count() == 1


def test_records_keep_the_last_state_and_error_text(spark, tmp_path):
    path = str(tmp_path / "records")
    for status, note in (("accepted", None), ("cleaning", None), ("error", "disk full")):
        append_record(spark, path, "job", status, note)
    append_record(spark, path, "other", "accepted")
    latest = {r.job_id: (r.status, r.note) for r in read_latest(spark, path).collect()}
    assert latest == {"job": ("error", "disk full"), "other": ("accepted", None)}


def month_run(tmp_path, **changes):
    settings = {
        "job_id": "j", "year": 2026, "month": 3, "gantries": TARGETS, "raw_path": str(tmp_path / "raw"),
        "lake_path": str(tmp_path / "lake"), "record_path": str(tmp_path / "records"),
    }
    return MonthRun(**{**settings, **changes})


def test_month_run_end_to_end(spark, tmp_path):
    for hour in range(3):
        line = LINE.replace(" 08:00", f" {hour:02d}:00")
        put(tmp_path / "raw", f"TRIPS_20260301_{hour:02d}0000.csv.gz", "\n".join([line, line, "abc" + line[2:], ""]), zipped=True)
    for _ in range(2):
        (summary,) = run_month(spark, month_run(tmp_path)).collect()
    assert summary.asDict() == {
        "scanned_rows": 9, "cleaned_rows": 6, "hourly_rows": 3, "file_count": 3, "retained_pct": 66.67, "hourly_pct": 50.0,
    }
    rows = read_lake(spark, str(tmp_path / "lake"), ["202603"])
    assert sorted((r.hour_0, r.counts) for r in rows.collect()) == [(0, 2), (1, 2), (2, 2)]
    (record,) = read_latest(spark, str(tmp_path / "records")).collect()
    assert (record.status, record.scanned_rows, record.note) == ("done", 9, None)
    run_statistics(spark, str(tmp_path / "lake"), str(tmp_path / "stats"))
    (document,) = spark.read.text(str(tmp_path / "stats" / "gantries")).collect()
    assert document.value.startswith('{"gantry_id":"01F2930N","available":true,"days_with_data":1')
    (document,) = spark.read.text(str(tmp_path / "stats" / "all")).collect()
    assert json.loads(document.value) == {"total_rows": 3, "days_covered": [1]}


def test_month_without_match_is_done_with_a_note(spark, tmp_path):
    put(tmp_path / "raw", "a.csv", LINE + "\n")
    run_month(spark, month_run(tmp_path, gantries=["05F0055N"])).collect()
    (record,) = read_latest(spark, str(tmp_path / "records")).collect()
    assert (record.status, record.hourly_rows, record.note) == ("done", 0, "no matching rows")


def test_failed_month_is_recorded_and_raised(spark, tmp_path):
    put(tmp_path / "raw", "a.csv", "0,1,2,3,4,5,6,7\n")
    with pytest.raises(FileNotFoundError):
        run_month(spark, month_run(tmp_path))
    (record,) = read_latest(spark, str(tmp_path / "records")).collect()
    assert (record.status, record.note) == ("error", "no trip rows found")
    with pytest.raises(ValueError):
        run_month(spark, month_run(tmp_path, gantries=[]))


def test_flow_run(spark, tmp_path):
    rows = [(f"2025-01-01 00:{m:02d}:00", "05F0287N", "N", 31, 2, "202501") for m in range(0, 60, 5)]
    rows += [("2025-01-01 01:00:00", "05F0287N", "N", 31, 3, "202501"), ("2025-01-01 01:00:00", "01F0001N", "N", 31, 9, "202501")]
    flow = spark.createDataFrame(rows, FLOW_SCHEMA)
    reports = run_flow(flow, ["05F0287N"], "flow_run_test", str(tmp_path / "flow"), "202501", "202501", "202512")
    (month,) = reports["month_totals"].collect()
    assert month.asDict() == {"yyyymm": "202501", "rows": 2, "gantries": 1, "days": 1, "total_flow": 27}
    (station,) = reports["station_completeness"].collect()
    assert (station.days, station.min_slots, station.max_slots) == (1, 1, 12)
    assert [r.slot_count for r in reports["slot_distribution"].collect()] == [12, 1]
    assert spark.table("flow_run_test").schema["dt"].dataType.simpleString() == "date"
    assert spark.table("flow_run_test").first().dt == dt.date(2025, 1, 1)
    spark.sql("DROP TABLE flow_run_test")
