"""Writers that die or race between their steps, and what can be read then."""

import gzip
import os

import pytest
from sample_trips import TARGETS, raw_row

from gantrylake.operators import hourly, quality
from gantrylake.plans.month import DamagedFiles, MonthRun, run_month
from gantrylake.sinks import heads as heads_module
from gantrylake.sinks.heads import Heads, Log
from gantrylake.sinks.lake import register_lake, replace_days, write_lake
from gantrylake.sinks.records import append_record, read_latest, read_records
from gantrylake.sinks.tallies import TallyStore
from gantrylake.sources.hourly import read_lake
from gantrylake.sources.inventory import read_inventory
from gantrylake.sources.storage import glob_pattern
from gantrylake.sources.trips import SOUND, file_list, file_stream, read_checked, read_trips
from gantrylake.streaming.hourly import compact_partials, set_aside, start_checked_stream, streamed_hourly, write_partial

LINE = "31,2026-03-01 08:00:00,01F2930N,2026-03-01 08:20:00,01F3083N,10.5,Y,info"


class Killed(Exception):
    pass


def kill(*_, **__):
    raise Killed


def counts(spark, root):
    return sorted((r.day, r.counts) for r in read_lake(spark, root).collect())


def folders(root):
    return sorted(os.path.join(d, f) for d, names, _ in os.walk(root) for f in names if f.startswith("version="))


# --- months --------------------------------------------------------------------------------


@pytest.mark.parametrize("step", ["commit", "create_once"])
def test_a_writer_killed_before_its_commit_leaves_the_month_as_it_was(spark, lake, tmp_path, monkeypatch, step):
    root = str(tmp_path / "lake")
    replace_days(lake([(1, 8, "a", 31, 1), (2, 8, "a", 31, 2)]), root, 2026, 3)
    with monkeypatch.context() as patch:
        patch.setattr(*((Heads, "commit", kill) if step == "commit" else (heads_module, "create_once", kill)))
        with pytest.raises(Killed):
            replace_days(lake([(2, 8, "a", 31, 9)]), root, 2026, 3, 2, 2)
        assert counts(spark, root) == [(1, 1), (2, 2)]
        with pytest.raises(Killed):
            write_lake(lake([(3, 8, "a", 31, 9)]), root)
    assert counts(spark, root) == [(1, 1), (2, 2)]
    replace_days(lake([(2, 8, "a", 31, 9)]), root, 2026, 3, 2, 2)
    assert counts(spark, root) == [(1, 1), (2, 9)]


def test_a_writer_killed_after_its_commit_has_replaced_the_month(spark, lake, tmp_path, monkeypatch):
    root = str(tmp_path / "lake")
    for n in range(2):
        replace_days(lake([(1, 8, "a", 31, n)]), root, 2026, 3)
    with monkeypatch.context() as patch:
        patch.setattr(Heads, "_tidy", kill)
        with pytest.raises(Killed):
            replace_days(lake([(1, 8, "a", 31, 7)]), root, 2026, 3)
    assert counts(spark, root) == [(1, 7)]
    replace_days(lake([(1, 8, "a", 31, 8)]), root, 2026, 3)
    assert counts(spark, root) == [(1, 8)]


def test_readers_that_began_before_a_commit_can_finish(spark, lake, tmp_path):
    root = str(tmp_path / "lake")
    replace_days(lake([(1, 8, "a", 31, 1)]), root, 2026, 3)
    before = read_lake(spark, root)
    replace_days(lake([(1, 8, "a", 31, 2)]), root, 2026, 3)
    assert [r.counts for r in before.collect()] == [1]
    for n in range(3):
        replace_days(lake([(1, 8, "a", 31, n)]), root, 2026, 3)
    assert len(folders(root)) == 2 and len(os.listdir(f"{root}/_heads")) <= 2 * 2  # with checksums
    assert counts(spark, root) == [(1, 2)]


def test_two_writers_of_one_month_keep_both_windows(spark, lake, tmp_path, monkeypatch):
    root = str(tmp_path / "lake")
    replace_days(lake([(d, 8, "a", 31, 1) for d in (1, 2, 3)]), root, 2026, 3)
    create, state = heads_module.create_once, {"raced": False}

    def raced(spark, path, text):
        if not state["raced"]:
            state["raced"] = True
            replace_days(lake([(1, 8, "a", 31, 5)]), root, 2026, 3, 1, 1)
        return create(spark, path, text)

    monkeypatch.setattr(heads_module, "create_once", raced)
    replace_days(lake([(2, 8, "a", 31, 6)]), root, 2026, 3, 2, 2)
    assert counts(spark, root) == [(1, 5), (2, 6), (3, 1)]


def test_a_name_is_taken_once(spark, tmp_path):
    path = f"{tmp_path}/x/000"
    assert heads_module.create_once(spark, path, "one")
    assert not heads_module.create_once(spark, path, "two")
    assert heads_module.read_text(spark, path) == "one"


def test_plain_month_folders_are_taken_over(spark, lake, tmp_path):
    root = str(tmp_path / "lake")
    rows = lake([(1, 8, "a", 31, 1), (2, 8, "a", 31, 2)])
    april = rows.selectExpr("year", "4 AS month", "day", "weekday", "hour_0", "gantry_id_o", "vehicle_type", "counts", "week_index", "'202604' AS yyyymm")
    rows.unionByName(april).write.partitionBy("yyyymm").parquet(root)
    assert read_lake(spark, root).count() == 4
    replace_days(lake([(2, 8, "a", 31, 7)]), root, 2026, 3, 2, 2)
    assert sorted((r.yyyymm, r.day, r.counts) for r in read_lake(spark, root).collect()) == [
        ("202603", 1, 1), ("202603", 2, 7), ("202604", 1, 1), ("202604", 2, 2),
    ]


def test_catalog_partitions_move_with_the_month(spark, lake, tmp_path):
    root = str(tmp_path / "lake")
    replace_days(lake([(1, 8, "a", 31, 1)]), root, 2026, 3)
    assert [r.counts for r in register_lake(spark, "moving", root).collect()] == [1]
    replace_days(lake([(1, 8, "a", 31, 4)]), root, 2026, 3)
    assert [r.counts for r in register_lake(spark, "moving", root).collect()] == [4]
    spark.sql("DROP TABLE moving")


# --- partial tables of a stream ----------------------------------------------------------------


def partials(spark, raw, root, batches, **options):
    for n in range(batches):
        write_partial(root, **options)(hourly.keyed_trips(raw(raw_row(), raw_row()), TARGETS, 2026, 3), n)


def total(spark, root):
    return streamed_hourly(spark, root).agg({"counts": "sum"}).first()[0]


@pytest.mark.parametrize("where", [(Heads, "commit"), (heads_module, "create_once"), (Heads, "_tidy")])
def test_a_merge_broken_off_anywhere_keeps_the_sums(spark, raw, tmp_path, monkeypatch, where):
    root = str(tmp_path)
    partials(spark, raw, root, 3)
    with monkeypatch.context() as patch:
        patch.setattr(*where, kill)
        with pytest.raises(Killed):
            compact_partials(spark, root, 1)
    assert total(spark, root) == 6
    compact_partials(spark, root, 2)
    compact_partials(spark, root, 2)
    assert total(spark, root) == 6
    assert list(Heads(spark, root).read()) == ["0-2"]


def test_a_batch_replayed_after_the_merge_counts_once(spark, raw, tmp_path):
    root = str(tmp_path)
    partials(spark, raw, root, 3)
    compact_partials(spark, root, 2)
    write_partial(root)(hourly.keyed_trips(raw(raw_row(), raw_row()), TARGETS, 2026, 3), 2)
    assert total(spark, root) == 6


def test_a_batch_killed_before_its_commit_counts_once_when_replayed(spark, raw, tmp_path, monkeypatch):
    root = str(tmp_path)
    partials(spark, raw, root, 1)
    with monkeypatch.context() as patch:
        patch.setattr(Heads, "commit", kill)
        with pytest.raises(Killed):
            write_partial(root)(hourly.keyed_trips(raw(raw_row()), TARGETS, 2026, 3), 1)
    assert total(spark, root) == 2
    write_partial(root)(hourly.keyed_trips(raw(raw_row()), TARGETS, 2026, 3), 1)
    assert total(spark, root) == 3


def test_many_partials_are_merged_by_the_stream_itself(spark, raw, tmp_path):
    partials(spark, raw, str(tmp_path), 7, partials=3)
    assert total(spark, str(tmp_path)) == 14
    assert len(Heads(spark, str(tmp_path)).read()) <= 4


# --- files ---------------------------------------------------------------------------------


def put(path, rows, part=1.0):
    path.parent.mkdir(parents=True, exist_ok=True)
    text = "".join(f"{LINE}{n}\n" for n in range(rows)).encode()
    whole = gzip.compress(text) if path.suffix == ".gz" else text
    path.write_bytes(whole[: int(len(whole) * part)])


def test_checked_rows_are_the_rows_of_a_scan(spark, tmp_path):
    lines = [LINE, "", '"31",b,"c,c",d,e,f,g,h', "31,only", LINE + ",more", "0,1,2,3,4,5,6,7", " 31 , x", "é,中"]
    (tmp_path / "a.csv.gz").write_bytes(gzip.compress("\r\n".join(lines[:4]).encode()) + gzip.compress(("\n" + "\n".join(lines[4:])).encode()))
    (tmp_path / "b.csv").write_text(LINE)
    checked = read_checked(file_list(spark, str(tmp_path)))
    verdicts = checked.where("verdict IS NOT NULL")
    assert [r.verdict for r in verdicts.collect()] == [SOUND, SOUND]
    rows = checked.where("verdict IS NULL").drop("file_name", "verdict")
    assert sorted(map(str, rows.collect())) == sorted(map(str, read_trips(spark, str(tmp_path)).collect()))


def test_long_files_are_read_piece_by_piece(spark, tmp_path, monkeypatch):
    from gantrylake.sources import storage

    text = b"".join(b"%d,%s\n" % (n, b"x" * (n % 50)) for n in range(20000)) + b"no end"
    (tmp_path / "a.csv.gz").write_bytes(gzip.compress(text))
    monkeypatch.setattr(storage, "PIECE", 1000)
    monkeypatch.setattr(storage, "UNPACKED", 3000)
    assert b"".join(storage.unpacked(str(tmp_path / "a.csv.gz"))) == text
    found = b"".join(line for block in storage.lines(storage.unpacked(str(tmp_path / "a.csv.gz"))) for line in block.to_pylist())
    assert found == text + b"\n"
    (tmp_path / "cut.csv.gz").write_bytes(gzip.compress(text)[:-9])
    with pytest.raises(ValueError, match="ends early"):
        list(storage.unpacked(str(tmp_path / "cut.csv.gz")))


def test_stream_sets_damaged_files_aside_and_goes_on(spark, tmp_path):
    source, root, checkpoint = tmp_path / "in", str(tmp_path / "partials"), str(tmp_path / "checkpoint")
    for n in range(3):
        put(source / f"good{n}.csv.gz", 5)
    put(source / "bad.csv.gz", 20000, 0.5)
    put(source / "plain.csv", 2)

    def run():
        start_checked_stream(file_stream(spark, str(source), 2), root, checkpoint, TARGETS, 2026, 3).awaitTermination()

    run()
    assert total(spark, root) == 17
    put(source / "late.csv.gz", 4)
    put(source / "worse.csv.gz", 5, 0.1)
    run()
    assert total(spark, root) == 21
    aside = {os.path.basename(r.file_name): (r.reason, r.attempts) for r in set_aside(spark, root).collect()}
    assert aside == {"bad.csv.gz": ("the file ends early", 2), "worse.csv.gz": ("the file ends early", 2)}


def test_rows_with_verdicts_are_counted_by_hash(spark, tmp_path):
    put(tmp_path / "good.csv.gz", 5)
    put(tmp_path / "cut.csv.gz", 5, 0.1)
    (tmp_path / "mixed.csv.gz").write_bytes(gzip.compress(f"{LINE}\n{LINE}\nabc{LINE}\nabc{LINE}\n".encode()))
    checked = read_checked(file_list(spark, str(tmp_path)))
    tally = hourly.tally_trips(checked, TARGETS, 2026, 3)
    plan = tally._jdf.queryExecution().sparkPlan().toString().splitlines()
    below = plan[[n for n, line in enumerate(plan) if "Aggregate(" in line][-1] :]
    assert "HashAggregate(" in below[0] and not any("Sort" in line for line in below)
    rows = sorted((os.path.basename(r.file_name), r.Day, r.scanned, r.cleaned, r.verdict) for r in tally.fillna(0, ["Day"]).collect())
    assert rows == [
        ("cut.csv.gz", 0, 0, 0, "the file ends early"),
        ("good.csv.gz", 0, 0, 0, SOUND),
        ("good.csv.gz", 1, 5, 5, None),
        ("mixed.csv.gz", 0, 2, 0, SOUND),
        ("mixed.csv.gz", 1, 2, 2, None),
    ]


def test_listing_in_tasks(spark, tmp_path):
    for name in ("a.csv", "x/b.csv.gz", "x/y/c.CSV", "x/y/_hidden/d.csv", "day=1/e.csv", ".f.csv"):
        put(tmp_path / name, 1)
    (tmp_path / "x" / "empty.csv").touch()
    (tmp_path / "none").mkdir()
    rows = {r.file_name: r for r in read_inventory(spark, str(tmp_path), "*.{[cC][sS][vV],[cC][sS][vV].[gG][zZ]}").collect()}
    assert set(rows) == {"a.csv", "b.csv.gz", "c.CSV", "e.csv", "empty.csv"}
    assert rows["empty.csv"].size == 0 and rows["a.csv"].size == len(LINE) + 2
    assert rows["c.CSV"].path.endswith("x/y/c.CSV") and rows["c.CSV"].changed > 10**15
    assert read_inventory(spark, str(tmp_path / "none")).collect() == []


def test_file_name_patterns():
    import re

    hit = lambda glob, name: bool(re.search(glob_pattern(glob), name))
    assert hit("*", "a.b") and hit("a?c", "abc") and not hit("a?c", "abbc") and hit("*.{x,y.z}", "q.y.z") and not hit("*.{x,y}", "q.z")
    assert hit("[!a]b", "cb") and not hit("[!a]b", "ab") and hit("a,b+", "a,b+")


# --- runs over changed files -----------------------------------------------------------------


def month_run(tmp_path, **more):
    return MonthRun("job", 2026, 3, TARGETS, str(tmp_path / "raw"), str(tmp_path / "lake"), str(tmp_path / "records"), tally_path=str(tmp_path / "tallies"), **more)


def test_a_second_run_reads_changed_files_only(spark, tmp_path):
    for n in range(4):
        put(tmp_path / "raw" / f"{n}.csv.gz", n + 1)
    (tmp_path / "raw" / "empty.csv").touch()
    run = month_run(tmp_path)
    note = lambda: read_latest(spark, run.record_path).first().note
    assert run_month(spark, run).first().scanned_rows == 10
    assert note() == "5 of 5 files read"
    put(tmp_path / "raw" / "1.csv.gz", 9)
    (summary,) = run_month(spark, run).collect()
    assert (summary.scanned_rows, summary.file_count, note()) == (17, 5, "1 of 5 files read")
    os.remove(tmp_path / "raw" / "3.csv.gz")
    put(tmp_path / "raw" / "new" / "4.csv", 2)
    assert run_month(spark, run).first().scanned_rows == 15
    assert note() == "1 of 5 files read"
    whole = MonthRun("job", 2026, 3, TARGETS, run.raw_path, str(tmp_path / "other"), run.record_path)
    run_month(spark, whole)
    assert counts(spark, run.lake_path) == counts(spark, whole.lake_path) == [(1, 15)]
    run_month(spark, month_run(tmp_path, day_start=1, day_end=1))
    assert note() == "5 of 5 files read"  # another question


def test_damaged_files_fail_the_run_or_are_tried_again(spark, tmp_path):
    put(tmp_path / "raw" / "a.csv.gz", 3)
    put(tmp_path / "raw" / "b.csv.gz", 20000, 0.5)
    with pytest.raises(DamagedFiles, match="b.csv.gz: the file ends early"):
        run_month(spark, month_run(tmp_path))
    run = month_run(tmp_path, skip_damaged=True)
    assert run_month(spark, run).first().scanned_rows == 3
    put(tmp_path / "raw" / "b.csv.gz", 4)
    assert run_month(spark, run).first().scanned_rows == 7
    assert read_latest(spark, run.record_path).first().note == "1 of 2 files read"


def test_a_run_killed_between_its_steps_is_made_good_by_the_next(spark, tmp_path, monkeypatch):
    from gantrylake.plans import month as month_module

    put(tmp_path / "raw" / "a.csv.gz", 3)
    run = month_run(tmp_path)
    for name in ("replace_days", "append_counters"):
        with monkeypatch.context() as patch:
            patch.setattr(month_module, name, kill)
            with pytest.raises(Killed):
                run_month(spark, run)
    with monkeypatch.context() as patch:
        patch.setattr(TallyStore, "commit", kill)
        put(tmp_path / "raw" / "b.csv.gz", 2)
        with pytest.raises(Killed):
            run_month(spark, run)
    assert run_month(spark, run).first().scanned_rows == 5
    assert counts(spark, run.lake_path) == [(1, 5)]


def test_generations_are_merged(spark, tmp_path, monkeypatch):
    from gantrylake.sinks import tallies

    monkeypatch.setattr(tallies, "MOST", 2)
    run = month_run(tmp_path)
    for n in range(5):
        put(tmp_path / "raw" / f"{n}.csv.gz", 1)
        assert run_month(spark, run).first().scanned_rows == n + 1


# --- records and rows ------------------------------------------------------------------------


def test_records_stay_in_few_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(Log, "MOST", 5)
    path = str(tmp_path / "records")
    for n in range(12):
        append_record(spark, path, f"job{n % 2}", "cleaning", str(n))
    assert len(Heads(spark, path).read()) <= 6
    assert sorted(int(r.note) for r in read_records(spark, path).collect()) == list(range(12))
    assert {r.job_id: r.note for r in read_latest(spark, path).collect()} == {"job0": "10", "job1": "11"}


def test_latest_status_compares_numbers_by_hash(spark):
    rows = [("a", 1, -5, "x"), ("a", 1, 2**62, "y"), ("a", None, 2**63 - 1, "n"), ("b", -3, None, "z"), ("b", -3, None, "z"), (None, None, None, "q")]
    rows += [("c", 7, 7, "one"), ("c", 7, 7, "two")]
    table = spark.createDataFrame(rows, "job string, at int, n long, status string")
    latest = quality.latest_status(table, "job", ("at", "n"))
    found = sorted(((r.job, r.status) for r in latest.collect()), key=str)
    assert [x for x in found if x[0] != "c"] == [("a", "y"), ("b", "z"), (None, "q")] and len(found) == 4
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan
    with pytest.raises(ValueError):
        quality.latest_status(table.selectExpr("job", "n AS a", "n AS b", "status"), "job", ("a", "b"))


def test_reconcile_rows_lists_what_differs(spark, monkeypatch):
    table = lambda rows: spark.createDataFrame(rows, "day int, v string")
    expected = table([(1, "a"), (2, "x"), (2, "x"), (2, "x"), (3, None), (None, "n")] + [(9, str(n)) for n in range(500)])
    actual = table([(1, "a"), (2, "x"), (4, "new"), (4, "new"), (None, "n")] + [(9, str(n)) for n in range(1, 501)])
    want = [("EXTRA", 1, 9, "500"), ("EXTRA", 2, 4, "new"), ("MISSING", 1, 3, None), ("MISSING", 1, 9, "0"), ("MISSING", 2, 2, "x")]
    found = lambda: sorted(((r.side, r.copies, r.day, r.v) for r in quality.reconcile_rows(expected, actual, ["day"]).collect()), key=str)
    assert found() == sorted(want, key=str)
    monkeypatch.setattr(quality, "LIST_ROWS", 0)
    assert found() == sorted(want, key=str)
    assert quality.reconcile_rows(expected, expected, ["day"]).collect() == []
    assert quality.reconcile_rows(expected.limit(0), actual.limit(0), ["day"]).collect() == []
