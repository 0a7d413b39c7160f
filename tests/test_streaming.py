from sample_trips import TARGETS, raw_row

from gantrylake.operators import hourly
from gantrylake.sinks.heads import Heads
from gantrylake.sources.trips import stream_trips
from gantrylake.streaming.hourly import compact_partials, hourly_windows, start_hourly_stream, start_quarantine_stream, streamed_hourly


def land(raw, folder, name, rows):
    raw(*rows).coalesce(1).write.csv(str(folder / name))


def test_stream_equals_batch_over_batches_late_files_and_restarts(spark, raw, tmp_path):
    rows = [raw_row(DetectionTime_O=f"2026-03-{d:02d} {h:02d}:30:00", VehicleType=v) for d in (9, 1, 2) for h in (8, 9) for v in ("31", "5", "abc")]
    source, root, checkpoint = tmp_path / "in", str(tmp_path / "partials"), str(tmp_path / "checkpoint")
    land(raw, source, "a", rows[:6])
    land(raw, source, "b", rows[3:9])

    def run():
        stream = stream_trips(spark, str(source), files_per_trigger=1)
        query = start_hourly_stream(stream, root, checkpoint, TARGETS, 2026, 3)
        query.awaitTermination()
        return query

    run()
    land(raw, source, "late", rows[9:] + rows[:1])
    run()
    run()
    landed = rows[:6] + rows[3:9] + rows[9:] + rows[:1]
    batch = hourly.hourly_counts(raw(*landed), TARGETS, 2026, 3)
    streamed = hourly.to_lake_rows(hourly.add_week_index(streamed_hourly(spark, root)))
    assert sorted(streamed.collect()) == sorted(batch.collect())
    batches = sorted(int(p.name[6:]) for p in (tmp_path / "partials").glob("batch=*"))
    assert len(batches) >= 3
    compact_partials(spark, root, batches[-1])
    assert list(Heads(spark, root).read()) == [f"0-{batches[-1]}"]
    merged = hourly.to_lake_rows(hourly.add_week_index(streamed_hourly(spark, root)))
    assert sorted(merged.collect()) == sorted(batch.collect())


def test_replayed_batch_overwrites_its_partial(spark, raw, tmp_path):
    from gantrylake.streaming.hourly import write_partial

    batch = hourly.keyed_trips(raw(raw_row(), raw_row()), TARGETS, 2026, 3)
    for _ in range(2):
        write_partial(str(tmp_path))(batch, 0)
    assert streamed_hourly(spark, str(tmp_path)).first().counts == 2


def test_quarantine_stream(spark, raw, tmp_path):
    land(raw, tmp_path / "in", "a", [raw_row(), raw_row(VehicleType="abc")])
    query = start_quarantine_stream(stream_trips(spark, str(tmp_path / "in")), str(tmp_path / "bad"), str(tmp_path / "c"))
    query.awaitTermination()
    (row,) = spark.read.parquet(str(tmp_path / "bad")).collect()
    assert (row.VehicleType, row.reject_reason) == ("abc", "vehicle_type")


def test_windows_in_append_mode_emit_closed_hours(spark, raw, tmp_path):
    times = ["2026-03-01 08:10:00", "2026-03-01 08:50:00", "2026-03-01 12:00:00"]
    land(raw, tmp_path / "in", "a", [raw_row(DetectionTime_O=t) for t in times])
    windows = hourly_windows(stream_trips(spark, str(tmp_path / "in")), late_by="1 hour")
    query = (
        windows.writeStream.format("parquet").outputMode("append").option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    (row,) = spark.read.parquet(str(tmp_path / "out")).collect()
    assert (row.window_start, row.window_end, row.trips) == ("2026-03-01 08:00:00", "2026-03-01 09:00:00", 2)


def test_time_field_is_matched_once(spark, raw, tmp_path):
    land(raw, tmp_path / "in", "a", [raw_row()])
    batch = hourly.keyed_trips(raw(raw_row()), TARGETS, 2026, 3)
    plan = hourly.count_keyed(batch, hourly.HOURLY_KEYS)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RLIKE") + plan.count("rlike") <= 1
