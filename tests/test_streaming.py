"""Streaming jobs: late data, restarts, equality with batch."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from terrahaz.functions import geometry as G
from terrahaz.session import scratch
from terrahaz.streaming import jobs

SCHEMA = "id int, ts timestamp, layer string, records bigint, errors bigint"


def _file(spark, folder, data):
    df = spark.createDataFrame(data, "id int, ts string, layer string, records bigint, errors bigint")
    df.withColumn("ts", F.col("ts").cast("timestamp")).coalesce(1).write.mode("append").parquet(folder)


def test_late_rows_are_dropped_and_counted(spark):
    folder, out, check = scratch(spark, "t-in"), scratch(spark, "t-out"), scratch(spark, "t-check")
    _file(spark, folder, [(1, "2024-01-01 10:00:00", "a", 1, 0), (2, "2024-01-01 12:00:00", "a", 1, 0)])

    def run():
        events = jobs.with_event_time(jobs.file_stream(spark, folder, SCHEMA), delay="10 minutes")
        return jobs.run_available(jobs.stream_tumbling(events, "ts", "1 hour"), out, check)

    run()
    _file(spark, folder, [(3, "2024-01-01 10:30:00", "a", 50, 0), (4, "2024-01-01 11:55:00", "a", 2, 0), (5, "2024-01-01 14:00:00", "a", 1, 0)])
    second = run()
    got = rows(spark.read.parquet(out).select(F.hour("window_start").alias("h"), "records"))
    assert got == [(10, 1), (11, 2), (12, 1)]
    assert jobs.count_late(second) == 1


def test_dedupe_across_batches(spark):
    folder, out, check = scratch(spark, "t-in"), scratch(spark, "t-out"), scratch(spark, "t-check")
    for _ in range(2):
        _file(spark, folder, [(1, "2024-01-01 10:00:00", "a", 1, 0), (2, "2024-01-01 10:01:00", "a", 1, 0)])
        events = jobs.with_event_time(jobs.file_stream(spark, folder, SCHEMA))
        jobs.run_available(jobs.stream_dedupe(events, ["id"]), out, check)
    assert rows(spark.read.parquet(out), "id") == [(1,), (2,)]


def test_gold_is_idempotent_per_batch(spark):
    folder, out, check = scratch(spark, "t-in"), scratch(spark, "t-out"), scratch(spark, "t-check")
    for i in range(2):
        _file(spark, folder, [(i, "2024-01-01 10:00:00", "a", 5, 1)])
        jobs.stream_gold(jobs.file_stream(spark, folder, SCHEMA), ["layer"], ["records", "errors"], out, check)
    jobs.stream_gold(jobs.file_stream(spark, folder, SCHEMA), ["layer"], ["records", "errors"], out, check)
    assert rows(jobs.read_gold(spark, out, ["layer"], ["records", "errors"])) == [("a", 10, 2)]


def test_large_mask_is_refused(spark, monkeypatch):
    from terrahaz.operators import spatial

    monkeypatch.setattr(spatial, "MAX_BROADCAST_BYTES", 0)
    square = '{"type":"Polygon","coordinates":[[[0,0],[1,0],[1,1],[0,0]]]}'
    shapes = spark.createDataFrame([(1, square)], "neighborhood_id int, t string").withColumn("geometry", G.polygon_from_geojson("t"))
    with pytest.raises(ValueError, match="broadcast"):
        jobs.stream_land_mask(spark.range(1), shapes)


def test_late_events_are_counted_as_events(spark):
    """Two late events of one closed hour are two, and a batch that runs again changes nothing."""
    folder, out, check = scratch(spark, "t-in"), scratch(spark, "t-counts"), scratch(spark, "t-check")
    hours = [["10:00", "14:00", "14:30"], ["10:10", "10:20", "13:55", "15:00"]]
    for part in hours:
        _file(spark, folder, [(i, f"2024-01-01 {t}:00", "a", 1, 0) for i, t in enumerate(part)])
        events = jobs.with_event_time(jobs.file_stream(spark, folder, SCHEMA), delay="10 minutes")
        jobs.run_counts(events.groupBy(F.window("ts", "1 hour").alias("w")).agg(F.count("*").alias("n")), out, check)
    got = jobs.late_events(spark, spark.read.schema(SCHEMA).parquet(folder), out, ["w"]).first()
    assert (got.offered, got.kept, got.late) == (7, 4, 3)


@pytest.mark.parametrize("max_bytes", [None, 0])
def test_land_mask_of_any_size(spark, sf, max_bytes):
    from terrahaz.operators import spatial
    from terrahaz.queries import views as V

    batch, land = V.view(spark, sf, "fx_311"), V.land(spark, sf)
    folder = scratch(spark, "t-points")
    batch.write.parquet(folder)
    points = spark.readStream.schema(spark.read.parquet(folder).schema).parquet(folder)
    out = scratch(spark, "t-masked")
    jobs.drain_land_mask(points, land, out, scratch(spark, "t-check"), max_bytes)
    want = rows(spatial.land_mask(batch, land), "request_id")
    assert want and rows(spark.read.parquet(out), "request_id") == want


def test_silence_is_told_over_a_restart(spark):
    """A timer set in one run fires in the next, when the others' events move the watermark; an event that
    comes late, but in time, prevents an alert."""
    folder, out, check = scratch(spark, "t-in"), scratch(spark, "t-alerts"), scratch(spark, "t-check")

    def run(events):
        _file(spark, folder, [(i, f"2024-01-01 {t}:00", layer, 1, 0) for i, (layer, t) in enumerate(events)])
        stream = jobs.with_event_time(jobs.file_stream(spark, folder, SCHEMA), delay="10 minutes")
        jobs.run_available(jobs.stream_no_data(stream, "layer", 1800.0), out, check)
        return [(layer, str(since)[11:16], str(fired)[11:16]) for layer, since, fired in rows(spark.read.parquet(out), "layer", "since", "fired_at")]

    # the watermark is 10:10: nobody has been silent for half an hour by then
    assert run([("a", "10:00"), ("b", "10:00"), ("c", "09:55"), ("c", "10:20")]) == []
    # b's gap is filled late, a's never: at 10:35 only a has fallen silent
    assert run([("b", "10:15"), ("c", "10:45")]) == [("a", "10:00", "10:30")]
    # nothing comes from a or b any more, and yet b is told too; c goes on
    assert run([("c", "11:10"), ("c", "11:35")]) == [("a", "10:00", "10:30"), ("b", "10:15", "10:45")]
    assert run([("a", "11:30"), ("c", "12:30")]) == [("a", "10:00", "10:30"), ("a", "11:30", "12:00"), ("b", "10:15", "10:45"), ("c", "11:35", "12:05")]
