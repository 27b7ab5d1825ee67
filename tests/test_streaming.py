"""Streams over several files: late rows, restarts, alert state, repeats."""

import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from aerostat import schema as S
from aerostat.operators import alerting
from aerostat.streaming import alerts, sinks, sources, windows
from aerostat.streaming import late as late_rows

T0 = datetime(2026, 1, 1)
ROW = "station_id string, timestamp timestamp, aqi double, pm2_5 double"


def feed(spark, path, *batches):
    """One file per batch, in order."""
    for rows in batches:
        spark.createDataFrame(rows, ROW).coalesce(1).write.mode("append").parquet(str(path))
    return sources.parquet_stream(spark, str(path), spark.read.parquet(str(path)).schema, max_files=1)


def reading(minutes, aqi=50.0, pm2_5=50.0, station="A"):
    return (station, T0 + timedelta(minutes=minutes), aqi, pm2_5)


def test_late_rows_are_dropped_and_counted(spark, tmp_path):
    # A row is judged by the watermark of the batch before the last one.
    stream = feed(spark, tmp_path / "in", [reading(0)], [reading(120)], [reading(121)], [reading(1), reading(122)])
    counts = windows.window_aqi(stream, "10 minutes", slide=None)
    late = sinks.LateRows()
    spark.streams.addListener(late)
    query, drained = sinks.bounded_run(counts, str(tmp_path / "out"), str(tmp_path / "cp"))
    assert drained
    out = spark.read.parquet(str(tmp_path / "out"))
    assert [r.record_count for r in out.orderBy("window_start").collect()] == [1]
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    deadline = time.time() + 20
    while late.batches < len(query.recentProgress) and time.time() < deadline:
        time.sleep(0.1)
    spark.streams.removeListener(late)
    assert late.total == sum(o.numRowsDroppedByWatermark for p in query.recentProgress for o in p.stateOperators) >= 1


def test_late_readings_are_those_that_no_window_counted(spark, tmp_path):
    batches = [[reading(i * 40 + j * 7, station=k) for j in range(6) for k in "AB"] for i in range(5)]
    batches[4] += [reading(m) for m in (1, 1, 2, 75, 178)] + [reading(-500, station="B")]
    stream = feed(spark, tmp_path / "in", *batches)
    late = late_rows.late_run(stream, str(tmp_path / "late"), str(tmp_path / "cp"), "10 minutes", "30 minutes")
    assert {r.batch_id for r in late.collect()} == {4}
    assert sorted((r.timestamp - T0).total_seconds() / 60 for r in late.collect()) == [-500, 1, 1, 2, 75]
    counts = windows.window_aqi(stream, "10 minutes", "30 minutes", None)
    sinks.bounded_run(counts, str(tmp_path / "out"), str(tmp_path / "cp2"))
    counted = spark.read.parquet(str(tmp_path / "out"))
    closed = counted.agg(F.max("window_end")).first()[0]
    every = spark.read.parquet(str(tmp_path / "in")).filter(F.window("timestamp", "30 minutes")["end"] <= closed).count()
    assert counted.agg(F.sum("record_count")).first()[0] + late.count() == every
    # Nothing is lost or doubled by a second run over the same checkpoint.
    again = late_rows.late_run(stream, str(tmp_path / "late"), str(tmp_path / "cp"), "10 minutes", "30 minutes")
    assert again.count() == 5


def test_a_run_that_is_stopped_says_so(spark, tmp_path):
    stream = feed(spark, tmp_path / "in", *[[reading(i)] for i in range(40)])
    with pytest.raises(TimeoutError):
        sinks.bounded_table(stream, seconds=0.5)
    _, drained = sinks.bounded_run(stream, str(tmp_path / "out"), str(tmp_path / "cp"), seconds=0.5)
    assert not drained
    _, drained = sinks.bounded_run(stream, str(tmp_path / "out"), str(tmp_path / "cp"))
    assert drained and spark.read.parquet(str(tmp_path / "out")).count() == 40


def test_snapshots_stand_beside_each_other(spark, tmp_path):
    path, counts = str(tmp_path / "out"), lambda: feed(spark, tmp_path / "in", [reading(0)], [reading(1)]).groupBy("station_id").count()
    like = counts()
    assert sinks.latest_snapshot(like, path).collect() == []
    sinks.snapshot_run(like, path, str(tmp_path / "cp"))
    (tmp_path / "out" / "batch_id=9").mkdir()  # a write that failed: no mark of completion
    assert [r["count"] for r in sinks.latest_snapshot(like, path).collect()] == [2]


def test_restart_adds_only_new_rows(spark, tmp_path):
    stream = feed(spark, tmp_path / "in", [reading(0)])
    sinks.bounded_run(stream, str(tmp_path / "out"), str(tmp_path / "cp"))
    stream = feed(spark, tmp_path / "in", [reading(5)])
    sinks.bounded_run(stream, str(tmp_path / "out"), str(tmp_path / "cp"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_alert_state_crosses_batches(spark, tmp_path):
    batches = [[reading(0, 50.0, 20.0), reading(1, 60.0, None)], [reading(2, None, 90.0), reading(3, 80.0, 31.0)]]
    found = sinks.bounded_table(alerts.alert_stream(feed(spark, tmp_path / "in", *batches)))
    table = spark.createDataFrame(sum(batches, []), ROW)
    want = alerting.alerts(table)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, want.collect()))
    assert [r.alert_type for r in found.collect()] == ["RAPID_CHANGE_ALERT"]
    again = alerts.alert_table(feed(spark, tmp_path / "again", *batches))
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, want.collect()))


def test_both_alert_streams_agree_on_a_busy_station(spark, tmp_path):
    def value(i):
        return None if i % 5 == 0 else float((i * 37) % 180)

    rows = [reading(i, None if i % 7 == 0 else float((i * 53) % 400), value(i), "A" if i % 3 else "B") for i in range(120)]
    batches = [rows[:40], rows[40:80], rows[80:]]
    want = sorted(map(tuple, alerting.alerts(spark.createDataFrame(rows, ROW)).collect()))
    stored = sinks.bounded_table(alerts.alert_stream(feed(spark, tmp_path / "s", *batches)))
    sliced = alerts.alert_table(feed(spark, tmp_path / "t", *batches))
    assert sorted(map(tuple, stored.collect())) == want
    assert sorted(map(tuple, sliced.collect())) == want


def test_duplicates_within_the_watermark(spark, tmp_path):
    stream = feed(spark, tmp_path / "in", [reading(0), reading(0)], [reading(0), reading(1)])
    assert sinks.bounded_table(sources.deduplicated_stream(stream)).count() == 2


def test_csv_stream_is_typed_and_indexed(spark, tmp_path):
    (tmp_path / "in").mkdir()
    text = "station_id,timestamp,pm2_5,pm10,no2,so2,co,o3\nA,2026-01-01 00:00:00,35.4,20,10,5,0.5,10\nA,bad,1,1,1,1,1,1\n"
    (tmp_path / "in" / "a.csv").write_text(text)
    out = sinks.bounded_table(sources.indexed_stream(sources.csv_stream(spark, str(tmp_path / "in"))), view="feed")
    assert [(r.aqi, r.aqi_category) for r in out.collect()] == [(100.0, "Moderate")]
    assert spark.sql("SELECT count(*) FROM feed").first()[0] == 1


def test_report_files(spark, tmp_path):
    stream = feed(spark, tmp_path / "in", [reading(0, 200.0), reading(1, 20.0)])
    sinks.report_run(stream, str(tmp_path / "a"), str(tmp_path / "r"), F.col("aqi") >= 150, str(tmp_path / "cp"))
    assert spark.read.json(str(tmp_path / "a")).count() == 1
    assert spark.read.option("header", True).csv(str(tmp_path / "r")).count() == 2


def test_windows_need_no_watermark_on_tables(spark):
    df = spark.createDataFrame([reading(0), reading(4), reading(8)], ROW)
    for p in S.POLLUTANTS[1:]:
        df = df.withColumn(p, F.lit(1.0))
    assert windows.window_pollutants(df).count() == 3


def test_failed_query_raises(spark, tmp_path):
    stream = feed(spark, tmp_path / "in", [reading(0)])
    broken = stream.withColumn("x", F.raise_error(F.lit("broken")))
    with pytest.raises(Exception, match="broken"):
        sinks.bounded_run(broken, str(tmp_path / "out"), str(tmp_path / "cp"))
