"""Streams against the batch results, and alerts on a small history."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tallyfold.streaming import monitor

START = datetime(2024, 1, 1)


def events(spark):
    rows = [(k, START + timedelta(minutes=7 * k), ["click", "error", "view"][k % 3]) for k in range(120)]
    return spark.createDataFrame(rows, "event_id long, ts timestamp, event_type string")


def test_windows_as_a_stream_equal_the_batch(spark, tmp_path):
    events(spark).repartition(3).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("event_id long, ts timestamp, event_type string").parquet(str(tmp_path / "in"))
    counts = monitor.tumbling_counts(stream, "1 hour")
    q = counts.writeStream.format("memory").queryName("tumbling").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination(120)
    batch = monitor.tumbling_counts(events(spark), "1 hour")
    assert sorted(map(str, spark.table("tumbling").collect())) == sorted(map(str, batch.collect()))


def test_batches_take_up_where_the_last_ended(spark, tmp_path):
    (tmp_path / "in").mkdir()
    rows = events(spark)
    seen = []
    for part in (0, 1):
        rows.where(F.col("event_id") % 2 == part).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema("event_id long, ts timestamp, event_type string").parquet(str(tmp_path / "in"))
        monitor.for_each_batch(stream, lambda df, k: seen.append(df.count()), str(tmp_path / "cp")).awaitTermination(120)
    assert seen == [60, 60]


def test_running_counts_keep_state(spark, tmp_path):
    events(spark).coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("event_id long, ts timestamp, event_type string").parquet(str(tmp_path / "in"))
    q = monitor.running_counts(stream, "event_type").writeStream.format("memory").queryName("running").outputMode("update").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert {r.event_type: r.seen for r in spark.table("running").collect()} == {"click": 40, "error": 40, "view": 40}


def test_alerts(spark):
    minute = lambda m: START + timedelta(minutes=m)
    rows = [
        (1, minute(0), minute(0), 5, 10, 0), (2, minute(40), minute(0), 5, 10, 0), (3, minute(50), minute(0), 5, 10, 2), (4, minute(60), minute(55), 5, 11, 2),
        (5, minute(70), minute(60), 0, 11, 1), (6, minute(80), minute(60), 0, 11, 1),
    ]
    df = spark.createDataFrame(rows, "k int, taken_at timestamp, last_processed_at timestamp, pending int, with_financials int, errors int")
    got = sorted((r.k, r.alert) for r in monitor.alerts(df, "k", 30, 2).collect())
    assert got == [(2, "stalled"), (3, "errors_increased"), (3, "no_progress"), (5, "completed"), (6, "no_progress")]
    change = {r.k: r.errors_delta for r in monitor.snapshot_change(df, "k", ["errors"]).collect()}
    assert change == {1: None, 2: 0, 3: 2, 4: 0, 5: -1, 6: 0}


def test_rates_and_last_events(spark):
    calls = spark.createDataFrame([("a", START + timedelta(milliseconds=400 * k)) for k in range(6)], "k string, at timestamp")
    assert sorted(r.in_window for r in monitor.calls_in_window(calls, "k", "at", 1_000_000).collect()) == [1, 2, 3, 3, 3, 3]
    log = spark.createDataFrame([("start", 1), ("done", 2), ("start", 3)], "event string, pos int")
    assert {r.event: r.last.pos for r in monitor.last_of_kind(log, "pos", ["start", "done"]).collect()} == {"start": 3, "done": 2}


def test_dense_calls_are_counted_by_running_counts(spark):
    from pyspark.sql import functions as F

    calls = spark.range(400).select("id", F.when(F.col("id") % 50 > 0, F.timestamp_micros((F.col("id") * 7919) % 997 * 10_000)).alias("at"), F.when(F.col("id") % 3 > 0, "k").alias("k"))
    found = monitor.calls_in_window(calls, "k", "at", 1_000_000)
    rows = [(r.id, r.at and round(r.at.timestamp() * 1e6), r.k) for r in calls.collect()]
    want = {i: sum(k == l and (a is b is None or None not in (a, b) and a - 1_000_000 <= b <= a) for _, b, l in rows) for i, a, k in rows}
    assert {r.id: r.in_window for r in found.collect()} == want
    assert "RangeFrame, -" not in found._jdf.queryExecution().optimizedPlan().toString()
