"""Streams in several batches give what one batch gives."""

import datetime as dt
import tempfile

from pyspark.sql import functions as F

from factlake.streaming import streams


def test_replay_over_batches(spark):
    root = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    rows = [(i % 7, i, f"t{i % 3}") for i in range(60)]
    schema = "user_id long, event_id long, event_type string"
    for k in range(4):
        spark.createDataFrame(rows[k::4], schema).coalesce(1).write.mode("append").parquet(f"{root}/log")
    whole = spark.read.schema(schema).parquet(f"{root}/log")
    state = streams.replayed(spark, f"{root}/log", whole.schema, "user_id", ["event_id"], ["user_id", "event_id", "event_type"], files_per_batch=1)
    assert {(r.user_id, r.event_id) for r in state.collect()} == {(u, max(i for v, i, _ in rows if v == u)) for u in range(7)}


def test_windows_and_watermarks(spark):
    now = dt.datetime(2026, 9, 30)
    cases = spark.createDataFrame([(now, None), (now, dt.datetime(2026, 9, 20)), (now, dt.datetime(2026, 1, 1))], "now timestamp, mark timestamp")
    start, end = streams.incremental_window(F.col("now"), F.col("mark"), "30 days", "48 hours")
    assert [r.s for r in cases.select(start.alias("s")).collect()] == [dt.datetime(2026, 8, 31), dt.datetime(2026, 9, 18), dt.datetime(2026, 8, 31)]
    (a, b), (c, d) = streams.bootstrap_windows(F.col("now"), "7 days", "30 days")
    row = cases.select(a.alias("a"), b.alias("b"), c.alias("c"), d.alias("d")).first()
    assert (row.a, row.b, row.c, row.d) == (dt.datetime(2026, 9, 23), now, dt.datetime(2026, 8, 31), dt.datetime(2026, 9, 23))
    units = spark.createDataFrame([(dt.datetime(2026, 9, 2), True), (dt.datetime(2026, 9, 3), False)], "at timestamp, done boolean")
    old = F.lit(dt.datetime(2026, 9, 1))
    assert streams.advanced_watermark(units, old).first().watermark == dt.datetime(2026, 9, 1)
    assert streams.advanced_watermark(units.filter("done"), old).first().watermark == dt.datetime(2026, 9, 2)
    pages = spark.createDataFrame([(1, "a"), (2, "b")], "page int, content string")
    seen = pages.withColumn("content_sha256", F.sha2("content", 256)).filter("page = 1").union(spark.createDataFrame([(2, "x", "old")], "page int, content string, content_sha256 string"))
    assert [r.page for r in streams.unread_pages(pages, seen).collect()] == [2]


def test_sessions(spark):
    t0 = dt.datetime(2026, 9, 1)
    rows = [("k", t0 + dt.timedelta(seconds=s)) for s in (0, 900, 1800, 5000)]
    out = streams.sessions(spark.createDataFrame(rows, "k string, at timestamp"), "k", "at", "960 seconds", "1 hour")
    assert sorted((r.seconds, r.n_samples) for r in out.collect()) == [(960.0, 1), (2760.0, 3)]


def test_a_broken_run_resumes(spark, monkeypatch):
    root = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    rows = [(i % 7, i, f"t{i % 3}") for i in range(60)]
    schema = "user_id long, event_id long, event_type string"
    for k in range(4):
        spark.createDataFrame(rows[k::4], schema).coalesce(1).write.mode("append").parquet(f"{root}/log")
    whole, where = spark.read.schema(schema).parquet(f"{root}/log").schema, f"file://{root}/run"
    run = lambda: streams.replayed(spark, f"{root}/log", whole, "user_id", ["event_id"], ["user_id", "event_id", "event_type"], files_per_batch=1, where=where)
    calls, real = [], streams.last_rows

    def breaks(*args):
        calls.append(1)
        if len(calls) == 3:
            raise RuntimeError("lost")
        return real(*args)

    monkeypatch.setattr(streams, "last_rows", breaks)
    try:
        run()
        raise AssertionError("the run was to break")
    except Exception as e:  # noqa: BLE001
        assert "lost" in str(e)
    assert streams.finished_batches(spark, where) == [0, 1]
    state = run()
    assert len(calls) == 5 and {(r.user_id, r.event_id) for r in state.collect()} == {(u, max(i for v, i, _ in rows if v == u)) for u in range(7)}
    assert run().count() == 7 and len(calls) == 5  # nothing new: the state as it was
    spark.createDataFrame([(3, 1000, "t")], schema).coalesce(1).write.mode("append").parquet(f"{root}/log")
    assert {(r.user_id, r.event_id) for r in run().collect() if r.user_id == 3} == {(3, 1000)} and len(calls) == 6
