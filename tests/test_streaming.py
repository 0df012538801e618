"""Streams equal batch on closed windows; late rows are dropped and counted; restarts do not duplicate."""

import datetime as dt

from pyspark.sql import functions as F

from fleetlake.operators import kpi as K
from fleetlake.sources.fixtures import bronze_events
from fleetlake.sources.kafka import read_events_stream
from fleetlake.streaming.kpi_stream import (
    dedupe_stream, kpi_stream, publish_extremes, publish_latest, read_current, read_metrics, start_metrics, stream_positions,
)
from fleetlake.streaming.landing import append_batch, start_landing

SF = "/root/testdata/sf0.001"


def _write_in_order(spark, bronze, path, cuts):
    """One directory write per event-time slice, in order, so file times follow event time."""
    ts = F.col("timestamp")
    for lo, hi in zip(cuts[:-1], cuts[1:]):
        bronze.filter((ts >= F.lit(lo).cast("timestamp_ntz")) & (ts < F.lit(hi).cast("timestamp_ntz"))) \
            .drop("insert_time").coalesce(1).write.mode("append").parquet(path)


CUTS = ["2023-12-31", "2024-01-08", "2024-01-16", "2024-01-24", "2024-02-01"]


def test_stream_equals_batch_on_closed_windows(spark, tmp_path):
    ev = spark.read.parquet(f"{SF}/events.parquet")
    b = bronze_events(ev)
    raw = str(tmp_path / "raw")
    _write_in_order(spark, b, raw, CUTS)
    src = read_events_stream(spark, "files", path=raw, max_files_per_trigger=1)
    q = (kpi_stream(stream_positions(src), approx=True).writeStream.format("parquet")
         .option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "chk"))
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).select("window_start", "events", "avg_speed")
    pos = stream_positions(b).withColumn("tst", F.col("event_time"))
    batch = K.kpi_windows(pos.withColumn("tst", F.col("event_time").cast("timestamp_ntz")))
    max_t = pos.agg(F.max("event_time")).first()[0].replace(tzinfo=None)
    closed = batch.filter(F.col("window_end") <= F.lit(max_t - dt.timedelta(minutes=1)))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, closed.select("window_start", "events", "avg_speed").collect()))
    assert q.lastProgress is not None


def test_late_rows_are_dropped_and_counted(spark, tmp_path):
    ev = spark.read.parquet(f"{SF}/events.parquet")
    b = bronze_events(ev, resend_every=None)
    raw = str(tmp_path / "raw")
    _write_in_order(spark, b, raw, CUTS)
    # a last file replaying the first day's reports: all behind the watermark
    b.filter(F.col("timestamp") < F.lit("2024-01-02").cast("timestamp_ntz")).drop("insert_time") \
        .coalesce(1).write.mode("append").parquet(raw)
    src = read_events_stream(spark, "files", path=raw, max_files_per_trigger=1)
    q = (kpi_stream(stream_positions(src)).writeStream.format("memory").queryName("late_kpi")
         .option("checkpointLocation", str(tmp_path / "chk")).outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    dropped = sum(sum(op.get("numRowsDroppedByWatermark", 0) for op in p.get("stateOperators", []))
                  for p in q.recentProgress)
    assert dropped > 0


def test_landing_restart_and_replayed_batch_do_not_duplicate(spark, tmp_path):
    ev = spark.read.parquet(f"{SF}/events.parquet")
    b = bronze_events(ev, resend_every=None)
    raw, out, chk = str(tmp_path / "raw"), str(tmp_path / "bronze"), str(tmp_path / "chk")
    _write_in_order(spark, b, raw, CUTS[:3])
    start_landing(read_events_stream(spark, "files", path=raw), out, chk, available_now=True).awaitTermination()
    n1 = spark.read.parquet(out).count()
    _write_in_order(spark, b, raw, CUTS[2:])
    start_landing(read_events_stream(spark, "files", path=raw), out, chk, available_now=True).awaitTermination()
    assert spark.read.parquet(out).count() == b.count() and n1 < b.count()
    # the same batch id written twice replaces itself
    one = spark.read.parquet(out).filter("batch_id = 0").drop("batch_id")
    cnt = one.count()
    append_batch(one.cache(), 0, out)
    assert spark.read.parquet(out).filter("batch_id = 0").count() == cnt


def test_dedupe_stream_and_metric_sinks(spark, tmp_path):
    ev = spark.read.parquet(f"{SF}/events.parquet")
    b = bronze_events(ev, resend_every=5)
    raw = str(tmp_path / "raw")
    b.drop("insert_time").write.parquet(raw)
    pos = stream_positions(read_events_stream(spark, "files", path=raw))
    q = (dedupe_stream(pos).writeStream.format("memory").queryName("dedup_pos")
         .option("checkpointLocation", str(tmp_path / "chk1")).trigger(availableNow=True).start())
    q.awaitTermination()
    assert spark.table("dedup_pos").count() == stream_positions(bronze_events(ev, resend_every=None)).count()
    t, e = start_metrics(pos, str(tmp_path / "m"), str(tmp_path / "chk2"), available_now=True)
    t.awaitTermination()
    e.awaitTermination()
    assert read_current(spark, str(tmp_path / "m" / "kpi_current")).count() == 1
    assert spark.read.parquet(str(tmp_path / "m" / "kpi")).count() > 0


def test_landing_with_processing_time_trigger(spark, tmp_path):
    ev = spark.read.parquet(f"{SF}/events.parquet")
    b = bronze_events(ev, resend_every=None)
    raw, out = str(tmp_path / "raw"), str(tmp_path / "bronze")
    b.drop("insert_time").write.parquet(raw)
    q = start_landing(read_events_stream(spark, "files", path=raw), out, str(tmp_path / "chk"),
                      trigger="1 second", query_name="landing_pt")
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    landed = spark.read.parquet(out)
    assert landed.count() == b.count()
    assert landed.filter(F.col("insert_time").isNull()).count() == 0


def test_an_empty_batch_keeps_the_published_window(spark, tmp_path):
    rows = [(dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1, 0, 5), "A", 1.0, 9)]
    schema = "window_start timestamp_ntz, window_end timestamp_ntz, route_id string, avg_delay_sec double, events_cnt long"
    df = spark.createDataFrame(rows, schema)
    publish_extremes(df, 0, str(tmp_path / "x"))
    publish_latest(df, 0, str(tmp_path / "l"))
    publish_extremes(df.limit(0), 1, str(tmp_path / "x"))
    publish_latest(df.limit(0), 1, str(tmp_path / "l"))
    assert read_current(spark, str(tmp_path / "x")).count() == 2 and read_current(spark, str(tmp_path / "l")).count() == 1
    publish_extremes(df.withColumn("events_cnt", F.lit(1)), 2, str(tmp_path / "x"))   # closed, but nobody qualifies: cleared
    assert read_current(spark, str(tmp_path / "x")).count() == 0


def test_metrics_table_feeds_the_gauge_queries(spark, tmp_path):
    from fleetlake.operators import metrics as M
    raw = str(tmp_path / "raw")
    bronze_events(spark.read.parquet(f"{SF}/events.parquet")).drop("insert_time").write.parquet(raw)
    pos = stream_positions(read_events_stream(spark, "files", path=raw))
    for q in start_metrics(pos, str(tmp_path / "m"), str(tmp_path / "c"), available_now=True, history=False, min_events=1, dedupe=True):
        q.awaitTermination()
    m = read_metrics(spark, str(tmp_path / "m"))
    assert {r["metric"] for r in M.metric_latest(m).select("metric").distinct().collect()} == {*M.GAUGES, M.EXTREME_GAUGE}
    assert M.metric_topk_over(m, M.EXTREME_GAUGE, 1, 120, labels={"type": "worst"}, scale=60.0).count() == 1


def test_landing_with_the_ingest_filter(spark, tmp_path):
    from fleetlake.operators.envelope import filter_journey, flatten_envelope
    b = bronze_events(spark.read.parquet(f"{SF}/events.parquet"), resend_every=None)
    raw, out = str(tmp_path / "raw"), str(tmp_path / "bronze")
    b.drop("insert_time").write.parquet(raw)
    start_landing(read_events_stream(spark, "files", path=raw), out, str(tmp_path / "chk"), available_now=True,
                  modes=["bus"]).awaitTermination()
    kept, lost = spark.read.parquet(out), spark.read.parquet(f"{out}_rejected")
    assert kept.count() == filter_journey(flatten_envelope(b)).count() and kept.count() + lost.count() == b.count()
    assert {r[0] for r in lost.select("reject_reason").distinct().collect()} >= {"mode", "not_journey", "not_ongoing"}
