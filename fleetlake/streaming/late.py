"""Late reports counted and kept.

The windowed queries drop what is behind their watermark and say nothing of
which reports those were.  This query runs beside them on the same positions,
with the same delay: a micro-batch's watermark is the greatest event time of all
earlier batches less the delay, as Spark's own is.  Reports behind it are kept in
a table, ``lost`` telling those whose every window had closed, and the counts
go to the metrics table as gauges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.observation import Observation
from pyspark.sql.streaming import StreamingQuery

from fleetlake.functions.exprs import utc_ntz
from fleetlake.sinks import TableStore
from fleetlake.streaming.kpi_stream import _append

WATERMARK = "late_watermark"
GAUGES = ("late_reports", "lost_reports")


def mark_late(positions: DataFrame, watermark_us: int | None, window_s: int = 300, slide_s: int = 30) -> DataFrame:
    """``late``: the report's time is behind the watermark; ``lost``: so is the end of the newest window that holds it."""
    at = F.unix_micros("event_time")
    if watermark_us is None:
        return positions.withColumns({"late": F.lit(False), "lost": F.lit(False)})
    slide = slide_s * 1_000_000
    newest_end = at - F.pmod(at, F.lit(slide)) + window_s * 1_000_000
    late = F.coalesce(at < watermark_us, F.lit(False))
    return positions.withColumns({"late": late, "lost": late & (newest_end <= watermark_us)})


def keep_late(batch_df: DataFrame, batch_id: int, out_dir: str, delay_s: int = 60, window_s: int = 300, slide_s: int = 30) -> None:
    """One micro-batch: late reports to ``late``, counts to the metrics table, its greatest time to the watermark.

    A batch that is repeated after a failure replaces its own rows; the
    watermark table holds the last two batches, so a repeated one finds the
    watermark that it had.
    """
    spark, store = batch_df.sparkSession, TableStore(batch_df.sparkSession, out_dir)
    before = {r["batch_id"]: r["max_us"] for r in store.read(WATERMARK).collect()} if store.exists(WATERMARK) else {}
    earlier = {b: t for b, t in before.items() if b < batch_id}
    reached = max((t for t in earlier.values() if t is not None), default=None)
    seen = Observation(f"late-{batch_id}")
    marked = mark_late(batch_df, None if reached is None else reached - delay_s * 1_000_000, window_s, slide_s).observe(
        seen, F.max(F.unix_micros("event_time")).alias("max_us"), F.count_if("late").alias("late"), F.count_if("lost").alias("lost"))
    _append(marked.filter("late").drop("late").withColumn("event_time", utc_ntz("event_time")), batch_id, "event_time", f"{out_dir}/late")
    found = seen.get
    top = max((t for t in (reached, found["max_us"]) if t is not None), default=None)
    if top is not None:
        gauges = spark.createDataFrame([(g, float(n or 0)) for g, n in zip(GAUGES, (found["late"], found["lost"]), strict=True)],
                                       "metric string, value double")
        _append(gauges.select("metric", F.lit(None).cast("string").alias("type"), F.lit(None).cast("string").alias("route_id"),
                              utc_ntz(F.timestamp_micros(F.lit(top))).alias("ts"), "value"), batch_id, "ts", f"{out_dir}/metrics/query=late")
    last = max(earlier, default=None)
    rows = [(batch_id, top)] + ([(last, earlier[last])] if last is not None else [])
    store.write_refresh(WATERMARK, spark.createDataFrame(rows, "batch_id long, max_us long"))
    store.vacuum(WATERMARK)


def start_late_audit(positions: DataFrame, out_dir: str, checkpoint: str, *, delay_s: int = 60, window_s: int = 300, slide_s: int = 30,
                     trigger: str = "15 seconds", available_now: bool = False) -> StreamingQuery:
    """Run ``keep_late`` beside ``start_metrics`` on the same positions; ``delay_s`` is the watermark delay of these."""
    w = (positions.writeStream.foreachBatch(lambda df, bid: keep_late(df, bid, out_dir, delay_s, window_s, slide_s))
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=trigger)
    return w.start()


def late_counts(metrics: DataFrame) -> DataFrame:
    """``(late_reports, lost_reports)`` of all batches, from the metrics table."""
    return metrics.filter(F.col("metric").isin(*GAUGES)).agg(*[
        F.coalesce(F.sum(F.when(F.col("metric") == g, F.col("value"))), F.lit(0.0)).cast("long").alias(g) for g in GAUGES])
