"""Watermarked sliding-window KPIs on a stream (X1-X7, A1-A5 streaming form).

The stream reads the five fields it needs straight from the JSON value
(``get_json_object``), like the live job, so nothing else is parsed.  Window
times are emitted as UTC ``timestamp_ntz`` to match the batch tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fleetlake.functions.exprs import utc_ntz
from fleetlake.operators import kpi as K
from fleetlake.operators import metrics as M
from fleetlake.sinks import TableStore

# Published snapshots that are kept for readers that have just opened one.
KEEP_PUBLISHED = 5


def stream_positions(bronze: DataFrame, max_abs: int = 1800) -> DataFrame:
    """route, vehicle, event time (instant), speed, delay; delay outliers removed."""
    v = F.col("json_str")
    # The places of the five fields in the message.
    return (bronze.select(
        F.get_json_object(v, "$.topic.route_id").alias("route_id"),
        F.get_json_object(v, "$.topic.vehicle_number").alias("vehicle_number"),
        F.try_to_timestamp(F.get_json_object(v, "$.payload.VP.tst")).alias("event_time"),
        F.get_json_object(v, "$.payload.VP.spd").try_cast("double").alias("spd"),
        F.get_json_object(v, "$.payload.VP.dl").try_cast("double").alias("dl"))
        .filter(F.col("dl").isNotNull() & (F.abs(F.col("dl")) <= max_abs)))


def _ntz_windows(df: DataFrame) -> DataFrame:
    return df.withColumn("window_start", utc_ntz("window_start")).withColumn("window_end", utc_ntz("window_end"))


def kpi_stream(positions: DataFrame, watermark: str = "1 minute", window_s: int = 300, slide_s: int | None = 30,
               approx: bool = True, dedupe: bool = False) -> DataFrame:
    """Sliding KPIs; append mode emits a window once the watermark passes its end.

    ``dedupe=True`` first drops repeated reports of a vehicle at the same
    instant within the watermark, so re-sent messages are not counted twice.
    """
    wm = dedupe_stream(positions, watermark=watermark) if dedupe else positions.withWatermark("event_time", watermark)
    return _ntz_windows(K.kpi_windows(wm, ts="event_time", window_s=window_s, slide_s=slide_s,
                                      approx=approx, method="window"))


def route_delay_stream(positions: DataFrame, watermark: str = "1 minute", window_s: int = 300,
                       slide_s: int | None = 30, dedupe: bool = False) -> DataFrame:
    wm = dedupe_stream(positions, watermark=watermark) if dedupe else positions.withWatermark("event_time", watermark)
    return _ntz_windows(K.route_delay_windows(wm, ts="event_time", window_s=window_s, slide_s=slide_s,
                                              method="window"))


def dedupe_stream(positions: DataFrame, keys=("vehicle_number", "event_time"), watermark: str = "1 minute") -> DataFrame:
    """Drop repeated reports inside the watermark before the KPIs (X7, fixes double counting)."""
    return positions.withWatermark("event_time", watermark).dropDuplicatesWithinWatermark(list(keys))


def _publish(df: DataFrame, batch_id: int, target: str) -> None:
    """A new snapshot of the small table at ``target``, made current by one manifest row: a reader sees the
    old one until then and never an empty or missing table.  Superseded snapshots go later."""
    root, name = target.rstrip("/").rsplit("/", 1)
    store = TableStore(df.sparkSession, root)
    store.write_refresh(name, df.withColumn("batch_id", F.lit(batch_id)))
    store.vacuum(name, keep=KEEP_PUBLISHED)


def read_current(spark: SparkSession, target: str) -> DataFrame:
    """The table last published at ``target`` by ``publish_latest`` or ``publish_extremes``."""
    root, name = target.rstrip("/").rsplit("/", 1)
    return TableStore(spark, root).read(name)


def publish_latest(batch_df: DataFrame, batch_id: int, target: str) -> None:
    """Per micro-batch, publish the freshest window as the small 'current' table (X5).  A batch that
    closes no window leaves the published row as it is."""
    if not batch_df.isEmpty():
        _publish(K.latest_window(batch_df), batch_id, target)


def publish_extremes(batch_df: DataFrame, batch_id: int, target: str, min_events: int = 5) -> None:
    """Clear-then-set of best/worst route of the freshest window, as one new snapshot (X6).  Cleared only
    when a window closed and none of its routes has enough reports."""
    if not batch_df.isEmpty():
        _publish(K.route_extremes(batch_df, min_events=min_events, latest_only=True), batch_id, target)


def _append(df: DataFrame, batch_id: int, day: str, target: str) -> None:
    """Idempotent append of a micro-batch's rows, by day and batch id."""
    (df.withColumn("day", F.col(day).cast("date")).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day", "batch_id").parquet(target))


def start_metrics(positions: DataFrame, out_dir: str, checkpoint_dir: str, *, trigger: str = "15 seconds",
                  available_now: bool = False, history: bool = True, watermark: str = "1 minute", approx: bool = True,
                  dedupe: bool = False, min_events: int = 5) -> tuple[StreamingQuery, StreamingQuery]:
    """Both stateful KPI queries of one application, each with its own checkpoint.

    Every closed window is appended to the metrics table in long form
    (``metrics/query=kpi`` and ``metrics/query=route_delay``; K11), which the
    gauge-series queries read; ``history=True`` also keeps the wide ``kpi`` and
    ``route_delay`` tables.  The 'current' snapshots hold the freshest window.
    """
    def sink(df: DataFrame, name: str, publish, to_long):
        def each(batch_df: DataFrame, batch_id: int) -> None:
            batch_df.persist()
            try:
                if history:
                    _append(batch_df, batch_id, "window_end", f"{out_dir}/{name}")
                _append(to_long(batch_df), batch_id, "ts", f"{out_dir}/metrics/query={name}")
                publish(batch_df, batch_id, f"{out_dir}/{name}_current")
            finally:
                batch_df.unpersist()

        w = (df.writeStream.outputMode("append").foreachBatch(each)
             .option("checkpointLocation", f"{checkpoint_dir}/{name}"))
        w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=trigger)
        return w.start()

    totals = sink(kpi_stream(positions, watermark, approx=approx, dedupe=dedupe), "kpi", publish_latest, M.metrics_to_long)
    extremes = sink(
        route_delay_stream(positions, watermark, dedupe=dedupe), "route_delay",
        lambda df, bid, to: publish_extremes(df, bid, to, min_events),
        lambda df: M.extremes_to_long(K.route_extremes(df, min_events=min_events, latest_only=False)))
    return totals, extremes


def read_metrics(spark: SparkSession, out_dir: str) -> DataFrame:
    """The metrics table that ``start_metrics`` writes."""
    return spark.read.parquet(f"{out_dir}/metrics").select(*M.SERIES, "ts", "value")
