"""Registered queries: one Spark plan per operator, over the driver's tables.

Each callable takes ``(spark, sf_dir)`` and returns a DataFrame whose column
names equal those of the matching SQL in ``fleetlake.plans.oracle``.  All of
them read whole tables (``events`` for the feed, ``part`` for dimensions);
limits appear only in top-k reports.
"""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake.operators import analytics as A
from fleetlake.operators import bitmaps as B
from fleetlake.operators import coverage as V
from fleetlake.operators import dq
from fleetlake.operators import kpi as K
from fleetlake.operators import metrics as M
from fleetlake.operators import panes as N
from fleetlake.operators.joblog import last_loaded, last_loaded_value, latest_job_log
from fleetlake.operators.envelope import (
    filter_journey, flatten_envelope, journey_rejects, parse_topic_path, record_key,
)
from fleetlake.operators.gold import dim_as_of, fact_new_rows, join_active_dim, join_as_of, join_as_of_carried, to_fact
from fleetlake.operators.scd2 import (
    ROUTE_ATTRS, STOP_ATTRS, new_or_changed_keys, scd2_apply, scd2_close, scd2_dimension, scd2_load,
)
from fleetlake.operators.silver import (
    ROUTES_CLEAN, STOPS_CLEAN, all_to_string, filter_delay_outliers, incremental, silver_events, stage_dim,
)
from fleetlake.functions.exprs import lit_ntz, utc_ntz
from fleetlake.plans import chains as C
from fleetlake.plans import sql as S
from fleetlake.schemas import FACT_COLUMNS
from fleetlake.session import shared_dir
from fleetlake.sinks import TableStore
from fleetlake.sources import fixtures as X
from fleetlake.sources import replay_index as R
from fleetlake.sources.kafka import read_events_stream, replay
from fleetlake.streaming.kpi_stream import (
    kpi_stream, read_current, read_metrics, route_delay_stream, start_metrics, stream_positions,
)
from fleetlake.streaming.landing import append_batch, compact_days, read_landed, start_landing
from fleetlake.streaming.late import late_counts, start_late_audit

# Fixed parameters of the registered queries.
DAY = "2024-01-08"                 # a Monday inside the driver's event range
LOAD1 = "2024-01-01 00:00:00"      # first dimension load / silver run
LOAD2 = "2024-01-15 00:00:00"      # second dimension load
FACT_NOW = "2024-02-01 00:00:00"   # gold run time
AS_OF = "2024-01-10 12:00:00"      # point-in-time dimension state
FIRST_UNTIL = "2024-01-16 00:00:00"   # first gold run read landings before this time
SECOND_FROM = "2024-01-14 00:00:00"   # second run re-reads two overlapping days
RANGE = ("2024-01-10 00:00:00", "2024-01-10 06:00:00")
HALF_DAY = 12 * 3600
HISTORY = ("2024-01-01 00:00:10", "2024-02-01 00:00:00")
REPLAY = ("2024-01-08 00:00:00", "2024-01-15 00:00:00")

Query = Callable[[SparkSession, str], DataFrame]


# ---------------------------------------------------------------- layers
def events(spark: SparkSession, sf: str) -> DataFrame:
    return X.table(spark, sf, "events")


# What is written once per application: stores and paths by (application, sf, name, ...).  The driver's tables
# under one ``sf`` do not change while an application runs; if they did, these would be stale.
_STORED: dict[tuple, TableStore | str] = {}


def bronze(spark: SparkSession, sf: str, **kw) -> DataFrame:
    """The raw layer: the feed encoded as messages and landed once per application, as in production."""
    key = (spark.sparkContext.applicationId, sf, "bronze", *sorted(kw.items()))
    if key not in _STORED:
        path = shared_dir(spark, "fleetlake-runs", uuid.uuid4().hex, "bronze")
        # the feed stands for many landed files: its rows are dealt out before they are made into JSON
        # and JSON repeats its names in every message, which zstd takes out far better than the default codec
        (X.bronze_events(events(spark, sf).repartition("event_id"), **kw).write.option("compression", "zstd").parquet(path))
        _STORED[key] = path
    return spark.read.parquet(_STORED[key])


def flat(spark: SparkSession, sf: str) -> DataFrame:
    return flatten_envelope(bronze(spark, sf))


def silver(spark: SparkSession, sf: str) -> DataFrame:
    return silver_events(flat(spark, sf), now=LOAD1)


def computed_fact(spark: SparkSession, sf: str) -> DataFrame:
    return to_fact(silver(spark, sf), FACT_NOW)


def _gold(spark: SparkSession, sf: str, name: str, write: Callable[[TableStore], object]) -> DataFrame:
    """A table of the gold layer of ``sf``, written once per application by the first query that reads it.
    Reports read it, as they do in production, instead of parsing the feed each time; one that reads no
    dimension doesn't wait for any."""
    key = (spark.sparkContext.applicationId, sf, "gold", name)
    if key not in _STORED:
        store = _store(spark)
        write(store)
        _STORED[key] = store
    return _STORED[key].read(name)


def fact(spark: SparkSession, sf: str) -> DataFrame:
    """The stored fact by operating day; its partition column comes first, as in the computed one."""
    def write(store: TableStore) -> None:
        store.write_append("fact_vehicle_position", computed_fact(spark, sf).repartition("oday"), ["oday"])

    return _gold(spark, sf, "fact_vehicle_position", write).select(*FACT_COLUMNS, "insert_time", "update_time")


def dim_routes(spark: SparkSession, sf: str) -> DataFrame:
    return _gold(spark, sf, "dim_routes", lambda store: store.write_refresh("dim_routes", computed_routes(spark, sf)))


def dim_stops(spark: SparkSession, sf: str) -> DataFrame:
    return _gold(spark, sf, "dim_stops", lambda store: store.write_refresh("dim_stops", computed_stops(spark, sf)))


def routes_staged(spark: SparkSession, sf: str, version: int) -> DataFrame:
    part = X.table(spark, sf, "part")
    at = LOAD1 if version == 1 else LOAD2
    landed = X.landed(X.routes_file(part, version), at, at[:10])
    return stage_dim(landed, "route_id", ROUTES_CLEAN)


def computed_routes(spark: SparkSession, sf: str, loads: int = 2, null_safe: bool = True) -> DataFrame:
    d = scd2_apply(None, routes_staged(spark, sf, 1), "route_id", ROUTE_ATTRS, LOAD1)
    if loads >= 2:
        d = scd2_apply(d, routes_staged(spark, sf, 2), "route_id", ROUTE_ATTRS, LOAD2, null_safe=null_safe)
    return d


def stops_staged(spark: SparkSession, sf: str) -> DataFrame:
    landed = X.landed(X.stops_file(X.table(spark, sf, "part")), LOAD1, LOAD1[:10])
    return stage_dim(landed, "stop_id", STOPS_CLEAN)


def computed_stops(spark: SparkSession, sf: str) -> DataFrame:
    return scd2_apply(None, stops_staged(spark, sf), "stop_id", STOP_ATTRS, LOAD1)


# ---------------------------------------------------------------- analytics
def q_route_delay_top(spark, sf):
    return A.route_delay_top(fact(spark, sf), dim_routes(spark, sf), DAY, n=10)


def q_route_density(spark, sf):
    return A.route_density(fact(spark, sf), dim_routes(spark, sf), DAY, n=10)


def q_partition_distribution(spark, sf):
    return A.partition_distribution(bronze(spark, sf))


def q_offset_gaps(spark, sf):
    # bucket_size is small here so the bucket-edge stitching is exercised at test scale
    # and two topics share the landing table with the same partitions and offsets, but other losses
    two = bronze(spark, sf, lose_every=97).unionByName(bronze(spark, sf, lose_every=89, topic="vehicle_positions_b"))
    return A.offset_gaps(two, bucket_size=64)


def q_route_bus_count(spark, sf):
    return A.route_bus_count(fact(spark, sf), None, n=10)


def q_route_stop_coverage(spark, sf):
    return A.route_stop_coverage(fact(spark, sf), n=10)


def q_hot_spots(spark, sf):
    return A.hot_spots(fact(spark, sf), 0.01, n=10)


def q_adaptive_hot_spots(spark, sf):
    return A.adaptive_hot_spots(fact(spark, sf), split_over=20)


def q_hot_stops(spark, sf):
    return A.hot_stops(fact(spark, sf), dim_stops(spark, sf), n=10)


def q_route_on_time(spark, sf):
    return A.route_on_time(fact(spark, sf))


def q_speed_by_route_vehicle(spark, sf):
    return A.speed_by_route_vehicle(fact(spark, sf))


def q_occupancy_trend(spark, sf):
    return A.occupancy_trend(fact(spark, sf), "hour")


def q_occupancy_daily(spark, sf):
    return A.occupancy_trend(fact(spark, sf), "day")


def q_peak_hours(spark, sf):
    return A.peak_hours(fact(spark, sf))


def q_stop_bottlenecks(spark, sf):
    return A.stop_bottlenecks(fact(spark, sf), dim_stops(spark, sf), DAY, n=10, min_events=2)


# ---------------------------------------------------------------- layers as queries
def q_fact_select(spark, sf):
    return computed_fact(spark, sf)


def q_fact_join_active_dim(spark, sf):
    f = fact(spark, sf).select("tst", "vehicle_number", "route_id", "dl")
    return join_active_dim(f, dim_routes(spark, sf), "route_id",
                           columns=["route_short_name", "route_long_name", "route_type"])


def q_envelope_flatten(spark, sf):
    return flat(spark, sf)


def q_dedupe_events(spark, sf):
    return silver(spark, sf).select("vehicle_number", "tst", "oday", "dl", "insert_time",
                                    "kafka_partition", "kafka_offset", "update_time")


def q_delay_outliers(spark, sf):
    return filter_delay_outliers(fact(spark, sf), "dl", max_abs=900).select("vehicle_number", "tst", "dl")


def q_json_extract(spark, sf):
    e = events(spark, sf)
    return e.select("event_id", F.get_json_object("props", "$.k").cast("int").alias("k"))


def q_all_to_string(spark, sf):
    return all_to_string(X.table(spark, sf, "customer"))


def q_topic_path(spark, sf):
    return parse_topic_path(X.topic_paths(events(spark, sf))).drop("topic_path")


def q_envelope_key(spark, sf):
    t = parse_topic_path(X.topic_paths(events(spark, sf)))
    return t.select("event_id", record_key().alias("record_key"))


def q_journey_filter(spark, sf):
    f = silver(spark, sf)
    return filter_journey(f, ("bus",)).select("vehicle_number", "tst", "route_id", "transport_mode")


def q_journey_rejects(spark, sf):
    f = silver(spark, sf)
    return journey_rejects(f, ("bus",)).select("vehicle_number", "tst", "reject_reason")


# ---------------------------------------------------------------- dimensions
_DIM_OUT = ["route_id", "route_short_name", "route_long_name", "route_type",
            "effective_start_dt", "effective_end_dt", "active_flg", "update_dt", "row_wid"]


def q_scd2_initial(spark, sf):
    return computed_routes(spark, sf, loads=1).select(*_DIM_OUT)


def q_scd2_incremental(spark, sf):
    return computed_routes(spark, sf, loads=2).select(*_DIM_OUT)


def q_scd2_incremental_plain(spark, sf):
    return computed_routes(spark, sf, loads=2, null_safe=False).select(*_DIM_OUT)


def q_scd2_new_keys(spark, sf):
    return new_or_changed_keys(routes_staged(spark, sf, 2), computed_routes(spark, sf, loads=1), "route_id",
                               ROUTE_ATTRS, LOAD2).select("route_id")


def q_scd2_closed(spark, sf):
    return scd2_close(computed_routes(spark, sf, loads=1), routes_staged(spark, sf, 2), "route_id",
                      ROUTE_ATTRS, LOAD2).select(*_DIM_OUT)


def q_dim_clean_routes(spark, sf):
    return routes_staged(spark, sf, 2)


def q_dim_clean_stops(spark, sf):
    return stops_staged(spark, sf)


def q_dim_stops(spark, sf):
    return computed_stops(spark, sf)


def q_dim_as_of(spark, sf):
    return dim_as_of(dim_routes(spark, sf), "route_id", AS_OF).select(*_DIM_OUT)


def q_fact_join_as_of(spark, sf):
    f = fact(spark, sf).select("tst", "vehicle_number", "route_id")
    return join_as_of(f, dim_routes(spark, sf), "route_id", "route_id", "tst",
                      ["route_long_name", "route_type", "row_wid"])


def q_fact_join_as_of_carried(spark, sf):
    """The point-in-time join by carrying versions forward through (route, day) slices."""
    f = fact(spark, sf).select("tst", "vehicle_number", "route_id")
    return join_as_of_carried(f, dim_routes(spark, sf), "route_id", "route_id", "tst",
                              ["route_long_name", "route_type", "row_wid"])


def q_fact_join_as_of_left(spark, sf):
    """Every report, those of no route or of a route without version too (their columns are NULL)."""
    f = fact(spark, sf).select("tst", "vehicle_number", F.when(F.col("vehicle_number") > "00005", F.col("route_id")).alias("route_id"))
    return join_as_of_carried(f, dim_routes(spark, sf), "route_id", "route_id", "tst", ["route_long_name", "row_wid"], how="left")


def q_scd2_buckets(spark, sf):
    """The routes dimension kept in hash buckets: two loads, then the second file once more (which rewrites none)."""
    store = _store(spark)
    scd2_load(store, "dim_routes", routes_staged(spark, sf, 1), "route_id", ROUTE_ATTRS, LOAD1)
    for _ in range(2):
        scd2_load(store, "dim_routes", routes_staged(spark, sf, 2), "route_id", ROUTE_ATTRS, LOAD2)
    return scd2_dimension(store, "dim_routes").select(*_DIM_OUT)


# ---------------------------------------------------------------- stored bitmaps, covered offsets, replay index
def _bitmaps(spark, sf) -> TableStore:
    """Bitmaps per day and route brought up to date by two loads: the days before DAY, then the others; once
    per application, like the gold layer."""
    key = (spark.sparkContext.applicationId, sf, "bitmaps")
    if key not in _STORED:
        store, f = _store(spark), fact(spark, sf)
        days = sorted(r[0] for r in f.select("oday").distinct().collect())
        B.refresh_bitmaps(store, f, [d for d in days if str(d) < DAY])
        B.refresh_bitmaps(store, f, [d for d in days if str(d) >= DAY])
        _STORED[key] = store
    return _STORED[key]


def q_route_density_bitmaps(spark, sf):
    return B.route_density(B.day_bitmaps(_bitmaps(spark, sf), [DAY]), dim_routes(spark, sf), n=10)


def q_route_bus_count_bitmaps(spark, sf):
    return B.route_bus_count(B.day_bitmaps(_bitmaps(spark, sf)), n=10)


def q_route_stop_coverage_bitmaps(spark, sf):
    return B.route_stop_coverage(B.day_bitmaps(_bitmaps(spark, sf)), n=10)


def q_offset_gaps_incremental(spark, sf):
    """Missing offsets after three loads: the first half of January, the rest without every seventh record, and
    the late ones, which fill holes that the second load left."""
    two = bronze(spark, sf, lose_every=97).unionByName(bronze(spark, sf, lose_every=89, topic="vehicle_positions_b"))
    first, late = F.col("insert_time") < lit_ntz(FIRST_UNTIL), F.col("offset") % 7 == 3
    store, found = _store(spark), None
    for load in (two.filter(first), two.filter(~first & ~late), two.filter(~first & late)):
        found = V.audit_load(store, load, bucket_size=64)
    return found


def _indexed_feed(spark, sf) -> TableStore:
    """Raw files by Kafka time, landed and indexed in two steps."""
    store = _store(spark)
    b, half = bronze(spark, sf).drop("insert_time"), F.col("timestamp") < lit_ntz(FIRST_UNTIL)
    for part in (b.filter(half), b.filter(~half)):
        part.repartitionByRange(8, "timestamp").write.mode("append").parquet(store.path("raw"))
        R.index_landed(store, store.path("raw"))
    return store


def q_replay_indexed(spark, sf):
    """The replay of ``replay_window`` from the files that the zone map names."""
    return R.replay_between(_indexed_feed(spark, sf), *REPLAY).select("key", "partition", "offset", "timestamp")


def q_replay_offsets(spark, sf):
    """Replay by offsets: of each Kafka partition the middle third, found in the data."""
    store = _indexed_feed(spark, sf)
    spans = store.read(R.INDEX).groupBy("topic", "partition").agg(F.min("min_offset").alias("lo"), F.max("max_offset").alias("hi"))
    third = F.expr("(hi - lo) div 3")
    ranges = spans.select("topic", "partition", (F.col("lo") + third).alias("from_offset"), (F.col("hi") - third).alias("to_offset"))
    return R.replay_offsets(store, ranges).select("key", "partition", "offset", "timestamp")


# ---------------------------------------------------------------- data quality, job control
STOPS_RULES = [
    dq.not_empty(),
    dq.columns_exist(["stop_id", "stop_name", "stop_lat", "stop_lon", "stop_url"]),
    dq.no_nulls("stop_id"),
    dq.no_nulls("stop_lon"),
    dq.no_duplicates(["stop_id"]),
    dq.values_in_set("wheelchair_boarding", [0, 1, 2]),
    dq.active_unique(["stop_id"]),
]


def q_dq_report(spark, sf):
    return dq.dq_report(dim_stops(spark, sf), STOPS_RULES, "dim_stops")


def q_dq_write_report(spark, sf):
    """The report of ``dq_report`` from the write itself: rule counters observed, bad rows dealt apart."""
    return dq.write_checked(_store(spark), "dim_stops", dim_stops(spark, sf), STOPS_RULES, "first")


def q_dq_quarantine(spark, sf):
    """Stops put apart by that write, each with the rules that it breaks, and the number of the others."""
    store = _store(spark)
    dq.write_checked(store, "dim_stops", dim_stops(spark, sf), STOPS_RULES, "first")
    bad = dq.checked_rows(store, "dim_stops", "first", quarantined=True)
    good = dq.checked_rows(store, "dim_stops", "first").agg(F.count(F.lit(1)).alias("rows"))
    return bad.select("stop_id", F.array_join("violations", ";").alias("broken"), F.lit(1).cast("long").alias("rows")).unionByName(
        good.select(F.lit(None).cast("string").alias("stop_id"), F.lit("").alias("broken"), "rows"))


def q_dq_duplicates(spark, sf):
    li = X.table(spark, sf, "lineitem")
    return dq.dq_report(li, [dq.no_duplicates(["l_orderkey", "l_linenumber"])], "lineitem")


def job_log(spark, sf):
    return X.job_log_from_bronze(bronze(spark, sf))


def q_joblog_last(spark, sf):
    return last_loaded(job_log(spark, sf))


def q_joblog_latest(spark, sf):
    return latest_job_log(job_log(spark, sf))


def _store(spark) -> TableStore:
    return TableStore(spark, shared_dir(spark, "fleetlake-runs", uuid.uuid4().hex))


def q_joblog_delete(spark, sf):
    """The log as stored after a delete (K9): written, one table forgotten, read back."""
    store = _store(spark)
    store.write_refresh(C.JOB_LOG, job_log(spark, sf))
    C.delete_logged(store, "hdw_stg", "events_stg")
    return C.job_log(store)


def q_incremental_scan(spark, sf):
    last = last_loaded_value(job_log(spark, sf), "hdw_stg", "events_stg")
    return incremental(bronze(spark, sf), last).select("key", "partition", "offset", "insert_time")


def q_dedupe_dim(spark, sf):
    """Three landings of routes; the last two at the same time, so the values decide between them."""
    part = X.table(spark, sf, "part")
    landed = (X.landed(X.routes_file(part, 1), LOAD1, LOAD1[:10])
              .unionByName(X.landed(X.routes_file(part, 2), LOAD2, LOAD2[:10]))
              .unionByName(X.landed(X.routes_file(part, 1), LOAD2, LOAD2[:10])))
    return stage_dim(landed, "route_id", ROUTES_CLEAN)


def q_fact_incremental(spark, sf):
    f = flat(spark, sf)
    existing = to_fact(silver_events(f.filter(F.col("insert_time") < lit_ntz(FIRST_UNTIL)), LOAD1), FACT_NOW)
    batch = to_fact(silver_events(incremental(f, SECOND_FROM), LOAD2), FACT_NOW)
    return fact_new_rows(batch, existing).select("oday", "vehicle_number", "tst", "dl")


# ---------------------------------------------------------------- KPIs and gauges
def kpi_in(spark, sf):
    return K.kpi_input(fact(spark, sf))


def q_kpi_windows(spark, sf):
    return K.kpi_windows(kpi_in(spark, sf))


def q_kpi_windows_tumbling(spark, sf):
    """Five-minute windows side by side (no slide)."""
    return K.kpi_windows(kpi_in(spark, sf), slide_s=None)


def q_kpi_windows_native(spark, sf):
    """Same KPIs through Spark's sliding ``window()`` (the streaming form) instead of panes."""
    return K.kpi_windows(kpi_in(spark, sf), method="window")


def q_kpi_windows_approx(spark, sf):
    """Sketch counts of vehicles against the exact ones, per window: within 5 % or not."""
    exact = K.kpi_windows(kpi_in(spark, sf)).select("window_start", F.col("active_vehicles").alias("exact"))
    rough = K.kpi_windows(kpi_in(spark, sf), approx=True)
    near = F.abs(F.col("active_vehicles") - F.col("exact")) <= 0.05 * F.col("exact")
    return rough.join(exact, "window_start").select(
        "window_start", "window_end", "events", "avg_speed", near.alias("vehicles_within_5_pct"))


def q_route_delay_windows(spark, sf):
    return K.route_delay_windows(kpi_in(spark, sf))


def q_latest_window(spark, sf):
    return K.latest_window(K.kpi_windows(K.newest(kpi_in(spark, sf))))


def q_route_extremes(spark, sf):
    return K.route_extremes(K.route_delay_windows(kpi_in(spark, sf)), min_events=2, latest_only=False)


def q_route_extremes_latest(spark, sf):
    """Half-day windows, so that the newest one has routes on both sides of the floor of five reports."""
    k = K.newest(kpi_in(spark, sf), slide_s=HALF_DAY)
    return K.route_extremes(K.route_delay_windows(k, window_s=HALF_DAY, slide_s=HALF_DAY), min_events=5, latest_only=True)


def q_route_extremes_none(spark, sf):
    """The floor is one report more than the newest window's busiest route has.  Older windows reach it, the newest
    does not: nothing is named.  Taking the floor first and the newest of what is left would name two."""
    windows = K.route_delay_windows(kpi_in(spark, sf), window_s=HALF_DAY, slide_s=HALF_DAY)
    floor = K.latest_window(windows).agg(F.max("events_cnt")).first()[0] + 1
    older = windows.filter(F.col("events_cnt") >= floor).agg((F.count(F.lit(1)) > 0).alias("older_reach_it"))
    found = K.route_extremes(windows, min_events=floor, latest_only=True).agg(F.count(F.lit(1)).alias("named"))
    return older.select("older_reach_it", found.scalar().alias("named"))


HORIZON = ("2024-01-03 10:20:30", "2024-01-20 05:07:00")


def _panes(spark, sf) -> TableStore:
    """Panes, hours and days of the KPI input (``kpi``) and of all reports (``all``), by three loads: the days before
    DAY, the others, and one day's early hours once more; once per application, like the gold layer."""
    key = (spark.sparkContext.applicationId, sf, "panes")
    if key not in _STORED:
        store = _store(spark)
        for name, f in (("kpi", K.kpi_input(fact(spark, sf))), ("all", fact(spark, sf))):
            first, at = F.col("tst") < lit_ntz(f"{DAY} 00:00:00"), F.col("tst")
            N.refresh(store, name, f.filter(first))
            N.refresh(store, name, f, f.filter(~first))
            N.refresh(store, name, f, f.filter((at >= lit_ntz(f"{DAY} 00:00:00")) & (at < lit_ntz(f"{DAY} 03:00:00"))))
        _STORED[key] = store
    return _STORED[key]


def q_kpi_windows_stored(spark, sf):
    """The sliding KPIs from stored panes; their sketch counts against the exact ones, within 5 % or not."""
    exact = K.kpi_windows(kpi_in(spark, sf)).select("window_start", F.col("active_vehicles").alias("exact"))
    rough = N.windows(_panes(spark, sf).read_parts("kpi_panes"))
    near = F.abs(F.col("active_vehicles") - F.col("exact")) <= 0.05 * F.col("exact")
    return rough.join(exact, "window_start").select(
        "window_start", "window_end", "events", "avg_speed", near.alias("vehicles_within_5_pct"))


def q_kpi_horizon(spark, sf):
    """KPIs of an odd stretch of 17 days from days, hours and panes; the sketch count against the exact one."""
    exact = kpi_in(spark, sf).filter((F.col("tst") >= lit_ntz(HORIZON[0])) & (F.col("tst") < lit_ntz(HORIZON[1]))).agg(
        F.count_distinct("vehicle_number").alias("exact"))
    got = N.horizon(_panes(spark, sf), "kpi", *HORIZON)
    near = F.abs(F.col("active_vehicles") - F.lit(exact.scalar())) <= 0.05 * F.lit(exact.scalar())
    return got.withColumn("vehicles_near", near).drop("active_vehicles")


def q_peak_hours_stored(spark, sf):
    exact = A.peak_hours(fact(spark, sf)).select("hour_of_day", F.col("vehicles").alias("exact"))
    near = F.abs(F.col("vehicles") - F.col("exact")) <= 0.05 * F.col("exact")
    return N.peak_hours(_panes(spark, sf), "all").join(exact, "hour_of_day").select(
        "hour_of_day", "events", "avg_delay_sec", near.alias("vehicles_near"))


def computed_metrics(spark, sf):
    k = kpi_in(spark, sf)
    ext = K.route_extremes(K.route_delay_windows(k), min_events=2, latest_only=False)
    return M.metrics_to_long(K.kpi_windows(k), ext)


def metrics(spark, sf):
    """The metrics table, written once per application: gauge queries read it, as they do where a stream writes it."""
    key = (spark.sparkContext.applicationId, sf, "metrics")
    if key not in _STORED:
        store = _store(spark)
        store.write_append("metrics", computed_metrics(spark, sf))
        _STORED[key] = store
    return _STORED[key].read("metrics")


def q_metrics_long(spark, sf):
    return computed_metrics(spark, sf)


def q_metric_latest(spark, sf):
    return M.metric_latest(metrics(spark, sf))


def q_metric_last_over(spark, sf):
    return M.metric_last_over(metrics(spark, sf), M.EXTREME_GAUGE, 120, None, scale=60.0)


def q_metric_topk(spark, sf):
    return M.metric_topk(metrics(spark, sf), M.EXTREME_GAUGE, k=1)


def q_metric_bottomk(spark, sf):
    return M.metric_topk(metrics(spark, sf), M.EXTREME_GAUGE, k=1, ascending=True, labels={"type": "best"}, scale=60.0)


def q_metric_topk_worst(spark, sf):
    """``topk(1, last_over_time(route_delay_extreme_seconds{type="worst"}[12h])) / 60``."""
    return M.metric_topk_over(metrics(spark, sf), M.EXTREME_GAUGE, 1, HALF_DAY, labels={"type": "worst"}, scale=60.0)


def q_metric_bottomk_best(spark, sf):
    """``bottomk(1, last_over_time(route_delay_extreme_seconds{type="best"}[12h])) / 60`` at a past time."""
    return M.metric_topk_over(metrics(spark, sf), M.EXTREME_GAUGE, 1, HALF_DAY, AS_OF, ascending=True,
                              labels={"type": "best"}, scale=60.0)


def q_metric_last_over_worst(spark, sf):
    """``last_over_time(route_delay_extreme_seconds{type="worst"}[12h]) / 60``, every route."""
    return M.metric_last_over(metrics(spark, sf), M.EXTREME_GAUGE, HALF_DAY, scale=60.0, labels={"type": "worst"})


def q_metric_range(spark, sf):
    return M.metric_range(metrics(spark, sf), "avg_speed_all", *RANGE)


def q_metric_range_steps(spark, sf):
    """The dashboard's range panel ``total_active_vehicles``, every 30 s, with a lookback of two minutes."""
    return M.metric_range_steps(metrics(spark, sf), "total_active_vehicles", *RANGE, step_s=30, lookback_s=120)


def q_metric_range_steps_worst(spark, sf):
    """``last_over_time(route_delay_extreme_seconds{type="worst"}[2m]) / 60`` over the whole history, every 30 s."""
    return M.metric_range_steps(metrics(spark, sf), M.EXTREME_GAUGE, *HISTORY, step_s=30, lookback_s=120, scale=60.0,
                                labels={"type": "worst"}, slice_s=3600)


def q_metric_topk_steps(spark, sf):
    """``topk(1, last_over_time(route_delay_extreme_seconds[10m]) / 60)`` over six hours, every 45 s."""
    return M.topk_steps(M.metric_range_steps(metrics(spark, sf), M.EXTREME_GAUGE, *RANGE, step_s=45, lookback_s=600, scale=60.0))


# ---------------------------------------------------------------- streaming
def _raw_feed(spark, sf) -> str:
    """Bronze records of ``events`` written once as immutable raw files (the replayable feed)."""
    root = shared_dir(spark, "fleetlake-runs", uuid.uuid4().hex)
    bronze(spark, sf).drop("insert_time").write.parquet(f"{root}/raw")
    return root


def _closed_with_exact(spark, sf, out: str, **kw) -> DataFrame:
    """The stream's windows, its sketch count of vehicles compared with the exact one of the batch form."""
    batch = stream_positions(bronze(spark, sf)).withColumn("tst", utc_ntz("event_time"))
    exact = K.kpi_windows(batch, **kw).select("window_start", F.col("active_vehicles").alias("exact"))
    near = F.abs(F.col("active_vehicles") - F.col("exact")) <= F.greatest(F.lit(1.0), 0.05 * F.col("exact"))
    return spark.read.parquet(out).join(exact, "window_start").select(
        "window_start", "window_end", near.alias("vehicles_near"), "events", "avg_speed",
        "on_time_ratio_1", "on_time_ratio_2", "on_time_ratio_3")


def q_kpi_stream(spark, sf):
    """Stream the raw feed through the watermarked sliding KPIs (availableNow), read the sink back."""
    root = _raw_feed(spark, sf)
    src = read_events_stream(spark, "files", path=f"{root}/raw")
    return _closed_with_exact(spark, sf, _stream_to_parquet(kpi_stream(stream_positions(src)), root, "kpi"))


def _land_in_order(spark, sf, path: str, files: int, batches: int = 4) -> None:
    """The whole feed as ``batches`` writes of ``files`` files, equal stretches of its time in order, then the first
    stretch once more."""
    b, t = bronze(spark, sf).drop("insert_time"), F.timestamp_diff("MICROSECOND", lit_ntz("1970-01-01 00:00:00"), F.col("timestamp"))
    lo, hi = b.agg(F.min(t), F.max(t)).first()
    edges = [lo + (hi - lo) * k // batches for k in range(batches)] + [hi + 1]
    for a, z in [*zip(edges, edges[1:], strict=False), (edges[0], edges[1])]:
        (b.filter((t >= a) & (t < z)).repartitionByRange(files, "offset")
         .write.mode("append").option("maxRecordsPerFile", 0).parquet(path))


def q_kpi_stream_late(spark, sf):
    """The feed in event order over several micro-batches, then its first days once more: these rows are
    behind the watermark and change no window (X1)."""
    root, files = shared_dir(spark, "fleetlake-runs", uuid.uuid4().hex), 4
    _land_in_order(spark, sf, f"{root}/raw", files)
    src = read_events_stream(spark, "files", path=f"{root}/raw", max_files_per_trigger=files)
    return _closed_with_exact(spark, sf, _stream_to_parquet(kpi_stream(stream_positions(src)), root, "kpi"))


def q_stream_late_rows(spark, sf):
    """The feed in four batches by time, then its first quarter once more: per day the reports that were behind the
    watermark and those that no open window could take, and (``day`` NULL) the totals of the metrics table."""
    root, files = shared_dir(spark, "fleetlake-runs", uuid.uuid4().hex), 4
    _land_in_order(spark, sf, f"{root}/raw", files)
    src = read_events_stream(spark, "files", path=f"{root}/raw", max_files_per_trigger=files)
    start_late_audit(stream_positions(src), f"{root}/m", f"{root}/chk", available_now=True).awaitTermination()
    late = spark.read.parquet(f"{root}/m/late").groupBy("day").agg(
        F.count(F.lit(1)).alias("late_reports"), F.count_if("lost").alias("lost_reports"))
    return late.unionByName(late_counts(read_metrics(spark, f"{root}/m")), allowMissingColumns=True)


def q_current_tables(spark, sf):
    """The published 'current' tables (X5, X6) as a reader finds them after the live queries have run."""
    root = _raw_feed(spark, sf)
    src = read_events_stream(spark, "files", path=f"{root}/raw")
    for q in start_metrics(stream_positions(src), f"{root}/m", f"{root}/chk_m", available_now=True, history=False, min_events=1):
        q.awaitTermination()
    kpi = read_current(spark, f"{root}/m/kpi_current").select("window_end", F.lit("all").alias("type"), "events", "avg_speed")
    ext = read_current(spark, f"{root}/m/route_delay_current").select("window_end", "type", "route_id", "avg_delay_sec")
    return kpi.unionByName(ext, allowMissingColumns=True)


def q_metrics_stream(spark, sf):
    """The metrics table as the two live queries write it (K11): gauges of every closed window."""
    root = _raw_feed(spark, sf)
    src = read_events_stream(spark, "files", path=f"{root}/raw")
    for q in start_metrics(stream_positions(src), f"{root}/m", f"{root}/chk_m", available_now=True, history=False, min_events=2):
        q.awaitTermination()
    # the vehicle gauge is a sketch on streams; kpi_stream compares it with the exact count
    return read_metrics(spark, f"{root}/m").filter(F.col("metric") != "total_active_vehicles")


def _stream_to_parquet(df, root: str, name: str) -> str:
    q = (df.writeStream.outputMode("append").format("parquet")
         .option("path", f"{root}/{name}").option("checkpointLocation", f"{root}/chk_{name}")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return f"{root}/{name}"


def q_route_delay_stream(spark, sf):
    """Per-route sliding delays on the stream (A4 streaming form), closed windows only."""
    root = _raw_feed(spark, sf)
    src = read_events_stream(spark, "files", path=f"{root}/raw")
    return spark.read.parquet(_stream_to_parquet(route_delay_stream(stream_positions(src)), root, "route_delay"))


def q_kpi_stream_dedupe(spark, sf):
    """KPI stream with re-sent reports dropped inside the watermark (X7); copy-independent columns."""
    root = _raw_feed(spark, sf)
    src = read_events_stream(spark, "files", path=f"{root}/raw")
    out = _stream_to_parquet(kpi_stream(stream_positions(src), dedupe=True), root, "kpi")
    return spark.read.parquet(out).select("window_start", "window_end", "events", "avg_speed")


def q_replay_window(spark, sf):
    """Deterministic replay of one week of the immutable raw feed."""
    root = _raw_feed(spark, sf)
    return replay(spark, f"{root}/raw", REPLAY[0], REPLAY[1]).select("key", "partition", "offset", "timestamp")


def q_stream_landing(spark, sf):
    """Land the raw feed through the idempotent foreachBatch sink, read bronze back."""
    root = _raw_feed(spark, sf)
    src = read_events_stream(spark, "files", path=f"{root}/raw", max_files_per_trigger=2)
    start_landing(src, f"{root}/bronze", f"{root}/chk", available_now=True).awaitTermination()
    return spark.read.parquet(f"{root}/bronze").select("key", "partition", "offset", "timestamp")


def q_landing_compacted(spark, sf):
    """Landing in many small batches; the days before DAY are put together, the others read as they landed."""
    store, b = _store(spark), bronze(spark, sf)
    for i in range(3):
        append_batch(b.filter(F.col("partition") % 3 == i), i, store.path("raw"))
    compact_days(store, "landed_days", store.path("raw"), DAY)
    return read_landed(store, "landed_days", store.path("raw")).select("key", "partition", "offset", "timestamp")


# ---------------------------------------------------------------- chains
def q_events_chain(spark, sf):
    """Two incremental runs and a rerun of bronze -> silver -> gold; the fact as finally stored."""
    store = _store(spark)
    b = bronze(spark, sf)
    C.run_events(spark, store, b.filter(F.col("insert_time") < lit_ntz(FIRST_UNTIL)), now=LOAD2, rundate=LOAD2[:10])
    C.run_events(spark, store, b, now=FACT_NOW, rundate=FACT_NOW[:10])
    C.run_events(spark, store, b, now=FACT_NOW, rundate=FACT_NOW[:10])
    return store.read("fact_vehicle_position").select("oday", "vehicle_number", "tst", "dl", "insert_time")


def q_routes_chain(spark, sf):
    """Two dimension files through landing, staging and SCD2; the dimension as finally stored."""
    store = _store(spark)
    part = X.table(spark, sf, "part")
    C.run_routes(spark, store, X.landed(X.routes_file(part, 1), LOAD1, LOAD1[:10]), now=LOAD1, rundate=LOAD1[:10])
    C.run_routes(spark, store, X.landed(X.routes_file(part, 2), LOAD2, LOAD2[:10]), now=LOAD2, rundate=LOAD2[:10])
    return store.read("dim_routes").select(*_DIM_OUT)


def q_stops_chain(spark, sf):
    """The stops file, its wheelchair codes mapped to the allowed set, through landing, staging and SCD2."""
    store, part = _store(spark), X.table(spark, sf, "part")
    landed = X.landed(X.stops_file(part), LOAD1, LOAD1[:10])
    code = (F.col("wheelchair_boarding").cast("int") % 3).cast("string")
    C.run_stops(spark, store, landed.withColumn("wheelchair_boarding", code), now=LOAD1, rundate=LOAD1[:10])
    return store.read("dim_stops")


class _FailOnce(TableStore):
    """A store whose first write of one table fails."""

    def __init__(self, store: TableStore, table: str):
        super().__init__(store.spark, store.root)
        self.table = table

    def write_append(self, name, df, partition_by=None):
        if name == self.table:
            raise OSError("planned failure")
        super().write_append(name, df, partition_by)


def q_events_chain_recovery(spark, sf):
    """A run whose fact write fails, then the same chain again: nothing is lost, nothing doubled."""
    store, b = _store(spark), bronze(spark, sf)
    first = b.filter(F.col("insert_time") < lit_ntz(FIRST_UNTIL))
    try:
        C.run_events(spark, _FailOnce(store, "fact_vehicle_position"), first, now=LOAD2, rundate=LOAD2[:10])
    except OSError:
        pass
    C.run_events(spark, store, b, now=FACT_NOW, rundate=FACT_NOW[:10])
    C.run_events(spark, store, b, now=FACT_NOW, rundate=FACT_NOW[:10])
    return store.read("fact_vehicle_position").select("oday", "vehicle_number", "tst", "dl", "insert_time")


def q_events_chain_malformed(spark, sf):
    """Some reports without time, with a malformed one, or without vehicle: diverted with a reason, the rest
    loads; clearing the log and running again adds nothing."""
    store, b = _store(spark), bronze(spark, sf)
    n = F.col("offset") % 50
    b = b.withColumn("json_str", F.when(n == 1, F.regexp_replace("json_str", '"tst":"[^"]*"', '"tst":"not a time"'))
                     .when(n == 2, F.regexp_replace("json_str", '"tst":"[^"]*",', ""))
                     .when(n == 3, F.regexp_replace("json_str", '"vehicle_number":"[^"]*"', '"vehicle_number":""'))
                     .otherwise(F.col("json_str")))
    C.run_events(spark, store, b, now=FACT_NOW, rundate=FACT_NOW[:10])
    C.truncate_logged(store)
    C.run_events(spark, store, b, now=FACT_NOW, rundate=FACT_NOW[:10])
    kept = store.read("fact_vehicle_position").groupBy(F.lit("kept").alias("outcome")).agg(F.count("*").alias("reports"))
    lost = store.read("events_rejects").groupBy(F.col("reject_reason").alias("outcome")).agg(F.count("*").alias("reports"))
    return kept.unionByName(lost)


# ---------------------------------------------------------------- SQL surface
def q_sql_route_delay_top(spark, sf):
    S.register_views(spark, fact=fact(spark, sf), dim_routes=dim_routes(spark, sf))
    return S.run(spark, S.DELAY_REPORT, day=datetime.date.fromisoformat(DAY), n=10)


def q_sql_route_density(spark, sf):
    S.register_views(spark, fact=fact(spark, sf), dim_routes=dim_routes(spark, sf))
    return S.run(spark, S.DENSITY_REPORT, day=datetime.date.fromisoformat(DAY), n=10)


def q_sql_partition_distribution(spark, sf):
    S.register_views(spark, bronze=bronze(spark, sf))
    return S.run(spark, S.PARTITION_REPORT)


QUERIES: dict[str, Query] = {
    "route_delay_top": q_route_delay_top,
    "route_density": q_route_density,
    "partition_distribution": q_partition_distribution,
    "offset_gaps": q_offset_gaps,
    "route_bus_count": q_route_bus_count,
    "route_stop_coverage": q_route_stop_coverage,
    "hot_spots": q_hot_spots,
    "adaptive_hot_spots": q_adaptive_hot_spots,
    "hot_stops": q_hot_stops,
    "kpi_windows_tumbling": q_kpi_windows_tumbling,
    "dq_write_report": q_dq_write_report,
    "dq_quarantine": q_dq_quarantine,
    "landing_compacted": q_landing_compacted,
    "route_on_time": q_route_on_time,
    "speed_by_route_vehicle": q_speed_by_route_vehicle,
    "occupancy_trend": q_occupancy_trend,
    "occupancy_daily": q_occupancy_daily,
    "peak_hours": q_peak_hours,
    "stop_bottlenecks": q_stop_bottlenecks,
    "fact_select": q_fact_select,
    "fact_join_active_dim": q_fact_join_active_dim,
    "envelope_flatten": q_envelope_flatten,
    "dedupe_events": q_dedupe_events,
    "delay_outliers": q_delay_outliers,
    "json_extract": q_json_extract,
    "all_to_string": q_all_to_string,
    "topic_path": q_topic_path,
    "envelope_key": q_envelope_key,
    "journey_filter": q_journey_filter,
    "journey_rejects": q_journey_rejects,
    "scd2_initial": q_scd2_initial,
    "scd2_incremental": q_scd2_incremental,
    "scd2_incremental_plain": q_scd2_incremental_plain,
    "scd2_new_keys": q_scd2_new_keys,
    "scd2_closed": q_scd2_closed,
    "dim_clean_routes": q_dim_clean_routes,
    "dim_clean_stops": q_dim_clean_stops,
    "dim_stops": q_dim_stops,
    "dim_as_of": q_dim_as_of,
    "fact_join_as_of": q_fact_join_as_of,
    "fact_join_as_of_carried": q_fact_join_as_of_carried,
    "fact_join_as_of_left": q_fact_join_as_of_left,
    "scd2_buckets": q_scd2_buckets,
    "route_density_bitmaps": q_route_density_bitmaps,
    "route_bus_count_bitmaps": q_route_bus_count_bitmaps,
    "route_stop_coverage_bitmaps": q_route_stop_coverage_bitmaps,
    "offset_gaps_incremental": q_offset_gaps_incremental,
    "replay_indexed": q_replay_indexed,
    "replay_offsets": q_replay_offsets,
    "metric_range_steps": q_metric_range_steps,
    "metric_range_steps_worst": q_metric_range_steps_worst,
    "metric_topk_steps": q_metric_topk_steps,
    "kpi_windows_stored": q_kpi_windows_stored,
    "kpi_horizon": q_kpi_horizon,
    "peak_hours_stored": q_peak_hours_stored,
    "stream_late_rows": q_stream_late_rows,
    "current_tables": q_current_tables,
    "dq_report": q_dq_report,
    "dq_duplicates": q_dq_duplicates,
    "joblog_last": q_joblog_last,
    "joblog_latest": q_joblog_latest,
    "joblog_delete": q_joblog_delete,
    "incremental_scan": q_incremental_scan,
    "dedupe_dim": q_dedupe_dim,
    "fact_incremental": q_fact_incremental,
    "kpi_windows": q_kpi_windows,
    "kpi_windows_native": q_kpi_windows_native,
    "kpi_windows_approx": q_kpi_windows_approx,
    "route_delay_windows": q_route_delay_windows,
    "latest_window": q_latest_window,
    "route_extremes": q_route_extremes,
    "route_extremes_latest": q_route_extremes_latest,
    "metrics_long": q_metrics_long,
    "metric_latest": q_metric_latest,
    "metric_last_over": q_metric_last_over,
    "metric_topk": q_metric_topk,
    "metric_range": q_metric_range,
    "kpi_stream": q_kpi_stream,
    "stream_landing": q_stream_landing,
    "route_delay_stream": q_route_delay_stream,
    "kpi_stream_dedupe": q_kpi_stream_dedupe,
    "replay_window": q_replay_window,
    "events_chain": q_events_chain,
    "routes_chain": q_routes_chain,
    "stops_chain": q_stops_chain,
    "events_chain_recovery": q_events_chain_recovery,
    "events_chain_malformed": q_events_chain_malformed,
    "kpi_stream_late": q_kpi_stream_late,
    "metrics_stream": q_metrics_stream,
    "metric_bottomk": q_metric_bottomk,
    "metric_topk_worst": q_metric_topk_worst,
    "metric_bottomk_best": q_metric_bottomk_best,
    "metric_last_over_worst": q_metric_last_over_worst,
    "route_extremes_none": q_route_extremes_none,
    "sql_route_delay_top": q_sql_route_delay_top,
    "sql_route_density": q_sql_route_density,
    "sql_partition_distribution": q_sql_partition_distribution,
}
