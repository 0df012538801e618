"""Bronze -> silver -> gold chains for events, routes and stops.

Each chain reads the job log for its incremental start, writes every layer
to the ``TableStore`` (which also cuts lineage between steps), guards each
layer with DQ rules and logs the newest ``insert_time`` it read.  Re-running
a chain over the same input changes nothing.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.observation import Observation

from fleetlake.functions.exprs import lit_ntz
from fleetlake.operators import dq
from fleetlake.operators.envelope import flatten_envelope
from fleetlake.operators.gold import fact_new_rows, to_fact
from fleetlake.operators.joblog import delete_job_log, last_loaded_value, log_row, truncate_job_log
from fleetlake.operators.scd2 import ROUTE_ATTRS, STOP_ATTRS, scd2_apply
from fleetlake.operators.silver import (
    ROUTES_CLEAN, STOPS_CLEAN, dedupe_events, incremental, reject_reason, stage_dim, type_events,
)
from fleetlake.schemas import JOB_LOG_SCHEMA, ROUTES_RAW_COLUMNS, STOPS_RAW_COLUMNS
from fleetlake.sinks import TableStore, observed_write

JOB_LOG = "job_control"


def _ts(v) -> _dt.datetime:
    return v if isinstance(v, _dt.datetime) else _dt.datetime.fromisoformat(str(v))


def job_log(store: TableStore) -> DataFrame:
    if store.exists(JOB_LOG):
        return store.read(JOB_LOG)
    return store.spark.createDataFrame([], JOB_LOG_SCHEMA)


def _log(store: TableStore, schema: str, table: str, max_ts, rundate, now) -> None:
    row = log_row(store.spark, schema, table, max_ts, rundate, _ts(now))
    store.write_refresh(JOB_LOG, job_log(store).unionByName(row).coalesce(1))


def delete_logged(store: TableStore, schema: str, table: str) -> None:
    """Forget one table's loads (K9): the next run of its chain loads everything again."""
    store.write_refresh(JOB_LOG, delete_job_log(job_log(store), schema, table).coalesce(1))


def truncate_logged(store: TableStore) -> None:
    """Forget all loads."""
    store.write_refresh(JOB_LOG, truncate_job_log(job_log(store)))


JOB_METRICS = "job_metrics"


def _metrics(store: TableStore, table: str, stats: dict, now) -> None:
    """One row of write history per written table."""
    row = (table, int(stats.get("rows_written", 0)), int(stats.get("rows_inserted", 0)),
           int(stats.get("rows_updated", 0)), int(stats.get("execution_ms", 0)), _ts(now))
    store.write_append(JOB_METRICS, store.spark.createDataFrame(
        [row], "table_name string, rows_written long, rows_inserted long, rows_updated long, "
               "execution_ms long, run_at timestamp_ntz"))


def run_events(spark: SparkSession, store: TableStore, bronze: DataFrame, *, now, rundate) -> dict:
    """Landing rows newer than the last completed load -> silver snapshot -> idempotent fact append.

    The increment is read and parsed once, into a typed copy that marks what
    can't be keyed; silver and ``events_rejects`` (reports without vehicle or
    time) both come from that copy.  Silver is written, audited on the written
    files, then published; the fact step reads the published snapshot.  Both
    loads are logged after the fact is committed: a run that fails anywhere is
    repeated from its start by the next one, and the anti-joins keep what was
    already appended single.  Superseded snapshots are removed at the end.
    """
    last = last_loaded_value(job_log(store), "hdw_stg", "events_stg")
    read = Observation("typed")
    typed = type_events(flatten_envelope(incremental(bronze, last)), now).withColumn("reject_reason", reject_reason())
    seen = typed.observe(read, F.max("insert_time").alias("max_read"),
                         F.count_if(F.col("reject_reason").isNotNull()).alias("rejected"))
    rules = [dq.no_nulls("vehicle_number"), dq.no_nulls("tst"), dq.no_duplicates(["vehicle_number", "tst"])]

    def new_rows(written: DataFrame) -> None:
        if written.isEmpty():
            raise _NothingNew

    try:
        store.write_refresh("events_typed", seen, new_rows)
    except _NothingNew:
        return {"silver_rows": 0, "fact_rows": 0}
    typed, max_read = store.read("events_typed"), read.get["max_read"]

    def audit(written: DataFrame) -> None:
        new_rows(written)
        dq.check(written, rules, "events_stg")

    stats, tables = {}, []
    try:
        good = dedupe_events(typed.filter(F.col("reject_reason").isNull()).drop("reject_reason"))
        stats["silver"] = observed_write(good, lambda d: store.write_refresh("events_stg", d, audit))
        fact = to_fact(store.read("events_stg"), now)
        if store.exists("fact_vehicle_position"):
            fact = fact_new_rows(fact, store.read("fact_vehicle_position"))
        stats["fact"] = observed_write(fact, lambda d: store.write_append("fact_vehicle_position", d, ["oday"]))
        tables = [("events_stg", "silver"), ("fact_vehicle_position", "fact")]
    except _NothingNew:
        pass
    if read.get["rejected"]:
        bad = typed.filter(F.col("reject_reason").isNotNull())
        if store.exists("events_rejects"):
            bad = fact_new_rows(bad, store.read("events_rejects"), ("kafka_partition", "kafka_offset", "insert_time"),
                                "reject_reason")
        stats["rejects"] = observed_write(bad, lambda d: store.write_append("events_rejects", d, ["reject_reason"]))
        tables.append(("events_rejects", "rejects"))
    _log(store, "hdw", "fact_vehicle_position", max_read, rundate, now)
    _log(store, "hdw_stg", "events_stg", max_read, rundate, now)
    for table, key in tables:
        _metrics(store, table, stats[key], now)
    for table in ("events_typed", "events_stg", JOB_LOG):
        store.vacuum(table)
    return stats


class _NothingNew(Exception):
    """Nothing to load: the snapshot is not published."""


def _run_dim(store: TableStore, landed: DataFrame, *, name: str, key: str, spec: dict, attrs, expected,
             extra_rules, now, rundate, null_safe: bool = True) -> dict:
    """Landing -> staging -> dimension.  Staging is logged once the dimension is published, so a run
    that fails in between is made good by the next one."""
    land, newest = f"{name}_ld", F.max("insert_time")
    dq.check(landed, [dq.not_empty(), dq.columns_exist(expected), dq.no_nulls(key)], land)
    stats = {"landing": observed_write(landed, lambda d: store.write_append(land, d), max_read=newest)}
    _log(store, "hdw_ld", land, stats["landing"]["max_read"], rundate, now)

    last = last_loaded_value(job_log(store), "hdw_stg", f"{name}_stg")
    staged = stage_dim(incremental(store.read(land), last), key, spec)
    stg_rules = [dq.not_empty(), dq.no_duplicates([key]), *extra_rules]
    stats["staging"] = observed_write(staged, lambda d: store.write_refresh(
        f"{name}_stg", d, lambda w: dq.check(w, stg_rules, f"{name}_stg")), max_read=newest)
    stg, max_read = store.read(f"{name}_stg"), stats["staging"]["max_read"]

    current = store.read(f"dim_{name}") if store.exists(f"dim_{name}") else None
    nxt = scd2_apply(current, stg, key, attrs, now, null_safe=null_safe)
    t = lit_ntz(now)
    stats["dim"] = observed_write(
        nxt, lambda d: store.write_refresh(f"dim_{name}", d, lambda w: dq.check(w, [dq.active_unique([key])], f"dim_{name}")),
        rows_inserted=F.count_if(F.col("effective_start_dt") == t),
        rows_updated=F.count_if((F.col("active_flg") == 0) & (F.col("update_dt") == t)))
    _log(store, "hdw", f"dim_{name}", max_read, rundate, now)
    _log(store, "hdw_stg", f"{name}_stg", max_read, rundate, now)
    for table in (f"{name}_stg", f"dim_{name}", JOB_LOG):
        store.vacuum(table)
    for table, k in ((land, "landing"), (f"{name}_stg", "staging"), (f"dim_{name}", "dim")):
        _metrics(store, table, stats[k], now)
    return stats


def run_routes(spark: SparkSession, store: TableStore, landed: DataFrame, *, now, rundate) -> dict:
    return _run_dim(store, landed, name="routes", key="route_id", spec=ROUTES_CLEAN, attrs=ROUTE_ATTRS,
                    expected=ROUTES_RAW_COLUMNS, extra_rules=[], now=now, rundate=rundate)


def run_stops(spark: SparkSession, store: TableStore, landed: DataFrame, *, now, rundate) -> dict:
    # Allowed wheelchair_boarding codes.
    rules = [dq.values_in_set("wheelchair_boarding", [0, 1, 2])]
    return _run_dim(store, landed, name="stops", key="stop_id", spec=STOPS_CLEAN, attrs=STOP_ATTRS,
                    expected=STOPS_RAW_COLUMNS, extra_rules=rules, now=now, rundate=rundate)
