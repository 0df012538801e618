"""Job entry points, one per pipeline step, for ``spark-submit`` or ``python -m fleetlake``.

    python -m fleetlake init    --root ROOT [--reset]
    python -m fleetlake land    --root ROOT --raw RAW_DIR | --bootstrap HOST:PORT [--topic T] [--available-now]
    python -m fleetlake events  --root ROOT [--rundate YYYY-MM-DD|YYYYMMDD]
    python -m fleetlake routes  --root ROOT --file routes.txt [--rundate ...]
    python -m fleetlake stops   --root ROOT --file stops.txt  [--rundate ...]
    python -m fleetlake metrics --root ROOT --raw RAW_DIR | --bootstrap HOST:PORT [--available-now]

``ROOT`` is the shared lake folder; bronze events land in ``ROOT/events_ld``.
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import functions as F

from fleetlake.functions.exprs import utc_ntz
from fleetlake.operators.joblog import normalize_rundate
from fleetlake.plans.chains import run_events, run_routes, run_stops
from fleetlake.schemas import STOPS_RAW_SCHEMA
from fleetlake.session import get_spark, size_batch
from fleetlake.sinks import TableStore, init_tables
from fleetlake.sources import read_csv_typed, read_delimited, read_events_stream


def _stream(spark, a):
    if a.bootstrap:
        return read_events_stream(spark, "kafka", bootstrap=a.bootstrap, topic=a.topic,
                                  starting_offsets=a.starting_offsets or ("latest" if a.step == "metrics" else "earliest"),
                                  max_offsets_per_trigger=a.max_offsets)
    return read_events_stream(spark, "files", path=a.raw)


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="fleetlake")
    ap.add_argument("step", choices=["init", "land", "events", "routes", "stops", "metrics"])
    ap.add_argument("--root", required=True)
    ap.add_argument("--raw")
    ap.add_argument("--file")
    ap.add_argument("--bootstrap")
    ap.add_argument("--topic", default="vehicle_positions")
    ap.add_argument("--starting-offsets", help="default: earliest for land, latest for metrics")
    ap.add_argument("--max-offsets", type=int, help="most Kafka records of one micro-batch")
    ap.add_argument("--modes", help="land only ongoing journeys of these modes (comma list); the rest go to events_rejected")
    ap.add_argument("--rundate")
    ap.add_argument("--reset", action="store_true")
    ap.add_argument("--available-now", action="store_true")
    a = ap.parse_args(argv)

    spark = get_spark(f"fleetlake-{a.step}", stream=a.step in ("land", "metrics"))
    store = TableStore(spark, a.root)
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    rundate = normalize_rundate(a.rundate).isoformat() if a.rundate else now.date().isoformat()

    if a.step == "init":
        print(init_tables(store, reset=a.reset))
    elif a.step == "land":
        from fleetlake.streaming.landing import start_landing
        q = start_landing(_stream(spark, a), store.path("events_ld"), f"{a.root}/_checkpoints/landing",
                          available_now=a.available_now, modes=a.modes.split(",") if a.modes else None)
        q.awaitTermination()
    elif a.step == "events":
        size_batch(spark, store.path("events_ld"))
        print(run_events(spark, store, store.read("events_ld"), now=now, rundate=rundate))
    elif a.step in ("routes", "stops"):
        size_batch(spark, a.file)
        raw = (read_delimited(spark, a.file) if a.step == "routes"
               else read_csv_typed(spark, a.file, STOPS_RAW_SCHEMA))
        landed = raw.withColumn("insert_time", utc_ntz(F.current_timestamp())).withColumn(
            "rundate", F.lit(rundate).cast("date"))
        run = run_routes if a.step == "routes" else run_stops
        print(run(spark, store, landed, now=now, rundate=rundate))
    elif a.step == "metrics":
        from fleetlake.streaming.kpi_stream import start_metrics, stream_positions
        qs = start_metrics(stream_positions(_stream(spark, a)), f"{a.root}/metrics", f"{a.root}/_checkpoints/metrics",
                           available_now=a.available_now)
        for q in qs:
            q.awaitTermination()


if __name__ == "__main__":
    main()
