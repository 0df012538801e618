"""Deterministic inputs derived from the driver's tables.

The telemetry feed is modelled on the driver's ``events`` table: a user is a
vehicle, an event is one position report.  Dimension files are derived from
``part``.  Every fixture is a Spark plan over the whole input table, so its
size grows with the table.  The modulo expressions below *define* synthetic
attributes (route of a vehicle, lost or re-sent messages); none of them is
used to shrink the work.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake.functions.exprs import epoch_seconds, lit_ntz

# Fixed values of the synthetic feed.
N_ROUTES = 30           # vehicle -> route "R<user_id % 30>"
N_STOPS = 200           # report -> stop "S<event_id % 200>"
N_KAFKA_PARTITIONS = 6  # report -> partition event_id % 6, offset event_id div 6
KAFKA_TOPIC = "vehicle_positions"
ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _vp_columns(e: DataFrame, resent: Column) -> DataFrame:
    """Topic and payload columns of one report; ``resent`` marks a re-sent copy."""
    uid, eid, ts = F.col("user_id"), F.col("event_id"), F.col("ts")
    k = F.get_json_object("props", "$.k").cast("int")
    dl = F.when(eid % 50 == 0, F.lit(None).cast("int")).otherwise(
        F.floor(F.col("value") * 5).cast("int") - 200 + F.when(resent, 1).otherwise(0))
    stop = F.when(eid % 10 == 0, F.lit(None).cast("string")).otherwise(F.concat(F.lit("S"), (eid % N_STOPS).cast("string")))
    oper = (uid % 3 + 20).cast("int")
    route_id = F.concat(F.lit("R"), (uid % N_ROUTES).cast("string"))
    direction = (eid % 2 + 1).cast("string")
    lat = (uid % 40).cast("double") / 100 + 60
    lon = (eid % 50).cast("double") / 100 + 24
    topic = F.struct(
        F.lit("hfp").alias("prefix"),
        F.lit("v2").alias("version"),
        F.when(eid % 13 == 0, "deadrun").otherwise("journey").alias("journey_type"),
        F.when(eid % 17 == 0, "upcoming").otherwise("ongoing").alias("temporal_type"),
        F.col("event_type").alias("event_type"),
        F.when(uid % 5 == 0, "tram").otherwise("bus").alias("transport_mode"),
        F.lpad(oper.cast("string"), 4, "0").alias("operator_id"),
        F.lpad(uid.cast("string"), 5, "0").alias("vehicle_number"),
        route_id.alias("route_id"),
        direction.alias("direction_id"),
        F.concat(F.lit("Terminal "), (uid % N_ROUTES).cast("string")).alias("headsign"),
        F.date_format(ts, "HH:mm").alias("start_time"),
        F.coalesce(stop, F.lit("EOL")).alias("next_stop"),
        F.lit("4").alias("geohash_level"),
        F.concat_ws(";", F.floor(lat).cast("string"), F.floor(lon).cast("string")).alias("geohash"),
        F.lit(None).cast("string").alias("sid"),
    )
    vp = F.struct(
        (uid % N_ROUTES).cast("string").alias("desi"),
        direction.alias("dir"),
        oper.alias("oper"),
        uid.cast("int").alias("veh"),
        F.date_format(ts, ISO_FORMAT).alias("tst"),
        epoch_seconds(ts).alias("tsi"),
        # speeds are multiples of 1/8 m/s: exact in binary, so sums do not depend on order
        (k.cast("double") / 8).alias("spd"),
        ((eid * 7) % 360).cast("int").alias("hdg"),
        lat.alias("lat"),
        lon.alias("long"),
        ((eid % 11 - 5).cast("double") / 4).alias("acc"),
        dl.alias("dl"),
        ((eid % 100000) * 3).cast("int").alias("odo"),
        (eid % 2).cast("int").alias("drst"),
        F.date_format(ts, "yyyy-MM-dd").alias("oday"),
        uid.cast("int").alias("jrn"),
        (uid % N_ROUTES + 1000).cast("int").alias("line"),
        F.date_format(ts, "HH:mm").alias("start"),
        F.lit("GPS").alias("loc"),
        stop.alias("stop"),
        route_id.alias("route"),
        (eid % 101).cast("int").alias("occu"),
    )
    return e.select(
        eid.alias("event_id"), ts, resent.alias("resent"),
        topic.alias("topic"), F.struct(vp.alias("VP")).alias("payload"))


def bronze_events(events: DataFrame, *, resend_every: int | None = 20, lose_every: int | None = None,
                  topic: str = KAFKA_TOPIC) -> DataFrame:
    """Bronze landing rows (Kafka record decoded + ``insert_time``) built from ``events``.

    * every report is one record on partition ``event_id % 6`` at offset
      ``event_id div 6``, Kafka time ``ts + 1 s``, landed at ``ts + 2 s``;
    * ``resend_every``: reports with ``event_id % n = 0`` are delivered again
      one second later with ``dl + 1`` (a re-delivery the dedupe must resolve
      in favour of the later copy);
    * ``lose_every``: reports with ``event_id % n = 0`` never arrive (the gap
      audit must find them).
    """
    e = events
    if lose_every:
        e = e.filter(F.col("event_id") % lose_every != 0)
    # one scan: a re-sent report becomes two rows (original, copy) through explode
    copies = F.array(F.lit(False))
    if resend_every:
        copies = F.when(F.col("event_id") % resend_every == 0, F.array(F.lit(False), F.lit(True))).otherwise(copies)
    rows = _vp_columns(e.withColumn("_resent", F.explode(copies)), F.col("_resent"))
    second = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(1))
    return rows.select(
        F.to_json(F.struct("topic", "payload")).alias("json_str"),
        F.col("topic.vehicle_number").alias("key"),
        F.lit(topic).alias("topic"),
        (F.col("event_id") % N_KAFKA_PARTITIONS).cast("int").alias("partition"),
        F.expr(f"event_id div {N_KAFKA_PARTITIONS}").cast("bigint").alias("offset"),
        (F.col("ts") + second).alias("timestamp"),
        (F.col("ts") + second * F.when(F.col("resent"), 3).otherwise(2)).alias("insert_time"),
    )


def topic_paths(events: DataFrame) -> DataFrame:
    """MQTT topic paths (``/hfp/v2/journey/...``) for every report.

    Every 7th path is cut after 8 parts and every 11th has an empty vehicle
    field, so parsing and keying meet short and blank paths.
    """
    t = _vp_columns(events, F.lit(False)).select("event_id", "topic.*")
    parts = [F.coalesce(F.col(c), F.lit("")) for c in t.columns[1:]]
    parts[7] = F.when(F.col("event_id") % 11 == 0, F.lit("")).otherwise(parts[7])
    full = F.concat_ws("/", F.lit(""), *parts)
    short = F.concat_ws("/", F.lit(""), *parts[:8])
    return t.select("event_id", F.when(F.col("event_id") % 7 == 0, short).otherwise(full).alias("topic_path"))


def routes_file(part: DataFrame, version: int = 1) -> DataFrame:
    """Routes file rows (all strings) derived from ``part``.

    Version 1 lacks keys with ``p_partkey % 16 = 15`` (they are new in
    version 2); version 2 lacks keys with ``p_partkey % 16 = 14`` (a file that
    omits a key must leave it active), raises ``route_type`` by one where
    ``p_partkey % 3 = 0`` and blanks the long name where ``p_partkey % 7 = 1``.
    """
    key = F.col("p_partkey")
    p = part.filter(key % 16 != (15 if version == 1 else 14))
    rtype = F.col("p_size") + (F.when(key % 3 == 0, 1).otherwise(0) if version == 2 else F.lit(0))
    long_name = F.col("p_name")
    if version == 2:
        long_name = F.when(key % 7 == 1, F.lit(None).cast("string")).otherwise(long_name)
    return p.select(
        F.concat(F.lit("R"), key.cast("string")).alias("route_id"),
        F.lit("CITY").alias("agency_id"),
        F.when(key % 9 == 4, F.lit(None).cast("string")).otherwise(F.col("p_brand")).alias("route_short_name"),
        long_name.alias("route_long_name"),
        F.col("p_type").alias("route_desc"),
        F.when(key % 23 == 5, F.lit("bus")).otherwise(rtype.cast("string")).alias("route_type"),
        F.concat(F.lit("route/"), key.cast("string")).alias("route_url"),
    )


def stops_file(part: DataFrame) -> DataFrame:
    """Stops file rows (all strings) derived from ``part``; some values break DQ rules on purpose."""
    key = F.col("p_partkey")
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    return part.select(
        F.concat(F.lit("S"), key.cast("string")).alias("stop_id"),
        key.cast("string").alias("stop_code"),
        F.col("p_name").alias("stop_name"),
        F.col("p_type").alias("stop_desc"),
        F.concat(F.lit("60."), two(key % 100)).alias("stop_lat"),
        F.when(key % 29 == 3, F.lit("n/a")).otherwise(F.concat(F.lit("24."), two(F.col("p_size")))).alias("stop_lon"),
        F.col("p_type").alias("zone_id"),
        F.concat(F.lit("stop/"), key.cast("string")).alias("stop_url"),
        F.lit("0").alias("location_type"),
        F.when(key % 5 == 0, F.lit(None).cast("string")).otherwise(F.concat(F.lit("P"), F.expr("p_partkey div 10").cast("string"))).alias("parent_station"),
        (F.col("p_size") % 4).cast("string").alias("wheelchair_boarding"),
        F.when(key % 3 == 0, F.lit(None).cast("string")).otherwise((key % 4 + 1).cast("string")).alias("platform_code"),
        F.when(key % 10 == 0, F.lit(None).cast("string")).otherwise((F.col("p_size") % 3).cast("string")).alias("vehicle_type"),
        (F.col("p_size") * 10).cast("string").alias("radius"),
    )


def landed(df: DataFrame, insert_time: str, rundate: str) -> DataFrame:
    """Add the landing audit columns with an injected time (bronze dimension rows)."""
    return df.withColumn("insert_time", lit_ntz(insert_time)).withColumn("rundate", F.lit(rundate).cast("date"))


def job_log_from_bronze(bronze: DataFrame, staged_until: str = "2024-01-15") -> DataFrame:
    """Job-control rows of daily loads over ``bronze``.

    Landing (``hdw_ld.events_ld``) logged one row per landing day with the
    newest ``insert_time`` of that day, an hour later; staging
    (``hdw_stg.events_stg``) ran two hours after landing, but only for days
    before ``staged_until``.
    """
    hour = F.make_dt_interval(F.lit(0), F.lit(1), F.lit(0), F.lit(0))
    per_day = bronze.groupBy(F.to_date("insert_time").alias("d")).agg(F.max("insert_time").alias("m"))

    def rows(df: DataFrame, schema: str, name: str, hours: int) -> DataFrame:
        return df.select(F.lit(schema).alias("schema_name"), F.lit(name).alias("table_name"),
                         F.col("m").alias("max_timestamp"), F.date_format("d", "yyyy-MM-dd").alias("rundate"),
                         (F.col("m") + hour * hours).alias("insert_dt"))

    staged = per_day.filter(F.col("d") < F.lit(staged_until).cast("date"))
    return rows(per_day, "hdw_ld", "events_ld", 1).unionByName(rows(staged, "hdw_stg", "events_stg", 2))
