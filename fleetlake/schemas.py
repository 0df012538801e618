"""StructType constants for every layer (§1 of the data model)."""

from pyspark.sql.types import (
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)


def _strings(*names: str) -> list[StructField]:
    return [StructField(n, StringType()) for n in names]


# The 16 MQTT topic fields of the vehicle-position feed, in topic-path order.
TOPIC_FIELDS = [
    "prefix", "version", "journey_type", "temporal_type", "event_type", "transport_mode",
    "operator_id", "vehicle_number", "route_id", "direction_id", "headsign", "start_time",
    "next_stop", "geohash_level", "geohash", "sid",
]

TOPIC_SCHEMA = StructType(_strings(*TOPIC_FIELDS))

# The 22 payload fields of a VP message and their types.
VP_SCHEMA = StructType([
    StructField("desi", StringType()),
    StructField("dir", StringType()),
    StructField("oper", IntegerType()),
    StructField("veh", IntegerType()),
    StructField("tst", StringType()),
    StructField("tsi", LongType()),
    StructField("spd", DoubleType()),
    StructField("hdg", IntegerType()),
    StructField("lat", DoubleType()),
    StructField("long", DoubleType()),
    StructField("acc", DoubleType()),
    StructField("dl", IntegerType()),
    StructField("odo", IntegerType()),
    StructField("drst", IntegerType()),
    StructField("oday", StringType()),
    StructField("jrn", IntegerType()),
    StructField("line", IntegerType()),
    StructField("start", StringType()),
    StructField("loc", StringType()),
    StructField("stop", StringType()),
    StructField("route", StringType()),
    StructField("occu", IntegerType()),
])
VP_FIELDS = [f.name for f in VP_SCHEMA.fields]

ENVELOPE_SCHEMA = StructType([
    StructField("topic", TOPIC_SCHEMA),
    StructField("payload", StructType([StructField("VP", VP_SCHEMA)])),
])

# Bronze events: Kafka record, decoded, plus landing time (UTC wall clock).
BRONZE_EVENTS_SCHEMA = StructType([
    StructField("json_str", StringType()),
    StructField("key", StringType()),
    StructField("topic", StringType()),
    StructField("partition", IntegerType()),
    StructField("offset", LongType()),
    StructField("timestamp", TimestampNTZType()),
    StructField("insert_time", TimestampNTZType()),
])

# The gold fact's business columns, in order.
FACT_COLUMNS = [
    "oday", "tst", "tsi", "route_id", "route", "stop", "operator_id", "oper",
    "vehicle_number", "veh", "transport_mode", "direction_id", "dir", "headsign",
    "lat", "long", "spd", "dl", "occu", "event_type",
]

# The routes file header (GTFS routes.txt subset).
ROUTES_RAW_COLUMNS = [
    "route_id", "agency_id", "route_short_name", "route_long_name", "route_desc", "route_type", "route_url",
]
ROUTES_RAW_SCHEMA = StructType(_strings(*ROUTES_RAW_COLUMNS))

# The stops file header (GTFS stops.txt subset).
STOPS_RAW_COLUMNS = [
    "stop_id", "stop_code", "stop_name", "stop_desc", "stop_lat", "stop_lon", "zone_id", "stop_url",
    "location_type", "parent_station", "wheelchair_boarding", "platform_code", "vehicle_type", "radius",
]
STOPS_RAW_SCHEMA = StructType(_strings(*STOPS_RAW_COLUMNS) + [StructField("_corrupt_record", StringType())])

# The columns and types of the two dimension tables.
DIM_ROUTES_SCHEMA = StructType([
    StructField("route_id", StringType()),
    StructField("agency_id", StringType()),
    StructField("route_short_name", StringType()),
    StructField("route_long_name", StringType()),
    StructField("route_type", IntegerType()),
    StructField("insert_time", TimestampNTZType()),
    StructField("rundate", DateType()),
    StructField("effective_start_dt", TimestampNTZType()),
    StructField("effective_end_dt", TimestampNTZType()),
    StructField("active_flg", IntegerType()),
    StructField("insert_dt", TimestampNTZType()),
    StructField("update_dt", TimestampNTZType()),
    StructField("row_wid", StringType()),
])

# vehicle_type is kept as a string in silver and gold (it carries "N/A").
DIM_STOPS_SCHEMA = StructType([
    StructField("stop_id", StringType()),
    StructField("stop_code", StringType()),
    StructField("stop_name", StringType()),
    StructField("stop_desc", StringType()),
    StructField("stop_lat", DoubleType()),
    StructField("stop_lon", DoubleType()),
    StructField("zone_id", StringType()),
    StructField("parent_station", StringType()),
    StructField("wheelchair_boarding", IntegerType()),
    StructField("platform_code", StringType()),
    StructField("vehicle_type", StringType()),
    StructField("radius", IntegerType()),
    StructField("insert_time", TimestampNTZType()),
    StructField("rundate", DateType()),
    StructField("effective_start_dt", TimestampNTZType()),
    StructField("effective_end_dt", TimestampNTZType()),
    StructField("active_flg", IntegerType()),
    StructField("insert_dt", TimestampNTZType()),
    StructField("update_dt", TimestampNTZType()),
    StructField("row_wid", StringType()),
])

JOB_LOG_SCHEMA = StructType([
    StructField("schema_name", StringType()),
    StructField("table_name", StringType()),
    StructField("max_timestamp", TimestampNTZType()),
    StructField("rundate", StringType()),
    StructField("insert_dt", TimestampNTZType()),
])
