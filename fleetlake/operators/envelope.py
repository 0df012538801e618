"""JSON envelope and MQTT topic operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlake.functions.exprs import blank_to_null
from fleetlake.schemas import ENVELOPE_SCHEMA, TOPIC_FIELDS, VP_FIELDS


def flatten_envelope(bronze: DataFrame, json_col: str = "json_str") -> DataFrame:
    """Parse ``{topic:{16}, payload:{VP:{22}}}`` and flatten it next to the landing metadata.

    Kafka ``partition``/``offset`` are kept as ``kafka_partition``/``kafka_offset``:
    they are the deterministic tie-break of the dedupe and the key of the gap
    audit.  The whole envelope is parsed whichever fields a later step uses, and
    once: the parse stands in a one-element generator, below which no later
    filter or projection is pushed, so none of them brings a copy of it along.
    """
    data = F.from_json(F.col(json_col), ENVELOPE_SCHEMA)
    parsed = bronze.select(
        "insert_time",
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
        F.explode(F.array(data)).alias("data"),
    )
    return parsed.select(
        "insert_time", "kafka_partition", "kafka_offset",
        *[F.col(f"data.topic.{f}").alias(f) for f in TOPIC_FIELDS],
        *[F.col(f"data.payload.VP.{f}").alias(f) for f in VP_FIELDS],
    )


def parse_topic_path(df: DataFrame, col: str = "topic_path") -> DataFrame:
    """Split ``/p0/p1/...`` into the 16 named topic fields.

    The leading slash yields an empty first element that is skipped; a path
    with fewer parts leaves the remaining fields NULL (``get`` is the
    ANSI-safe index).
    """
    parts = F.split(F.col(col), "/")
    return df.select("*", *[F.get(parts, i + 1).alias(name) for i, name in enumerate(TOPIC_FIELDS)])


def record_key(vehicle: str = "vehicle_number", route: str = "route_id"):
    """Kafka record key: vehicle, else route, else ``'unknown'``; blanks count as missing."""
    return F.coalesce(blank_to_null(F.col(vehicle)), blank_to_null(F.col(route)), F.lit("unknown"))


def to_envelope(flat: DataFrame) -> DataFrame:
    """Flat topic + VP columns -> ``json_str`` envelope and record ``key``."""
    topic = F.struct(*[F.col(f) for f in TOPIC_FIELDS])
    vp = F.struct(*[F.col(f) for f in VP_FIELDS])
    return flat.select(
        record_key().alias("key"),
        F.to_json(F.struct(topic.alias("topic"), F.struct(vp.alias("VP")).alias("payload"))).alias("json_str"),
    )


def journey_reason(modes: Sequence[str], prefix: str = ""):
    """First failed rule of the ingest filter, NULL for a journey to keep."""
    c = lambda name: F.col(prefix + name)
    # Accepted journey/temporal types of the producer filter.
    return (F.when(F.coalesce(c("journey_type"), F.lit("")) != "journey", "not_journey")
            .when(F.coalesce(c("temporal_type"), F.lit("")) != "ongoing", "not_ongoing")
            .when(~F.coalesce(c("transport_mode").isin(list(modes)), F.lit(False)), "mode")
            .when(blank_to_null(c("vehicle_number")).isNull(), "no_vehicle")
            .when(blank_to_null(c("route_id")).isNull(), "no_route")
            .when(c("tst").isNull(), "no_tst"))


def filter_journey(df: DataFrame, modes: Sequence[str] = ("bus",)) -> DataFrame:
    """Keep ongoing journeys of the given modes with vehicle, route and tst present."""
    return df.filter(journey_reason(modes).isNull())


def journey_rejects(df: DataFrame, modes: Sequence[str] = ("bus",)) -> DataFrame:
    """The complement of ``filter_journey``, each row with its first failed rule."""
    return df.withColumn("reject_reason", journey_reason(modes)).filter(F.col("reject_reason").isNotNull())
