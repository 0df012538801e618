"""Analytic queries over the star schema and the bronze layer.

Every ranking takes ``n`` and a deterministic key tie-break; ``orderBy + limit``
plans as a top-k (``TakeOrderedAndProject``): each task keeps ``n`` rows, so
no single task sorts the whole input.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetlake.operators.gold import join_active_dim


def _on_day(fact: DataFrame, day: str | _dt.date | None) -> DataFrame:
    # A plain equality on the partition column: pruned to one oday= directory.
    return fact if day is None else fact.filter(F.col("oday") == F.lit(str(day)).cast("date"))


def route_delay_top(fact: DataFrame, routes: DataFrame, day: str | None, n: int = 10) -> DataFrame:
    """Most delayed routes of a day: mean delay in minutes, 2 decimals."""
    f = _on_day(fact, day).select("oday", "route_id", "dl")
    j = join_active_dim(f, routes, "route_id", columns=["route_short_name", "route_long_name"])
    return (j.groupBy("oday", "route_short_name", "route_long_name")
            .agg(F.round(F.avg("dl") / 60, 2).alias("avg_delay_min"))
            .orderBy(F.col("avg_delay_min").desc_nulls_last(), "route_short_name", "route_long_name")
            .limit(n))


def route_density(fact: DataFrame, routes: DataFrame, day: str | None, n: int = 10) -> DataFrame:
    """Distinct vehicles per distinct stop for each route on a day."""
    f = _on_day(fact, day).select("oday", "route_id", "route", "vehicle_number", "stop")
    j = join_active_dim(f, routes, "route_id", columns=["route_short_name", "route_long_name", "route_type"])
    return (j.groupBy("oday", "route_id", "route", "route_short_name", "route_long_name", "route_type")
            .agg(F.count_distinct("vehicle_number").alias("bus_count"),
                 F.count_distinct("stop").alias("unique_stops"))
            .withColumn("veh_to_stops_ratio",
                        F.round(F.col("bus_count").cast("double") / F.nullif(F.col("unique_stops"), F.lit(0)).cast("double"), 2))
            .orderBy(F.col("veh_to_stops_ratio").desc_nulls_last(), "route_id")
            .limit(n))


def partition_distribution(bronze: DataFrame, partition_col: str = "partition") -> DataFrame:
    """Events per Kafka partition, listed by partition."""
    return (bronze.groupBy(F.col(partition_col).alias("kafka_partition"))
            .agg(F.count(F.lit(1)).alias("event_count"))
            .orderBy("kafka_partition"))


def offset_gaps(bronze: DataFrame, topic_col: str = "topic", partition_col: str = "partition",
                offset_col: str = "offset", bucket_size: int = 1 << 20) -> DataFrame:
    """Missing offset ranges per topic and Kafka partition.

    Same rows as ``lead(offset) over (partition by topic, partition order by
    offset)``, but a Kafka partition is split into offset buckets of
    ``bucket_size``.  An aggregate first finds the buckets with a hole; ``lead``
    runs inside these only, and the edge between consecutive non-empty buckets
    (max of one, min of the next) is checked on the per-bucket summary.  No task
    ever holds a whole Kafka partition.
    """
    place = ["topic", "kafka_partition", "bucket"]
    df = bronze.select(F.col(topic_col).alias("topic"), F.col(partition_col).alias("kafka_partition"),
                       F.col(offset_col).alias("kafka_offset"))
    df = df.withColumn("bucket", F.floor(F.col("kafka_offset") / bucket_size))
    summary = df.groupBy(*place).agg(F.min("kafka_offset").alias("lo"), F.max("kafka_offset").alias("hi"),
                                     F.count_distinct("kafka_offset").alias("n"))
    holes = summary.filter(F.col("hi") - F.col("lo") + 1 > F.col("n")).select(*place)
    inner = df.join(holes, place, "left_semi").withColumn(
        "next_offset", F.lead("kafka_offset").over(Window.partitionBy(*place).orderBy("kafka_offset")))
    edges = summary.select(
        "topic", "kafka_partition", F.col("hi").alias("kafka_offset"),
        F.lead("lo").over(Window.partitionBy("topic", "kafka_partition").orderBy("bucket")).alias("next_offset"))
    pairs = inner.select(*edges.columns).unionByName(edges).filter(F.col("next_offset") > F.col("kafka_offset") + 1)
    return pairs.select(
        "topic", "kafka_partition",
        (F.col("kafka_offset") + 1).alias("missing_start"),
        (F.col("next_offset") - 1).alias("missing_end"),
        (F.col("next_offset") - F.col("kafka_offset") - 1).alias("missing_count"),
    )


def route_bus_count(fact: DataFrame, day: str | None = None, n: int = 10) -> DataFrame:
    """Routes with the most distinct vehicles in a day."""
    return (_on_day(fact, day).groupBy("oday", "route_id")
            .agg(F.count_distinct("vehicle_number").alias("bus_count"))
            .orderBy(F.col("bus_count").desc(), "oday", "route_id")
            .limit(n))


def route_stop_coverage(fact: DataFrame, n: int = 10) -> DataFrame:
    """Routes with the most distinct stops, both directions together."""
    return (fact.groupBy("route_id")
            .agg(F.count_distinct("stop").alias("unique_stops"),
                 F.count_distinct("direction_id").alias("directions"))
            .orderBy(F.col("unique_stops").desc(), "route_id")
            .limit(n))


def hot_spots(fact: DataFrame, cell_deg: float = 0.01, n: int = 10) -> DataFrame:
    """Densest lat/long grid cells by number of reports."""
    return (fact.groupBy(F.floor(F.col("lat") / cell_deg).alias("lat_cell"),
                         F.floor(F.col("long") / cell_deg).alias("lon_cell"))
            .agg(F.count(F.lit(1)).alias("events"), F.count_distinct("vehicle_number").alias("vehicles"))
            .orderBy(F.col("events").desc(), "lat_cell", "lon_cell")
            .limit(n))


LEVELS = 16


def _spread_bits(c: Column) -> Column:
    """The 16 low bits of ``c`` moved apart, one zero between two."""
    for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
        c = (c.bitwiseOR(F.shiftleft(c, shift))).bitwiseAND(F.lit(mask).cast("long"))
    return c


def z_code(lat: str = "lat", long: str = "long") -> Column:
    """Z-order code of a position at the finest level: 16 bits of latitude and longitude interleaved.

    A code less its last two bits is the code of the cell that holds it one level up.
    """
    side = 1 << LEVELS
    cell = lambda c, lo, span: F.least(F.floor((F.col(c) - lo) / span * side), F.lit(side - 1)).cast("long")
    return _spread_bits(cell(long, -180, 360)).bitwiseOR(F.shiftleft(_spread_bits(cell(lat, -90, 180)), 1))


def adaptive_hot_spots(fact: DataFrame, split_over: int = 1000, levels: int = LEVELS) -> DataFrame:
    """Cells of unequal size that partition the reports: dense places in small cells, empty ones in large.

    A quadtree cut without a tree: reports are counted per finest cell, those
    counts are summed for the cells of all levels (a row per cell and level,
    however many reports), and a cell stays if it holds at most ``split_over``
    reports, or is at the last of ``levels``, while its parent holds more.  A
    parent has at most four children, so the one join has no hot key.  Reports
    without position are left out.  ``(level, lat_from, lon_from, events)``.
    """
    fine = (fact.filter(F.col("lat").isNotNull() & F.col("long").isNotNull()).select(z_code().alias("code"))
            .groupBy("code").agg(F.count(F.lit(1)).alias("n")))
    every = fine.withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(levels))))
    up = F.expr(f"shiftright(code, cast(2 * ({LEVELS} - level) as int))")
    cells = every.groupBy("level", up.alias("cell")).agg(F.sum("n").alias("events"))
    parents = cells.filter(F.col("events") > split_over).select((F.col("level") + 1).alias("level"), F.col("cell").alias("parent"))
    kept = cells.filter((F.col("events") <= split_over) | (F.col("level") == levels))
    below = kept.withColumn("parent", F.shiftright("cell", 2)).join(parents, ["level", "parent"], "left_semi").drop("parent")
    leaves = below.unionByName(kept.filter(F.col("level") == 0).select(*below.columns))

    def from_edge(bit: int, lo: int, span: int) -> Column:
        own = F.lit(0).cast("long")
        for i in range(levels):
            own = own.bitwiseOR(F.shiftleft(F.shiftright("cell", 2 * i + bit).bitwiseAND(F.lit(1).cast("long")), i))
        return own * span / F.expr("shiftleft(1L, cast(level as int))") + lo

    return leaves.select("level", from_edge(1, -90, 180).alias("lat_from"), from_edge(0, -180, 360).alias("lon_from"), "events")


def hot_stops(fact: DataFrame, stops: DataFrame, day: str | None = None, n: int = 10) -> DataFrame:
    """Stops with the most reports, where they are, and the distinct vehicles and routes that meet there (A14, by stop)."""
    f = _on_day(fact, day).select("stop", "vehicle_number", "route_id")
    counted = f.filter(F.col("stop").isNotNull()).groupBy("stop").agg(
        F.count(F.lit(1)).alias("events"), F.count_distinct("vehicle_number").alias("vehicles"), F.count_distinct("route_id").alias("routes"))
    j = join_active_dim(counted, stops, "stop", "stop_id", columns=["stop_name", "stop_lat", "stop_lon"])
    return (j.withColumnRenamed("stop", "stop_id").orderBy(F.col("events").desc(), "stop_id").limit(n))


def _on_time(delay: str, thresholds: Sequence[int]):
    return [F.avg(F.when(F.abs(F.col(delay)) <= t, 1).otherwise(0)).alias(f"on_time_ratio_{i}")
            for i, t in enumerate(thresholds, 1)]


def route_on_time(fact: DataFrame, thresholds: Sequence[int] = (60, 120, 180)) -> DataFrame:
    """Share of reports within ±60/120/180 s of schedule, per route."""
    return (fact.filter(F.col("dl").isNotNull()).groupBy("route_id")
            .agg(F.count(F.lit(1)).alias("events"), *_on_time("dl", thresholds)))


def speed_by_route_vehicle(fact: DataFrame) -> DataFrame:
    """Mean speed per route and vehicle, m/s and km/h."""
    return (fact.groupBy("route_id", "vehicle_number")
            .agg(F.avg("spd").alias("avg_speed"), F.count(F.lit(1)).alias("events"))
            .withColumn("avg_speed_kmh", F.col("avg_speed") * 3.6))


def occupancy_trend(fact: DataFrame, grain: str = "hour") -> DataFrame:
    """Active vehicles and mean occupancy per hour (or day)."""
    bucket = F.date_trunc(grain, F.col("tst")).cast("timestamp_ntz") if grain != "day" else F.col("oday")
    return (fact.groupBy(bucket.alias("period"))
            .agg(F.count_distinct("vehicle_number").alias("active_vehicles"),
                 F.avg("occu").alias("avg_occupancy"),
                 F.count(F.lit(1)).alias("events")))


def peak_hours(fact: DataFrame) -> DataFrame:
    """Load and delay by hour of day over the whole history."""
    return (fact.groupBy(F.hour("tst").alias("hour_of_day"))
            .agg(F.count(F.lit(1)).alias("events"),
                 F.count_distinct("vehicle_number").alias("vehicles"),
                 F.avg("dl").alias("avg_delay_sec"))
            .orderBy("hour_of_day"))


def stop_bottlenecks(fact: DataFrame, stops: DataFrame, day: str | None, n: int = 10,
                     min_events: int = 2) -> DataFrame:
    """Stops with the highest mean delay on a day, with at least ``min_events`` reports."""
    f = _on_day(fact, day).select("stop", "vehicle_number", "dl")
    j = join_active_dim(f, stops, "stop", "stop_id", columns=["stop_id", "stop_name"])
    return (j.groupBy("stop", "stop_name")
            .agg(F.count(F.lit(1)).alias("events"),
                 F.count_distinct("vehicle_number").alias("vehicles"),
                 F.avg("dl").alias("avg_delay_sec"))
            .filter(F.col("events") >= min_events)
            .withColumnRenamed("stop", "stop_id")
            .orderBy(F.col("avg_delay_sec").desc_nulls_last(), "stop_id")
            .limit(n))
