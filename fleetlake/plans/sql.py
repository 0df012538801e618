"""The star schema through Spark SQL (ad-hoc query path, L4).

``register_views`` exposes the layers under short names, so analysts can keep
writing SQL: ``positions`` (the fact), ``current_routes`` (active versions),
``raw_events`` (bronze).  The statements take named parameters, bound by Spark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def register_views(spark: SparkSession, *, fact: DataFrame | None = None, dim_routes: DataFrame | None = None,
                   bronze: DataFrame | None = None) -> None:
    if fact is not None:
        fact.createOrReplaceTempView("positions")
    if dim_routes is not None:
        dim_routes.where("active_flg = 1").createOrReplaceTempView("current_routes")
    if bronze is not None:
        bronze.createOrReplaceTempView("raw_events")


DELAY_REPORT = """
SELECT oday, route_short_name, route_long_name, round(avg(dl) / 60, 2) AS avg_delay_min
FROM positions JOIN current_routes USING (route_id)
WHERE oday = :day
GROUP BY oday, route_short_name, route_long_name
ORDER BY avg_delay_min DESC NULLS LAST, route_short_name, route_long_name LIMIT :n
"""

DENSITY_REPORT = """
WITH used AS (
  SELECT route_id, route, count(DISTINCT vehicle_number) AS bus_count, count(DISTINCT stop) AS unique_stops
  FROM positions WHERE oday = :day GROUP BY route_id, route)
SELECT CAST(:day AS DATE) AS oday, route_id, route, route_short_name, route_long_name, route_type, bus_count, unique_stops,
       round(try_divide(CAST(bus_count AS DOUBLE), unique_stops), 2) AS veh_to_stops_ratio
FROM used JOIN current_routes USING (route_id)
ORDER BY veh_to_stops_ratio DESC NULLS LAST, route_id LIMIT :n
"""

PARTITION_REPORT = """
SELECT `partition` AS kafka_partition, count(*) AS event_count FROM raw_events GROUP BY `partition` ORDER BY kafka_partition
"""


def run(spark: SparkSession, statement: str, **params) -> DataFrame:
    return spark.sql(statement, args=params)
