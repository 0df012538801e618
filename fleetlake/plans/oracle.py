"""Independent DuckDB SQL for every registered query (the correctness oracle).

Written from the operator *semantics* (window dedupe, MERGE-style SCD2,
``LEAD`` gap audit, ...) directly over the driver's views, not from the Spark
plans.  Spark's ``round(double, 2)`` rounds the shortest decimal form half-up;
``R2`` reproduces that in DuckDB by rounding through a DECIMAL.
"""

from __future__ import annotations

from fleetlake.plans.queries import AS_OF, DAY, FACT_NOW, FIRST_UNTIL, HISTORY, HORIZON, LOAD1, LOAD2, RANGE, REPLAY, SECOND_FROM


def R2(x: str) -> str:
    return f"CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38, 28)), 2) AS DOUBLE)"


def _src(lose_every: int | None = None) -> str:
    lose = f"WHERE event_id % {lose_every} <> 0" if lose_every else ""
    return f"""
src AS (
  SELECT *, false AS resent FROM events {lose}
  UNION ALL
  SELECT *, true AS resent FROM events WHERE event_id % 20 = 0 {f'AND event_id % {lose_every} <> 0' if lose_every else ''}
),
src2 AS (
  SELECT *,
    CASE WHEN event_id % 10 = 0 THEN NULL ELSE 'S' || CAST(event_id % 200 AS VARCHAR) END AS stop_,
    CAST(user_id % 40 AS DOUBLE) / 100 + 60 AS lat_,
    CAST(event_id % 50 AS DOUBLE) / 100 + 24 AS lon_
  FROM src
)"""


FLAT_COLS = """
    ts + INTERVAL 2 SECOND + CASE WHEN resent THEN INTERVAL 1 SECOND ELSE INTERVAL 0 SECOND END AS insert_time,
    CAST(event_id % 6 AS INTEGER) AS kafka_partition,
    CAST(event_id // 6 AS BIGINT) AS kafka_offset,
    'hfp' AS prefix,
    'v2' AS version,
    CASE WHEN event_id % 13 = 0 THEN 'deadrun' ELSE 'journey' END AS journey_type,
    CASE WHEN event_id % 17 = 0 THEN 'upcoming' ELSE 'ongoing' END AS temporal_type,
    event_type,
    CASE WHEN user_id % 5 = 0 THEN 'tram' ELSE 'bus' END AS transport_mode,
    lpad(CAST(user_id % 3 + 20 AS VARCHAR), 4, '0') AS operator_id,
    lpad(CAST(user_id AS VARCHAR), 5, '0') AS vehicle_number,
    'R' || CAST(user_id % 30 AS VARCHAR) AS route_id,
    CAST(event_id % 2 + 1 AS VARCHAR) AS direction_id,
    'Terminal ' || CAST(user_id % 30 AS VARCHAR) AS headsign,
    strftime(ts, '%H:%M') AS start_time,
    coalesce(stop_, 'EOL') AS next_stop,
    '4' AS geohash_level,
    CAST(CAST(floor(lat_) AS BIGINT) AS VARCHAR) || ';' || CAST(CAST(floor(lon_) AS BIGINT) AS VARCHAR) AS geohash,
    CAST(NULL AS VARCHAR) AS sid,
    CAST(user_id % 30 AS VARCHAR) AS desi,
    CAST(event_id % 2 + 1 AS VARCHAR) AS dir,
    CAST(user_id % 3 + 20 AS INTEGER) AS oper,
    CAST(user_id AS INTEGER) AS veh,
    strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS tst,
    CAST(epoch_us(ts) // 1000000 AS BIGINT) AS tsi,
    CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) AS DOUBLE) / 8 AS spd,
    CAST((event_id * 7) % 360 AS INTEGER) AS hdg,
    lat_ AS lat,
    lon_ AS "long",
    CAST(event_id % 11 - 5 AS DOUBLE) / 4 AS acc,
    CASE WHEN event_id % 50 = 0 THEN NULL
         ELSE CAST(floor(value * 5) AS INTEGER) - 200 + CASE WHEN resent THEN 1 ELSE 0 END END AS dl,
    CAST((event_id % 100000) * 3 AS INTEGER) AS odo,
    CAST(event_id % 2 AS INTEGER) AS drst,
    strftime(ts, '%Y-%m-%d') AS oday,
    CAST(user_id AS INTEGER) AS jrn,
    CAST(user_id % 30 + 1000 AS INTEGER) AS line,
    strftime(ts, '%H:%M') AS start,
    'GPS' AS loc,
    stop_ AS stop,
    'R' || CAST(user_id % 30 AS VARCHAR) AS route,
    CAST(event_id % 101 AS INTEGER) AS occu"""

FACT_LIST = ("oday, tst, tsi, route_id, route, stop, operator_id, oper, vehicle_number, veh, transport_mode, "
             "direction_id, dir, headsign, lat, \"long\", spd, dl, occu, event_type")


def base(lose_every: int | None = None) -> str:
    """CTEs: ``flat`` (parsed bronze), ``silver`` (deduped, typed), ``fact``."""
    return f"""WITH {_src(lose_every)},
flat AS (SELECT {FLAT_COLS} FROM src2),
silver AS (
  SELECT * EXCLUDE (rn, tst, oday),
         strptime(tst, '%Y-%m-%dT%H:%M:%S.%fZ') AS tst,
         CAST(oday AS DATE) AS oday,
         TIMESTAMP '{LOAD1}' AS update_time
  FROM (SELECT *, row_number() OVER (PARTITION BY vehicle_number, tst
                                     ORDER BY insert_time DESC, kafka_partition DESC, kafka_offset DESC) AS rn
        FROM flat)
  WHERE rn = 1
),
fact AS (
  SELECT {FACT_LIST}, TIMESTAMP '{FACT_NOW}' AS insert_time, TIMESTAMP '{FACT_NOW}' AS update_time FROM silver
),
{DIMS}"""


def _routes(version: int) -> str:
    at = LOAD1 if version == 1 else LOAD2
    excl = 15 if version == 1 else 14
    long_name = "CASE WHEN p_partkey % 7 = 1 THEN NULL ELSE p_name END" if version == 2 else "p_name"
    size = "p_size + CASE WHEN p_partkey % 3 = 0 THEN 1 ELSE 0 END" if version == 2 else "p_size"
    return f"""SELECT 'R' || CAST(p_partkey AS VARCHAR) AS route_id,
         'CITY' AS agency_id,
         coalesce(CASE WHEN p_partkey % 9 = 4 THEN NULL ELSE p_brand END, 'NA') AS route_short_name,
         {long_name} AS route_long_name,
         TRY_CAST(CASE WHEN p_partkey % 23 = 5 THEN 'bus' ELSE CAST({size} AS VARCHAR) END AS INTEGER) AS route_type,
         TIMESTAMP '{at}' AS insert_time,
         DATE '{at[:10]}' AS rundate
  FROM part WHERE p_partkey % 16 <> {excl}"""


def _changed(null_safe: bool) -> str:
    op = "IS DISTINCT FROM" if null_safe else "<>"
    return " OR ".join(f"a.{c} {op} b.{c}" for c in ("route_short_name", "route_long_name", "route_type"))


def _dim2(null_safe: bool, name: str) -> str:
    return f"""{name}_chg AS (
  SELECT a.route_id FROM routes_v1 a JOIN routes_v2 b ON a.route_id = b.route_id WHERE {_changed(null_safe)}
),
{name} AS (
  SELECT d.* REPLACE (
           CASE WHEN d.route_id IN (SELECT route_id FROM {name}_chg)
                THEN TIMESTAMP '{LOAD2}' - INTERVAL 1 SECOND ELSE d.effective_end_dt END AS effective_end_dt,
           CASE WHEN d.route_id IN (SELECT route_id FROM {name}_chg) THEN 0 ELSE d.active_flg END AS active_flg,
           CASE WHEN d.route_id IN (SELECT route_id FROM {name}_chg) THEN TIMESTAMP '{LOAD2}' ELSE d.update_dt END AS update_dt)
  FROM dim1 d
  UNION ALL
  SELECT v.*, TIMESTAMP '{LOAD2}' AS effective_start_dt, TIMESTAMP '9999-12-31 00:00:00' AS effective_end_dt,
         1 AS active_flg, TIMESTAMP '{LOAD2}' AS insert_dt, TIMESTAMP '{LOAD2}' AS update_dt,
         sha256(v.route_id || '|' || '{LOAD2}') AS row_wid
  FROM routes_v2 v
  WHERE v.route_id NOT IN (SELECT route_id FROM routes_v1) OR v.route_id IN (SELECT route_id FROM {name}_chg)
)"""


DIMS = f"""routes_v1 AS ({_routes(1)}),
routes_v2 AS ({_routes(2)}),
dim1 AS (
  SELECT v.*, TIMESTAMP '{LOAD1}' AS effective_start_dt, TIMESTAMP '9999-12-31 00:00:00' AS effective_end_dt,
         1 AS active_flg, TIMESTAMP '{LOAD1}' AS insert_dt, TIMESTAMP '{LOAD1}' AS update_dt,
         sha256(v.route_id || '|' || '{LOAD1}') AS row_wid
  FROM routes_v1 v
),
{_dim2(True, 'dim2')},
{_dim2(False, 'dim2_plain')},
active_routes AS (SELECT * FROM dim2 WHERE active_flg = 1),
stops_stg AS (
  SELECT 'S' || CAST(p_partkey AS VARCHAR) AS stop_id,
         CAST(p_partkey AS VARCHAR) AS stop_code,
         p_name AS stop_name,
         p_type AS stop_desc,
         TRY_CAST('60.' || lpad(CAST(p_partkey % 100 AS VARCHAR), 2, '0') AS DOUBLE) AS stop_lat,
         TRY_CAST(CASE WHEN p_partkey % 29 = 3 THEN 'n/a' ELSE '24.' || lpad(CAST(p_size AS VARCHAR), 2, '0') END AS DOUBLE) AS stop_lon,
         p_type AS zone_id,
         coalesce(CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE 'P' || CAST(p_partkey // 10 AS VARCHAR) END, 'N/A') AS parent_station,
         TRY_CAST(CAST(p_size % 4 AS VARCHAR) AS INTEGER) AS wheelchair_boarding,
         coalesce(CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE CAST(p_partkey % 4 + 1 AS VARCHAR) END, 'N/A') AS platform_code,
         coalesce(CASE WHEN p_partkey % 10 = 0 THEN NULL ELSE CAST(p_size % 3 AS VARCHAR) END, 'N/A') AS vehicle_type,
         TRY_CAST(CAST(p_size * 10 AS VARCHAR) AS INTEGER) AS radius,
         TIMESTAMP '{LOAD1}' AS insert_time,
         DATE '{LOAD1[:10]}' AS rundate
  FROM part
),
dim_stops AS (
  SELECT s.*, TIMESTAMP '{LOAD1}' AS effective_start_dt, TIMESTAMP '9999-12-31 00:00:00' AS effective_end_dt,
         1 AS active_flg, TIMESTAMP '{LOAD1}' AS insert_dt, TIMESTAMP '{LOAD1}' AS update_dt,
         sha256(s.stop_id || '|' || '{LOAD1}') AS row_wid
  FROM stops_stg s
)"""

DIM_OUT = ("route_id, route_short_name, route_long_name, route_type, effective_start_dt, effective_end_dt, "
           "active_flg, update_dt, row_wid")

TOPIC_FIELDS = ["prefix", "version", "journey_type", "temporal_type", "event_type", "transport_mode",
                "operator_id", "vehicle_number", "route_id", "direction_id", "headsign", "start_time",
                "next_stop", "geohash_level", "geohash", "sid"]


def _paths() -> str:
    cols = ", ".join(f"coalesce({c}, '')" if c != "vehicle_number" else
                     "CASE WHEN event_id % 11 = 0 THEN '' ELSE coalesce(vehicle_number, '') END"
                     for c in TOPIC_FIELDS)
    short = ", ".join(f"coalesce({c}, '')" if c != "vehicle_number" else
                      "CASE WHEN event_id % 11 = 0 THEN '' ELSE coalesce(vehicle_number, '') END"
                      for c in TOPIC_FIELDS[:8])
    return f"""topic_src AS (SELECT event_id, {FLAT_COLS} FROM src2 WHERE NOT resent),
paths AS (
  SELECT event_id,
         CASE WHEN event_id % 7 = 0 THEN concat_ws('/', '', {short}) ELSE concat_ws('/', '', {cols}) END AS topic_path
  FROM topic_src
)"""


_PARSED = ", ".join(f"string_split(topic_path, '/')[{i + 2}] AS {c}" for i, c in enumerate(TOPIC_FIELDS))

_REASON = """CASE WHEN coalesce(journey_type, '') <> 'journey' THEN 'not_journey'
            WHEN coalesce(temporal_type, '') <> 'ongoing' THEN 'not_ongoing'
            WHEN NOT coalesce(transport_mode IN ('bus'), false) THEN 'mode'
            WHEN nullif(vehicle_number, '') IS NULL THEN 'no_vehicle'
            WHEN nullif(route_id, '') IS NULL THEN 'no_route'
            WHEN tst IS NULL THEN 'no_tst' END"""


def _silver_of(where: str) -> str:
    return f"""SELECT * EXCLUDE (rn, tst, oday), strptime(tst, '%Y-%m-%dT%H:%M:%S.%fZ') AS tst, CAST(oday AS DATE) AS oday
  FROM (SELECT *, row_number() OVER (PARTITION BY vehicle_number, tst
                                     ORDER BY insert_time DESC, kafka_partition DESC, kafka_offset DESC) AS rn
        FROM flat WHERE {where})
  WHERE rn = 1"""


JOB_LOG = """,
jl_day AS (SELECT CAST(insert_time AS DATE) AS d, max(insert_time) AS m FROM flat GROUP BY 1),
job_log AS (
  SELECT 'hdw_ld' AS schema_name, 'events_ld' AS table_name, m AS max_timestamp,
         strftime(d, '%Y-%m-%d') AS rundate, m + INTERVAL 1 HOUR AS insert_dt FROM jl_day
  UNION ALL
  SELECT 'hdw_stg', 'events_stg', m, strftime(d, '%Y-%m-%d'), m + INTERVAL 2 HOUR FROM jl_day
  WHERE d < DATE '2024-01-15'
)"""

_HITS = ",\n".join(f"avg(CASE WHEN abs(dl) <= {t} THEN 1 ELSE 0 END) AS on_time_ratio_{i}"
                    for i, t in enumerate((60, 120, 180), 1))

KPI = f""",
kin AS (SELECT tst, vehicle_number, route_id, spd, dl FROM fact WHERE dl IS NOT NULL AND abs(dl) <= 1800),
kexp AS (
  SELECT time_bucket(INTERVAL 30 SECOND, tst) - INTERVAL 30 SECOND * k AS window_start, kin.*
  FROM kin CROSS JOIN range(10) AS r(k)
),
kpi AS (
  SELECT window_start, window_start + INTERVAL 300 SECOND AS window_end,
         count(DISTINCT vehicle_number) AS active_vehicles, avg(spd) AS avg_speed,
         {_HITS},
         count(*) AS events, avg(spd) * 3.6 AS avg_speed_kmh
  FROM kexp GROUP BY window_start
),
rwin AS (
  SELECT window_start, window_start + INTERVAL 300 SECOND AS window_end, route_id,
         avg(CAST(dl AS DOUBLE)) AS avg_delay_sec, count(*) AS events_cnt
  FROM kexp GROUP BY window_start, route_id
)"""


def _extremes(src: str) -> str:
    return f"""SELECT window_start, window_end, 'worst' AS type, route_id, avg_delay_sec FROM {src}
  QUALIFY row_number() OVER (PARTITION BY window_start ORDER BY avg_delay_sec DESC, route_id) = 1
  UNION ALL
  SELECT window_start, window_end, 'best' AS type, route_id, avg_delay_sec FROM {src}
  QUALIFY row_number() OVER (PARTITION BY window_start ORDER BY avg_delay_sec ASC, route_id) = 1"""


_GAUGES = {"total_active_vehicles": "CAST(active_vehicles AS DOUBLE)", "avg_speed_all": "avg_speed",
           "pct_routes_on_time_1": "on_time_ratio_1", "pct_routes_on_time_2": "on_time_ratio_2",
           "pct_routes_on_time_3": "on_time_ratio_3"}

METRICS = KPI + f""",
ext AS ({_extremes("(SELECT * FROM rwin WHERE events_cnt >= 2)")}),
metrics AS (
  {" UNION ALL ".join(f"SELECT '{g}' AS metric, CAST(NULL AS VARCHAR) AS type, CAST(NULL AS VARCHAR) AS route_id, window_end AS ts, {e} AS value FROM kpi" for g, e in _GAUGES.items())}
  UNION ALL
  SELECT 'route_delay_extreme_seconds', type, route_id, window_end, avg_delay_sec FROM ext
)"""

EXTREME = "route_delay_extreme_seconds"


def _steps(which: str, start: str, end: str, step_s: int, lookback_s: int, scale: str = "1.0") -> str:
    """Every step joined with the samples of its lookback; the newest one counts."""
    return f"""SELECT metric, type, route_id, t AS ts, arg_max(value, ts) / {scale} AS value
FROM metrics JOIN (SELECT unnest(generate_series(TIMESTAMP '{start}', TIMESTAMP '{end}', INTERVAL {step_s} SECOND)) AS t) steps
  ON metrics.ts <= steps.t AND metrics.ts > steps.t - INTERVAL {lookback_s} SECOND
WHERE {which} GROUP BY metric, type, route_id, t"""


def _sql() -> dict[str, str]:
    b = base()
    return {
        "route_delay_top": b + f"""
SELECT f.oday, r.route_short_name, r.route_long_name, {R2('avg(f.dl) / 60')} AS avg_delay_min
FROM fact f JOIN active_routes r ON f.route_id = r.route_id
WHERE f.oday = DATE '{DAY}'
GROUP BY f.oday, r.route_short_name, r.route_long_name
ORDER BY avg_delay_min DESC NULLS LAST, route_short_name, route_long_name
LIMIT 10""",
        "route_density": b + f"""
SELECT f.oday, f.route_id, f.route, r.route_short_name, r.route_long_name, r.route_type,
       count(DISTINCT f.vehicle_number) AS bus_count,
       count(DISTINCT f.stop) AS unique_stops,
       {R2('CAST(count(DISTINCT f.vehicle_number) AS DOUBLE) / CAST(nullif(count(DISTINCT f.stop), 0) AS DOUBLE)')} AS veh_to_stops_ratio
FROM fact f JOIN active_routes r ON f.route_id = r.route_id
WHERE f.oday = DATE '{DAY}'
GROUP BY f.oday, f.route_id, f.route, r.route_short_name, r.route_long_name, r.route_type
ORDER BY veh_to_stops_ratio DESC NULLS LAST, f.route_id
LIMIT 10""",
        "partition_distribution": b + """
SELECT kafka_partition, count(*) AS event_count FROM flat GROUP BY kafka_partition ORDER BY kafka_partition""",
        "offset_gaps": """
WITH feed AS (
  SELECT 'vehicle_positions' AS topic, event_id FROM events WHERE event_id % 97 <> 0
  UNION ALL
  SELECT 'vehicle_positions_b', event_id FROM events WHERE event_id % 89 <> 0
),
ordered AS (
  SELECT topic, CAST(event_id % 6 AS INTEGER) AS kafka_partition, CAST(event_id // 6 AS BIGINT) AS kafka_offset,
         lead(CAST(event_id // 6 AS BIGINT)) OVER (PARTITION BY topic, event_id % 6 ORDER BY event_id) AS next_offset
  FROM feed
)
SELECT topic, kafka_partition, kafka_offset + 1 AS missing_start, next_offset - 1 AS missing_end,
       next_offset - kafka_offset - 1 AS missing_count
FROM ordered WHERE next_offset > kafka_offset + 1""",
        "route_bus_count": b + """
SELECT oday, route_id, count(DISTINCT vehicle_number) AS bus_count
FROM fact GROUP BY oday, route_id ORDER BY bus_count DESC, oday, route_id LIMIT 10""",
        "route_stop_coverage": b + """
SELECT route_id, count(DISTINCT stop) AS unique_stops, count(DISTINCT direction_id) AS directions
FROM fact GROUP BY route_id ORDER BY unique_stops DESC, route_id LIMIT 10""",
        "hot_spots": b + """
SELECT CAST(floor(lat / 0.01) AS BIGINT) AS lat_cell, CAST(floor("long" / 0.01) AS BIGINT) AS lon_cell,
       count(*) AS events, count(DISTINCT vehicle_number) AS vehicles
FROM fact GROUP BY 1, 2 ORDER BY events DESC, lat_cell, lon_cell LIMIT 10""",
        "adaptive_hot_spots": b + """,
fine AS (
  SELECT least(CAST(floor((lat - -90) / 180 * 65536) AS BIGINT), 65535) AS y,
         least(CAST(floor(("long" - -180) / 360 * 65536) AS BIGINT), 65535) AS x, count(*) AS n
  FROM fact WHERE lat IS NOT NULL AND "long" IS NOT NULL GROUP BY 1, 2
),
cells AS (
  SELECT CAST(l AS INTEGER) AS level, y >> (16 - CAST(l AS INTEGER)) AS cy, x >> (16 - CAST(l AS INTEGER)) AS cx, CAST(sum(n) AS BIGINT) AS events
  FROM fine CROSS JOIN range(17) AS r(l) GROUP BY 1, 2, 3
)
SELECT c.level, CAST(c.cy * 180 AS DOUBLE) / (1 << c.level) - 90 AS lat_from,
       CAST(c.cx * 360 AS DOUBLE) / (1 << c.level) - 180 AS lon_from, c.events
FROM cells c LEFT JOIN cells p ON p.level = c.level - 1 AND p.cy = c.cy >> 1 AND p.cx = c.cx >> 1
WHERE (c.events <= 20 OR c.level = 16) AND (c.level = 0 OR p.events > 20)""",
        "hot_stops": b + """
SELECT s.stop_id, s.stop_name, s.stop_lat, s.stop_lon, count(*) AS events, count(DISTINCT f.vehicle_number) AS vehicles,
       count(DISTINCT f.route_id) AS routes
FROM fact f JOIN (SELECT * FROM dim_stops WHERE active_flg = 1) s ON f.stop = s.stop_id
GROUP BY ALL ORDER BY events DESC, s.stop_id LIMIT 10""",
        "kpi_windows_tumbling": b + KPI + f"""
SELECT time_bucket(INTERVAL 300 SECOND, tst) AS window_start, time_bucket(INTERVAL 300 SECOND, tst) + INTERVAL 300 SECOND AS window_end,
       count(DISTINCT vehicle_number) AS active_vehicles, avg(spd) AS avg_speed, {_HITS},
       count(*) AS events, avg(spd) * 3.6 AS avg_speed_kmh
FROM kin GROUP BY 1, 2""",
        "dq_quarantine": b + """,
judged AS (
  SELECT stop_id, concat_ws(';', CASE WHEN stop_id IS NULL OR stop_id = '' THEN 'no_nulls:stop_id' END,
                            CASE WHEN stop_lon IS NULL THEN 'no_nulls:stop_lon' END,
                            CASE WHEN wheelchair_boarding NOT IN (0, 1, 2) THEN 'values_in_set:wheelchair_boarding' END) AS broken
  FROM dim_stops
)
SELECT stop_id, broken, CAST(1 AS BIGINT) AS "rows" FROM judged WHERE broken <> ''
UNION ALL
SELECT NULL, '', count(*) FROM judged WHERE broken = ''""",
        "route_on_time": b + """
SELECT route_id, count(*) AS events,
       avg(CASE WHEN abs(dl) <= 60 THEN 1 ELSE 0 END) AS on_time_ratio_1,
       avg(CASE WHEN abs(dl) <= 120 THEN 1 ELSE 0 END) AS on_time_ratio_2,
       avg(CASE WHEN abs(dl) <= 180 THEN 1 ELSE 0 END) AS on_time_ratio_3
FROM fact WHERE dl IS NOT NULL GROUP BY route_id""",
        "speed_by_route_vehicle": b + """
SELECT route_id, vehicle_number, avg(spd) AS avg_speed, count(*) AS events, avg(spd) * 3.6 AS avg_speed_kmh
FROM fact GROUP BY route_id, vehicle_number""",
        "occupancy_trend": b + """
SELECT date_trunc('hour', tst) AS period, count(DISTINCT vehicle_number) AS active_vehicles,
       avg(occu) AS avg_occupancy, count(*) AS events
FROM fact GROUP BY 1""",
        "occupancy_daily": b + """
SELECT oday AS period, count(DISTINCT vehicle_number) AS active_vehicles,
       avg(occu) AS avg_occupancy, count(*) AS events
FROM fact GROUP BY 1""",
        "peak_hours": b + """
SELECT CAST(hour(tst) AS INTEGER) AS hour_of_day, count(*) AS events,
       count(DISTINCT vehicle_number) AS vehicles, avg(dl) AS avg_delay_sec
FROM fact GROUP BY 1 ORDER BY 1""",
        "stop_bottlenecks": b + f"""
SELECT s.stop_id, s.stop_name, count(*) AS events, count(DISTINCT f.vehicle_number) AS vehicles,
       avg(f.dl) AS avg_delay_sec
FROM fact f JOIN (SELECT * FROM dim_stops WHERE active_flg = 1) s ON f.stop = s.stop_id
WHERE f.oday = DATE '{DAY}'
GROUP BY s.stop_id, s.stop_name HAVING count(*) >= 2
ORDER BY avg_delay_sec DESC NULLS LAST, s.stop_id LIMIT 10""",
        "fact_select": b + "\nSELECT * FROM fact",
        "fact_join_active_dim": b + """
SELECT f.tst, f.vehicle_number, f.route_id, f.dl, r.route_short_name, r.route_long_name, r.route_type
FROM fact f JOIN active_routes r ON f.route_id = r.route_id""",
        "envelope_flatten": b + "\nSELECT * FROM flat",
        "dedupe_events": b + """
SELECT vehicle_number, tst, oday, dl, insert_time, kafka_partition, kafka_offset, update_time FROM silver""",
        "delay_outliers": b + """
SELECT vehicle_number, tst, dl FROM fact WHERE dl IS NOT NULL AND abs(dl) <= 900""",
        "json_extract": """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events""",
        "all_to_string": """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
       CAST(c_acctbal AS VARCHAR) AS c_acctbal, c_mktsegment FROM customer""",
        "topic_path": b + f""",
{_paths()}
SELECT event_id, {_PARSED} FROM paths""",
        "envelope_key": b + f""",
{_paths()},
parsed AS (SELECT event_id, {_PARSED} FROM paths)
SELECT event_id, coalesce(nullif(vehicle_number, ''), nullif(route_id, ''), 'unknown') AS record_key FROM parsed""",
        "journey_filter": b + f"""
SELECT vehicle_number, tst, route_id, transport_mode FROM silver WHERE ({_REASON}) IS NULL""",
        "journey_rejects": b + f"""
SELECT vehicle_number, tst, {_REASON} AS reject_reason FROM silver WHERE ({_REASON}) IS NOT NULL""",
        "scd2_initial": b + f"\nSELECT {DIM_OUT} FROM dim1",
        "scd2_incremental": b + f"\nSELECT {DIM_OUT} FROM dim2",
        "scd2_incremental_plain": b + f"\nSELECT {DIM_OUT} FROM dim2_plain",
        "scd2_new_keys": b + """
-- new in the second file, or closed by it
SELECT route_id FROM routes_v2
WHERE route_id NOT IN (SELECT route_id FROM dim1) OR route_id IN (SELECT route_id FROM dim2 WHERE active_flg = 0)""",
        "scd2_closed": b + f"""
SELECT {DIM_OUT} FROM dim2 WHERE active_flg = 0""",
        "dim_clean_routes": b + "\nSELECT * FROM routes_v2",
        "dim_clean_stops": b + "\nSELECT * FROM stops_stg",
        "dim_stops": b + "\nSELECT * FROM dim_stops",
        "dim_as_of": b + f""",
versions AS (
  SELECT *, lead(effective_start_dt) OVER (PARTITION BY route_id ORDER BY effective_start_dt) AS valid_to FROM dim2
)
SELECT route_id, route_short_name, route_long_name, route_type, effective_start_dt,
       TIMESTAMP '9999-12-31 00:00:00' AS effective_end_dt, 1 AS active_flg, insert_dt AS update_dt, row_wid
FROM versions
WHERE effective_start_dt <= TIMESTAMP '{AS_OF}' AND (valid_to IS NULL OR TIMESTAMP '{AS_OF}' < valid_to)""",
        "fact_join_as_of": b + """,
versions AS (
  SELECT *, lead(effective_start_dt) OVER (PARTITION BY route_id ORDER BY effective_start_dt) AS valid_to FROM dim2
)
SELECT f.tst, f.vehicle_number, f.route_id, v.route_long_name, v.route_type, v.row_wid
FROM fact f JOIN versions v
  ON f.route_id = v.route_id AND f.tst >= v.effective_start_dt AND (v.valid_to IS NULL OR f.tst < v.valid_to)""",
        "fact_join_as_of_left": b + """,
versions AS (
  SELECT *, lead(effective_start_dt) OVER (PARTITION BY route_id ORDER BY effective_start_dt) AS valid_to FROM dim2
),
f AS (SELECT tst, vehicle_number, CASE WHEN vehicle_number > '00005' THEN route_id END AS route_id FROM fact)
SELECT f.tst, f.vehicle_number, f.route_id, v.route_long_name, v.row_wid
FROM f LEFT JOIN versions v
  ON f.route_id = v.route_id AND f.tst >= v.effective_start_dt AND (v.valid_to IS NULL OR f.tst < v.valid_to)""",
        "replay_offsets": b + """,
span AS (SELECT kafka_partition, min(kafka_offset) AS lo, max(kafka_offset) AS hi FROM flat GROUP BY 1)
SELECT vehicle_number AS "key", kafka_partition AS "partition", kafka_offset AS "offset",
       strptime(tst, '%Y-%m-%dT%H:%M:%S.%fZ') + INTERVAL 1 SECOND AS "timestamp"
FROM flat JOIN span USING (kafka_partition)
WHERE kafka_offset BETWEEN lo + (hi - lo) // 3 AND hi - (hi - lo) // 3""",
        "metric_range_steps": b + METRICS + _steps("metric = 'total_active_vehicles'", *RANGE, 30, 120),
        "metric_range_steps_worst": b + METRICS + _steps(f"metric = '{EXTREME}' AND type = 'worst'", *HISTORY, 30, 120, "60.0"),
        "metric_topk_steps": b + METRICS + f"""
SELECT * FROM ({_steps(f"metric = '{EXTREME}'", *RANGE, 45, 600, "60.0")})
QUALIFY row_number() OVER (PARTITION BY ts ORDER BY value DESC, type NULLS FIRST, route_id NULLS FIRST) = 1""",
        "kpi_horizon": b + KPI + f"""
SELECT count(*) AS events, avg(spd) AS avg_speed, avg(CAST(dl AS DOUBLE)) AS avg_delay_sec, true AS vehicles_near, {_HITS}
FROM kin WHERE tst >= TIMESTAMP '{HORIZON[0]}' AND tst < TIMESTAMP '{HORIZON[1]}'""",
        "peak_hours_stored": b + """
SELECT CAST(hour(tst) AS INTEGER) AS hour_of_day, count(*) AS events, avg(dl) AS avg_delay_sec, true AS vehicles_near
FROM fact GROUP BY 1""",
        "stream_late_rows": b + """,
sent AS (
  SELECT strptime(tst, '%Y-%m-%dT%H:%M:%S.%fZ') AS event_time, abs(dl) <= 1800 AS used FROM flat
),
late AS (
  SELECT event_time FROM sent
  WHERE used AND epoch_us(event_time) < (SELECT min(epoch_us(event_time)) + (max(epoch_us(event_time)) - min(epoch_us(event_time))) // 4 FROM sent)
)
SELECT CAST(event_time AS DATE) AS day, count(*) AS late_reports, count(*) AS lost_reports FROM late GROUP BY 1
UNION ALL
SELECT NULL, count(*), count(*) FROM late""",
        "current_tables": b + f""",
sin AS (
  SELECT strptime(tst, '%Y-%m-%dT%H:%M:%S.%fZ') AS event_time, route_id, spd, CAST(dl AS DOUBLE) AS dl
  FROM flat WHERE dl IS NOT NULL AND abs(dl) <= 1800
),
sexp AS (
  SELECT time_bucket(INTERVAL 30 SECOND, event_time) - INTERVAL 30 SECOND * k + INTERVAL 300 SECOND AS window_end, sin.*
  FROM sin CROSS JOIN range(10) AS r(k)
),
fresh AS (
  SELECT * FROM sexp QUALIFY window_end = max(window_end) FILTER
    (WHERE window_end <= (SELECT max(event_time) FROM sin) - INTERVAL 1 MINUTE) OVER ()
),
route AS (SELECT window_end AS window_start, window_end, route_id, avg(dl) AS avg_delay_sec FROM fresh GROUP BY window_end, route_id)
SELECT window_end, 'all' AS type, count(*) AS events, avg(spd) AS avg_speed, CAST(NULL AS VARCHAR) AS route_id,
       CAST(NULL AS DOUBLE) AS avg_delay_sec FROM fresh GROUP BY window_end
UNION ALL
SELECT window_end, type, NULL, NULL, route_id, avg_delay_sec FROM ({_extremes("route")})""",
        "dq_report": b + """
SELECT 'dim_stops' AS table_name, rule, target, violations, violations = 0 AS passed,
       CASE WHEN rule = 'columns_exist' THEN 'missing: stop_url' ELSE '' END AS detail FROM (
  SELECT 'not_empty' AS rule, '' AS target, CAST(CASE WHEN count(*) = 0 THEN 1 ELSE 0 END AS BIGINT) AS violations FROM dim_stops
  UNION ALL
  -- stop_url is dropped while staging, so one listed column is missing
  SELECT 'columns_exist', 'stop_id,stop_name,stop_lat,stop_lon,stop_url', CAST(1 AS BIGINT)
  UNION ALL
  SELECT 'no_nulls', 'stop_id', count(*) FILTER (WHERE stop_id IS NULL OR stop_id = '') FROM dim_stops
  UNION ALL
  SELECT 'no_nulls', 'stop_lon', count(*) FILTER (WHERE stop_lon IS NULL) FROM dim_stops
  UNION ALL
  SELECT 'no_duplicates', 'stop_id', count(*) FILTER (WHERE c > 1) FROM (SELECT stop_id, count(*) AS c FROM dim_stops GROUP BY stop_id)
  UNION ALL
  SELECT 'values_in_set', 'wheelchair_boarding', count(*) FILTER (WHERE wheelchair_boarding NOT IN (0, 1, 2)) FROM dim_stops
  UNION ALL
  SELECT 'active_unique', 'stop_id', count(*) FILTER (WHERE c > 1)
  FROM (SELECT stop_id, count(*) AS c FROM dim_stops WHERE active_flg = 1 GROUP BY stop_id)
)""",
        "dq_duplicates": """
SELECT 'lineitem' AS table_name, 'no_duplicates' AS rule, 'l_orderkey,l_linenumber' AS target,
       count(*) FILTER (WHERE c > 1) AS violations, '' AS detail, count(*) FILTER (WHERE c > 1) = 0 AS passed
FROM (SELECT l_orderkey, l_linenumber, count(*) AS c FROM lineitem GROUP BY l_orderkey, l_linenumber)""",
        "joblog_last": b + JOB_LOG + """
SELECT schema_name, table_name, max(max_timestamp) AS max_timestamp FROM job_log GROUP BY schema_name, table_name""",
        "joblog_latest": b + JOB_LOG + """
SELECT * FROM job_log QUALIFY row_number() OVER (PARTITION BY schema_name, table_name ORDER BY insert_dt DESC) = 1""",
        "joblog_delete": b + JOB_LOG + """
SELECT * FROM job_log WHERE NOT (schema_name = 'hdw_stg' AND table_name = 'events_stg')""",
        "incremental_scan": b + JOB_LOG + """
SELECT vehicle_number AS "key", kafka_partition AS "partition", kafka_offset AS "offset", insert_time FROM flat
WHERE insert_time > (SELECT max(max_timestamp) FROM job_log WHERE schema_name = 'hdw_stg' AND table_name = 'events_stg')""",
        "dedupe_dim": b + """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY route_id ORDER BY insert_time DESC, agency_id DESC NULLS LAST,
           route_short_name DESC NULLS LAST, route_long_name DESC NULLS LAST, route_type DESC NULLS LAST, rundate DESC) AS rn
  FROM (SELECT * FROM routes_v1 UNION ALL SELECT * FROM routes_v2
        UNION ALL SELECT * REPLACE (TIMESTAMP '""" + LOAD2 + """' AS insert_time, DATE '""" + LOAD2[:10] + """' AS rundate) FROM routes_v1)
) WHERE rn = 1""",
        "fact_incremental": b + f""",
ex AS ({_silver_of(f"insert_time < TIMESTAMP '{FIRST_UNTIL}'")}),
bt AS ({_silver_of(f"insert_time > TIMESTAMP '{SECOND_FROM}'")})
SELECT oday, vehicle_number, tst, dl FROM bt
WHERE NOT EXISTS (SELECT 1 FROM ex WHERE ex.oday = bt.oday AND ex.vehicle_number = bt.vehicle_number AND ex.tst = bt.tst)""",
        "kpi_windows": b + KPI + "\nSELECT * FROM kpi",
        "route_delay_windows": b + KPI + "\nSELECT * FROM rwin",
        "latest_window": b + KPI + "\nSELECT * FROM kpi WHERE window_end = (SELECT max(window_end) FROM kpi)",
        "route_extremes": b + KPI + f"""
SELECT * FROM ({_extremes("(SELECT * FROM rwin WHERE events_cnt >= 2)")})""",
        "route_extremes_latest": b + KPI + f""",
half AS (
  SELECT time_bucket(INTERVAL 12 HOUR, tst) AS window_start, time_bucket(INTERVAL 12 HOUR, tst) + INTERVAL 12 HOUR AS window_end,
         route_id, avg(CAST(dl AS DOUBLE)) AS avg_delay_sec, count(*) AS events_cnt
  FROM kin GROUP BY ALL
),
lw AS (SELECT * FROM half WHERE window_end = (SELECT max(window_end) FROM half) AND events_cnt >= 5)
SELECT * FROM ({_extremes("lw")})""",
        "route_extremes_none": b + KPI + """,
half AS (
  SELECT time_bucket(INTERVAL 12 HOUR, tst) AS w, route_id, count(*) AS c FROM kin GROUP BY ALL
),
low AS (SELECT max(c) + 1 AS c FROM half WHERE w = (SELECT max(w) FROM half))
SELECT (SELECT count(*) FROM half WHERE c >= (SELECT c FROM low)) > 0 AS older_reach_it,
       (SELECT count(*) FROM half WHERE w = (SELECT max(w) FROM half) AND c >= (SELECT c FROM low)) AS named""",
        "kpi_windows_approx": b + KPI + """
SELECT window_start, window_end, events, avg_speed, true AS vehicles_within_5_pct FROM kpi""",
        "metric_bottomk": b + METRICS + f"""
SELECT metric, type, route_id, ts, value / 60.0 AS value FROM metrics WHERE metric = '{EXTREME}' AND type = 'best'
QUALIFY row_number() OVER (PARTITION BY ts ORDER BY value, route_id NULLS FIRST) = 1""",
        "metric_topk_worst": b + METRICS + f"""
SELECT metric, type, route_id, max(ts) AS ts, arg_max(value, ts) / 60.0 AS value FROM metrics
WHERE metric = '{EXTREME}' AND type = 'worst'
  AND ts > (SELECT max(ts) FROM metrics WHERE metric = '{EXTREME}') - INTERVAL 12 HOUR
GROUP BY ALL ORDER BY value DESC, route_id LIMIT 1""",
        "metric_bottomk_best": b + METRICS + f"""
SELECT metric, type, route_id, max(ts) AS ts, arg_max(value, ts) / 60.0 AS value FROM metrics
WHERE metric = '{EXTREME}' AND type = 'best' AND ts > TIMESTAMP '{AS_OF}' - INTERVAL 12 HOUR AND ts <= TIMESTAMP '{AS_OF}'
GROUP BY ALL ORDER BY value, route_id LIMIT 1""",
        "metric_last_over_worst": b + METRICS + f"""
SELECT metric, type, route_id, max(ts) AS ts, arg_max(value, ts) / 60.0 AS value FROM metrics
WHERE metric = '{EXTREME}' AND type = 'worst'
  AND ts > (SELECT max(ts) FROM metrics WHERE metric = '{EXTREME}') - INTERVAL 12 HOUR
GROUP BY ALL""",
        "metrics_long": b + METRICS + "\nSELECT * FROM metrics",
        "metric_latest": b + METRICS + """
SELECT metric, type, route_id, max(ts) AS ts, arg_max(value, ts) AS value FROM metrics GROUP BY metric, type, route_id""",
        "metric_last_over": b + METRICS + f"""
SELECT metric, type, route_id, max(ts) AS ts, arg_max(value, ts) / 60.0 AS value FROM metrics
WHERE metric = '{EXTREME}'
  AND ts > (SELECT max(ts) FROM metrics WHERE metric = '{EXTREME}') - INTERVAL 120 SECOND
GROUP BY metric, type, route_id""",
        "metric_topk": b + METRICS + f"""
SELECT * FROM metrics WHERE metric = '{EXTREME}'
QUALIFY row_number() OVER (PARTITION BY ts ORDER BY value DESC, type NULLS FIRST, route_id NULLS FIRST) = 1""",
        "kpi_stream": b + f""",
sin AS (
  SELECT strptime(tst, '%Y-%m-%dT%H:%M:%S.%fZ') AS event_time, vehicle_number, spd, CAST(dl AS DOUBLE) AS dl
  FROM flat WHERE dl IS NOT NULL AND abs(dl) <= 1800
),
sexp AS (
  SELECT time_bucket(INTERVAL 30 SECOND, event_time) - INTERVAL 30 SECOND * k AS window_start, sin.*
  FROM sin CROSS JOIN range(10) AS r(k)
)
SELECT window_start, window_start + INTERVAL 300 SECOND AS window_end, true AS vehicles_near, count(*) AS events,
       avg(spd) AS avg_speed,
       {_HITS}
FROM sexp GROUP BY window_start
-- append mode: only windows closed by the final watermark (max event time - 1 minute)
HAVING window_start + INTERVAL 300 SECOND <= (SELECT max(event_time) FROM sin) - INTERVAL 1 MINUTE""",
        "route_delay_stream": b + f""",
sin AS (
  SELECT strptime(tst, '%Y-%m-%dT%H:%M:%S.%fZ') AS event_time, route_id, CAST(dl AS DOUBLE) AS dl
  FROM flat WHERE dl IS NOT NULL AND abs(dl) <= 1800
),
sexp AS (
  SELECT time_bucket(INTERVAL 30 SECOND, event_time) - INTERVAL 30 SECOND * k AS window_start, sin.*
  FROM sin CROSS JOIN range(10) AS r(k)
)
SELECT window_start, window_start + INTERVAL 300 SECOND AS window_end, route_id,
       avg(dl) AS avg_delay_sec, count(*) AS events_cnt
FROM sexp GROUP BY window_start, route_id
HAVING window_start + INTERVAL 300 SECOND <= (SELECT max(event_time) FROM sin) - INTERVAL 1 MINUTE""",
        "kpi_stream_dedupe": b + f""",
sin AS (
  SELECT DISTINCT strptime(tst, '%Y-%m-%dT%H:%M:%S.%fZ') AS event_time, vehicle_number, spd
  FROM flat WHERE dl IS NOT NULL AND abs(dl) <= 1800
),
sexp AS (
  SELECT time_bucket(INTERVAL 30 SECOND, event_time) - INTERVAL 30 SECOND * k AS window_start, sin.*
  FROM sin CROSS JOIN range(10) AS r(k)
)
SELECT window_start, window_start + INTERVAL 300 SECOND AS window_end, count(*) AS events, avg(spd) AS avg_speed
FROM sexp GROUP BY window_start
HAVING window_start + INTERVAL 300 SECOND <= (SELECT max(event_time) FROM sin) - INTERVAL 1 MINUTE""",
        "replay_window": b + f"""
SELECT vehicle_number AS "key", kafka_partition AS "partition", kafka_offset AS "offset",
       strptime(tst, '%Y-%m-%dT%H:%M:%S.%fZ') + INTERVAL 1 SECOND AS "timestamp"
FROM flat
WHERE strptime(tst, '%Y-%m-%dT%H:%M:%S.%fZ') + INTERVAL 1 SECOND >= TIMESTAMP '{REPLAY[0]}'
  AND strptime(tst, '%Y-%m-%dT%H:%M:%S.%fZ') + INTERVAL 1 SECOND < TIMESTAMP '{REPLAY[1]}'""",
        "stream_landing": b + """
SELECT vehicle_number AS "key", kafka_partition AS "partition", kafka_offset AS "offset",
       strptime(tst, '%Y-%m-%dT%H:%M:%S.%fZ') + INTERVAL 1 SECOND AS "timestamp"
FROM flat""",
        "events_chain": b + f""",
run1 AS ({_silver_of(f"insert_time < TIMESTAMP '{FIRST_UNTIL}'")}),
run2 AS ({_silver_of(f"insert_time > (SELECT max(insert_time) FROM flat WHERE insert_time < TIMESTAMP '{FIRST_UNTIL}')")})
SELECT oday, vehicle_number, tst, dl, TIMESTAMP '{LOAD2}' AS insert_time FROM run1
UNION ALL
SELECT oday, vehicle_number, tst, dl, TIMESTAMP '{FACT_NOW}' AS insert_time FROM run2
WHERE NOT EXISTS (SELECT 1 FROM run1 WHERE run1.oday = run2.oday AND run1.vehicle_number = run2.vehicle_number
                  AND run1.tst = run2.tst)""",
        "routes_chain": b + f"\nSELECT {DIM_OUT} FROM dim2",
        "stops_chain": b + """
SELECT * REPLACE (CAST(CAST(stop_code AS BIGINT) AS VARCHAR) AS stop_code, wheelchair_boarding % 3 AS wheelchair_boarding)
FROM dim_stops""",
        "events_chain_recovery": b + f"""
SELECT oday, vehicle_number, tst, dl, TIMESTAMP '{FACT_NOW}' AS insert_time FROM silver""",
        "events_chain_malformed": b + """,
marked AS (SELECT *, kafka_offset % 50 AS n FROM flat)
SELECT 'kept' AS outcome, count(DISTINCT (vehicle_number, tst)) AS reports FROM marked WHERE n NOT IN (1, 2, 3)
UNION ALL
SELECT 'no_tst', count(*) FROM marked WHERE n IN (1, 2)
UNION ALL
SELECT 'no_vehicle', count(*) FROM marked WHERE n = 3""",
        "metrics_stream": b + f""",
sin AS (
  SELECT strptime(tst, '%Y-%m-%dT%H:%M:%S.%fZ') AS event_time, route_id, spd, CAST(dl AS DOUBLE) AS dl
  FROM flat WHERE dl IS NOT NULL AND abs(dl) <= 1800
),
sexp AS (
  SELECT time_bucket(INTERVAL 30 SECOND, event_time) - INTERVAL 30 SECOND * k AS window_start, sin.*
  FROM sin CROSS JOIN range(10) AS r(k)
  WHERE time_bucket(INTERVAL 30 SECOND, event_time) - INTERVAL 30 SECOND * k + INTERVAL 300 SECOND
        <= (SELECT max(event_time) FROM sin) - INTERVAL 1 MINUTE
),
skpi AS (SELECT window_start + INTERVAL 300 SECOND AS ts, avg(spd) AS avg_speed, {_HITS} FROM sexp GROUP BY window_start),
sroute AS (
  SELECT window_start, window_start + INTERVAL 300 SECOND AS window_end, route_id, avg(dl) AS avg_delay_sec
  FROM sexp GROUP BY window_start, route_id HAVING count(*) >= 2
)
{" UNION ALL ".join(f"SELECT '{g}' AS metric, CAST(NULL AS VARCHAR) AS type, CAST(NULL AS VARCHAR) AS route_id, ts, {e} AS value FROM skpi"
                    for g, e in _GAUGES.items() if g != "total_active_vehicles")}
UNION ALL
SELECT '{EXTREME}', type, route_id, window_end, avg_delay_sec FROM ({_extremes("sroute")})""",
        "metric_range": b + METRICS + f"""
SELECT * FROM metrics WHERE metric = 'avg_speed_all' AND ts >= TIMESTAMP '{RANGE[0]}' AND ts <= TIMESTAMP '{RANGE[1]}'
ORDER BY ts""",
    }


ORACLE_SQL: dict[str, str] = _sql()
# the SQL surface answers the same questions as the DataFrame reports
for _k in ("route_delay_top", "route_density", "partition_distribution"):
    ORACLE_SQL[f"sql_{_k}"] = ORACLE_SQL[_k]
# both batch forms of the sliding KPIs answer the same question
ORACLE_SQL["kpi_windows_native"] = ORACLE_SQL["kpi_windows"]
# other plans for the same rows: carried versions, buckets, stored bitmaps and intervals, the zone map
for _k, _same in {"fact_join_as_of_carried": "fact_join_as_of", "scd2_buckets": "scd2_incremental",
                  "route_density_bitmaps": "route_density", "route_bus_count_bitmaps": "route_bus_count",
                  "route_stop_coverage_bitmaps": "route_stop_coverage", "offset_gaps_incremental": "offset_gaps",
                  "replay_indexed": "replay_window", "kpi_windows_stored": "kpi_windows_approx",
                  "dq_write_report": "dq_report", "landing_compacted": "stream_landing"}.items():
    ORACLE_SQL[_k] = ORACLE_SQL[_same]
# rows behind the watermark change no window
ORACLE_SQL["kpi_stream_late"] = ORACLE_SQL["kpi_stream"]
