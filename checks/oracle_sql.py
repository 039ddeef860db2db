"""The registered queries as plain SQL for DuckDB, written apart from the Spark code.

All of them stand on the common table expressions in `FEED`, which read the `events` table
the way `tramline.sources.sample` does. Coordinates are doubles, or of single precision where
they came through decoded messages.
"""

from __future__ import annotations

FEED = """
WITH raw AS (
  SELECT event_id AS arrival_seq, user_id, event_type, value,
         CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k,
         1712275200 + CAST(floor((epoch(ts) - 1704067200) / 10) AS BIGINT) AS timestamp
  FROM events
),
feed AS (
  SELECT arrival_seq,
         'bus-' || user_id AS vehicle_id,
         (2500 + user_id % 10) || '_M' || (user_id % 15) AS route_id,
         CAST(2500 + user_id % 10 AS VARCHAR) AS agency_id,
         'M' || (user_id % 15) AS route_short_name,
         'T' || user_id || '-' || (timestamp // 14400) AS trip_id,
         CAST(CAST(CASE WHEN k % 25 = 0 THEN 0e0 ELSE -33.87e0 + (k % 10) * 0.001e0 END
                   AS {precision}) AS DOUBLE) AS latitude,
         CAST(CAST(CASE WHEN k % 25 = 0 THEN 0e0 ELSE 151.2e0 + (user_id % 5) * 0.001e0 END
                   AS {precision}) AS DOUBLE) AS longitude,
         CAST(k * 37 % 360 AS DOUBLE) AS bearing,
         timestamp,
         event_type = 'error' AS is_update,
         CAST(floor(value * 10) AS BIGINT) - 200 AS delay_seconds
  FROM raw
),
pos AS (SELECT * EXCLUDE (is_update, delay_seconds) FROM feed WHERE NOT is_update),
upd AS (SELECT arrival_seq, trip_id, delay_seconds FROM feed WHERE is_update),
delayed AS (
  SELECT pos.*, coalesce(upd.delay_seconds, 0) AS delay_seconds
  FROM pos ASOF LEFT JOIN upd
    ON pos.trip_id = upd.trip_id AND pos.arrival_seq >= upd.arrival_seq
),
spans AS (
  SELECT *, lead(arrival_seq) OVER (PARTITION BY route_id, vehicle_id ORDER BY arrival_seq) AS until
  FROM pos
),
bunched AS (
  SELECT DISTINCT e.arrival_seq
  FROM pos e JOIN spans o
    ON e.route_id = o.route_id AND e.vehicle_id <> o.vehicle_id
   AND o.arrival_seq < e.arrival_seq AND (o.until IS NULL OR o.until > e.arrival_seq)
   AND abs(e.timestamp - o.timestamp) <= 120
  WHERE least(abs(e.bearing - o.bearing) % 360, 360 - abs(e.bearing - o.bearing) % 360) <= 45
    AND 2 * 6371000 * asin(least(1, sqrt(
          pow(sin(radians(o.latitude - e.latitude) / 2), 2)
          + cos(radians(e.latitude)) * cos(radians(o.latitude))
            * pow(sin(radians(o.longitude - e.longitude) / 2), 2)))) <= 500
),
enriched AS (
  SELECT delayed.*, bunched.arrival_seq IS NOT NULL AS is_bunching
  FROM delayed LEFT JOIN bunched USING (arrival_seq)
),
silver AS (
  SELECT * FROM enriched
  UNION ALL
  SELECT * REPLACE (delay_seconds + 30 AS delay_seconds) FROM enriched WHERE arrival_seq % 7 = 0
),
foldered AS (
  SELECT *, CAST(make_timestamp(timestamp * 1000000) AS DATE) AS ingest_date FROM silver
),
staged AS (
  SELECT vehicle_id, route_id, agency_id, route_short_name, trip_id, latitude, longitude, bearing,
         make_timestamp(timestamp * 1000000)
           + CASE WHEN timestamp < 1712419200 THEN INTERVAL 11 HOUR ELSE INTERVAL 10 HOUR END
           AS event_time,
         delay_seconds, is_bunching
  FROM (
    SELECT *, row_number() OVER (
             PARTITION BY vehicle_id, timestamp
             ORDER BY delay_seconds NULLS LAST, is_bunching NULLS LAST, route_id, trip_id,
                      latitude, longitude, bearing) AS place
    FROM silver)
  WHERE place = 1
),
agencies(agency_id, agency_name) AS (VALUES
  ('2501', 'Alpha Lines'), ('2502', 'Bravo Transit'), ('2503', 'Alpha Lines'),
  ('2504', 'Delta, Coaches'), ('2507', 'Echo Buses'),
  ('2508', 'Foxtrot Mobility Northern Region'), ('2509', 'Golf Buses')
),
live AS (
  SELECT vehicle_id, route_id, agency_id, route_short_name, trip_id, latitude, longitude,
         timestamp, delay_seconds, is_bunching
  FROM enriched
  WHERE arrival_seq IN (SELECT max(arrival_seq) FROM enriched GROUP BY vehicle_id)
),
board AS (
  SELECT live.*, coalesce(agency_name, 'Unknown operator (' || agency_id || ')') AS operator_name
  FROM live LEFT JOIN agencies USING (agency_id)
  WHERE NOT (latitude = 0 AND longitude = 0)
),
routes AS (
  SELECT route_short_name, count(DISTINCT vehicle_id) AS active_vehicle_count,
         avg(delay_seconds) AS average_delay_seconds,
         count(*) FILTER (is_bunching) AS bunching_events, count(*) AS readings
  FROM staged GROUP BY ALL
),
operators AS (
  SELECT coalesce(agency_name, 'Unknown operator (' || agency_id || ')') AS operator_name,
         agency_id, count(DISTINCT vehicle_id) AS active_vehicle_count,
         count(DISTINCT route_id) AS route_count, count(*) AS reading_count,
         avg(delay_seconds) AS average_delay_seconds,
         count(*) FILTER (is_bunching) AS bunching_events
  FROM staged LEFT JOIN agencies USING (agency_id)
  GROUP BY ALL HAVING active_vehicle_count >= 3
),
trips AS (
  SELECT route_short_name, trip_id, min(event_time) AS first_seen_at FROM staged GROUP BY ALL
),
gaps AS (
  SELECT *, epoch(first_seen_at) - epoch(lag(first_seen_at) OVER (
              PARTITION BY route_short_name ORDER BY first_seen_at, trip_id))
            AS gap_to_previous_trip
  FROM trips
)
"""

TREND = """,
means AS (
  SELECT timestamp // 60 * 60 AS minute, avg(delay_seconds) AS delay_seconds FROM chosen GROUP BY ALL
),
minutes AS (
  SELECT unnest(generate_series(min(minute), max(minute), 60)) AS minute FROM means
)
SELECT make_timestamp(minute * 1000000)
         + CASE WHEN minute < 1712419200 THEN INTERVAL 11 HOUR ELSE INTERVAL 10 HOUR END AS timestamp,
       minute, delay_seconds
FROM minutes LEFT JOIN means USING (minute)
"""

LABEL = "CASE WHEN length({0}) <= 18 THEN {0} ELSE left({0}, 17) || '…' END AS axis_label"

FIGURES = """
  SELECT count(*) FILTER ({0}) AS selection_vehicles,
         avg(delay_seconds) FILTER ({0}) AS selection_avg_delay,
         avg(delay_seconds) AS network_avg_delay,
         count(*) FILTER ({0} AND is_bunching) AS selection_bunching,
         count(*) FILTER (is_bunching) AS network_bunching,
         avg(CAST(is_bunching AS INTEGER)) FILTER ({0}) * 100 AS selection_bunching_rate,
         avg(CAST(is_bunching AS INTEGER)) * 100 AS network_bunching_rate
  FROM board
"""

HISTORY = "timestamp, route_id, agency_id, delay_seconds, is_bunching"

KAFKA = """
  SELECT arrival_seq AS sent, vehicle_id, trip_id, is_update, delay_seconds,
         row_number() OVER (ORDER BY timestamp,
           CASE WHEN is_update THEN 'trip-updates-raw' ELSE 'vehicle-positions-raw' END,
           arrival_seq % 1500, arrival_seq // 1500) - 1 AS arrival_seq
  FROM feed"""

SPOILED = """
  SELECT * REPLACE (
    CASE WHEN agency_id <> '2503' THEN route_id END AS route_id,
    delay_seconds + CASE agency_id WHEN '2504' THEN 10000 WHEN '2507' THEN -9000 ELSE 0 END AS delay_seconds,
    CASE WHEN agency_id = '2508' THEN CAST(date_trunc('hour', event_time) AS TIMESTAMP) ELSE event_time END
      AS event_time)
  FROM staged"""

_ON_FEED = {
    # sources and decoding
    "feed_fanout": """
      SELECT arrival_seq // 500 AS snapshot_id, 'vehicle-positions-raw' AS topic,
             CAST(arrival_seq AS VARCHAR) AS entity_id,
             to_base64(encode(vehicle_id || '|' || trip_id || '|' || timestamp)) AS value
      FROM pos""",
    "decode_trip_updates": """
      SELECT arrival_seq, trip_id, delay_seconds FROM upd WHERE arrival_seq % 4 IN (0, 1)""",
    "route_split": """
      SELECT route_id, split_part(route_id, '_', 1) AS agency_id,
             substr(route_id, strpos(route_id, '_') + 1) AS route_short_name, count(*) AS readings
      FROM pos GROUP BY ALL""",
    "partition_keys": """
      SELECT arrival_seq, strftime(ingest_date, '%Y') AS year, strftime(ingest_date, '%m') AS month,
             strftime(ingest_date, '%d') AS day
      FROM foldered""",
    # geometry
    "haversine_pairs": """
      SELECT arrival_seq, round(2 * 6371000 * asin(sqrt(
               pow(sin(radians(latitude + 33.87e0) / 2), 2)
               + cos(radians(latitude)) * cos(radians(-33.87e0))
                 * pow(sin(radians(longitude - 151.21e0) / 2), 2))), 3) AS from_centre_m
      FROM pos""",
    "bearing_diff": """
      SELECT arrival_seq, CASE WHEN bearing >= 170 THEN abs(bearing - 350) ELSE bearing + 10 END
               AS gap_deg
      FROM pos""",
    # enrichment
    "attach_delay": "SELECT arrival_seq, vehicle_id, trip_id, delay_seconds FROM delayed",
    "bunching": """
      SELECT arrival_seq, vehicle_id, route_id, bunched.arrival_seq IS NOT NULL AS is_bunching
      FROM pos LEFT JOIN bunched USING (arrival_seq)""",
    "silver_events": "SELECT * FROM silver",
    "stream_stateful": "SELECT * FROM enriched",
    "staged_events": "SELECT * FROM staged",
    # live table
    "live_state": "SELECT * FROM live",
    "live_state_decimal": """
      SELECT * REPLACE (
        CAST(CAST(CAST(latitude AS VARCHAR) AS DECIMAL(38, 18)) AS VARCHAR) AS latitude,
        CAST(CAST(CAST(longitude AS VARCHAR) AS DECIMAL(38, 18)) AS VARCHAR) AS longitude)
      FROM live""",
    "live_vehicles": """
      SELECT * REPLACE (CAST(timestamp AS DOUBLE) AS timestamp,
                        CAST(delay_seconds AS DOUBLE) AS delay_seconds)
      FROM live""",
    "live_vehicles_projected": """
      SELECT * EXCLUDE (trip_id) REPLACE (CAST(timestamp AS DOUBLE) AS timestamp,
                                          CAST(delay_seconds AS DOUBLE) AS delay_seconds)
      FROM live""",
    "live_normalized": """
      SELECT vehicle_id, route_id,
             CASE WHEN timestamp % 2 = 0 THEN route_short_name ELSE route_id END
               AS route_short_name
      FROM live""",
    "valid_coordinates": """
      SELECT vehicle_id, latitude, longitude FROM live WHERE latitude <> 0 OR longitude <> 0""",
    # labels
    "operator_names": "SELECT vehicle_id, agency_id, operator_name FROM board",
    "delay_status": """
      SELECT vehicle_id,
             CASE WHEN is_bunching THEN 'bunching' WHEN delay_seconds > 300 THEN 'late'
                  ELSE 'on time' END AS status,
             CASE WHEN is_bunching OR delay_seconds > 300 THEN 255 ELSE 0 END AS red,
             CASE WHEN is_bunching THEN 0 WHEN delay_seconds > 300 THEN 165 ELSE 200 END AS green,
             0 AS blue, 200 AS alpha,
             CASE WHEN is_bunching THEN 'Yes' ELSE 'No' END AS is_bunching_label
      FROM board""",
    "axis_labels": f"SELECT DISTINCT operator_name, {LABEL.format('operator_name')} FROM board",
    # dashboard
    "vehicle_board": """
      SELECT vehicle_id, operator_name, route_short_name, delay_seconds, is_bunching
      FROM board ORDER BY delay_seconds DESC, vehicle_id""",
    "network_kpis": """
      SELECT count(*) AS active_vehicles, round_even(avg(delay_seconds), 1) AS avg_delay_seconds,
             count(*) FILTER (is_bunching) AS bunching_now
      FROM board""",
    "selection_vs_network": f"""
      SELECT *, selection_avg_delay - network_avg_delay AS avg_delay_delta,
             selection_bunching_rate - network_bunching_rate AS bunching_rate_delta
      FROM ({FIGURES.format("route_id = '2501_M1'")})""",
    "comparison_rows": f"""
      SELECT unnest(['Selection', 'Network average']) AS "group",
             unnest([selection_avg_delay, network_avg_delay]) AS avg_delay_seconds,
             unnest([selection_bunching, network_bunching]) AS bunching_events
      FROM ({FIGURES.format("operator_name = 'Alpha Lines'")})""",
    "route_options": """
      SELECT route_short_name, operator_name, min(route_id) AS route_id,
             route_short_name || ' (' || operator_name || ')' AS display_label
      FROM board GROUP BY route_short_name, operator_name""",
    "operator_options": "SELECT DISTINCT operator_name FROM board",
    "view_bounds": """
      SELECT (min(latitude) + max(latitude)) / 2 AS latitude,
             (min(longitude) + max(longitude)) / 2 AS longitude,
             round(greatest(2, least(
               log2(180 / (greatest(max(latitude) - min(latitude), 0.005e0) * 1.3e0)),
               log2(360 / (greatest(max(longitude) - min(longitude), 0.005e0) * 1.3e0)), 16)), 6)
               AS zoom
      FROM board""",
    # history
    "recent_history": f"""
      SELECT {HISTORY} FROM foldered
      WHERE ingest_date > (SELECT max(ingest_date) FROM foldered) - 2""",
    "recent_history_fallback": f"SELECT {HISTORY} FROM silver",
    "schema_union": """
      SELECT arrival_seq, vehicle_id, route_id, trip_id, timestamp, delay_seconds, is_bunching,
             CASE WHEN arrival_seq % 3 <> 0 THEN agency_id END AS agency_id,
             CASE WHEN arrival_seq % 3 <> 0 THEN route_short_name END AS route_short_name,
             CASE WHEN arrival_seq % 3 <> 0 THEN bearing END AS bearing
      FROM silver""",
    "retention_90d": "SELECT arrival_seq, vehicle_id, delay_seconds FROM foldered WHERE arrival_seq % 3 <> 0",
    "compacted_day": """
      SELECT arrival_seq, vehicle_id, delay_seconds, 'compacted' AS batch FROM foldered
      WHERE ingest_date = (SELECT max(ingest_date) FROM foldered)""",
    "operator_performance_csv": "SELECT * FROM operators",
    "kafka_arrivals": f"SELECT sent, arrival_seq FROM ({KAFKA})",
    "kafka_attach_delay": f"""
      SELECT p.arrival_seq, p.sent, p.vehicle_id, p.trip_id, coalesce(u.delay_seconds, 0) AS delay_seconds
      FROM (SELECT * FROM ({KAFKA}) WHERE NOT is_update) p
      ASOF LEFT JOIN (SELECT * FROM ({KAFKA}) WHERE is_update) u
        ON p.trip_id = u.trip_id AND p.arrival_seq >= u.arrival_seq""",
    "dq_null_violations": f"""
      SELECT 'vehicle_id' AS checked, count(*) FILTER (vehicle_id IS NULL) AS violations FROM ({SPOILED})
      UNION ALL
      SELECT 'route_id', count(*) FILTER (route_id IS NULL) FROM ({SPOILED})""",
    "dq_range_violations": f"""
      SELECT vehicle_id, event_time, delay_seconds FROM ({SPOILED})
      WHERE delay_seconds < -3600 OR delay_seconds > 7200""",
    "dq_unique_violations": f"""
      SELECT vehicle_id, event_time, count(*) AS occurrences FROM ({SPOILED})
      GROUP BY ALL HAVING occurrences > 1""",
    "operator_history": f"""
      SELECT {HISTORY} FROM silver
      WHERE agency_id IN (SELECT agency_id FROM board WHERE operator_name = 'Alpha Lines')""",
    # gold
    "busiest_routes": "SELECT * EXCLUDE (readings) FROM routes",
    "delay_by_hour": """
      SELECT date_trunc('hour', event_time) AS hour, avg(delay_seconds) AS avg_delay_seconds,
             count(*) AS event_count
      FROM staged GROUP BY ALL""",
    "operator_performance": "SELECT * FROM operators",
    # The batch of vehicles 1, 4, 7 ... is spoiled and held back.
    "gate_published": "SELECT * FROM staged WHERE CAST(substr(vehicle_id, 5) AS INTEGER) % 3 <> 1",
    "headway_gaps": "SELECT * FROM gaps",
    # The sample deviation from whole sums; a running one ends in other digits on every run.
    "headway_adherence": """
      SELECT route_short_name, count(*) AS trip_count, avg(gap_to_previous_trip) AS average_gap_seconds,
             sqrt(CAST(count(*) * sum(g * g) - sum(g) * sum(g) AS DOUBLE)
                  / (CAST(count(*) AS DOUBLE) * (count(*) - 1))) AS headway_stddev_seconds
      FROM (SELECT *, CAST(gap_to_previous_trip AS HUGEINT) AS g FROM gaps)
      WHERE gap_to_previous_trip < 1800
      GROUP BY ALL HAVING trip_count > 5""",
    "top_routes_by_delay": """
      SELECT * EXCLUDE (readings) FROM (
        (SELECT * FROM routes WHERE active_vehicle_count >= 3 AND readings >= 20
         ORDER BY average_delay_seconds DESC, route_short_name LIMIT 5)
        UNION ALL
        (SELECT * FROM routes WHERE active_vehicle_count >= 3 AND readings >= 20
         ORDER BY average_delay_seconds, route_short_name LIMIT 5))""",
    "top15_routes": f"""
      SELECT * EXCLUDE (readings), {LABEL.format('route_short_name')} FROM routes
      ORDER BY active_vehicle_count DESC, route_short_name LIMIT 15""",
    "top15_operators": f"""
      SELECT *, {LABEL.format('operator_name')} FROM operators
      ORDER BY active_vehicle_count DESC, agency_id LIMIT 15""",
    # data tests
    "dq_not_null": """
      SELECT * EXCLUDE (readings) FROM (
        SELECT 'vehicle_id' AS checked, count(*) FILTER (vehicle_id IS NULL) AS violations,
               count(*) AS readings FROM staged
        UNION ALL
        SELECT 'route_id', count(*) FILTER (route_id IS NULL), count(*) FROM staged)""",
    "dq_delay_range": """
      SELECT vehicle_id, event_time, delay_seconds FROM staged
      WHERE delay_seconds < -3600 OR delay_seconds > 7200""",
    "dq_unique_event": """
      SELECT vehicle_id, event_time, count(*) AS occurrences
      FROM staged GROUP BY ALL HAVING occurrences > 1""",
    "dq_stale_delay": """
      SELECT vehicle_id, route_short_name, delay_seconds, count(*) AS repeated_reading_count
      FROM staged GROUP BY ALL HAVING repeated_reading_count > 5""",
}

_TRENDS = {
    "delay_trend_1min": "SELECT * FROM silver",
    "route_trend_1min": "SELECT * FROM silver WHERE route_id = '2501_M1'",
}


_ON_MESSAGES = {
    "decode_positions": """
      SELECT arrival_seq, vehicle_id, r AS route_id,
             CASE WHEN contains(r, '_') THEN split_part(r, '_', 1) ELSE r END AS agency_id,
             CASE WHEN contains(r, '_') THEN substr(r, strpos(r, '_') + 1) ELSE r END
               AS route_short_name,
             trip_id, latitude, longitude,
             CASE WHEN arrival_seq % 17 = 0 THEN 0 ELSE bearing END AS bearing, timestamp
      FROM (SELECT *, CASE WHEN arrival_seq % 19 = 0 THEN '' ELSE route_id END AS r FROM pos)
      WHERE arrival_seq % 13 <> 0""",
    "stream_bronze_positions": "SELECT * FROM pos",
    "stream_bronze_updates": "SELECT * FROM upd",
    "stream_buffered_updates": "SELECT * FROM upd",
    "topic_published": """
      SELECT 'vehicle-positions-raw' AS topic, count(*) OVER () AS sent, true AS gapless,
             to_base64(encode(vehicle_id || '|' || trip_id || '|' || timestamp)) AS value
      FROM pos""",
    "stream_silver": "SELECT * FROM enriched",
    "stream_live_state": _ON_FEED["live_vehicles"],
    "stream_live_keyvalue": _ON_FEED["live_vehicles_projected"],
}


# Written once more by other means: the SQL is the same.
_SAME = {
    "daily_busiest_routes": "busiest_routes",
    "daily_operator_performance": "operator_performance",
    "daily_headway_adherence": "headway_adherence",
    "sql_route_split": "route_split",
    "sql_haversine_pairs": "haversine_pairs",
    "sql_bearing_diff": "bearing_diff",
    "sql_busiest_routes": "busiest_routes",
    "stream_staged": "staged_events",
}

# What is published after the first third of the arrivals, numbered as it arrives.
_AFTER_BACKLOG = """every AS (
  SELECT * FROM ({feed})
),
feed AS (
  SELECT * REPLACE (row_number() OVER (ORDER BY arrival_seq) - 1 AS arrival_seq)
  FROM every
  WHERE arrival_seq >= (SELECT min(arrival_seq) + (max(arrival_seq) - min(arrival_seq) + 1) // 3 FROM every)
)"""


def _after_backlog(sql: str) -> str:
    start, end = sql.index("feed AS ("), sql.index("),\npos AS")
    whole = sql[start + len("feed AS (") : end]
    return sql[:start] + _AFTER_BACKLOG.replace("{feed}", whole) + sql[end + 1 :]


def statements() -> dict[str, str]:
    doubles, singles = (FEED.replace("{precision}", p) for p in ("DOUBLE", "FLOAT"))
    sql = {name: doubles + select for name, select in _ON_FEED.items()}
    sql |= {name: singles + select for name, select in _ON_MESSAGES.items()}
    sql |= {name: sql[other] for name, other in _SAME.items()}
    sql["stream_from_latest"] = _after_backlog(singles) + "SELECT * FROM enriched"
    for name, chosen in _TRENDS.items():
        sql[name] = doubles + f", chosen AS ({chosen})" + TREND
    return sql
