"""The functions of this package for users of SQL, in the session's catalog.

They are SQL functions: Spark puts their bodies into the plan, where they are optimised like any expression. Table
functions take their parameters and read the view or table that `register` was given.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from tramline.settings import DEFAULTS, Settings


def statements(staged: str, settings: Settings = DEFAULTS) -> list[str]:
    """CREATE statements; `staged` names the view of staged events that the table functions read."""
    return [
        # All before the first underscore, or the whole id.
        """route_agency(route STRING) RETURNS STRING
           RETURN split(route, '_', 2)[0]""",
        """route_short(route STRING) RETURNS STRING
           RETURN coalesce(get(split(route, '_', 2), 1), route)""",
        """half_chord(lat1 DOUBLE, lon1 DOUBLE, lat2 DOUBLE, lon2 DOUBLE) RETURNS DOUBLE
           RETURN pow(sin(radians(lat2 - lat1) / 2), 2)
             + cos(radians(lat1)) * cos(radians(lat2)) * pow(sin(radians(lon2 - lon1) / 2), 2)""",
        f"""distance_m(lat1 DOUBLE, lon1 DOUBLE, lat2 DOUBLE, lon2 DOUBLE) RETURNS DOUBLE
           RETURN 2 * {settings.earth_radius_m}D * atan2(
             sqrt(half_chord(lat1, lon1, lat2, lon2)), sqrt(1 - half_chord(lat1, lon1, lat2, lon2)))""",
        """bearing_gap(a DOUBLE, b DOUBLE) RETURNS DOUBLE
           RETURN least(abs(a - b) % 360, 360 - abs(a - b) % 360)""",
        f"""local_time(epoch BIGINT) RETURNS TIMESTAMP_NTZ
           RETURN convert_timezone('UTC', '{settings.zone}', timestamp_ntz'1970-01-01 00:00:00' + make_dt_interval(0, 0, 0, epoch))""",
        f"""delay_label(bunching BOOLEAN, delay BIGINT) RETURNS STRING
           RETURN CASE WHEN bunching THEN 'bunching' WHEN delay > {settings.late_after_s} THEN 'late' ELSE 'on time' END""",
        f"""busiest(least_vehicles BIGINT)
           RETURNS TABLE (route_short_name STRING, active_vehicle_count BIGINT, average_delay_seconds DOUBLE, bunching_events BIGINT)
           RETURN SELECT route_short_name, count(DISTINCT vehicle_id), avg(delay_seconds), count_if(is_bunching)
             FROM {staged} GROUP BY route_short_name HAVING count(DISTINCT vehicle_id) >= least_vehicles""",
        f"""stale_delays(repeats BIGINT)
           RETURNS TABLE (vehicle_id STRING, route_short_name STRING, delay_seconds BIGINT, repeated_reading_count BIGINT)
           RETURN SELECT vehicle_id, route_short_name, delay_seconds, count(*)
             FROM {staged} GROUP BY vehicle_id, route_short_name, delay_seconds HAVING count(*) > repeats""",
    ]


def register(spark: SparkSession, staged: str, settings: Settings = DEFAULTS) -> None:
    """Makes the functions known to this session's SQL, in place of earlier ones."""
    for statement in statements(staged, settings):
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {statement}")
