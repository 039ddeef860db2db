"""Silver to the staged event view all marts read."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.functions.clock import local_time
from tramline.operators.latest import first_per_key
from tramline.settings import DEFAULTS, Settings

STAGED_COLUMNS = [
    "vehicle_id",
    "route_id",
    "agency_id",
    "route_short_name",
    "trip_id",
    "latitude",
    "longitude",
    "bearing",
    "event_time",
    "delay_seconds",
    "is_bunching",
]

# Of repeated readings the first in the order of these stays.
PREFERRED = ["delay_seconds", "is_bunching", "route_id", "trip_id", "latitude", "longitude", "bearing"]


def stage_events(silver: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """One row per vehicle and instant, with local event time.

    Of repeated readings the lowest delay wins, then the row that is not bunching; nulls come
    last. Remaining ties are settled by the other columns, so reruns agree.
    """
    once = first_per_key(
        silver,
        ["vehicle_id", "timestamp"],
        [F.col(name).asc_nulls_last() for name in PREFERRED],
    )
    return once.withColumn("event_time", local_time(F.col("timestamp"), settings.zone)).select(
        STAGED_COLUMNS
    )
