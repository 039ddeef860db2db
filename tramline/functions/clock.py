"""Epoch seconds to wall-clock columns. No result depends on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tramline.settings import DEFAULTS

SECONDS_PER_DAY = 86_400


def utc_time(epoch: Column) -> Column:
    return F.timestamp_add("SECOND", epoch, F.expr("timestamp_ntz'1970-01-01 00:00:00'"))


def local_time(epoch: Column, zone: str = DEFAULTS.zone) -> Column:
    """Zone-less wall clock in `zone`, following its daylight-saving rules."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc_time(epoch))


def hour_of(wall_clock: Column) -> Column:
    """Truncate a zone-less timestamp to the hour. `date_trunc` would hand back a zoned one."""
    return F.make_timestamp_ntz(
        F.year(wall_clock),
        F.month(wall_clock),
        F.day(wall_clock),
        F.hour(wall_clock),
        F.lit(0),
        F.lit(0),
    )


def wall_seconds(wall_clock: Column) -> Column:
    """Seconds on the wall clock since 1970, as a long: the arithmetic form of a local time."""
    return F.timestamp_diff("SECOND", F.expr("timestamp_ntz'1970-01-01 00:00:00'"), wall_clock)


def partition_keys(epoch: Column) -> list[Column]:
    """UTC folder keys: `year`, zero-padded `month`, zero-padded `day`."""
    day = utc_time(epoch)
    return [
        F.year(day).cast("string").alias("year"),
        F.lpad(F.month(day).cast("string"), 2, "0").alias("month"),
        F.lpad(F.day(day).cast("string"), 2, "0").alias("day"),
    ]
