"""Data tests. Each returns the violating rows; an empty result is a pass."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.settings import DEFAULTS, Settings


@dataclass(frozen=True)
class DataTest:
    name: str
    severity: str
    violations: DataFrame


def not_null(staged: DataFrame, column: str) -> DataFrame:
    return staged.filter(F.col(column).isNull())


def null_counts(staged: DataFrame, columns: list[str]) -> DataFrame:
    """How often each column is missing, for all of them in one scan."""
    counts = staged.agg(*[F.count_if(F.col(name).isNull()).alias(name) for name in columns])
    pairs = [part for name in columns for part in (F.lit(name), F.col(name))]
    return counts.select(F.stack(F.lit(len(columns)), *pairs).alias("checked", "violations"))


def delay_out_of_range(staged: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Both bounds are allowed values, and a missing delay is not a violation."""
    allowed = F.col("delay_seconds").between(settings.delay_floor_s, settings.delay_ceiling_s)
    return staged.filter(~allowed)


def repeated_events(staged: DataFrame) -> DataFrame:
    """Vehicle and local time seen more than once, as in the hour the clock is set back."""
    return (
        staged.groupBy("vehicle_id", "event_time")
        .agg(F.count(F.lit(1)).alias("occurrences"))
        .filter(F.col("occurrences") > 1)
    )


def stale_delays(staged: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """The same delay reported again and again: its updates have probably stopped."""
    return (
        staged.groupBy("vehicle_id", "route_short_name", "delay_seconds")
        .agg(F.count(F.lit(1)).alias("repeated_reading_count"))
        .filter(F.col("repeated_reading_count") > settings.stale_repeats)
        .orderBy(
            F.desc("repeated_reading_count"), "vehicle_id", "route_short_name", "delay_seconds"
        )
    )


def data_tests(staged: DataFrame, settings: Settings = DEFAULTS) -> list[DataTest]:
    return [
        DataTest("vehicle_id is present", "error", not_null(staged, "vehicle_id")),
        DataTest("route_id is present", "error", not_null(staged, "route_id")),
        DataTest("delay_seconds is plausible", "warn", delay_out_of_range(staged, settings)),
        DataTest("one event per vehicle and time", "warn", repeated_events(staged)),
        DataTest("delays keep changing", "warn", stale_delays(staged, settings)),
    ]
