"""Positions and updates as one stream, the form both enrichment paths read."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline import schemas

ARRIVAL_COLUMNS = [*schemas.POSITION.names, "delay_seconds", "is_position"]


def merged(positions: DataFrame, updates: DataFrame) -> DataFrame:
    """Both inputs in one frame; only updates have `delay_seconds`."""
    return (
        positions.withColumn("is_position", F.lit(True))
        .unionByName(updates.withColumn("is_position", F.lit(False)), allowMissingColumns=True)
        .select(ARRIVAL_COLUMNS)
    )


def positions_of(arrivals: DataFrame, *extra: str) -> DataFrame:
    return arrivals.filter("is_position").select(*schemas.POSITION.names, *extra)


def updates_of(arrivals: DataFrame, *extra: str) -> DataFrame:
    return arrivals.filter(~F.col("is_position")).select(*schemas.TRIP_UPDATE.names, *extra)
