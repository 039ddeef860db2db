"""Silver history for the dashboard: which rows, and the delay trend over them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.functions.clock import SECONDS_PER_DAY, local_time
from tramline.settings import DEFAULTS, Settings

BIN_SECONDS = 60


def operator_history(history: DataFrame, board: DataFrame, operator_name: str) -> DataFrame:
    """History of the agencies that run under `operator_name` on the live board."""
    ids = board.filter(F.col("operator_name") == operator_name).select("agency_id").distinct()
    return history.join(ids, "agency_id", "left_semi")


def delay_trend(history: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Mean delay per minute of local time, with every minute between first and last present.

    Readings count as often as they were polled. The empty minutes come from a grid built day
    by day on the executors, so a stray early timestamp widens it without a giant array.
    """
    minute = F.floor(F.col("timestamp") / BIN_SECONDS) * BIN_SECONDS
    means = (
        history.select(minute.alias("minute"), "delay_seconds")
        .filter(F.col("minute").isNotNull())
        .groupBy("minute")
        .agg(F.avg("delay_seconds").alias("delay_seconds"))
    )
    # Whole bins are compared, so that both uses of `means` are one plan and Spark runs it once.
    whole = F.struct("minute", "delay_seconds")
    span = means.agg(
        F.min(whole)["minute"].alias("first"), F.max(whole)["minute"].alias("last")
    )
    day = F.lit(SECONDS_PER_DAY)
    first_day, last_day = (F.floor(F.col(c) / day) * day for c in ("first", "last"))
    days = span.filter(F.col("first").isNotNull()).select(
        "first", "last", F.explode(F.sequence(first_day, last_day, day.cast("long"))).alias("day")
    )
    # Days are dealt out before each becomes 1,440 rows: a stray timestamp can make thousands.
    grid = days.repartition("day").select(
        "first",
        "last",
        F.explode(
            F.sequence(
                F.col("day"),
                F.col("day") + SECONDS_PER_DAY - BIN_SECONDS,
                F.lit(BIN_SECONDS).cast("long"),
            )
        ).alias("minute"),
    ).filter(F.col("minute").between(F.col("first"), F.col("last")))
    return (
        grid.select("minute")
        .join(means, "minute", "left")
        .select(local_time(F.col("minute"), settings.zone).alias("timestamp"), "minute", "delay_seconds")
        .orderBy("minute")
    )
