"""Last-known-value join: each position gets the delay that arrived last for its trip."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tramline.operators.arrival import block_start, blocks_of, earlier, up_to_here, with_carried
from tramline.settings import DEFAULTS, Settings


def attach_delay(
    positions: DataFrame, updates: DataFrame, settings: Settings = DEFAULTS
) -> DataFrame:
    """Positions with `delay_seconds`, 0 where no update has arrived yet.

    One shuffle of the union by `(trip_id, block)` and a running `last`, no join. The newest
    update of the earlier blocks enters each block as a carried row.
    """
    block = block_start(F.col("arrival_seq"), settings.arrivals_per_block).alias("block")
    tagged = (
        positions.select("*", block, F.lit(True).alias("is_position"))
        .unionByName(
            updates.select(
                "trip_id", "arrival_seq", "delay_seconds", block, F.lit(False).alias("is_position")
            ),
            allowMissingColumns=True,
        )
    )

    newest = tagged.groupBy("trip_id", "block").agg(
        F.max(F.when(~F.col("is_position"), F.col("arrival_seq"))).alias("update_seq"),
        F.max_by("delay_seconds", F.when(~F.col("is_position"), F.col("arrival_seq"))).alias("delay"),
    )
    before = earlier(blocks_of(["trip_id"], "block"))
    carried = newest.select(
        "trip_id",
        "block",
        F.last("update_seq", ignorenulls=True).over(before).alias("arrival_seq"),
        F.last("delay", ignorenulls=True).over(before).alias("delay_seconds"),
        F.lit(False).alias("is_position"),
    ).filter(F.col("delay_seconds").isNotNull())

    in_order = up_to_here(Window.partitionBy("trip_id", "block").orderBy("arrival_seq", "is_position"))
    return (
        with_carried(tagged, carried)
        .withColumn(
            "delay_seconds",
            F.coalesce(F.last("delay_seconds", ignorenulls=True).over(in_order), F.lit(0)),
        )
        .filter("is_position")
        .select(*positions.columns, "delay_seconds")
    )
