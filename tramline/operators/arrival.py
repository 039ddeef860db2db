"""Splitting one key's rows along arrival order, so that no window holds a whole hot key.

A window function over `key ORDER BY arrival_seq` puts every row of a key in one task. The
operators here window over `(key, block)` instead, where a block is a fixed span of arrival
numbers, and pass what a block needs from its neighbours as one extra *carried* row per
`(key, block)`. The carried rows come from a hash aggregate with map-side partials, so they
cost a narrow scan and as many rows as there are (key, block) pairs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F


HOUR_MS = 3_600_000


def numbered(messages: DataFrame, after: int = -1) -> DataFrame:
    """Messages with `arrival_seq`, gapless from `after` + 1, in place of their struct `arrival`.

    The order is (time, topic, partition, offset). Counts per hour, then per (time, topic, partition)
    within the hour, are summed up; messages are numbered only within one partition's millisecond.
    `messages` is read twice, so it should be stored or cached.
    """
    place = ["time", "topic", "partition"]
    placed = messages.select("*", *[F.col(f"arrival.{name}").alias(f"_{name}") for name in [*place, "offset"]])
    keys = [f"_{name}" for name in place]
    hour = F.floor(F.col("_time") / HOUR_MS).alias("_hour")
    counts = placed.groupBy(hour, *keys).agg(F.count(F.lit(1)).alias("_n"))
    hours = counts.groupBy("_hour").agg(F.sum("_n").alias("_n"))
    # One row per hour.
    upto_hour = earlier(Window.orderBy("_hour"))
    hours = hours.select("_hour", F.coalesce(F.sum("_n").over(upto_hour), F.lit(0)).alias("_before_hour"))
    upto = earlier(Window.partitionBy("_hour").orderBy(*keys))
    starts = counts.withColumn("_before", F.coalesce(F.sum("_n").over(upto), F.lit(0))).join(hours, "_hour")
    within = F.row_number().over(Window.partitionBy(*keys).orderBy("_offset"))
    return (
        placed.withColumn("_at", within)
        .join(starts, keys)
        .withColumn("arrival_seq", F.col("_before_hour") + F.col("_before") + F.col("_at") + F.lit(after))
        .select("arrival_seq", *[name for name in messages.columns if name != "arrival"])
    )


def block_start(order: Column, span: int) -> Column:
    """First order value of the block `order` falls in; exact for any long."""
    return order - F.pmod(order, F.lit(span))


def blocks_of(keys: list[str], block: str) -> WindowSpec:
    """The blocks of one key in order; its rows are per-block summaries, never raw rows."""
    return Window.partitionBy(*keys).orderBy(block)


def earlier(window: WindowSpec) -> WindowSpec:
    return window.rowsBetween(Window.unboundedPreceding, -1)


def up_to_here(window: WindowSpec) -> WindowSpec:
    return window.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def with_carried(rows: DataFrame, carried: DataFrame) -> DataFrame:
    """Rows plus carried rows, told apart by the boolean `carried`."""
    return rows.withColumn("carried", F.lit(False)).unionByName(
        carried.withColumn("carried", F.lit(True)), allowMissingColumns=True
    )
