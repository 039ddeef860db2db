"""One row kept per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(rows: DataFrame, keys: list[str | Column], order: list[Column]) -> DataFrame:
    """The first row of each key under `order`.

    Written as `row_number() = 1` because Spark then keeps one row per key in every map task
    before the shuffle (`WindowGroupLimit`), so a hot key reaches the reducer already thinned.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def latest_per_key(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The last arrival of each key, whatever its event timestamp says."""
    return first_per_key(rows, list(keys), [F.col("arrival_seq").desc()])
