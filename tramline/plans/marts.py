"""The gold tables. Each takes staged events and returns rows in the order they are read in.

Every aggregate is cut down by map-side partials before its shuffle, and nothing is grouped
into a single task: distinct counts first collapse to one row per (group, vehicle), headways
to one row per (route, second).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tramline.functions.clock import SECONDS_PER_DAY, hour_of, wall_seconds
from tramline.functions.labels import add_operator_name
from tramline.operators.arrival import block_start, blocks_of, with_carried
from tramline.settings import DEFAULTS, Settings


def _bunching_count() -> Column:
    return F.count_if("is_bunching").alias("bunching_events")


def busiest_routes(staged: DataFrame) -> DataFrame:
    return (
        staged.groupBy("route_short_name")
        .agg(
            F.count_distinct("vehicle_id").alias("active_vehicle_count"),
            F.avg("delay_seconds").alias("average_delay_seconds"),
            _bunching_count(),
        )
        .orderBy(F.desc("active_vehicle_count"), "route_short_name")
    )


def delay_by_hour(staged: DataFrame) -> DataFrame:
    return (
        staged.groupBy(hour_of(F.col("event_time")).alias("hour"))
        .agg(
            F.avg("delay_seconds").alias("avg_delay_seconds"),
            F.count(F.lit(1)).alias("event_count"),
        )
        .orderBy("hour")
    )


def operator_performance(
    staged: DataFrame, agencies: DataFrame, settings: Settings = DEFAULTS
) -> DataFrame:
    """Grouped by agency id, so a name shared by two ids stays two rows.

    Two distinct counts over raw rows would triple them before the shuffle. Events are summed
    per (agency, vehicle, route) first; the distinct counts then run over that small result,
    and the names are joined to one row per agency.
    """
    per_vehicle = staged.groupBy("agency_id", "vehicle_id", "route_id").agg(
        F.count(F.lit(1)).alias("readings"),
        F.count("delay_seconds").alias("delays"),
        F.sum("delay_seconds").alias("delay_sum"),
        F.count_if("is_bunching").alias("bunched"),
    )
    per_agency = (
        per_vehicle.groupBy("agency_id")
        .agg(
            F.count_distinct("vehicle_id").alias("active_vehicle_count"),
            F.count_distinct("route_id").alias("route_count"),
            F.sum("readings").alias("reading_count"),
            F.try_divide(F.sum("delay_sum"), F.sum("delays")).alias("average_delay_seconds"),
            F.sum("bunched").alias("bunching_events"),
        )
        .filter(F.col("active_vehicle_count") >= settings.min_vehicles)
    )
    return (
        add_operator_name(per_agency, agencies)
        .select("operator_name", *per_agency.columns)
        .orderBy(F.desc("average_delay_seconds"), "agency_id")
    )


def route_stats(staged: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Per route, where the sample is large enough to rank."""
    return (
        staged.groupBy("route_short_name")
        .agg(
            F.count_distinct("vehicle_id").alias("active_vehicle_count"),
            F.avg("delay_seconds").alias("average_delay_seconds"),
            _bunching_count(),
            F.count(F.lit(1)).alias("readings"),
        )
        .filter(
            (F.col("active_vehicle_count") >= settings.min_vehicles)
            & (F.col("readings") >= settings.min_readings)
        )
        .drop("readings")
    )


def top_routes_by_delay(staged: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """The worst routes, then the best. With few routes a route is in both halves."""
    stats = route_stats(staged, settings)
    delay = F.col("average_delay_seconds")
    worst = stats.orderBy(delay.desc_nulls_last(), "route_short_name").limit(settings.ranked_routes)
    best = stats.orderBy(delay.asc_nulls_last(), "route_short_name").limit(settings.ranked_routes)
    return worst.unionAll(best)


def _first_seen(staged: DataFrame) -> DataFrame:
    return staged.groupBy("route_short_name", "trip_id").agg(
        F.min("event_time").alias("first_seen_at")
    )


def departures(first_seen: DataFrame) -> DataFrame:
    """One row per route and second in which trips were first seen, with the gap before it.

    `trips` trips share the second; `leading_trip` is the one that gets the gap, the others
    follow it by zero seconds. A day of one route has at most 86,400 of these rows however
    many trips it has, so the window runs per (route, day) and the last departure of the day
    before is carried in.
    """
    keys = ["route_short_name"]
    seconds = (
        first_seen.withColumn("second", wall_seconds(F.col("first_seen_at")))
        .filter(F.col("second").isNotNull())
        .groupBy(*keys, "second")
        .agg(F.count(F.lit(1)).alias("trips"), F.min("trip_id").alias("leading_trip"))
        .withColumn("day", block_start(F.col("second"), SECONDS_PER_DAY))
    )
    carried = (
        seconds.groupBy(*keys, "day")
        .agg(F.max("second").alias("last_second"))
        .select(*keys, "day", F.lag("last_second").over(blocks_of(keys, "day")).alias("second"))
        .filter(F.col("second").isNotNull())
    )
    previous = F.lag("second").over(Window.partitionBy(*keys, "day").orderBy("second"))
    return (
        with_carried(seconds, carried)
        .withColumn("gap_seconds", F.col("second") - previous)
        .filter(~F.col("carried"))
        .select(*keys, "second", "trips", "leading_trip", "gap_seconds")
    )


def headway_gaps(staged: DataFrame) -> DataFrame:
    """Every trip with the seconds since the trip before it on its route; none without a time."""
    first_seen = _first_seen(staged).withColumn("second", wall_seconds(F.col("first_seen_at")))
    gaps = departures(_first_seen(staged)).select(
        F.col("route_short_name").alias("g_route"),
        F.col("second").alias("g_second"),
        "leading_trip",
        "gap_seconds",
    )
    same = F.col("route_short_name").eqNullSafe(F.col("g_route")) & (
        F.col("second") == F.col("g_second")
    )
    follows = F.col("trip_id") != F.col("leading_trip")
    gap = F.when(follows, F.lit(0).cast("long")).otherwise(F.col("gap_seconds"))
    return first_seen.join(gaps, same, "left").select(
        "route_short_name",
        "trip_id",
        "first_seen_at",
        gap.cast("double").alias("gap_to_previous_trip"),
    )


def headway_adherence(staged: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """How regular each route runs: count, mean and spread of the gaps between its trips.

    Gaps are whole seconds, so count, sum and sum of squares are kept exactly and the sample
    deviation comes out the same however the rows were split over tasks.
    """
    sums = departures(_first_seen(staged)).groupBy("route_short_name").agg(*gap_sums(settings))
    return adherence(sums, settings)


def gap_sums(settings: Settings = DEFAULTS) -> list[Column]:
    """Aggregates over `departures`: the number of gaps, their sum and sum of squares."""
    # Trips sharing a second add `trips - 1` gaps of zero; the leading trip adds the real gap.
    kept = F.col("gap_seconds") < settings.headway_break_s
    gap = F.when(kept, F.col("gap_seconds"))
    return [
        F.sum(F.col("trips") - 1 + F.when(kept, 1).otherwise(0)).alias("trip_count"),
        F.coalesce(F.sum(gap), F.lit(0)).alias("gap_sum"),
        F.coalesce(F.sum(gap * gap), F.lit(0)).alias("square_sum"),
    ]


def adherence(sums: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """The gold table from one row of `gap_sums` per route."""
    n, total, squares = (
        F.col(name).cast("decimal(19,0)") for name in ("trip_count", "gap_sum", "square_sum")
    )
    spread = (n * squares - total * total).cast("double")
    count = F.col("trip_count").cast("double")
    return (
        sums.filter(F.col("trip_count") > settings.headway_min_gaps)
        .select(
            "route_short_name",
            "trip_count",
            (F.col("gap_sum") / count).alias("average_gap_seconds"),
            F.sqrt(spread / (count * (count - 1))).alias("headway_stddev_seconds"),
        )
        .orderBy(F.desc("headway_stddev_seconds"), "route_short_name")
    )


def build_marts(
    staged: DataFrame, agencies: DataFrame, settings: Settings = DEFAULTS
) -> dict[str, DataFrame]:
    """All gold tables by name."""
    return {
        "busiest_routes": busiest_routes(staged),
        "delay_by_hour": delay_by_hour(staged),
        "operator_performance": operator_performance(staged, agencies, settings),
        "headway_adherence": headway_adherence(staged, settings),
        "top_routes_by_delay": top_routes_by_delay(staged, settings),
    }
