"""The frames a dashboard shows, from the live table, the silver history and the gold tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tramline.functions import labels
from tramline.operators.latest import latest_per_key
from tramline.schemas import LIVE_COLUMNS
from tramline.settings import DEFAULTS, Settings


# --- live table -------------------------------------------------------------------------


def live_state(enriched: DataFrame) -> DataFrame:
    """The last arrival of every vehicle, however old its reading."""
    return latest_per_key(enriched, ["vehicle_id"]).select(LIVE_COLUMNS)


def as_local_values(live: DataFrame) -> DataFrame:
    """Value types of the local live table: flags are 0 and 1."""
    return live.withColumn("is_bunching", F.col("is_bunching").cast("int"))


def as_keyvalue_values(live: DataFrame) -> DataFrame:
    """Value types of the key-value live table: exact decimals of the printed coordinates."""

    def exact(name: str) -> Column:
        return F.col(name).cast("string").cast("decimal(38,18)")

    return live.withColumn("latitude", exact("latitude")).withColumn("longitude", exact("longitude"))


def normalize_live(live: DataFrame) -> DataFrame:
    """Undo backend value types, and fall back to the route id where there is no short name."""
    frame = live
    for name in ["latitude", "longitude", "delay_seconds", "timestamp"]:
        frame = frame.withColumn(name, F.col(name).cast("double"))
    short = (
        F.coalesce("route_short_name", "route_id")
        if "route_short_name" in live.columns
        else F.col("route_id")
    )
    return frame.withColumn("route_short_name", short).withColumn(
        "is_bunching", F.col("is_bunching").cast("boolean")
    )


def with_valid_coordinates(live: DataFrame) -> DataFrame:
    """Without the (0, 0) rows of vehicles that have no GPS fix. Missing values stay."""
    no_fix = (F.col("latitude") == 0) & (F.col("longitude") == 0)
    return live.filter(~F.coalesce(no_fix, F.lit(False)))


def board_rows(live: DataFrame, agencies: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Live vehicles as shown: placed, named, with status, colour and yes/no label."""
    bunching, delay = F.col("is_bunching"), F.col("delay_seconds")
    return (
        labels.add_operator_name(with_valid_coordinates(live), agencies)
        .withColumn("status", labels.status(bunching, delay, settings))
        .withColumn("color", labels.status_rgba(bunching, delay, settings))
        .withColumn("is_bunching_label", labels.yes_no(bunching))
    )


def vehicle_board(board: DataFrame) -> DataFrame:
    """Most delayed first. The vehicle id in the sort key lets one frequent delay value, such
    as 0, be split over several sort tasks."""
    return board.select(
        "vehicle_id", "operator_name", "route_short_name", "delay_seconds", "is_bunching"
    ).orderBy(F.desc("delay_seconds"), "vehicle_id")


# --- key figures ------------------------------------------------------------------------


def network_kpis(board: DataFrame) -> DataFrame:
    """Vehicle count, mean delay to one decimal (half to even), vehicles bunching now."""
    return board.agg(
        F.count(F.lit(1)).alias("active_vehicles"),
        F.bround(F.avg("delay_seconds"), 1).alias("avg_delay_seconds"),
        F.count_if("is_bunching").alias("bunching_now"),
    )


def selection_vs_network(board: DataFrame, selected: Column) -> DataFrame:
    """Key figures of a selection beside those of the network, in one pass over the rows."""
    flag = F.when(F.col("is_bunching"), 1.0).when(~F.col("is_bunching"), 0.0)
    delay = F.col("delay_seconds")
    return board.agg(
        F.count_if(selected).alias("selection_vehicles"),
        F.avg(F.when(selected, delay)).alias("selection_avg_delay"),
        F.avg(delay).alias("network_avg_delay"),
        F.count_if(selected & F.col("is_bunching")).alias("selection_bunching"),
        F.count_if("is_bunching").alias("network_bunching"),
        (F.avg(F.when(selected, flag)) * 100).alias("selection_bunching_rate"),
        (F.avg(flag) * 100).alias("network_bunching_rate"),
    ).select(
        "*",
        (F.col("selection_avg_delay") - F.col("network_avg_delay")).alias("avg_delay_delta"),
        (F.col("selection_bunching_rate") - F.col("network_bunching_rate")).alias("bunching_rate_delta"),
    )


def comparison_rows(figures: DataFrame) -> DataFrame:
    """The same figures as one row per chart bar."""
    return figures.select(
        F.stack(
            F.lit(2),
            F.lit("Selection"),
            F.col("selection_avg_delay"),
            F.col("selection_bunching"),
            F.lit("Network average"),
            F.col("network_avg_delay"),
            F.col("network_bunching"),
        ).alias("group", "avg_delay_seconds", "bunching_events")
    )


def view_bounds(
    placed: DataFrame,
    padding: float = 1.3,
    min_spread: float = 0.005,
    settings: Settings = DEFAULTS,
) -> DataFrame:
    """Map centre and zoom that fit all rows; the default view where there are none."""
    box = placed.agg(
        F.min("latitude").alias("south"),
        F.max("latitude").alias("north"),
        F.min("longitude").alias("west"),
        F.max("longitude").alias("east"),
    )

    def spread(low: str, high: str) -> Column:
        return F.greatest(F.col(high) - F.col(low), F.lit(min_spread)) * padding

    fitting = F.least(F.log2(180 / spread("south", "north")), F.log2(360 / spread("west", "east")))
    zoom = F.greatest(F.lit(settings.min_zoom), F.least(fitting, F.lit(settings.max_zoom)))
    default_lat, default_lon, default_zoom = settings.default_view
    empty = F.col("south").isNull()
    return box.select(
        F.when(empty, default_lat).otherwise((F.col("south") + F.col("north")) / 2).alias("latitude"),
        F.when(empty, default_lon).otherwise((F.col("west") + F.col("east")) / 2).alias("longitude"),
        F.when(empty, default_zoom).otherwise(zoom).alias("zoom"),
    )


# --- choices ----------------------------------------------------------------------------


def route_options(board: DataFrame) -> DataFrame:
    """One row per label offered. Where two routes share a label the lowest id is meant."""
    label = F.concat("route_short_name", F.lit(" ("), "operator_name", F.lit(")"))
    return (
        board.groupBy("route_short_name", "operator_name")
        .agg(F.min("route_id").alias("route_id"))
        .withColumn("display_label", label)
        .orderBy("route_short_name", "operator_name")
    )


def operator_options(board: DataFrame) -> DataFrame:
    return board.select("operator_name").distinct().orderBy("operator_name")


def top_charted(
    gold: DataFrame, name_column: str, key: str | None = None, settings: Settings = DEFAULTS
) -> DataFrame:
    """The rows with most vehicles, with their shortened axis label."""
    return (
        gold.orderBy(F.desc("active_vehicle_count"), key or name_column)
        .limit(settings.charted_rows)
        .withColumn("axis_label", labels.axis_label(F.col(name_column), settings.label_chars))
    )
