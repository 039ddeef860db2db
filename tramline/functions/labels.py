"""Text and colour columns shown to people, and the split of route ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tramline.settings import DEFAULTS, Settings


def route_agency(route_id: Column) -> Column:
    """Text before the first underscore, or the whole id."""
    return F.split(route_id, "_", 2)[0]


def route_short_name(route_id: Column) -> Column:
    """Text after the first underscore, or the whole id."""
    return F.coalesce(F.get(F.split(route_id, "_", 2), F.lit(1)), route_id)


def operator_label(agency_name: Column, agency_id: Column) -> Column:
    return F.coalesce(agency_name, F.concat(F.lit("Unknown operator ("), agency_id, F.lit(")")))


def add_operator_name(rows: DataFrame, agencies: DataFrame) -> DataFrame:
    """Left join to the agency dimension. No hint: Spark broadcasts it while its size allows."""
    named = rows.join(agencies, "agency_id", "left")
    return named.withColumn(
        "operator_name", operator_label(F.col("agency_name"), F.col("agency_id"))
    ).drop("agency_name")


def status(is_bunching: Column, delay: Column, settings: Settings = DEFAULTS) -> Column:
    return (
        F.when(is_bunching, "bunching")
        .when(delay > settings.late_after_s, "late")
        .otherwise("on time")
    )


def status_rgba(is_bunching: Column, delay: Column, settings: Settings = DEFAULTS) -> Column:
    def rgba(parts: tuple[int, ...]) -> Column:
        return F.array(*[F.lit(p) for p in parts])

    return (
        F.when(is_bunching, rgba(settings.bunching_rgba))
        .when(delay > settings.late_after_s, rgba(settings.late_rgba))
        .otherwise(rgba(settings.on_time_rgba))
    )


def yes_no(flag: Column) -> Column:
    return F.when(flag, "Yes").when(~flag, "No")


def axis_label(name: Column, max_chars: int = DEFAULTS.label_chars) -> Column:
    shortened = F.concat(F.substring(name, 1, max_chars - 1), F.lit("…"))
    return F.when(F.length(name) <= max_chars, name).otherwise(shortened)
