"""Distance and heading as column expressions; nothing here leaves the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tramline.settings import DEFAULTS


def haversine_m(lat_a: Column, lon_a: Column, lat_b: Column, lon_b: Column) -> Column:
    """Great-circle distance in metres between two points given in degrees."""
    half_lat = F.sin(F.radians(lat_b - lat_a) / 2)
    half_lon = F.sin(F.radians(lon_b - lon_a) / 2)
    chord = half_lat * half_lat + F.cos(F.radians(lat_a)) * F.cos(F.radians(lat_b)) * half_lon * half_lon
    return F.lit(2 * DEFAULTS.earth_radius_m) * F.atan2(F.sqrt(chord), F.sqrt(1 - chord))


def bearing_gap_deg(a: Column, b: Column) -> Column:
    """Smallest angle between two compass bearings."""
    turn = F.abs(a - b) % 360
    return F.least(turn, 360 - turn)
