"""Every threshold, period and name the jobs depend on, in one frozen record."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Settings:
    # Results only match other deployments when these stay as they are.
    bunching_distance_m: float = 500.0
    bunching_window_s: int = 120
    bunching_bearing_deg: float = 45.0
    earth_radius_m: float = 6_371_000.0
    late_after_s: int = 300
    headway_break_s: int = 1800
    headway_min_gaps: int = 5
    min_vehicles: int = 3
    min_readings: int = 20
    ranked_routes: int = 5
    charted_rows: int = 15
    label_chars: int = 18
    delay_floor_s: int = -3600
    delay_ceiling_s: int = 7200
    stale_repeats: int = 5
    recent_days: int = 2
    retention_days: int = 90
    flush_interval: str = "60 seconds"
    zone: str = "Australia/Sydney"
    positions_topic: str = "vehicle-positions-raw"
    updates_topic: str = "trip-updates-raw"
    bunching_rgba: tuple[int, ...] = (255, 0, 0, 200)
    late_rgba: tuple[int, ...] = (255, 165, 0, 200)
    on_time_rgba: tuple[int, ...] = (0, 200, 0, 200)
    default_view: tuple[float, float, float] = (-33.87, 151.21, 9.0)
    min_zoom: float = 2.0
    max_zoom: float = 16.0

    # Scale knobs: they change how work is split, never what comes out.
    arrivals_per_block: int = 1 << 20
    positions_per_cell: int = 1 << 12

    # Streaming state older than this is forgotten; the default keeps it for ever. A day is
    # plenty for trips, and bunching looks back two minutes.
    state_ttl_s: int | None = None

    # Stored state by key: into how many buckets, and after how many changes a bucket is written whole.
    state_buckets: int = 64
    state_segments: int = 8

    # Into how many shards the keys of Spark's state store are put; the same for the life of a checkpoint.
    state_shards: int = 1024

    # How long an old version of the live table or the state stays for readers that began with it.
    version_grace_s: int = 900

    # Where the latest row per vehicle is kept: "local" or "dynamodb" value types.
    live_backend: str = "local"


DEFAULTS = Settings()
