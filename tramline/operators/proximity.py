"""Bunching: is another vehicle of the route close by at the moment a position arrives?

A position counts for others from its arrival until its vehicle reports again on the same
route, so it is valid on a span of arrival numbers. A row is flagged when some other
vehicle's position is valid at its arrival and lies within the time, distance and bearing
limits. Three steps, none of which pairs up the rows of a route:

1. `_with_validity` finds where each position stops being valid.
2. `_crowded` cuts route, time, space and bearing into cells so small that any two rows of a
   cell are within all limits. Inside a cell the question is only whether some earlier row is
   still valid, and a running maximum answers it. A vehicle's own earlier positions end at or
   before its next one, so they can never answer for it. Crowds (a depot, vehicles without a
   GPS fix) are settled here in linear work. It looks back within one block of arrivals only;
   a row whose neighbours all arrived in an earlier block is left to step 3.
3. `_near_neighbours` takes the rows that are alone in their cell and semi-joins them to the
   positions in wider cells around them, with the exact limits as residual condition. Alone
   rows of one small cell have disjoint spans, so few are left wherever many vehicles meet.
   Wide cells with many positions are also cut along arrival order, so that a row is held
   against the positions valid around its arrival and not against all there ever were.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tramline.functions.geo import bearing_gap_deg, haversine_m
from tramline.operators.arrival import block_start, blocks_of, earlier, with_carried
from tramline.settings import DEFAULTS, Settings

_NEVER = (1 << 63) - 1
_GEOMETRY = ["timestamp", "latitude", "longitude", "bearing"]
# Longitude cells are used up to this latitude, where a degree is still about half as long as
# at the equator; rows beyond share one longitude cell.
_LAT_LIMIT = 60.0
_POLAR = -1
# Slots of arrival order in heavy cells: a position goes to the narrowest level that is as wide
# as its span, where it overlaps two slots at most. The last level is one slot for everything.
_LEVELS = [10, 18, 26, 34, 42, 50, 58]
_WHOLE = 63


def flag_bunching(positions: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Positions with `is_bunching`. `arrival_seq` has to be unique."""
    flagged = bunching_arrivals(positions, settings).withColumn("is_bunching", F.lit(True))
    return positions.join(flagged, "arrival_seq", "left").select(
        *positions.columns, F.coalesce("is_bunching", F.lit(False)).alias("is_bunching")
    )


def bunching_arrivals(positions: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """The arrival numbers of the flagged positions, each once."""
    # Both keys are tested here, once, so that the branches below share one shuffle: the null
    # tests Spark infers from their joins would otherwise make each of them a plan of its own.
    seen = positions.filter("route_id IS NOT NULL AND vehicle_id IS NOT NULL").select(
        "route_id", "vehicle_id", "arrival_seq", *_GEOMETRY
    )
    valid = _with_validity(seen, settings)
    marked = _crowded(valid, settings)
    crowd = marked.filter("crowded").select("arrival_seq")
    near = _near_neighbours(
        marked.filter(~F.col("crowded")),
        valid.filter("moved"),
        _heavy_cells(seen, settings),
        settings,
    )
    return crowd.unionByName(near)


def _with_validity(seen: DataFrame, settings: Settings) -> DataFrame:
    """Adds `until` (the vehicle's next arrival), `moved` and `moved_until`.

    `moved` is false for a repeat of the vehicle's previous reading (the feed is polled faster
    than vehicles report). Repeats need no entry of their own in the join of step 3 when the
    first reading stays valid until the next different one, `moved_until`.
    """
    keys = ["route_id", "vehicle_id"]
    blocked = seen.withColumn(
        "block", block_start(F.col("arrival_seq"), settings.arrivals_per_block)
    )
    firsts = blocked.groupBy(*keys, "block").agg(F.min("arrival_seq").alias("first_seq"))
    carried = firsts.select(
        *keys, "block", F.lead("first_seq").over(blocks_of(keys, "block")).alias("arrival_seq")
    ).filter(F.col("arrival_seq").isNotNull())

    in_order = Window.partitionBy(*keys, "block").orderBy("arrival_seq")
    repeats = F.col("carried") == F.lit(False)
    for name in _GEOMETRY:
        repeats = repeats & F.col(name).eqNullSafe(F.lag(name).over(in_order))
    has_previous = F.lag("arrival_seq").over(in_order).isNotNull()
    return (
        with_carried(blocked, carried)
        .withColumn("moved", ~(repeats & has_previous))
        .withColumn("until", F.coalesce(F.lead("arrival_seq").over(in_order), F.lit(_NEVER)))
        .withColumn("moved_seq", F.when(F.col("moved"), F.col("arrival_seq")))
        .withColumn(
            "moved_until",
            F.expr(
                "coalesce(lead(moved_seq) ignore nulls over "
                f"(partition by route_id, vehicle_id, block order by arrival_seq), {_NEVER})"
            ),
        )
        .filter(~F.col("carried"))
        .drop("carried", "moved_seq")
    )


def _crowded(valid: DataFrame, settings: Settings) -> DataFrame:
    """Adds `crowded`: an earlier row of the same small cell is still valid."""
    # 0.7 < 1/sqrt(2): the diagonal of a cell stays under the distance limit.
    side = math.degrees(0.7 * settings.bunching_distance_m / settings.earth_radius_m)
    cell = ["route_id", "small_time", "small_lat", "small_lon", "small_bearing"]
    celled = (
        valid.withColumn("small_time", F.floor(F.col("timestamp") / settings.bunching_window_s))
        .withColumn("small_lat", F.floor(F.col("latitude") / side))
        .withColumn("small_lon", F.floor(F.col("longitude") / side))
        .withColumn(
            "small_bearing",
            F.floor(F.pmod(F.col("bearing"), F.lit(360.0)) / settings.bunching_bearing_deg),
        )
    )
    before = earlier(Window.partitionBy(*cell, "block").orderBy("arrival_seq"))
    still_valid = F.max("until").over(before) > F.col("arrival_seq")
    return celled.withColumn("crowded", F.coalesce(still_valid, F.lit(False))).select(
        *valid.columns, "crowded"
    )


def _heavy_cells(seen: DataFrame, settings: Settings) -> DataFrame:
    """Wide cells with too many positions to hold every row against every other."""
    return (
        seen.groupBy(Grid(settings).home().alias("cell"))
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > settings.positions_per_cell)
        .select("cell", F.lit(True).alias("heavy"))
    )


def _near_neighbours(
    alone: DataFrame, others: DataFrame, heavy: DataFrame, settings: Settings
) -> DataFrame:
    """Arrival numbers of `alone` rows with a valid position of another vehicle in reach.

    Route, cell and slot are hashed into one long: rows stay narrow and sort fast, and where
    two keys collide the residual condition still tells their rows apart.
    """
    grid = Grid(settings)
    heavy_cell = F.coalesce("heavy", F.lit(False))

    span = F.col("moved_until") - F.col("arrival_seq")
    level = F.when(~heavy_cell | (F.col("moved_until") == _NEVER), _WHOLE)
    for bits in _LEVELS:
        level = level.when(span <= 1 << bits, bits)
    homes = (
        others.withColumn("cell", grid.home())
        .join(heavy, "cell", "left")
        .withColumn("level", level.otherwise(_WHOLE))
        .withColumn("slot", F.explode(F.sequence(_slot("arrival_seq"), _slot("moved_until"))))
        .select(
            _slot_key().alias("key"),
            F.col("route_id").alias("o_route_id"),
            F.col("vehicle_id").alias("o_vehicle_id"),
            F.col("arrival_seq").alias("o_arrival_seq"),
            F.col("moved_until").alias("o_until"),
            *[F.col(name).alias(f"o_{name}") for name in _GEOMETRY],
        )
    )
    visited = F.when(heavy_cell, _array(*_LEVELS, _WHOLE)).otherwise(_array(_WHOLE))
    probes = (
        grid.with_cells_in_reach(alone)
        .join(heavy, "cell", "left")
        .withColumn("level", F.explode(visited))
        .withColumn("slot", _slot("arrival_seq"))
        .select(_slot_key().alias("key"), "route_id", "vehicle_id", "arrival_seq", *_GEOMETRY)
    )

    p, h = probes.alias("p"), homes.alias("h")
    # Cheapest test first; the distance is only worked out for what is left.
    in_reach = (
        (F.col("o_arrival_seq") < F.col("arrival_seq"))
        & (F.col("o_until") > F.col("arrival_seq"))
        & (F.col("o_vehicle_id") != F.col("vehicle_id"))
        & (F.col("o_route_id") == F.col("route_id"))
        & (F.abs(F.col("p.timestamp") - F.col("o_timestamp")) <= settings.bunching_window_s)
        & (bearing_gap_deg(F.col("p.bearing"), F.col("o_bearing")) <= settings.bunching_bearing_deg)
        & (
            haversine_m(
                F.col("p.latitude"), F.col("p.longitude"), F.col("o_latitude"), F.col("o_longitude")
            )
            <= settings.bunching_distance_m
        )
    )
    same_key = F.col("p.key") == F.col("h.key")
    return p.join(h, [same_key, in_reach], "left_semi").select("arrival_seq").distinct()


def _array(*values: int) -> Column:
    return F.array(*[F.lit(value) for value in values])


def _slot(seq: str) -> Column:
    """The slot of an arrival number on the row's level."""
    return F.when(F.col("level") == _WHOLE, F.lit(0).cast("long")).otherwise(
        F.expr(f"shiftright({seq}, level)")
    )


def _slot_key() -> Column:
    return F.when(F.col("level") == _WHOLE, F.col("cell")).otherwise(
        F.xxhash64("cell", "level", "slot")
    )


class Grid:
    """Wide cells: a position lives in one, a probe visits every cell its reach overlaps.

    Cells are several reaches wide, so a probe visits two of them on average and eight at most.
    """

    def __init__(self, settings: Settings) -> None:
        # A hair more than the limit, so that rounding cannot hide a pair on the boundary.
        self.lat_reach = math.degrees(settings.bunching_distance_m / settings.earth_radius_m) * 1.001
        self.lat_width = 8 * self.lat_reach
        self.lon_reach = self.lat_reach / math.cos(math.radians(_LAT_LIMIT + 1))
        # A whole number of cells around the globe, so that the last one touches the first.
        self.lon_cells = math.floor(360 / (8 * self.lon_reach))
        self.lon_width = 360 / self.lon_cells
        self.time_reach = settings.bunching_window_s
        self.time_width = 8 * settings.bunching_window_s

    def home(self) -> Column:
        lon = F.pmod(F.floor(F.col("longitude") / self.lon_width), F.lit(self.lon_cells))
        return F.xxhash64(
            "route_id",
            F.floor(F.col("timestamp") / self.time_width),
            F.floor(F.col("latitude") / self.lat_width),
            F.when(F.abs("latitude") <= _LAT_LIMIT, lon).otherwise(F.lit(_POLAR).cast("long")),
        )

    def with_cells_in_reach(self, rows: DataFrame) -> DataFrame:
        lons = F.transform(
            self._overlapped(F.col("longitude"), self.lon_reach, self.lon_width),
            lambda cell: F.pmod(cell, F.lit(self.lon_cells).cast("long")),
        )
        polar = F.array(F.lit(_POLAR).cast("long"))
        lons = F.when(F.abs("latitude") <= _LAT_LIMIT - 1, lons).otherwise(F.concat(lons, polar))
        return (
            rows.withColumn(
                "t", F.explode(self._overlapped(F.col("timestamp"), self.time_reach, self.time_width))
            )
            .withColumn(
                "y", F.explode(self._overlapped(F.col("latitude"), self.lat_reach, self.lat_width))
            )
            .withColumn("x", F.explode(lons))
            .withColumn("cell", F.xxhash64("route_id", "t", "y", "x"))
            .drop("t", "y", "x")
        )

    def place(self, latitude: Column, longitude: Column, timestamp: Column) -> Column:
        """The cell a position lives in, as (time, latitude, longitude) numbers."""
        lon = F.pmod(F.floor(longitude / self.lon_width), F.lit(self.lon_cells).cast("long"))
        return F.struct(
            F.floor(timestamp / self.time_width).alias("t"),
            F.floor(latitude / self.lat_width).alias("y"),
            F.when(F.abs(latitude) <= _LAT_LIMIT, lon).otherwise(F.lit(_POLAR).cast("long")).alias("x"),
        )

    def places_in_reach(self, latitude: Column, longitude: Column, timestamp: Column) -> Column:
        """Every cell that holds positions in reach of this one: its own among them, eight at most, a ninth near the poles."""
        lons = F.transform(
            self._overlapped(longitude, self.lon_reach, self.lon_width),
            lambda cell: F.pmod(cell, F.lit(self.lon_cells).cast("long")),
        )
        polar = F.array(F.lit(_POLAR).cast("long"))
        lons = F.when(F.abs(latitude) <= _LAT_LIMIT - 1, lons).otherwise(F.concat(lons, polar))
        times = self._overlapped(timestamp, self.time_reach, self.time_width)
        lats = self._overlapped(latitude, self.lat_reach, self.lat_width)

        def row(t: Column) -> Column:
            return F.flatten(F.transform(lats, lambda y: F.transform(lons, lambda x: F.struct(t.alias("t"), y.alias("y"), x.alias("x")))))

        return F.array_distinct(F.flatten(F.transform(times, row)))

    @staticmethod
    def _overlapped(value: Column, reach: float, width: float) -> Column:
        return F.sequence(F.floor((value - reach) / width), F.floor((value + reach) / width))
