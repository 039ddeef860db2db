"""Enrichment with keyed state in Spark's state store.

Three stateful operators in one query, and only keys with new messages are touched, however many trips and
vehicles there have ever been:

* `AttachDelay`, by trip, puts the last delay on every position;
* `TrackVehicle`, by route and vehicle, puts the vehicle's position before beside it;
* `FlagInCell`, by route and cell of place and time, remembers who is in reach of the cell.

Spark calls a processor for each of a fixed number of shards (`state_shards`) and not for each key: a call costs a few
milliseconds and a look into the state a tenth of one. The state is a map by key, of which only keys with news are touched.

No task holds a whole route. A position is sent to its own cell, where it is compared, and as a copy to the cells
around that it reaches into; a vehicle that has moved is taken out of the cells it no longer reaches. So
a cell knows the last position of every vehicle that anything in it can bunch with, and work
and state follow the vehicles in one place at one time. A shard's rows of one micro-batch meet in one task,
so bound the batch at the source (`maxOffsetsPerTrigger`, `maxFilesPerTrigger`).

The RocksDB state store has to be on: `STATE_STORE` names the setting. With `state_ttl_s` Spark
keeps making empty batches to expire state, so a run with `once` then ends only if
`spark.sql.streaming.noDataMicroBatches.enabled` is off.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, GroupedData
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.types import DoubleType, StructField, StructType

import tramline
from tramline import schemas
from tramline.operators.proximity import Grid
from tramline.settings import DEFAULTS, Settings
from tramline.streaming.sinks import append_parquet

STATE_STORE = (
    "spark.sql.streaming.stateStore.providerClass",
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
)

DELAYED = StructType([f for f in schemas.SILVER.fields if f.name != "is_bunching"])
_BEFORE = ["was_latitude", "was_longitude", "was_timestamp"]
TRACKED = StructType([*DELAYED.fields, *[StructField(name, DoubleType()) for name in _BEFORE]])
_CELL = ["route_id", "t", "y", "x"]
_PLACE = ["latitude", "longitude", "bearing", "timestamp"]

# What a cell needs of a position that does not ask.
_COPIED = ["arrival_seq", "vehicle_id", "route_id", *_PLACE]


def _in_order(chunks: Iterator[pd.DataFrame]) -> pd.DataFrame:
    """The rows of a shard in arrival order. They come in chunks that are not in order."""
    rows = pd.concat(chunks, ignore_index=True)
    keys = [name for name in ("arrival_seq", "is_position", "stays") if name in rows]
    return rows.sort_values(keys, kind="stable", ignore_index=True)


def _keyed(rows: pd.DataFrame, keys: list[str]) -> tuple[np.ndarray, list[tuple]]:
    """For each row the number of its key, and the keys by number. Null is a key."""
    numbers = rows.groupby(keys, sort=False, dropna=False).ngroup().to_numpy()
    first = np.unique(numbers, return_index=True)[1]
    known = rows[keys].iloc[first].astype(object)
    return numbers, list(known.where(known.notna(), None).itertuples(index=False, name=None))


class AttachDelay(StatefulProcessor):
    """Keyed by shards of trips: remembers the last delay of each trip and puts it on every position."""

    def __init__(self, ttl_ms: int | None = None) -> None:
        self._ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._last = handle.getMapState("delays", "trip_id string", "delay long", self._ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        arrivals = _in_order(rows)
        trip, trips = _keyed(arrivals, ["trip_id"])
        by_trip = arrivals["delay_seconds"].astype("float64").groupby(trip)
        delays, last = by_trip.ffill(), by_trip.last()
        is_position = arrivals["is_position"].to_numpy(bool)
        # Only positions before the first update of the batch need what was known.
        known = np.zeros(len(trips))
        for number in np.unique(trip[is_position & delays.isna().to_numpy()]):
            if (held := self._last.getValue(trips[number])) is not None:
                known[number] = held[0]
        for number, delay in last.dropna().items():
            self._last.updateValue(trips[number], (int(delay),))
        arrivals["delay_seconds"] = delays.fillna(pd.Series(known[trip], index=delays.index)).astype("int64")
        positions = arrivals[is_position]
        if len(positions):
            yield positions[DELAYED.names].astype({"timestamp": "int64"})

    def close(self) -> None:
        pass


class TrackVehicle(StatefulProcessor):
    """Keyed by shards of routes and vehicles: puts the position before beside each, null for the first."""

    def __init__(self, ttl_ms: int | None = None) -> None:
        self._ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._last = handle.getMapState(
            "places", "route_id string, vehicle_id string", "latitude double, longitude double, timestamp double", self._ttl_ms
        )

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        arrivals = _in_order(rows)
        vehicle, vehicles = _keyed(arrivals, ["route_id", "vehicle_id"])
        here = arrivals[["latitude", "longitude", "timestamp"]].to_numpy("float64")
        # The rows of one vehicle after another, each in arrival order: the one before is in the row above.
        order = np.argsort(vehicle, kind="stable")
        starts = np.searchsorted(vehicle[order], np.arange(len(vehicles)))
        ends = np.append(starts[1:], len(order)) - 1
        before = np.empty_like(here)
        before[order[1:]] = here[order[:-1]]
        for number, which in enumerate(vehicles):
            held = self._last.getValue(which)
            before[order[starts[number]]] = (np.nan,) * 3 if held is None else tuple(held)
            self._last.updateValue(which, tuple(float(x) for x in here[order[ends[number]]]))
        yield arrivals.assign(**dict(zip(_BEFORE, before.T)))[TRACKED.names]

    def close(self) -> None:
        pass


def cell_messages(tracked: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """What each position tells the cells: `t, y, x, stays, asks` and the position's columns.

    It `stays` in the cells in its reach, and `asks` in its own who else is near; the cells that only the
    position before had reached hear that the vehicle left. Without coordinates it counts as at 0, 0, where nothing
    is close to it.
    """
    grid = Grid(settings)
    at = lambda prefix: [F.nanvl(F.coalesce(f"{prefix}{name}", F.lit(0)).cast("double"), F.lit(0.0)) for name in ("latitude", "longitude")]
    here = (*at(""), F.coalesce("timestamp", F.lit(0)))
    was = (*at("was_"), F.col("was_timestamp").cast("long"))
    reached = grid.places_in_reach(*here)
    known = F.col("was_timestamp").isNotNull() & ~F.isnan("was_timestamp")
    left = F.when(known, F.array_except(grid.places_in_reach(*was), reached)).otherwise(F.array_except(reached, reached))
    home = grid.place(*here)
    told = F.concat(
        F.transform(reached, lambda cell: F.struct(cell.alias("cell"), F.lit(True).alias("stays"), (cell == home).alias("asks"))),
        F.transform(left, lambda cell: F.struct(cell.alias("cell"), F.lit(False).alias("stays"), F.lit(False).alias("asks"))),
    )
    exploded = tracked.select(*DELAYED.names, F.explode(told).alias("told"))
    # Copies carry the place only.
    carried = [name if name in _COPIED else F.when(F.col("told.asks"), F.col(name)).alias(name) for name in DELAYED.names]
    return exploded.select("told.cell.*", "told.stays", "told.asks", *carried)


class FlagInCell(StatefulProcessor):
    """Keyed by shards of routes and cells: remembers the last position of every vehicle in reach, and compares those that ask.

    What a cell knows is one value, which is read and written once a batch: the vehicles, and for each its place and the time it
    was told, as doubles.
    """

    def __init__(self, settings: Settings, ttl_ms: int | None = None) -> None:
        self._settings, self._ttl_ms = settings, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._seen = handle.getMapState(
            "last_positions", "route_id string, t long, y long, x long", "vehicles array<string>, places binary", self._ttl_ms
        )

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        now = 0 if self._ttl_ms is None else timerValues.getCurrentProcessingTimeInMs()
        arrivals = _in_order(rows)
        cell, cells = _keyed(arrivals, _CELL)
        asks, stays = arrivals["asks"].to_numpy(bool), arrivals["stays"].to_numpy(bool)
        vehicles, new = arrivals["vehicle_id"].to_numpy(object), arrivals[_PLACE].to_numpy("float64")
        vehicles = np.where(arrivals["vehicle_id"].isna(), None, vehicles)
        flags = np.zeros(len(arrivals), dtype=bool)
        order = np.argsort(cell, kind="stable")
        starts = np.searchsorted(cell[order], np.arange(1, len(cells)))
        for where, part in zip(cells, np.split(order, starts)):
            where = (where[0], *map(int, where[1:]))
            flags[part] = self._in_cell(where, vehicles[part], new[part], asks[part], stays[part], now)
        if asks.any():
            yield arrivals.assign(is_bunching=flags)[asks][schemas.SILVER.names].astype({"timestamp": "int64", "delay_seconds": "int64"})

    def _in_cell(self, where: tuple, vehicles: np.ndarray, new: np.ndarray, asks: np.ndarray, stays: np.ndarray, now: int) -> np.ndarray:
        held, told = self._held(where, now)
        row_of = {vehicle: i for i, vehicle in enumerate(held)}
        for vehicle in vehicles:
            row_of.setdefault(vehicle, len(row_of))
        # Vehicles that are not here are far in the past, where nothing is close to them.
        away = np.full(4, -np.inf)
        places = np.concatenate([told[:, :4], np.tile(away, (len(row_of) - len(held), 1))])
        at = np.concatenate([told[:, 4], np.full(len(row_of) - len(held), now)])

        flags = np.zeros(len(vehicles), dtype=bool)
        for i, vehicle in enumerate(vehicles):
            own = row_of[vehicle]
            if asks[i]:
                recent = np.abs(places[:, 3] - new[i, 3]) <= self._settings.bunching_window_s
                recent[own] = False
                flags[i] = recent.any() and self._any_close(new[i], places[recent])
            places[own] = new[i] if stays[i] else away
            at[own] = now

        here = places[:, 3] != -np.inf
        if here.any():
            stay = [vehicle for vehicle, is_here in zip(row_of, here) if is_here]
            self._seen.updateValue(where, (stay, np.column_stack([places, at])[here].tobytes()))
        elif held:
            self._seen.removeKey(where)
        return flags

    def _held(self, where: tuple, now: int) -> tuple[list[str], np.ndarray]:
        """What the cell knows, without what has expired."""
        if (value := self._seen.getValue(where)) is None:
            return [], np.empty((0, 5))
        vehicles, places = list(value[0]), np.frombuffer(value[1], "float64").reshape(-1, 5)
        if self._ttl_ms is None:
            return vehicles, places
        fresh = places[:, 4] + self._ttl_ms > now
        return [vehicle for vehicle, is_fresh in zip(vehicles, fresh) if is_fresh], places[fresh]

    def _any_close(self, here: np.ndarray, others: np.ndarray) -> bool:
        turn = np.abs(others[:, 2] - here[2]) % 360
        others = others[np.minimum(turn, 360 - turn) <= self._settings.bunching_bearing_deg]
        lat, lon = np.radians(here[0]), np.radians(here[1])
        o_lat, o_lon = np.radians(others[:, 0]), np.radians(others[:, 1])
        chord = (
            np.sin((o_lat - lat) / 2) ** 2
            + np.cos(lat) * np.cos(o_lat) * np.sin((o_lon - lon) / 2) ** 2
        )
        metres = 2 * self._settings.earth_radius_m * np.arctan2(np.sqrt(chord), np.sqrt(1 - chord))
        return bool((metres <= self._settings.bunching_distance_m).any())

    def close(self) -> None:
        pass


def _ttl_ms(settings: Settings) -> int | None:
    return None if settings.state_ttl_s is None else 1000 * settings.state_ttl_s


def _time_mode(settings: Settings) -> str:
    return "None" if settings.state_ttl_s is None else "ProcessingTime"


def _sharded(rows: DataFrame, keys: list[str], settings: Settings) -> GroupedData:
    """Rows by shards of keys: a call of Python handles a shard of a batch, and its state is by key."""
    shard = F.pmod(F.xxhash64(*keys), F.lit(settings.state_shards)).alias("_shard")
    return rows.select(shard, *rows.columns).groupBy("_shard")


def enrich(arrivals: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """A merged stream to silver rows."""
    # The processors travel to the workers as code, which need not have this package installed.
    cloudpickle.register_pickle_by_value(tramline)
    delayed = _sharded(arrivals, ["trip_id"], settings).transformWithStateInPandas(
        AttachDelay(_ttl_ms(settings)),
        outputStructType=DELAYED,
        outputMode="Append",
        timeMode=_time_mode(settings),
    )
    tracked = _sharded(delayed, ["route_id", "vehicle_id"], settings).transformWithStateInPandas(
        TrackVehicle(_ttl_ms(settings)),
        outputStructType=TRACKED,
        outputMode="Append",
        timeMode=_time_mode(settings),
    )
    return _sharded(cell_messages(tracked, settings), _CELL, settings).transformWithStateInPandas(
        FlagInCell(settings, _ttl_ms(settings)),
        outputStructType=schemas.SILVER,
        outputMode="Append",
        timeMode=_time_mode(settings),
    )


def start(
    arrivals: DataFrame, path: str, checkpoint: str, once: bool = False, settings: Settings = DEFAULTS
) -> StreamingQuery:
    return append_parquet(enrich(arrivals, settings), path, checkpoint, once, settings)
