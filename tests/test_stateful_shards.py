"""The stateful operators: a call handles a shard of keys, and looks into the state once a key."""

from __future__ import annotations

import pandas as pd
import pytest

from tramline.settings import Settings
from tramline.streaming import stateful


class FakeMap:
    def __init__(self):
        self.rows, self.reads, self.writes = {}, 0, 0

    def getValue(self, key):
        self.reads += 1
        return self.rows.get(key)

    def updateValue(self, key, value):
        self.writes += 1
        self.rows[key] = value

    def removeKey(self, key):
        self.rows.pop(key)


class FakeHandle:
    def __init__(self):
        self.map = FakeMap()

    def getMapState(self, *_):
        return self.map


class Clock:
    def __init__(self, now):
        self.now = now

    def getCurrentProcessingTimeInMs(self):
        return self.now


def started(processor):
    handle = FakeHandle()
    processor.init(handle)
    return processor, handle.map


def called(processor, rows, now=0):
    return pd.concat([*processor.handleInputRows((0,), iter([rows]), Clock(now)), pd.DataFrame()])


def merged_rows(rows):
    """(arrival_seq, trip_id, delay_seconds or None for a position)"""
    frame = pd.DataFrame(rows, columns=["arrival_seq", "trip_id", "delay_seconds"])
    empty = {name: None for name in stateful.DELAYED.names if name not in frame}
    return frame.assign(**empty | {"timestamp": 5}, is_position=frame["delay_seconds"].isna())


def test_one_call_attaches_delays_of_many_trips():
    processor, held = started(stateful.AttachDelay())
    first = merged_rows([(1, "a", 60), (2, "b", None), (3, "a", None), (4, None, 7), (5, None, None), (6, "b", 9)])
    assert called(processor, first)[["arrival_seq", "delay_seconds"]].values.tolist() == [[2, 0], [3, 60], [5, 7]]
    assert held.rows == {("a",): (60,), ("b",): (9,), (None,): (7,)}
    # Only the trip without an update before its position is asked for.
    assert (held.reads, held.writes) == (1, 3)
    again = merged_rows([(7, "a", None), (8, "b", None), (9, None, None), (10, "c", None), (11, "a", None)])
    assert called(processor, again)["delay_seconds"].tolist() == [60, 9, 7, 0, 60]
    assert (held.reads, held.writes) == (5, 3)


def test_one_call_tracks_many_vehicles():
    processor, held = started(stateful.TrackVehicle())
    rows = pd.DataFrame([(3, "r", "v", 3.0), (1, "r", "v", 1.0), (2, "r", None, 2.0), (4, None, "v", 4.0)], columns=["arrival_seq", "route_id", "vehicle_id", "latitude"])
    rows = rows.assign(**{name: None for name in stateful.DELAYED.names if name not in rows} | {"longitude": 0.0, "timestamp": 5})
    got = called(processor, rows)
    assert got["was_latitude"].fillna(-1).tolist() == [-1, -1, 1, -1]
    assert {key: place[0] for key, place in held.rows.items()} == {("r", "v"): 3.0, ("r", None): 2.0, (None, "v"): 4.0}
    got = called(processor, rows.assign(arrival_seq=rows["arrival_seq"] + 4))
    assert got["was_latitude"].tolist() == [3, 2, 1, 4] and held.reads == 6 and held.writes == 6


def told(rows):
    """(arrival_seq, cell, vehicle_id, timestamp, stays, asks)"""
    frame = pd.DataFrame(rows, columns=["arrival_seq", "t", "vehicle_id", "timestamp", "stays", "asks"])
    fixed = {"route_id": "r", "y": 0, "x": 0, "latitude": 1.0, "longitude": 1.0, "bearing": 0.0, "delay_seconds": 0}
    return frame.assign(**fixed | {"agency_id": None, "route_short_name": None, "trip_id": None})


@pytest.mark.parametrize("ttl_ms", [None, 1000])
def test_a_cell_is_read_and_written_once_a_batch(ttl_ms):
    processor, held = started(stateful.FlagInCell(Settings(), ttl_ms))
    many = told([(n, n % 2, f"v{n}", 100, True, False) for n in range(400)] + [(401, 0, None, 5000, True, True), (402, 1, "v1", 100, True, True)])
    got = called(processor, many, now=10_000)
    assert got[["arrival_seq", "is_bunching"]].values.tolist() == [[401, False], [402, True]]
    assert (held.reads, held.writes) == (2, 2) and sorted(held.rows) == [("r", 0, 0, 0), ("r", 1, 0, 0)]
    left = told([(n, 0, f"v{n}", 100, False, False) for n in range(500, 900)] + [(n + 1000, 0, f"v{n}", 100, False, False) for n in range(0, 400, 2)])
    called(processor, left, now=10_500)
    later = called(processor, told([(2000, 0, "w", 110, True, True), (2001, 0, "w", 5010, True, True), (2002, 1, "w", 110, True, True)]), now=10_999)
    assert later["is_bunching"].tolist() == [False, True, True]
    late = called(processor, told([(3000, 0, "u", 5010, True, True), (3001, 1, "v1", 100, True, True), (3002, 1, "w", 110, True, True)]), now=11_500)
    # With a limit of a second the vehicles of the first batch are forgotten, those of the later ones not.
    assert late["is_bunching"].tolist() == [True, True, True]
    gone = called(processor, told([(4000, 1, "u", 100, True, True)]), now=99_000)
    assert gone["is_bunching"].tolist() == [ttl_ms is None]
