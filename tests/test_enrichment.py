"""The delay join and the bunching flag against a replay, one arrival at a time."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from tramline import schemas
from tramline.operators.last_known import attach_delay
from tramline.operators.proximity import bunching_arrivals, flag_bunching
from tramline.plans.enrich import enrich
from tramline.settings import Settings

# Small blocks and cell sizes, so that a few hundred rows exceed them.
TIGHT = Settings(arrivals_per_block=16, positions_per_cell=4)
WIDE = Settings()


def metres(a, b):
    half_lat = math.sin(math.radians(b[0] - a[0]) / 2)
    half_lon = math.sin(math.radians(b[1] - a[1]) / 2)
    h = half_lat**2 + math.cos(math.radians(a[0])) * math.cos(math.radians(b[0])) * half_lon**2
    return 2 * 6_371_000 * math.atan2(math.sqrt(h), math.sqrt(1 - h))


def replay(arrivals, s=WIDE):
    """(arrival_seq, delay, flag) of each position. Arrivals are dicts, updates have a delay."""
    delays, seen, out = {}, {}, []
    for row in sorted(arrivals, key=lambda r: r["arrival_seq"]):
        if "delay_seconds" in row:
            delays[row["trip_id"]] = row["delay_seconds"]
            continue
        here = (row["latitude"], row["longitude"], row["bearing"], row["timestamp"])
        on_route = seen.setdefault(row["route_id"], {})
        flag = False
        for vehicle, other in on_route.items():
            turn = abs(here[2] - other[2]) % 360
            if (
                vehicle != row["vehicle_id"]
                and abs(here[3] - other[3]) <= s.bunching_window_s
                and min(turn, 360 - turn) <= s.bunching_bearing_deg
                and metres(here, other) <= s.bunching_distance_m
            ):
                flag = True
        on_route[row["vehicle_id"]] = here
        out.append((row["arrival_seq"], delays.get(row["trip_id"], 0), flag))
    return sorted(out)


def position(seq, vehicle="a", lat=-33.87, lon=151.2, bearing=0.0, ts=1000, route="1_r", trip="t"):
    return {
        "arrival_seq": seq,
        "vehicle_id": vehicle,
        "route_id": route,
        "agency_id": route.split("_")[0],
        "route_short_name": route.split("_")[-1],
        "trip_id": trip,
        "latitude": float(lat),
        "longitude": float(lon),
        "bearing": float(bearing),
        "timestamp": ts,
    }


def update(seq, delay, trip="t"):
    return {"arrival_seq": seq, "trip_id": trip, "delay_seconds": delay}


def frames(spark, arrivals):
    positions = [[r[c] for c in schemas.POSITION.names] for r in arrivals if "vehicle_id" in r]
    updates = [[r[c] for c in schemas.TRIP_UPDATE.names] for r in arrivals if "vehicle_id" not in r]
    return (
        spark.createDataFrame(positions, schemas.POSITION),
        spark.createDataFrame(updates, schemas.TRIP_UPDATE),
    )


def enriched(spark, arrivals, settings):
    rows = enrich(*frames(spark, arrivals), settings)
    return sorted(tuple(r) for r in rows.select("arrival_seq", "delay_seconds", "is_bunching").collect())


def flags(spark, arrivals, settings=TIGHT):
    positions, _ = frames(spark, arrivals)
    return sorted(r.arrival_seq for r in flag_bunching(positions, settings).filter("is_bunching").collect())


def random_feed(seed, n=400, centre=(-33.87, 151.2)):
    """Half of the rows on one route, a third at one place, timestamps out of order."""
    rng = random.Random(seed)
    rows = []
    for seq in rng.sample(range(10 * n), n):
        if rng.random() < 0.2:
            rows.append(update(seq, rng.randrange(-100, 900), f"t{rng.randrange(4)}"))
            continue
        crowd = rng.random() < 0.33
        lat = 0.0 if crowd else centre[0] + rng.uniform(-0.006, 0.006)
        lon = 0.0 if crowd else centre[1] + rng.uniform(-0.006, 0.006)
        if lon > 180:
            lon -= 360
        rows.append(
            position(
                seq,
                vehicle=f"v{rng.randrange(12)}",
                lat=lat,
                lon=lon,
                bearing=rng.choice([0, 0, 90, 359.5, rng.uniform(0, 360)]),
                ts=1000 + seq // 4 + rng.choice([0, 0, -200, 130]),
                route="1_hot" if rng.random() < 0.5 else f"1_r{rng.randrange(3)}",
                trip=f"t{rng.randrange(4)}",
            )
        )
    return rows


@pytest.mark.parametrize("settings", [TIGHT, WIDE], ids=["tight", "wide"])
@pytest.mark.parametrize(
    ("seed", "centre"),
    [(1, (-33.87, 151.2)), (2, (0.0, 179.999)), (3, (59.998, 10.0)), (4, (89.9, 0.0)), (5, (-60.002, -179.999))],
)
def test_enrichment_equals_a_replay(spark, seed, centre, settings):
    rows = random_feed(seed, centre=centre)
    want = replay(rows)
    assert 0 < sum(flag for _, _, flag in want) < len(want)
    assert enriched(spark, rows, settings) == want


def test_delay_is_the_one_that_arrived_last_before(spark):
    rows = [
        position(1),
        update(2, 60),
        position(3),
        update(20, 120),
        update(21, 90, trip="other"),
        position(40),
        position(100),
        position(101, trip="unknown"),
    ]
    positions, updates = frames(spark, rows)
    got = {r.arrival_seq: r.delay_seconds for r in attach_delay(positions, updates, TIGHT).collect()}
    assert got == {1: 0, 3: 60, 40: 120, 100: 120, 101: 0}


def test_delay_join_keeps_columns_and_works_without_updates(spark):
    positions, updates = frames(spark, [position(1), position(2)])
    got = attach_delay(positions, updates)
    assert got.columns == [*positions.columns, "delay_seconds"]
    assert [r.delay_seconds for r in got.collect()] == [0, 0]


def test_limits_are_inclusive(spark):
    # At the equator 500 m are this many degrees of latitude, give or take rounding.
    reach = math.degrees(500 / 6_371_000)
    assert flags(spark, [position(1, "a", lat=0), position(2, "b", lat=reach * 0.999999)]) == [2]
    assert flags(spark, [position(1, "a", lat=0), position(2, "b", lat=reach * 1.00001)]) == []
    assert flags(spark, [position(1, "a", ts=1000), position(2, "b", ts=1120)]) == [2]
    assert flags(spark, [position(1, "a", ts=1000), position(2, "b", ts=1121)]) == []
    assert flags(spark, [position(1, "a", ts=1120), position(2, "b", ts=1000)]) == [2]
    assert flags(spark, [position(1, "a", bearing=340), position(2, "b", bearing=25)]) == [2]
    assert flags(spark, [position(1, "a", bearing=340), position(2, "b", bearing=25.01)]) == []


def test_only_the_later_arrival_is_flagged_and_never_by_itself(spark):
    assert flags(spark, [position(1, "a"), position(2, "a"), position(3, "a")]) == []
    assert flags(spark, [position(1, "a"), position(2, "b"), position(3, "a")]) == [2, 3]


def test_an_older_reading_replaces_a_newer_one_when_it_arrives_later(spark):
    rows = [position(1, "a", ts=1000), position(2, "a", ts=500), position(3, "b", ts=1000)]
    assert flags(spark, rows) == []
    assert flags(spark, [*rows, position(4, "c", ts=500)]) == [4]


def test_a_vehicle_that_left_no_longer_counts(spark):
    rows = [position(1, "a"), position(20, "a", lat=-34.5), position(40, "b")]
    assert flags(spark, rows) == []


def test_routes_do_not_see_each_other(spark):
    assert flags(spark, [position(1, "a", route="1_x"), position(2, "b", route="1_y")]) == []


def test_vehicles_without_a_fix_bunch_at_zero(spark):
    rows = [position(i, f"v{i}", lat=0, lon=0) for i in range(1, 30)]
    assert flags(spark, rows) == list(range(2, 30))


def test_repeated_readings_of_a_parked_vehicle(spark):
    rows = [position(1, "a")] + [position(i, "a") for i in range(5, 60, 5)] + [position(62, "b")]
    assert flags(spark, rows) == [62]
    rows.append(position(63, "a"))
    assert flags(spark, rows) == [62, 63]


def test_every_flag_is_listed_once(spark):
    positions, _ = frames(spark, random_feed(9))
    listed = [r.arrival_seq for r in bunching_arrivals(positions, TIGHT).collect()]
    assert len(listed) == len(set(listed))
    assert sorted(listed) == [seq for seq, _, flag in replay(random_feed(9)) if flag]


def test_negative_arrival_numbers_have_blocks_too(spark):
    rows = [{**row, "arrival_seq": row["arrival_seq"] - 2000} for row in random_feed(11)]
    assert enriched(spark, rows, TIGHT) == replay(rows)
