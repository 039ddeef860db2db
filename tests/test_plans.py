from __future__ import annotations

import datetime as dt
import statistics

import pytest
from pyspark.sql import functions as F

from tramline import schemas
from tramline.plans import dashboard, history, marts, quality
from tramline.plans.staging import stage_events
from tramline.settings import Settings

AGENCIES = [("1", "One"), ("2", "Two, Ltd"), ("3", "One")]


def silver(spark, rows):
    """Silver rows from (vehicle, route, trip, timestamp, delay, bunching)."""
    full = [
        (i, v, r, r and r.split("_")[0], r and r.split("_")[-1], t, -33.8, 151.2, 0.0, ts, d, b)
        for i, (v, r, t, ts, d, b) in enumerate(rows)
    ]
    return spark.createDataFrame(full, schemas.SILVER)


def staged(spark, rows):
    return stage_events(silver(spark, rows))


@pytest.fixture(scope="module")
def agencies(spark):
    return spark.createDataFrame(AGENCIES, schemas.AGENCY)


# --- staging ----------------------------------------------------------------------------


def test_staging_keeps_the_lowest_delay_then_the_calm_row_and_nulls_last(spark):
    rows = staged(
        spark,
        [
            ("a", "1_x", "t", 100, 30, False),
            ("a", "1_x", "t", 100, 10, True),
            ("a", "1_x", "t", 100, 10, False),
            ("a", "1_x", "t", 100, None, None),
            ("b", "1_x", "t", 100, None, None),
            ("a", "1_x", "t", 101, 99, None),
            ("a", "1_x", "t", 101, 99, True),
        ],
    )
    got = sorted((r.vehicle_id, r.event_time, r.delay_seconds, r.is_bunching) for r in rows.collect())
    first = dt.datetime(1970, 1, 1, 10, 1, 40)
    assert got == [
        ("a", first, 10, False),
        ("a", first + dt.timedelta(seconds=1), 99, True),
        ("b", first, None, None),
    ]


def test_staging_thins_groups_before_the_shuffle(spark):
    plan = stage_events(silver(spark, [("a", "1_x", "t", 1, 1, True)]))._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


# --- gold -------------------------------------------------------------------------------


def test_busiest_routes(spark):
    rows = staged(
        spark,
        [("a", "1_x", "t", 1, 10, True), ("a", "1_x", "t", 2, 20, None), ("b", "2_x", "t", 1, 60, False), ("c", "1_y", "t", 1, None, True)],
    )
    assert [tuple(r) for r in marts.busiest_routes(rows).collect()] == [("x", 2, 30.0, 1), ("y", 1, None, 1)]


def test_operator_performance_groups_by_id_and_needs_three_vehicles(spark, agencies):
    rows = [(f"v{i}", "1_x", "t", 1, 10 * i, i == 0) for i in range(3)]
    rows += [(f"v{i}", f"9_r{i}", "t", 2, 100, False) for i in range(4)] + [("v0", "9_r0", "t", 3, None, True)]
    rows += [("v0", "2_z", "t", 4, 0, False), ("v1", "2_z", "t", 4, 0, False)]
    rows += [(f"w{i}", "3_x", "t", 1, 0, False) for i in range(3)]
    got = [tuple(r) for r in marts.operator_performance(staged(spark, rows), agencies).collect()]
    assert got == [
        ("Unknown operator (9)", "9", 4, 4, 5, 100.0, 1),
        ("One", "1", 3, 1, 3, 10.0, 1),
        ("One", "3", 3, 1, 3, 0.0, 0),
    ]


def test_delay_by_hour_uses_the_local_hour(spark):
    # 15:30 and 16:30 UTC are both half past two on the night the clock is set back.
    rows = staged(spark, [("a", "1_x", "t", 1712417400, 10, False), ("a", "1_x", "t", 1712421000, 30, False)])
    assert [tuple(r) for r in marts.delay_by_hour(rows).collect()] == [(dt.datetime(2024, 4, 7, 2), 20.0, 2)]


def gaps_by_hand(starts):
    ordered = sorted(starts)
    return [b - a for a, b in zip(ordered, ordered[1:])]


def departures(route, starts):
    trips = [f"{route}{i:03}" for i in range(len(starts))]
    return [(trip, f"1_{route}", trip, 1_700_000_000 + s, 0, False) for trip, s in zip(trips, starts)]


def test_headways_match_a_hand_count_across_days_and_shared_seconds(spark):
    starts = {
        "busy": [0, 0, 0, 0, 600, 700, 700, 2500, 90_000, 90_060, 260_000, 261_799, 261_800],
        "few": [0, 60, 120],
        "broken": [i * 1800 for i in range(12)],
    }
    rows = staged(spark, [r for name, s in starts.items() for r in departures(name, s)])
    got = {r.route_short_name: tuple(r)[1:] for r in marts.headway_adherence(rows).collect()}
    kept = [g for g in gaps_by_hand(starts["busy"]) if g < 1800]
    assert got.keys() == {"busy"}
    count, mean, spread = got["busy"]
    assert count == len(kept)
    assert mean == pytest.approx(statistics.mean(kept), rel=1e-12)
    assert spread == pytest.approx(statistics.stdev(kept), rel=1e-12)

    listed = marts.headway_gaps(rows).filter("route_short_name = 'busy'").orderBy("first_seen_at", "trip_id")
    gaps = [r.gap_to_previous_trip for r in listed.collect()]
    assert gaps == [None, *gaps_by_hand(starts["busy"])]


def test_trips_without_a_time_have_no_headway(spark):
    """Eight trips without a time give no gap; among timed ones they change nothing."""
    events = spark.createDataFrame(
        [("none", f"t{i}", None) for i in range(8)]
        + [("some", f"u{i}", dt.datetime(2024, 4, 3, 9, 0, 11 * i)) for i in range(5)]
        + [("some", "lost", None), (None, "odd", None)],
        "route_short_name string, trip_id string, event_time timestamp_ntz",
    )
    gaps = marts.headway_gaps(events)
    assert gaps.count() == 15
    listed = [(r.trip_id, r.gap_to_previous_trip) for r in gaps.filter("gap_to_previous_trip IS NOT NULL").collect()]
    assert sorted(listed) == [(f"u{i}", 11.0) for i in range(1, 5)]
    kept = marts.headway_adherence(events, Settings(headway_min_gaps=0)).collect()
    assert [(r.route_short_name, r.trip_count, r.average_gap_seconds) for r in kept] == [("some", 4, 11.0)]


def test_headway_counts_a_trip_once_where_it_was_first_seen(spark):
    rows = [("v", "1_x", "t1", 1000, 0, False), ("v", "1_x", "t1", 5000, 0, False), ("v", "1_x", "t2", 1100, 0, False)]
    gaps = {r.trip_id: r.gap_to_previous_trip for r in marts.headway_gaps(staged(spark, rows)).collect()}
    assert gaps == {"t1": None, "t2": 100}


def test_routes_without_a_short_name_form_a_group(spark):
    rows = [("v", None, f"t{i}", 1000 + 10 * i, 0, False) for i in range(8)]
    events = staged(spark, rows)
    assert [r.gap_to_previous_trip for r in marts.headway_gaps(events).orderBy("first_seen_at").collect()] == [None] + [10] * 7
    assert [(r.route_short_name, r.trip_count) for r in marts.headway_adherence(events).collect()] == [(None, 7)]


def test_top_routes_repeats_routes_when_there_are_few(spark):
    # (route, delay, vehicles, readings): the last two have too small a sample.
    routes = [("x", 5, 3, 20), ("y", 9, 3, 20), ("small", 99, 3, 19), ("lone", 99, 2, 40)]
    rows = [
        (f"{route}{i % vehicles}", f"1_{route}", "t", i, delay, False)
        for route, delay, vehicles, readings in routes
        for i in range(readings)
    ]
    got = [(r.route_short_name, r.average_delay_seconds) for r in marts.top_routes_by_delay(staged(spark, rows)).collect()]
    assert sorted(got) == [("x", 5.0), ("x", 5.0), ("y", 9.0), ("y", 9.0)]


# --- dashboard --------------------------------------------------------------------------


def live(spark, rows):
    """Live rows from (vehicle, route, lat, lon, delay, bunching)."""
    full = [(v, r, r.split("_")[0], r.split("_")[-1], "t", lat, lon, 100, d, b) for v, r, lat, lon, d, b in rows]
    return spark.createDataFrame(full, schemas.LIVE)


@pytest.fixture(scope="module")
def board(spark, agencies):
    rows = live(
        spark,
        [
            ("a", "1_x", 47.0, 8.0, 0, True),
            ("b", "1_x", 47.5, 9.5, 400, False),
            ("c", "2_y", 47.2, 8.6, 101, False),
            ("d", "3_x", 47.2, 8.6, 100, False),
            ("e", "2_y", 0.0, 0.0, 9999, True),
            ("f", "2_y", 0.0, 8.0, 4, None),
        ],
    )
    return dashboard.board_rows(rows, agencies)


def test_live_state_is_the_last_arrival_even_if_its_reading_is_older(spark):
    rows = silver(spark, [("a", "1_x", "t", 200, 90, False), ("a", "1_y", "t2", 100, 120, True), ("b", "1_x", "t", 5, 1, False)])
    got = sorted((r.vehicle_id, r.route_id, r.delay_seconds) for r in dashboard.live_state(rows).collect())
    assert got == [("a", "1_y", 120), ("b", "1_x", 1)]
    assert dashboard.live_state(rows).columns == schemas.LIVE_COLUMNS


def test_backend_value_types_are_undone(spark):
    rows = live(spark, [("a", "1_x", -33.87, 151.21, 90, True)])
    local, keyvalue = dashboard.as_local_values(rows), dashboard.as_keyvalue_values(rows)
    assert local.first().is_bunching == 1
    assert str(keyvalue.first().latitude).rstrip("0") == "-33.87"
    for stored in (local, keyvalue):
        row = dashboard.normalize_live(stored).first()
        assert (row.latitude, row.longitude, row.delay_seconds, row.is_bunching) == (-33.87, 151.21, 90.0, True)


def test_missing_short_names_become_route_ids(spark):
    rows = live(spark, [("a", "1_x", 1.0, 1.0, 0, False)])
    assert dashboard.normalize_live(rows.drop("route_short_name")).first().route_short_name == "1_x"
    blank = rows.withColumn("route_short_name", F.lit(None).cast("string"))
    assert dashboard.normalize_live(blank).first().route_short_name == "1_x"


def test_only_rows_at_exactly_zero_zero_are_dropped(spark):
    rows = spark.createDataFrame(
        [(0.0, 0.0, "a"), (-33.87, 151.21, "b"), (0.0, 151.0, "c"), (None, 0.0, "d")],
        "latitude double, longitude double, vehicle_id string",
    )
    assert sorted(r.vehicle_id for r in dashboard.with_valid_coordinates(rows).collect()) == ["b", "c", "d"]


def test_board_is_sorted_by_delay(board):
    rows = dashboard.vehicle_board(board).collect()
    assert [r.vehicle_id for r in rows] == ["b", "c", "d", "f", "a"]
    assert {r.vehicle_id: r.is_bunching_label for r in board.collect()} == {"a": "Yes", "b": "No", "c": "No", "d": "No", "f": None}


def test_network_figures(board):
    assert tuple(dashboard.network_kpis(board).first()) == (5, 121.0, 1)


def test_selection_beside_network(board):
    figures = dashboard.selection_vs_network(board, F.col("operator_name") == "One")
    row = figures.first()
    assert (row.selection_vehicles, row.selection_avg_delay, row.network_avg_delay) == (3, 500 / 3, 121.0)
    assert (row.selection_bunching, row.network_bunching) == (1, 1)
    assert (row.selection_bunching_rate, row.network_bunching_rate) == (pytest.approx(100 / 3), 25.0)
    assert row.avg_delay_delta == pytest.approx(500 / 3 - 121)
    bars = [tuple(r) for r in dashboard.comparison_rows(figures).collect()]
    assert bars == [("Selection", 500 / 3, 1), ("Network average", 121.0, 1)]


def test_options(board):
    routes = [tuple(r) for r in dashboard.route_options(board).collect()]
    # 1_x and 3_x share a label; the lower id is meant.
    assert routes == [("x", "One", "1_x", "x (One)"), ("y", "Two, Ltd", "2_y", "y (Two, Ltd)")]
    assert [r.operator_name for r in dashboard.operator_options(board).collect()] == ["One", "Two, Ltd"]


def test_view_fits_the_rows(spark, board):
    frame = board.filter(F.col("vehicle_id").isin("a", "b"))
    row = dashboard.view_bounds(frame).first()
    assert (row.latitude, row.longitude) == (47.25, 8.75)
    assert row.zoom == pytest.approx(7.5284, abs=1e-3)
    assert tuple(dashboard.view_bounds(frame.limit(0)).first()) == (-33.87, 151.21, 9.0)
    one_place = dashboard.view_bounds(frame.limit(1), padding=1.1, min_spread=0.003).first()
    assert one_place.zoom == pytest.approx(15.7353, abs=1e-3)
    assert dashboard.view_bounds(frame.limit(1), min_spread=1e-9).first().zoom == 16.0


def test_charts_show_the_top_fifteen(spark):
    gold = spark.createDataFrame([(f"route number {i:09}", i % 20) for i in range(40)], "name string, active_vehicle_count long")
    rows = dashboard.top_charted(gold, "name").collect()
    assert [r.active_vehicle_count for r in rows] == [19, 19, 18, 18, 17, 17, 16, 16, 15, 15, 14, 14, 13, 13, 12]
    assert rows[0].axis_label == "route number 0000…"


# --- history ----------------------------------------------------------------------------


def test_trend_has_every_minute_and_counts_repolled_rows_twice(spark):
    rows = silver(spark, [("a", "1_x", "t", ts, d, False) for ts, d in ((59, 10), (60, 30), (61, 60), (61, 60), (86_400 + 200, 5))])
    got = {r.minute: r.delay_seconds for r in history.delay_trend(rows).collect()}
    assert sorted(got) == list(range(0, 86_400 + 181, 60))
    assert {m: d for m, d in got.items() if d is not None} == {0: 10.0, 60: 50.0, 86_580: 5.0}
    assert history.delay_trend(rows.limit(0)).count() == 0


def test_trend_runs_its_input_once(spark):
    plan = history.delay_trend(silver(spark, [("a", "1_x", "t", 5, 1, False)]))
    plan.collect()
    assert "ReusedExchange" in plan._jdf.queryExecution().executedPlan().toString()


def test_operator_history_uses_the_ids_on_the_board(spark, board):
    rows = silver(spark, [("q", f"{agency}_x", "t", 1, 0, False) for agency in (1, 2, 3, 4)])
    got = history.operator_history(rows, board, "One")
    assert sorted(r.agency_id for r in got.collect()) == ["1", "3"]


# --- data tests -------------------------------------------------------------------------


def test_data_tests_find_violations_and_only_those(spark):
    rows = [
        (None, "1_x", "t", 1, 0, False),
        ("a", None, "t", 1, 0, False),
        ("a", "1_x", "t", 2, -3600, False),
        ("a", "1_x", "t", 3, 7200, False),
        ("a", "1_x", "t", 4, -3601, False),
        ("a", "1_x", "t", 5, 7201, False),
        ("a", "1_x", "t", 6, None, False),
        # The same wall clock, an hour apart.
        ("b", "1_x", "t", 1712417400, 0, False),
        ("b", "1_x", "t", 1712421000, 1, False),
    ]
    rows += [("c", "1_x", "t", 100 + i, 77, False) for i in range(6)]
    rows += [("d", "1_x", "t", 100 + i, 77, False) for i in range(5)]
    events = staged(spark, rows)
    found = {t.name: (t.severity, t.violations.count()) for t in quality.data_tests(events)}
    assert found == {
        "vehicle_id is present": ("error", 1),
        "route_id is present": ("error", 1),
        "delay_seconds is plausible": ("warn", 2),
        "one event per vehicle and time": ("warn", 1),
        "delays keep changing": ("warn", 1),
    }
    assert [tuple(r) for r in quality.stale_delays(events).collect()] == [("c", "x", 77, 6)]
    assert [tuple(r) for r in quality.stale_delays(events, Settings(stale_repeats=4)).collect()][1] == ("d", "x", 77, 5)
    counts = {r.checked: r.violations for r in quality.null_counts(events, ["vehicle_id", "route_id"]).collect()}
    assert counts == {"vehicle_id": 1, "route_id": 1}
