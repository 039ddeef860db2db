from __future__ import annotations

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from tramline.functions import clock, geo, labels


def lit(*values):
    return [F.lit(v) for v in values]


def test_distance_of_a_point_to_itself_is_zero(values):
    assert values(geo.haversine_m(*lit(47.4, 8.55, 47.4, 8.55)))[0] == 0


def test_a_degree_of_latitude_is_about_111_km(values):
    assert values(geo.haversine_m(*lit(59.5, 18.1, 60.5, 18.1)))[0] == pytest.approx(111_000, rel=0.02)


def test_distance_crosses_the_date_line(values):
    east, around = values(
        geo.haversine_m(*lit(0.0, 0.0, 0.0, 0.002)), geo.haversine_m(*lit(0.0, 179.999, 0.0, -179.999))
    )
    assert around == pytest.approx(east, rel=1e-6)


@pytest.mark.parametrize(("a", "b", "gap"), [(33, 71, 38), (341, 15, 34), (25, 205, 180), (10, 730, 0)])
def test_bearing_gap(values, a, b, gap):
    assert values(geo.bearing_gap_deg(*lit(float(a), float(b))))[0] == gap


@pytest.mark.parametrize(
    ("route", "agency", "short"),
    [
        ("77_K4", "77", "K4"),
        ("880_1204", "880", "1204"),
        ("77_K4_Z", "77", "K4_Z"),
        ("58", "58", "58"),
        ("_9", "", "9"),
        ("", "", ""),
    ],
)
def test_route_id_is_split_at_its_first_underscore(values, route, agency, short):
    got = values(labels.route_agency(F.lit(route)), labels.route_short_name(F.lit(route)))
    assert got == (agency, short)


def test_status_puts_bunching_before_lateness(values):
    rows = [(True, 0), (True, 999), (False, 400), (False, 300), (False, 30)]
    got = [values(labels.status(*lit(*row)), labels.status_rgba(*lit(*row))) for row in rows]
    red, amber, green = [255, 0, 0, 200], [255, 165, 0, 200], [0, 200, 0, 200]
    assert got == [
        ("bunching", red),
        ("bunching", red),
        ("late", amber),
        ("on time", green),
        ("on time", green),
    ]


def test_yes_no(values):
    assert values(labels.yes_no(F.lit(True)), labels.yes_no(F.lit(False))) == ("Yes", "No")


def test_axis_label_keeps_short_names_and_cuts_long_ones(values):
    short, exact, long = values(
        labels.axis_label(F.lit("Harbour R1")),
        labels.axis_label(F.lit("x" * 18)),
        labels.axis_label(F.lit("Foxtrot Mobility Northern Region"), 18),
    )
    assert short == "Harbour R1"
    assert exact == "x" * 18
    assert long == "Foxtrot Mobility …" and len(long) == 18


def test_operator_label_falls_back_to_the_id(spark):
    agencies = spark.createDataFrame([("2503", "Bravo Transit")], "agency_id string, agency_name string")
    rows = spark.createDataFrame([("2503",), ("999999",), (None,)], "agency_id string")
    got = {r.agency_id: r.operator_name for r in labels.add_operator_name(rows, agencies).collect()}
    assert got == {"2503": "Bravo Transit", "999999": "Unknown operator (999999)", None: None}


# Daylight saving ended at 2024-04-06 16:00 UTC: 02:59:59 was followed by 02:00:00 again.
@pytest.mark.parametrize(
    ("epoch", "local"),
    [
        (1712419199, dt.datetime(2024, 4, 7, 2, 59, 59)),
        (1712419200, dt.datetime(2024, 4, 7, 2, 0, 0)),
        (1700000000, dt.datetime(2023, 11, 15, 9, 13, 20)),
        (0, dt.datetime(1970, 1, 1, 10, 0, 0)),
        (5_000_000_000, dt.datetime(2128, 6, 11, 18, 53, 20)),
    ],
)
@pytest.mark.parametrize("session_zone", ["UTC", "America/New_York"])
def test_local_time_follows_daylight_saving_in_any_session(spark, values, epoch, local, session_zone):
    spark.conf.set("spark.sql.session.timeZone", session_zone)
    try:
        time = clock.local_time(F.lit(epoch).cast("long"))
        got = values(time, clock.hour_of(time), clock.wall_seconds(time))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got[:2] == (local, local.replace(minute=0, second=0))
    assert got[2] == (local - dt.datetime(1970, 1, 1)) / dt.timedelta(seconds=1)


def test_folder_keys_are_utc_and_padded(values):
    assert values(*clock.partition_keys(F.lit(1712447999).cast("long"))) == ("2024", "04", "06")
    assert values(*clock.partition_keys(F.lit(1712448000).cast("long"))) == ("2024", "04", "07")


def test_numbers_do_not_depend_on_argument_order(values):
    there = geo.haversine_m(*lit(-33.87, 151.21, -33.9, 151.1))
    back = geo.haversine_m(*lit(-33.9, 151.1, -33.87, 151.21))
    a, b = values(there, back)
    assert math.isclose(a, b, rel_tol=1e-12)
