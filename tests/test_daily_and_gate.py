"""Gold merged from days, batches behind the gate, functions for SQL."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from test_plans import staged
from tramline import schemas
from tramline.functions import catalog
from tramline.functions.geo import bearing_gap_deg, haversine_m
from tramline.functions.labels import route_agency, route_short_name
from tramline.plans import daily, gate, marts
from tramline.settings import Settings

DAY = 86_400
LOOSE = Settings(headway_min_gaps=0, min_vehicles=1)


def feed(seed, days=4):
    """Events around midnight and over days, trips that run over midnight, nulls everywhere."""
    rng = random.Random(seed)
    rows = []
    for n in range(700):
        route = rng.choice(["1_x", "1_y", "2_x", None])
        ts = 1_712_000_000 + rng.randrange(days) * DAY + rng.choice([rng.randrange(DAY), 46_000 + rng.randrange(2500)])
        rows.append((rng.choice([f"v{rng.randrange(30)}", None]), route, rng.choice([f"t{rng.randrange(90)}", None]), ts, rng.choice([None, rng.randrange(-50, 900)]), rng.random() < 0.2))
    return rows


def built(spark, path, events, order=None, **knobs):
    gold = daily.DailyGold(spark, str(path), settings=LOOSE, **knobs)
    by_day = events.withColumn("event_day", daily.day_of(F.col("event_time"))).cache()
    for day in order or sorted(r[0] for r in by_day.select("event_day").distinct().collect()):
        gold.build_day(by_day.filter(F.col("event_day") == day), day)
    return gold


def rows_of(frame):
    rounded = (tuple(round(x, 9) if isinstance(x, float) else x for x in row) for row in map(tuple, frame.collect()))
    return sorted(rounded, key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_merged_days_equal_the_rebuilt_tables(spark, tmp_path, seed):
    events = staged(spark, feed(seed)).cache()
    agencies = spark.createDataFrame([("1", "One")], schemas.AGENCY)
    gold = built(spark, tmp_path / "gold", events)
    assert len(gold.days()) >= 4
    assert rows_of(gold.busiest_routes()) == rows_of(marts.busiest_routes(events))
    assert rows_of(gold.operator_performance(agencies)) == rows_of(marts.operator_performance(events, agencies, LOOSE))
    assert rows_of(gold.headway_adherence()) == rows_of(marts.headway_adherence(events, LOOSE))
    # Days merge in any order, and a day that is built again changes nothing.
    shuffled = random.Random(seed).sample(gold.days(), len(gold.days()))
    assert rows_of(gold.headway_adherence(shuffled)) == rows_of(gold.headway_adherence())
    last = gold.days()[-1]
    gold.build_day(events.filter(daily.day_of(F.col("event_time")) == last), last)
    assert rows_of(gold.busiest_routes(shuffled)) == rows_of(marts.busiest_routes(events))
    assert gold.operator_performance(agencies, []).count() == 0


def test_a_new_day_reads_its_own_events_and_summaries(spark, tmp_path):
    events = staged(spark, feed(3))
    by_day = str(tmp_path / "staged")
    events.withColumn("event_day", daily.day_of(F.col("event_time"))).write.partitionBy("event_day").parquet(by_day)
    days = sorted(r[0] for r in spark.read.parquet(by_day).select(F.col("event_day").cast("string")).distinct().collect())
    gold = daily.DailyGold(spark, str(tmp_path / "gold"), settings=LOOSE)
    for day in days:
        part = spark.read.parquet(f"{by_day}/event_day={day}")
        assert all(f"event_day={day}" in file for file in part.inputFiles())
        gold.build_day(part, day)
    assert rows_of(gold.headway_adherence()) == rows_of(marts.headway_adherence(events, LOOSE))
    # Ids keep their numbers, and no two share one.
    numbers = spark.read.schema(daily._NUMBERS).option("recursiveFileLookup", True).parquet(str(tmp_path / "gold" / "numbers"))
    assert numbers.count() == numbers.select("kind", "id").distinct().count() == numbers.select("kind", "bucket", "place").distinct().count()


def test_sketches_are_near(spark, tmp_path):
    rows = [(f"v{n % 3000}", "1_x", f"t{n % 50}", 1_712_000_000 + n * 30, 0, False) for n in range(9000)]
    events = staged(spark, rows)
    got = built(spark, tmp_path / "gold", events, sketches=True).busiest_routes().first()
    assert abs(got.active_vehicle_count - 3000) < 150


# --- gate -------------------------------------------------------------------------------


def test_a_spoiled_batch_stays_unpublished(spark, tmp_path):
    path, ddl = str(tmp_path / "g"), None
    good = staged(spark, [("a", "1_x", "t", 1000, 5, False), ("b", "1_x", "t", 1000, 9000, True)])
    ddl = schemas.ddl(good.schema)
    assert gate.published(spark, path, ddl).count() == 0
    first = gate.publish_batch(good, path, "1")
    assert first.published and first.violations["delay_seconds is plausible"] == 1
    bad = staged(spark, [(None, "1_x", "t", 2000, 5, False), ("c", None, "t", 2000, None, False)])
    second = gate.publish_batch(bad, path, "2")
    assert not second.published and (second.violations["vehicle_id is present"], second.violations["route_id is present"]) == (1, 1)
    assert sorted(r.vehicle_id for r in gate.published(spark, path, ddl).collect()) == ["a", "b"]
    # Mended and tried again, it replaces itself; so does a batch that is published already.
    assert gate.publish_batch(bad.fillna("c").fillna("1_x"), path, "2").published
    assert gate.publish_batch(good, path, "1").published
    assert gate.published(spark, path, ddl).count() == 4
    report = {(r.batch, r.test): (r.severity, r.violations, r.published) for r in gate.audits(spark, path).collect()}
    assert report["1", "delay_seconds is plausible"] == ("warn", 1, True) and len(report) == 10


def test_grouped_tests_warn_and_do_not_stop(spark, tmp_path):
    rows = [("a", "1_x", "t", 1000 + n, 60, False) for n in range(7)] + [("b", "1_x", "t", 1712415600, 1, False), ("b", "1_x", "t", 1712419200, 2, False)]
    audit = gate.publish_batch(staged(spark, rows), str(tmp_path / "g"), "1")
    assert audit.published and audit.violations["delays keep changing"] == 1
    assert audit.violations["one event per vehicle and time"] == 1


def test_the_batch_is_read_once(spark, tmp_path):
    staged(spark, [("a", "1_x", "t", 1000, 5, False)]).write.parquet(str(tmp_path / "in"))
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    source = spark.read.parquet(str(tmp_path / "in"))
    gate.publish_batch(source.mapInArrow(counted, source.schema), str(tmp_path / "g"), "1")
    assert read.value == 1


# --- SQL --------------------------------------------------------------------------------


def test_sql_functions_equal_the_columns(spark):
    rows = [("2503_M90_X", -33.87, 151.2, 10.0), ("333", 0.0, 0.0, 350.0), ("_9", 89.9, -179.9, 180.5), ("", 1.0, 1.0, 0.0), (None, None, None, None)]
    frame = spark.createDataFrame(rows, "r string, lat double, lon double, b double")
    frame.createOrReplaceTempView("some")
    staged(spark, [("a", "1_x", "t", 1000, 5, False), ("b", "1_x", "t", 1000, 5, True)]).createOrReplaceTempView("some_staged")
    catalog.register(spark, "some_staged")
    got = spark.sql("SELECT route_agency(r), route_short(r), distance_m(lat, lon, -33.87D, 151.21D), bearing_gap(b, 350D) FROM some").collect()
    want = frame.select(
        route_agency(F.col("r")), route_short_name(F.col("r")),
        haversine_m(F.col("lat"), F.col("lon"), F.lit(-33.87), F.lit(151.21)), bearing_gap_deg(F.col("b"), F.lit(350.0)),
    ).collect()
    for one, other in zip(map(tuple, got), map(tuple, want)):
        assert one[:2] == other[:2]
        assert all(a == b if None in (a, b) else a == pytest.approx(b, rel=1e-12) for a, b in zip(one[2:], other[2:]))
    assert spark.sql("SELECT CAST(local_time(1712419200) AS STRING)").first()[0] == "2024-04-07 02:00:00"
    assert spark.sql("SELECT delay_label(true, 0), delay_label(false, 301), delay_label(false, 300)").first()[:] == ("bunching", "late", "on time")
    assert [tuple(r) for r in spark.sql("SELECT * FROM busiest(2)").collect()] == [("x", 2, 5.0, 1)]
    assert spark.sql("SELECT * FROM busiest(3)").count() == 0 and spark.sql("SELECT * FROM stale_delays(0)").count() == 2
    # Bodies are part of the plan: no Python, and nothing that is called row by row.
    plan = spark.sql("SELECT distance_m(lat, lon, 0D, 0D) FROM some")._jdf.queryExecution().toString()
    assert "Python" not in plan


def test_ids_of_a_day_meet_their_numbers_in_one_join(spark, tmp_path, monkeypatch):
    written = {}
    write = daily.DailyGold._write

    def noted(gold, rows, table, day):
        written[table] = rows._jdf.queryExecution().analyzed().toString()
        write(gold, rows, table, day)

    monkeypatch.setattr(daily.DailyGold, "_write", noted)
    rows = [("1", "a", f"v{n % 3}", f"a_{n % 2}", f"t{n}", None, n, n % 2 == 0) for n in range(12)]
    names = "route_short_name string, agency_id string, vehicle_id string, route_id string, trip_id string, event_time timestamp_ntz, delay_seconds bigint, is_bunching boolean"
    gold = daily.DailyGold(spark, str(tmp_path / "gold"))
    gold.build_day(spark.createDataFrame(rows, names), daily.NO_DAY)
    assert written["distinct"].count("Join ") == 1
    (row,) = gold.busiest_routes().collect()
    assert tuple(row) == ("1", 3, 5.5, 6)
