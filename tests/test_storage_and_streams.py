from __future__ import annotations

import dataclasses
import datetime as dt
import random
import re
import time
import uuid

import pandas as pd
import pytest
from pyspark.sql import functions as F

from test_enrichment import TIGHT, metres, position, random_feed, replay, update
from tramline import schemas
from tramline.functions.clock import partition_keys
from tramline.operators import arrival
from tramline.plans import build
from tramline.plans.dashboard import live_state
from tramline.settings import Settings
from tramline.sources import feed, tables, topics
from tramline.sources.folders import BatchNumbers, Folder, KeyedTable, VersionedTable, compact, drop_expired
from tramline.session import cluster_conf, scratch_folder
from tramline.streaming import buffered, microbatch, pipeline, sinks, stateful
from tramline.streaming.arrivals import ARRIVAL_COLUMNS
from tramline.streaming.microbatch import BatchEnricher, Places

DAY = 86_400
TODAY = dt.date(2024, 4, 10)
TODAY_EPOCH = int(dt.datetime(2024, 4, 10, tzinfo=dt.timezone.utc).timestamp())


def write_silver(spark, path, days_back):
    rows = [
        (i, "a", "1_x", "1", "x", "t", 0.0, 0.0, 0.0, TODAY_EPOCH - DAY * back, back, False)
        for i, back in enumerate(days_back)
    ]
    frame = spark.createDataFrame(rows, schemas.SILVER)
    frame.select("*", *partition_keys(F.col("timestamp"))).write.mode("append").partitionBy(
        "year", "month", "day"
    ).parquet(path)


# --- decoding and fan-out ---------------------------------------------------------------


def messages(spark, entities):
    return spark.createDataFrame(
        list(enumerate(entities)), schemas.T.StructType([schemas.ARRIVAL, schemas.T.StructField("entity", schemas.ENTITY)])
    )


def vehicle(trip="north-4", route="58", place=(47.4, 8.55, None), timestamp=1_711_000_000):
    return {"vehicle": {"trip": {"trip_id": trip, "route_id": route}, "vehicle": {"id": "tram-12"}, "position": place, "timestamp": timestamp}}


def test_positions_are_decoded(spark):
    rows = feed.decode_positions(
        messages(spark, [vehicle(), vehicle(trip=""), vehicle(trip=None), {"trip_update": {"trip": {"trip_id": "t"}}}, vehicle(route=None, place=None, timestamp=None), {}])
    ).collect()
    assert [r.arrival_seq for r in rows] == [0, 4]
    first, bare = rows
    assert (first.vehicle_id, first.route_id, first.agency_id, first.route_short_name) == ("tram-12", "58", "58", "58")
    assert (first.latitude, first.longitude) == (pytest.approx(47.4, abs=1e-4), pytest.approx(8.55, abs=1e-4))
    assert (bare.route_id, bare.agency_id, bare.latitude, bare.bearing, bare.timestamp) == ("", "", 0.0, 0.0, 0)


def test_updates_take_the_next_stop_and_its_arrival_first(spark):
    def stops(*pairs, trip="south-9"):
        delays = [{k: {"delay": d} for k, d in pair.items()} for pair in pairs]
        return {"trip_update": {"trip": {"trip_id": trip}, "stop_time_update": delays}}

    rows = feed.decode_trip_updates(
        messages(
            spark,
            [
                stops({"arrival": 135}),
                stops({"departure": -5}),
                stops({"arrival": 0, "departure": 9}),
                stops({"arrival": None, "departure": 7}),
                stops(),
                stops({}, {"arrival": 60}),
                stops({"arrival": 10}, trip=""),
                vehicle(),
            ],
        )
    ).collect()
    assert [(r.arrival_seq, r.trip_id, r.delay_seconds) for r in rows] == [
        (0, "south-9", 135), (1, "south-9", -5), (2, "south-9", 0), (3, "south-9", 7)
    ]


def test_fan_out_sends_one_readable_message_per_entity(spark):
    snapshots = spark.createDataFrame(
        [(1, [("e1", b"one"), ("e2", b"\x00two" * 40)]), (2, []), (3, [("e3", b"")])],
        "snapshot_id long, entities array<struct<id:string,payload:binary>>",
    )
    sent = feed.fan_out(snapshots, "some-topic").withColumn("back", feed.message_bytes(F.col("value")))
    got = [(r.snapshot_id, r.topic, r.entity_id, bytes(r.back)) for r in sent.orderBy("entity_id").collect()]
    assert got == [(1, "some-topic", "e1", b"one"), (1, "some-topic", "e2", b"\x00two" * 40), (3, "some-topic", "e3", b"")]
    assert all("\n" not in r.value for r in sent.collect())


def test_messages_are_counted_while_they_are_written(spark):
    snapshots = spark.createDataFrame([([("e1", b"one"), ("e2", b"two")],), ([("e3", b"")],)], "entities array<struct<id:string,payload:binary>>")
    sent, counted = topics.count_while_writing(feed.fan_out(snapshots, "some-topic"))
    counted.write.format("noop").mode("overwrite").save()
    assert sent.get["messages"] == 3


def kafka_rows(spark, rows):
    """(time, topic, partition, offset) of messages as the Kafka source gives them."""
    frame = spark.createDataFrame(rows, "ms long, topic string, partition int, offset long")
    return frame.select(F.timestamp_millis("ms").alias("timestamp"), "topic", "partition", "offset").select(
        topics.kafka_arrival().alias("arrival"), F.struct("topic", "partition", "offset").alias("tag")
    )


def test_arrival_numbers_neither_wrap_nor_collide(spark):
    ms = 1_700_000_000_000
    rows = [(ms, "b", 3, o) for o in range(4090, 4103)]
    rows += [(ms, topic, p, 7) for topic in "ab" for p in (0, 1, 1023, 1024, 2048)]
    rows += [(ms + 3_600_000 * h + d, "a", 0, 8 + 2 * h + d) for h in range(5) for d in (0, 1)]
    numbered = arrival.numbered(kafka_rows(spark, rows), after=9).collect()
    assert sorted(r.arrival_seq for r in numbered) == list(range(10, 10 + len(rows)))
    order = [tuple(r.tag) for r in sorted(numbered, key=lambda r: r.arrival_seq)]
    assert order == [(t, p, o) for _, t, p, o in sorted(rows)]


def test_a_hot_trip_is_cut_into_few_blocks_under_source_numbers(spark):
    """One message per 5 ms, a third of them on one trip."""
    messages = spark.range(30_000).select(
        F.timestamp_millis(F.lit(1_700_000_000_000) + 5 * F.col("id")).alias("timestamp"),
        F.lit("positions").alias("topic"), (F.col("id") % 12).cast("int").alias("partition"),
        F.floor(F.col("id") / 12).alias("offset"), "id",
    ).select(topics.kafka_arrival().alias("arrival"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("t"), F.col("id") % 500)).alias("trip_id"))
    numbered = arrival.numbered(messages)
    blocks = numbered.select("trip_id", arrival.block_start(F.col("arrival_seq"), 10_000)).distinct()
    assert numbered.select("arrival_seq").distinct().count() == 30_000
    assert blocks.filter("trip_id = 'hot'").count() == 3 and blocks.count() <= 1503


# --- silver folders ---------------------------------------------------------------------


def test_recent_history_reads_the_last_days_only(spark, tmp_path):
    path = str(tmp_path / "silver")
    write_silver(spark, path, [0, 1, 1, 2, 30])
    rows = tables.read_history(spark, path, TODAY)
    assert rows.columns == schemas.HISTORY_COLUMNS
    assert [r.delay_seconds for r in rows.collect()] == [1, 1, 0]
    # No other folder is listed: one that is no folder of files does not disturb the recent read.
    (tmp_path / "silver" / "year=2024" / "month=01").mkdir()
    (tmp_path / "silver" / "year=2024" / "month=01" / "day=01").write_text("not a folder")
    assert sorted(rows.inputFiles()) and all("month=04/day=" in f for f in rows.inputFiles())
    assert tables.read_history(spark, path, TODAY).count() == 3
    wider = tables.read_history(spark, path, TODAY, Settings(recent_days=3))
    assert wider.count() == 4


def test_history_falls_back_to_everything_then_to_nothing(spark, tmp_path):
    path = str(tmp_path / "silver")
    write_silver(spark, path, [30, 40])
    assert tables.read_history(spark, path, TODAY).count() == 2
    missing = tables.read_history(spark, str(tmp_path / "none"), TODAY)
    assert missing.columns == schemas.HISTORY_COLUMNS and missing.count() == 0


def test_files_of_an_older_schema_read_with_nulls(spark, tmp_path):
    path = str(tmp_path / "silver")
    write_silver(spark, path, [0])
    old = spark.createDataFrame([("bus-1", "333", "t1", TODAY_EPOCH, 10, False)], "vehicle_id string, route_id string, trip_id string, timestamp long, delay_seconds long, is_bunching boolean")
    old.write.parquet(f"{path}/year=2024/month=04/day=09")
    for rows in (tables.read_silver(spark, path), tables.read_merged(spark, path)):
        got = {r.vehicle_id: (r.agency_id, r.route_short_name, r.bearing) for r in rows.collect()}
        assert got == {"a": ("1", "x", 0.0), "bus-1": (None, None, None)}


def test_retention_removes_old_days_and_nothing_else(spark, tmp_path):
    path = str(tmp_path / "silver")
    write_silver(spark, path, [0, 89, 90, 91, 400])
    removed = drop_expired(spark, path, TODAY)
    assert len(removed) == 2
    assert sorted(r.delay_seconds for r in tables.read_silver(spark, path).collect()) == [0, 89, 90]
    assert drop_expired(spark, path, TODAY) == []


def test_agency_ids_stay_text_and_quoted_commas_survive(spark, tmp_path):
    file = tmp_path / "agencies.csv"
    file.write_text('agency_id,agency_name\n0701,"Buses, Trams"\nX0000,Rail\n')
    got = [tuple(r) for r in tables.read_agencies(spark, str(file)).collect()]
    assert got == [("0701", "Buses, Trams"), ("X0000", "Rail")]


def test_gold_is_rebuilt_from_staging_written_once(spark, tmp_path):
    database = f"gold_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{tmp_path / 'warehouse'}'")
    spark.sql(f"USE {database}")
    agencies = spark.createDataFrame([("1", "One")], schemas.AGENCY)
    try:
        for days in ([0, 1], [0, 1, 2]):
            path = str(tmp_path / f"silver{len(days)}")
            write_silver(spark, path, days)
            staging = str(tmp_path / "staging")
            checks = build.rebuild_gold(spark, tables.read_silver(spark, path), agencies, staging)
        names = {t.name for t in spark.catalog.listTables() if not t.isTemporary}
        assert names == {"busiest_routes", "delay_by_hour", "operator_performance", "headway_adherence", "top_routes_by_delay", "agency_lookup"}
        assert build.read_gold(spark, "delay_by_hour").count() == 3
        assert [tuple(r) for r in build.read_gold(spark, "busiest_routes").collect()] == [("x", 1, 1.0, 0)]
        assert spark.table(build.STAGED_VIEW).count() == 3
        assert [c.violations.count() for c in checks] == [0] * 5
    finally:
        spark.catalog.dropTempView(build.STAGED_VIEW)
        spark.sql("USE default")
        spark.sql(f"DROP DATABASE {database} CASCADE")


def test_cluster_settings_follow_the_size_of_the_run():
    small, large = cluster_conf(1 << 30, 1000), cluster_conf(20 << 40, 1000)
    assert small["spark.sql.shuffle.partitions"] == "3000"
    assert large["spark.sql.shuffle.partitions"] == str((20 << 40) // (128 << 20))


def test_scratch_lies_in_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir", None)
    first, second = scratch_folder(spark, "x"), scratch_folder(spark, "x")
    assert first != second
    assert shared is None or first.startswith(shared)


# --- versioned tables -------------------------------------------------------------------


def test_versions_are_complete_or_invisible(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"), "id bigint", grace_s=0)
    assert table.before().count() == 0
    for version in range(6):
        table.write(spark.range(version), version)
    assert table.versions() == [3, 4, 5]
    assert (table.before().count(), table.before(5).count(), table.before(3).count()) == (5, 4, 0)
    half = spark.range(9)
    half.write.parquet(str(tmp_path / "t" / "version=6"))
    folder = Folder(spark, str(tmp_path / "t"))
    folder.remove(f"{folder.path}/version=6/_SUCCESS")
    assert table.before().count() == 5


def test_old_versions_stay_for_readers_that_began_with_them(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"), "id bigint")
    table.write(spark.range(7), 0)
    reader = table.before()
    for version in range(1, 8):
        table.write(spark.range(version), version)
    assert reader.count() == 7 and table.versions() == list(range(8))


def test_batch_numbers_grow_over_runs_and_stay_for_retries(spark, tmp_path):
    numbers = BatchNumbers(spark, str(tmp_path / "n"))
    assert [numbers.of("a", 0), numbers.of("a", 1), numbers.of("a", 1)] == [0, 1, 1]
    assert [numbers.of("b", 0), numbers.of("b", 0), numbers.of("a", 2, above=9)] == [2, 2, 10]


def keyed(spark, tmp_path, **knobs):
    return KeyedTable(spark, str(tmp_path / "k"), "id bigint, value bigint, flushed bigint", ["id"], grace_s=0, **knobs)


def news(spark, ids, value):
    return spark.createDataFrame([(i, value, value) for i in ids], "id bigint, value bigint, flushed bigint")


def test_a_keyed_table_holds_the_newest_row_of_every_key(spark, tmp_path):
    table, rng, want = keyed(spark, tmp_path, buckets=4, segments=3), random.Random(3), {}
    history = []
    for version in range(14):
        ids = rng.sample(range(60), rng.choice([0, 1, 5, 40]))
        # A try that failed half way wrote something else before.
        table.write(news(spark, ids[:2], -1), version)
        table.write(news(spark, ids, version), version)
        history.append(dict(want))
        want |= dict.fromkeys(ids, version)
        assert {r.id: r.value for r in table.before().collect()} == want
        assert {r.id: r.value for r in table.before(version).collect()} == history[-1]
    some = spark.createDataFrame([(7,), (8,), (99,)], "id bigint")
    assert {r.id for r in table.before(None, some).filter("id in (7, 8, 99)").collect()} == {7, 8, 99} & want.keys()
    # Segments that a whole bucket has replaced are gone, but for those a retry of the last version needs.
    assert len(Folder(spark, str(tmp_path / "k")).matching("version=*/whole=*/bucket=*")) <= 4 * (3 + KeyedTable.KEPT + 1)


def test_a_null_key_is_one_key(spark, tmp_path):
    table = keyed(spark, tmp_path, buckets=1, segments=2)
    for version in range(4):
        table.write(news(spark, [None, version], version), version)
    got = {(r.id, r.value) for r in table.before().collect()}
    assert got == {(0, 0), (1, 1), (2, 2), (3, 3), (None, 3)} and table.before().count() == 5


def test_bytes_written_follow_the_keys_with_news(spark, tmp_path):
    table = keyed(spark, tmp_path, buckets=64)
    table.write(news(spark, range(200_000), 0), 0)
    folder = Folder(spark, str(tmp_path / "k"))
    whole = folder.bytes(f"{folder.path}/version=0")
    for version in range(1, 6):
        table.write(news(spark, range(version * 3), version), version)
        parts = folder.matching(f"version={version}/whole=*/bucket=*")
        assert folder.bytes(f"{folder.path}/version={version}") < whole / 20 and len(parts) <= 3 * version
    assert table.before().filter("value > 0").count() == 15
    # Only buckets that can hold the keys asked for are read.
    asked = table.before(None, spark.createDataFrame([(1,)], "id bigint"))
    assert len({re.search("bucket=([0-9]+)", f)[1] for f in asked.inputFiles()}) == 1
    assert [r.value for r in asked.filter("id = 1").collect()] == [5]


def test_a_version_that_is_not_complete_is_invisible(spark, tmp_path):
    table = keyed(spark, tmp_path, buckets=2)
    table.write(news(spark, [1, 2, 3], 0), 0)
    table.write(news(spark, [1], 1), 1)
    folder = Folder(spark, str(tmp_path / "k"))
    folder.remove(f"{folder.path}/version=1/_SUCCESS")
    assert {r.id: r.value for r in table.before().collect()} == {1: 0, 2: 0, 3: 0}


# --- streams ----------------------------------------------------------------------------


def arrivals_frame(spark, rows):
    full = [[row.get(c) for c in ARRIVAL_COLUMNS[:-1]] + ["vehicle_id" in row] for row in rows]
    schema = schemas.T.StructType([*schemas.POSITION.fields, schemas.TRIP_UPDATE["delay_seconds"], schemas.T.StructField("is_position", schemas.T.BooleanType())])
    return spark.createDataFrame(full, schema)


def run_in_waves(spark, folder, rows, cuts, start):
    ordered = sorted(rows, key=lambda r: r["arrival_seq"])
    for low, high in zip([0, *cuts], [*cuts, len(ordered)]):
        frame = arrivals_frame(spark, ordered[low:high])
        frame.write.mode("append").parquet(folder)
        start(topics.landed_files(spark, folder, frame.schema)).awaitTermination()


def summary(rows):
    return sorted((r.arrival_seq, r.delay_seconds, r.is_bunching) for r in rows.collect())


def test_micro_batches_equal_a_replay(spark, tmp_path):
    rows, places = random_feed(21), Places.under(str(tmp_path / "out"))
    run_in_waves(
        spark, str(tmp_path / "in"), rows, [90, 91, 260],
        lambda stream: microbatch.start(spark, stream, places, once=True, settings=TIGHT),
    )
    silver = tables.read_silver(spark, places.silver)
    assert summary(silver) == replay(rows)
    live = {tuple(r) for r in tables.live_table(spark, places.live).before().select(schemas.LIVE_COLUMNS).collect()}
    assert live == {tuple(r) for r in live_state(silver).collect()}
    assert tables.read_live(spark, places.live, Settings(live_backend="dynamodb")).columns == [c for c in schemas.LIVE_COLUMNS if c != "trip_id"]
    assert tables.read_live(spark, str(tmp_path / "none")).count() == 0


def test_a_batch_that_runs_twice_leaves_the_same_tables(spark, tmp_path):
    rows = sorted(random_feed(22, n=120), key=lambda r: r["arrival_seq"])
    places = Places.under(str(tmp_path))
    enricher = BatchEnricher(spark, places, TIGHT)
    for batch_id, part in ((0, rows[:50]), (1, rows[50:90]), (1, rows[50:90]), (2, []), (3, rows[90:])):
        frame = arrivals_frame(spark, part).withColumn("flushed", F.lit(TODAY_EPOCH).cast("long"))
        enricher(frame, batch_id)
    silver = tables.read_silver(spark, places.silver)
    assert summary(silver) == replay(rows)
    assert Folder(spark, places.silver).matching("year=2024/month=04/day=10/batch=*")


def test_batches_count_in_the_order_they_are_handled(spark, tmp_path):
    """A slow partition delivers lower arrival numbers in a later batch."""
    feed_rows = sorted(random_feed(24, n=160), key=lambda r: r["arrival_seq"])
    late, rest = feed_rows[40:80], feed_rows[:40] + feed_rows[80:]
    handled = [{**row, "arrival_seq": i} for i, row in enumerate([*rest, *late])]
    want = {(handled[seq]["vehicle_id"], handled[seq]["timestamp"], delay, flag) for seq, delay, flag in replay(handled)}
    places = Places.under(str(tmp_path))
    enricher = BatchEnricher(spark, places, TIGHT)
    for batch_id, part in enumerate((rest, late)):
        frame = arrivals_frame(spark, part).withColumn("flushed", F.lit(TODAY_EPOCH).cast("long"))
        enricher(frame, batch_id)
    rows = tables.read_silver(spark, places.silver).collect()
    assert {(r.vehicle_id, r.timestamp, r.delay_seconds, r.is_bunching) for r in rows} == want
    last = {row["vehicle_id"]: row["timestamp"] for row in handled if "vehicle_id" in row}
    assert {r.vehicle_id: r.timestamp for r in tables.live_table(spark, places.live).before().collect()} == last


def test_old_state_is_forgotten_on_request(spark, tmp_path):
    enricher = BatchEnricher(spark, Places.under(str(tmp_path)), Settings(state_ttl_s=60))
    batches = [[update(1, 500), position(2, "a", ts=1)], [position(3, "b", ts=1)], [position(4, "c", ts=1, trip="u")]]
    for batch_id, (part, clock) in enumerate(zip(batches, (1000, 1060, 1200))):
        frame = arrivals_frame(spark, part).withColumn("flushed", F.lit(clock).cast("long"))
        enricher(frame, batch_id)
    assert summary(tables.read_silver(spark, Places.under(str(tmp_path)).silver)) == [(2, 500, False), (3, 500, True), (4, 0, False)]


@pytest.mark.parametrize("settings", [Settings(), Settings(state_ttl_s=3600)], ids=["kept", "ttl"])
def test_stateful_operators_equal_a_replay(spark, tmp_path, settings):
    rows = random_feed(23)
    setting, provider = stateful.STATE_STORE
    before = spark.conf.get(setting)
    spark.conf.set(setting, provider)
    # With expiring state Spark keeps making empty batches to expire it, and never stops.
    spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")
    try:
        run_in_waves(
            spark, str(tmp_path / "in"), rows, [150],
            lambda stream: stateful.start(stream, str(tmp_path / "out"), str(tmp_path / "check"), once=True, settings=settings),
        )
    finally:
        spark.conf.set(setting, before)
        spark.conf.unset("spark.sql.streaming.noDataMicroBatches.enabled")
    assert summary(tables.read_silver(spark, str(tmp_path / "out"))) == replay(rows)


def test_a_hot_route_is_spread_over_tasks(spark):
    """A third of all rows on one route: its positions meet in many cells, none of which holds much of the route."""
    rows = spark.range(60_000).selectExpr(
        "id as arrival_seq", "concat('v', id % 3000) as vehicle_id", "if(id % 3 = 0, 'hot', concat('r', id % 200)) as route_id",
        "'a' as agency_id", "'s' as route_short_name", "'t' as trip_id",
        "47.0 + (xxhash64(id) % 1000) / 2000.0D as latitude", "8.0 + (xxhash64(id, 1) % 1000) / 2000.0D as longitude",
        "0.0D as bearing", "1000 + id div 10 as timestamp", "0L as delay_seconds",
        "double(null) as was_latitude", "double(null) as was_longitude", "double(null) as was_timestamp",
    )
    told = stateful.cell_messages(rows, Settings()).filter("route_id = 'hot'").cache()
    asked = told.filter("asks")
    assert asked.count() == 20_000 and asked.select("arrival_seq").distinct().count() == 20_000
    assert told.count() < 3 * 20_000 and told.filter("not stays").isEmpty()
    cells = [r["count"] for r in asked.groupBy("t", "y", "x").count().collect()]
    assert len(cells) > 1000 and max(cells) < 0.01 * 20_000
    tasks = told.repartition(32, "route_id", "t", "y", "x").groupBy(F.spark_partition_id().alias("task")).count().collect()
    assert len(tasks) == 32 and max(r["count"] for r in tasks) < 2 * told.count() / 32


@pytest.mark.parametrize("place", [(-33.87, 151.2), (0.0, 0.0), (47.0, 179.9999), (59.5, 10.0), (60.2, -180.0), (89.99, 3.0)])
def test_cells_hear_of_everything_in_reach(spark, place):
    """Any two positions within the limits: the copies of one are in the other's own cell."""
    rng = random.Random(str(place))
    rows = []
    for n in range(300):
        lat, lon = place[0] + rng.uniform(-0.01, 0.01), place[1] + rng.uniform(-0.02, 0.02)
        lon = lon - 360 if lon > 180 else lon + 360 if lon < -180 else lon
        rows.append((*position(n, f"v{n}", lat, lon, 0, 1000 + rng.randrange(400)).values(), 0, None, None, None))
    told = stateful.cell_messages(spark.createDataFrame(rows, stateful.TRACKED), Settings()).collect()
    own = {r.arrival_seq: (r.t, r.y, r.x) for r in told if r.asks}
    copies = {}
    for r in told:
        copies.setdefault((r.t, r.y, r.x), set()).add(r.arrival_seq)
    at = {r[0]: (r[6], r[7], r[9]) for r in rows}
    near = [
        (a, b) for a in at for b in at
        if a != b and abs(at[a][2] - at[b][2]) <= 120 and metres(at[a][:2], at[b][:2]) <= 500
    ]
    assert len(own) == 300 and near
    assert all(b in copies[own[a]] for a, b in near)


def test_vehicles_leave_the_cells_they_no_longer_reach(spark):
    moved = [(*position(1, lat=10.0).values(), 0, -33.87, 151.2, 1000.0), (*position(2).values(), 0, -33.87, 151.2, 1000.0)]
    told = stateful.cell_messages(spark.createDataFrame(moved, stateful.TRACKED), Settings()).collect()
    assert {r.arrival_seq for r in told if not r.stays} == {1}
    assert {(r.t, r.y, r.x) for r in told if not r.stays} == {(r.t, r.y, r.x) for r in told if r.arrival_seq == 2}
    unknown = [(1, "v", "r", "a", "s", "t", None, None, None, None, 0, None, None, None)]
    assert [r.asks for r in stateful.cell_messages(spark.createDataFrame(unknown, stateful.TRACKED), Settings()).collect()].count(True) == 1


# --- buffers flushed by timers ----------------------------------------------------------


class Timers:
    """Stands in for Spark's handle: one list of rows, and the timers that were set."""

    def __init__(self):
        self.rows, self.set = [], []

    def getListState(self, name, schema):
        return self

    def registerTimer(self, at):
        self.set.append(at)

    def exists(self):
        return bool(self.rows)

    def appendList(self, rows):
        self.rows += rows

    def get(self):
        return iter(self.rows)

    def clear(self):
        self.rows = []

    def getCurrentProcessingTimeInMs(self):
        return self.now


def test_the_first_row_of_a_buffer_sets_its_only_timer():
    timers = Timers()
    buffer = buffered.Buffer(schemas.TRIP_UPDATE, 60_000)
    buffer.init(timers)
    chunk = lambda *seqs: pd.DataFrame({"arrival_seq": seqs, "trip_id": ["t"] * len(seqs), "delay_seconds": [None] * len(seqs)})

    def rows_in(now, *chunks):
        timers.now = now
        assert list(buffer.handleInputRows((0,), iter(chunks), timers)) == []

    rows_in(1_000)
    rows_in(1_500, chunk())
    assert timers.set == []
    rows_in(2_000, chunk(1, 2), chunk(3))
    rows_in(40_000, chunk(4))
    assert timers.set == [62_000]
    timers.now = 62_001
    (flushed,) = buffer.handleExpiredTimer((0,), timers, None)
    assert flushed["arrival_seq"].tolist() == [1, 2, 3, 4] and not timers.rows
    # Nothing is set until a row comes again, however long that takes.
    rows_in(500_000)
    assert timers.set == [62_000]
    rows_in(600_000, chunk(5))
    assert timers.set == [62_000, 660_000]


def test_buffered_rows_come_through_once_by_timer(spark, tmp_path):
    rows = spark.createDataFrame([(n, f"t{n % 3}", None if n % 5 == 0 else n) for n in range(200)], schemas.TRIP_UPDATE)
    rows.filter("arrival_seq < 120").write.mode("append").parquet(str(tmp_path / "in"))
    out, check = str(tmp_path / "out"), str(tmp_path / "check")
    quick = Settings(flush_interval="200 milliseconds")
    setting, provider = stateful.STATE_STORE
    before = spark.conf.get(setting)
    spark.conf.set(setting, provider)

    def run(done):
        stream = topics.landed_files(spark, str(tmp_path / "in"), rows.schema)
        query = buffered.append_buffered(stream, out, check, wait_s=15, settings=quick)
        deadline = time.time() + 120
        while not done() and query.isActive and time.time() < deadline:
            time.sleep(0.3)
        query.stop()
        assert done()

    flushes = lambda: Folder(spark, out).matching("year=*/month=*/day=*/batch=*/*.parquet")
    try:
        # Stopped once the rows are taken in and before their timer: what waits is in the checkpoint.
        run(lambda: Folder(spark, check).matching("commits/0"))
        assert not flushes()
        run(lambda: len(flushes()) == 1)
        rows.filter("arrival_seq >= 120").write.mode("append").parquet(str(tmp_path / "in"))
        run(lambda: len(flushes()) == 2)
    finally:
        spark.conf.set(setting, before)
    got = spark.read.schema(schemas.TRIP_UPDATE).parquet(out).select(schemas.TRIP_UPDATE.names)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, rows.collect()))


def test_rows_can_be_watched_on_the_console(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "in"))
    query = sinks.print_rows(topics.landed_files(spark, str(tmp_path / "in"), spark.range(1).schema), once=True)
    query.awaitTermination()
    assert query.exception() is None
    assert sum(p.numInputRows for p in query.recentProgress) == 3


def test_live_path_from_entities(spark, tmp_path):
    entity = messages(
        spark,
        [
            {"trip_update": {"trip": {"trip_id": "north-4"}, "stop_time_update": [{"arrival": {"delay": 90}}]}},
            vehicle(),
            vehicle(trip=""),
        ],
    )
    entity.write.parquet(str(tmp_path / "in"))
    stream = topics.landed_files(spark, str(tmp_path / "in"), entity.schema)
    places = Places.under(str(tmp_path / "out"))
    for query in pipeline.start(spark, stream, stream, places, once=True):
        query.awaitTermination()
    assert summary(tables.read_silver(spark, places.silver)) == [(1, 90, False)]
    today = dt.datetime.now(dt.timezone.utc)
    for bronze, columns in ((places.bronze_positions, schemas.POSITION.names), (places.bronze_updates, schemas.TRIP_UPDATE.names)):
        rows = spark.read.parquet(bronze)
        assert rows.columns == [*columns, "year", "month", "day", "batch"] and rows.count() == 1
        assert Folder(spark, bronze).matching(f"{today:year=%Y/month=%m}/day=*")


def live_messages(spark, rows):
    """(ms, topic, partition, offset, entity) as the wired job takes them."""
    schema = schemas.T.StructType(
        [
            schemas.T.StructField("arrival", schemas.T.StructType([
                schemas.T.StructField("time", schemas.T.LongType()), schemas.T.StructField("topic", schemas.T.StringType()),
                schemas.T.StructField("partition", schemas.T.IntegerType()), schemas.T.StructField("offset", schemas.T.LongType()),
            ])),
            schemas.T.StructField("entity", schemas.ENTITY),
        ]
    )
    frame = spark.createDataFrame([(row[:4], row[4]) for row in rows], schema)
    return frame.withColumn("ingest_time", F.timestamp_millis("arrival.time"))


def bus(name, trip, timestamp):
    entity = vehicle(trip=trip, timestamp=timestamp)
    entity["vehicle"]["vehicle"] = {"id": name}
    return entity


def delay_of(trip, seconds):
    return {"trip_update": {"trip": {"trip_id": trip}, "stop_time_update": [{"arrival": {"delay": seconds}}]}}


def test_the_wired_job_survives_a_new_checkpoint(spark, tmp_path):
    """Two waves on one checkpoint, a third on a fresh one: nothing is replaced, new vehicles show at once."""
    places = Places.under(str(tmp_path / "out"))
    fresh = dataclasses.replace(places, checkpoints=str(tmp_path / "fresh"))
    waves = [
        (places, [(10, "updates", 0, 4096, delay_of("t1", 70)), (10, "positions", 0, 4096, bus("a", "t1", 1000)), (9, "positions", 0, 4095, bus("b", "t2", 1000))]),
        (places, [(20, "positions", 0, 4097, bus("a", "t1", 1100))]),
        (fresh, [(30, "positions", 0, 4098, bus("c", "t1", 1200)), (30, "positions", 1024, 0, bus("d", "t2", 1300))]),
    ]
    for n, (where, rows) in enumerate(waves):
        landing = str(tmp_path / f"in{int(where is fresh)}")
        frame = live_messages(spark, rows)
        frame.write.mode("append").parquet(landing)
        pipeline.start_live(spark, topics.landed_files(spark, landing, frame.schema), where, once=True).awaitTermination()
    silver = tables.read_silver(spark, places.silver)
    got = sorted((r.arrival_seq, r.vehicle_id, r.timestamp, r.delay_seconds) for r in silver.collect())
    # At 10 ms "positions" comes before "updates", so the first reading of a has no delay yet.
    assert got == [(0, "b", 1000, 0), (1, "a", 1000, 0), (3, "a", 1100, 70), (4, "c", 1200, 70), (5, "d", 1300, 0)]
    assert {r.vehicle_id for r in tables.read_live(spark, places.live).collect()} == {"a", "b", "c", "d"}
    bronze = spark.read.parquet(places.bronze_positions)
    assert sorted(r.arrival_seq for r in bronze.collect()) == [seq for seq, *_ in got]
    assert "ingest_time" in bronze.columns and bronze.filter("ingest_time IS NULL").count() == 0
    assert [r.arrival_seq for r in spark.read.parquet(places.bronze_updates).collect()] == [2]


def test_folders_a_stream_wrote_can_expire_and_be_compacted(spark, tmp_path):
    path, landing = str(tmp_path / "bronze"), str(tmp_path / "in")
    start = lambda: sinks.append_parquet(topics.landed_files(spark, landing, "id long"), path, str(tmp_path / "check"), once=True)
    for wave in range(3):
        spark.range(3 * wave, 3 * wave + 3).write.mode("append").parquet(landing)
        start().awaitTermination()
    today = dt.datetime.now(dt.timezone.utc).date()
    assert len(Folder(spark, path).matching("year=*/month=*/day=*/batch=*")) == 3
    assert compact(spark, path, today) == 3 and compact(spark, path, today) == 0
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == list(range(9))
    assert len(drop_expired(spark, path, today + dt.timedelta(days=91))) == 1
    spark.range(100, 101).write.mode("append").parquet(landing)
    start().awaitTermination()
    assert [r.id for r in spark.read.parquet(path).collect()] == [100]


def test_an_interrupted_compaction_is_finished(spark, tmp_path):
    path = str(tmp_path / "t")
    day = f"{path}/year=2024/month=04/day=10"
    for n in range(3):
        spark.range(n, n + 1).write.parquet(f"{day}/batch={n}")
    spark.range(3).write.parquet(f"{day}/_compacted")
    folder = Folder(spark, day)
    folder.remove(f"{day}/batch=0")
    compact(spark, path, TODAY)
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [0, 1, 2]
