"""The registered queries: each reads whole tables and returns a lazy DataFrame."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline import schemas
from tramline.functions import catalog, geo, labels
from tramline.functions.clock import partition_keys
from tramline.operators.arrival import numbered
from tramline.operators.last_known import attach_delay
from tramline.operators.proximity import flag_bunching
from tramline.plans import daily, dashboard, gate, history, marts, quality
from tramline.plans.enrich import enrich
from tramline.plans.staging import stage_events
from tramline.schemas import HISTORY_COLUMNS
from tramline.session import scratch_folder
from tramline.settings import DEFAULTS, Settings
from tramline.sources import feed, sample, segments, tables, topics
from tramline.sources.folders import Folder, compact, drop_expired
from tramline.streaming import buffered, dedupe, pipeline, stateful
from tramline.streaming.arrivals import merged
from tramline.streaming.microbatch import Places

Query = Callable[[SparkSession, str], DataFrame]

ROUTE = "2501_M1"
OPERATOR = "Alpha Lines"


# --- layers the queries start from ------------------------------------------------------


def enriched(spark: SparkSession, sf: str) -> DataFrame:
    return enrich(sample.positions(spark, sf), sample.trip_updates(spark, sf))


def silver(spark: SparkSession, sf: str) -> DataFrame:
    return sample.repolled(enriched(spark, sf))


def foldered(spark: SparkSession, sf: str) -> DataFrame:
    """Silver with its folder keys; a reading counts as flushed the moment it was taken."""
    return silver(spark, sf).select("*", *partition_keys(F.col("timestamp")))


def staged(spark: SparkSession, sf: str) -> DataFrame:
    return stage_events(silver(spark, sf))


def live(spark: SparkSession, sf: str) -> DataFrame:
    return dashboard.live_state(enriched(spark, sf))


def board(spark: SparkSession, sf: str) -> DataFrame:
    return dashboard.board_rows(live(spark, sf), sample.agencies(spark))


def last_ingest_date(spark: SparkSession, sf: str) -> dt.date:
    newest = sample.positions(spark, sf).agg(F.max("timestamp")).first()[0]
    return dt.datetime.fromtimestamp(newest, dt.timezone.utc).date()


def landed_silver(spark: SparkSession, sf: str) -> str:
    path = scratch_folder(spark, "silver")
    foldered(spark, sf).write.partitionBy("year", "month", "day").parquet(path)
    return path


# --- sources and decoding ---------------------------------------------------------------


def feed_fanout(spark: SparkSession, sf: str) -> DataFrame:
    return feed.fan_out(sample.snapshots(spark, sf), DEFAULTS.positions_topic)


def decode_positions(spark: SparkSession, sf: str) -> DataFrame:
    return feed.decode_positions(sample.messages_with_gaps(spark, sf))


def decode_trip_updates(spark: SparkSession, sf: str) -> DataFrame:
    return feed.decode_trip_updates(sample.messages_with_gaps(spark, sf))


def route_split(spark: SparkSession, sf: str) -> DataFrame:
    route = F.col("route_id")
    return (
        sample.positions(spark, sf)
        .groupBy("route_id")
        .agg(F.count(F.lit(1)).alias("readings"))
        .select(
            "route_id",
            labels.route_agency(route).alias("agency_id"),
            labels.route_short_name(route).alias("route_short_name"),
            "readings",
        )
    )


def partition_key_columns(spark: SparkSession, sf: str) -> DataFrame:
    return foldered(spark, sf).select("arrival_seq", "year", "month", "day")


# --- geometry ---------------------------------------------------------------------------


def haversine_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Distance of every position from the centre of the default view, to the millimetre."""
    lat, lon, _ = DEFAULTS.default_view
    metres = geo.haversine_m(F.lit(lat), F.lit(lon), F.col("latitude"), F.col("longitude"))
    return sample.positions(spark, sf).select("arrival_seq", F.round(metres, 3).alias("from_centre_m"))


def bearing_diff(spark: SparkSession, sf: str) -> DataFrame:
    """How far every vehicle heads from just west of north, so that some gaps wrap around."""
    gap = geo.bearing_gap_deg(F.lit(350.0), F.col("bearing"))
    return sample.positions(spark, sf).select("arrival_seq", gap.alias("gap_deg"))


# --- enrichment -------------------------------------------------------------------------


def last_known_delay(spark: SparkSession, sf: str) -> DataFrame:
    joined = attach_delay(sample.positions(spark, sf), sample.trip_updates(spark, sf))
    return joined.select("arrival_seq", "vehicle_id", "trip_id", "delay_seconds")


def bunching(spark: SparkSession, sf: str) -> DataFrame:
    flagged = flag_bunching(sample.positions(spark, sf))
    return flagged.select("arrival_seq", "vehicle_id", "route_id", "is_bunching")


# --- live table -------------------------------------------------------------------------


def live_state_decimal(spark: SparkSession, sf: str) -> DataFrame:
    """Decimals are shown as text, which compares digit by digit."""
    rows = dashboard.as_keyvalue_values(live(spark, sf))
    return rows.withColumns({c: F.col(c).cast("string") for c in ("latitude", "longitude")})


def live_vehicles(spark: SparkSession, sf: str) -> DataFrame:
    return dashboard.normalize_live(dashboard.as_local_values(live(spark, sf)))


def live_vehicles_projected(spark: SparkSession, sf: str) -> DataFrame:
    stored = dashboard.as_keyvalue_values(live(spark, sf)).drop("trip_id")
    return dashboard.normalize_live(stored)


def live_normalized(spark: SparkSession, sf: str) -> DataFrame:
    """Every second vehicle comes from a writer that did not know short names yet."""
    known = F.when(F.col("timestamp") % 2 == 0, F.col("route_short_name"))
    rows = live(spark, sf).withColumn("route_short_name", known)
    return dashboard.normalize_live(rows).select("vehicle_id", "route_id", "route_short_name")


def valid_coordinates(spark: SparkSession, sf: str) -> DataFrame:
    placed = dashboard.with_valid_coordinates(live(spark, sf))
    return placed.select("vehicle_id", "latitude", "longitude")


# --- labels and dashboard frames --------------------------------------------------------


def operator_names(spark: SparkSession, sf: str) -> DataFrame:
    return board(spark, sf).select("vehicle_id", "agency_id", "operator_name")


def delay_status(spark: SparkSession, sf: str) -> DataFrame:
    channels = [
        F.col("color")[i].alias(name) for i, name in enumerate(("red", "green", "blue", "alpha"))
    ]
    return board(spark, sf).select("vehicle_id", "status", *channels, "is_bunching_label")


def axis_labels(spark: SparkSession, sf: str) -> DataFrame:
    names = board(spark, sf).select("operator_name").distinct()
    return names.withColumn("axis_label", labels.axis_label(F.col("operator_name")))


def selection_vs_network(spark: SparkSession, sf: str) -> DataFrame:
    return dashboard.selection_vs_network(board(spark, sf), F.col("route_id") == ROUTE)


def comparison_rows(spark: SparkSession, sf: str) -> DataFrame:
    chosen = F.col("operator_name") == OPERATOR
    return dashboard.comparison_rows(dashboard.selection_vs_network(board(spark, sf), chosen))


def view_bounds(spark: SparkSession, sf: str) -> DataFrame:
    bounds = dashboard.view_bounds(board(spark, sf))
    return bounds.withColumn("zoom", F.round("zoom", 6))


# --- history ----------------------------------------------------------------------------


def recent_history(spark: SparkSession, sf: str) -> DataFrame:
    return tables.read_history(spark, landed_silver(spark, sf), last_ingest_date(spark, sf))


def recent_history_fallback(spark: SparkSession, sf: str) -> DataFrame:
    """Asked for a month after the last reading, when the recent folders are empty."""
    later = last_ingest_date(spark, sf) + dt.timedelta(days=30)
    return tables.read_history(spark, landed_silver(spark, sf), later)


def schema_union(spark: SparkSession, sf: str) -> DataFrame:
    """Every third reading lies in a file written before three of the columns existed."""
    path = scratch_folder(spark, "mixed")
    added_later = ["agency_id", "route_short_name", "bearing"]
    rows = silver(spark, sf).drop("latitude", "longitude")
    old = F.col("arrival_seq") % 3 == 0
    rows.filter(old).drop(*added_later).write.parquet(f"{path}/written=before")
    rows.filter(~old).write.parquet(f"{path}/written=since")
    return tables.read_merged(spark, path).select(rows.columns)


def retention_90d(spark: SparkSession, sf: str) -> DataFrame:
    """Landed folders, every third reading a hundred days older; the folders past retention go."""
    path = scratch_folder(spark, "retained")
    older = F.when(F.col("arrival_seq") % 3 == 0, 100 * 86_400).otherwise(0)
    rows = silver(spark, sf).withColumn("taken", F.col("timestamp") - older)
    rows.select("*", *partition_keys(F.col("taken"))).write.partitionBy("year", "month", "day").parquet(path)
    drop_expired(spark, path, last_ingest_date(spark, sf))
    return tables.read_silver(spark, path).select("arrival_seq", "vehicle_id", "delay_seconds")


def kafka_arrivals(spark: SparkSession, sf: str) -> DataFrame:
    """The number that each message gets from its time, topic, partition and offset."""
    return numbered(sample.kafka_messages(spark, sf)).select("sent", "arrival_seq")


def kafka_attach_delay(spark: SparkSession, sf: str) -> DataFrame:
    """The delay join in the order in which a broker's messages are numbered."""
    messages = numbered(sample.kafka_messages(spark, sf))
    positions = messages.filter(~F.col("is_update")).select("arrival_seq", "sent", "vehicle_id", "trip_id")
    updates = messages.filter("is_update").select("arrival_seq", "trip_id", "delay_seconds")
    return attach_delay(positions, updates)


def compacted_day(spark: SparkSession, sf: str) -> DataFrame:
    """The last day's silver, landed in several batches and then compacted into one folder."""
    path, day = scratch_folder(spark, "compacted"), last_ingest_date(spark, sf)
    rows = foldered(spark, sf).withColumn("batch", F.col("arrival_seq") % 5)
    rows.write.partitionBy("year", "month", "day", "batch").parquet(path)
    compact(spark, path, day)
    found = spark.read.option("basePath", path).parquet(f"{path}/{day:year=%Y/month=%m/day=%d}")
    return found.select("arrival_seq", "vehicle_id", "delay_seconds", F.col("batch").cast("string").alias("batch"))


def operator_performance_csv(spark: SparkSession, sf: str) -> DataFrame:
    """Operator performance with the dimension landed as CSV and read back."""
    path = scratch_folder(spark, "agencies")
    sample.agencies(spark).write.csv(path, header=True)
    return marts.operator_performance(staged(spark, sf), tables.read_agencies(spark, path))


def spoiled(spark: SparkSession, sf: str) -> DataFrame:
    """Staged events with faults: one agency without routes, one with absurd delays, one
    whose clock shows whole hours only."""
    rows, agency = staged(spark, sf), F.col("agency_id")
    return rows.withColumns(
        {
            "route_id": F.when(agency != "2503", F.col("route_id")),
            "delay_seconds": F.col("delay_seconds") + F.when(agency == "2504", 10_000).when(agency == "2507", -9_000).otherwise(0),
            "event_time": F.when(agency == "2508", F.expr("cast(date_trunc('HOUR', event_time) as timestamp_ntz)")).otherwise(F.col("event_time")),
        }
    )


def dq_range_violations(spark: SparkSession, sf: str) -> DataFrame:
    return quality.delay_out_of_range(spoiled(spark, sf)).select("vehicle_id", "event_time", "delay_seconds")


def operator_history(spark: SparkSession, sf: str) -> DataFrame:
    rows = silver(spark, sf).select(HISTORY_COLUMNS)
    return history.operator_history(rows, board(spark, sf), OPERATOR).select(HISTORY_COLUMNS)


def route_trend(spark: SparkSession, sf: str) -> DataFrame:
    return history.delay_trend(silver(spark, sf).filter(F.col("route_id") == ROUTE))


# --- gold and data tests ----------------------------------------------------------------


def operator_performance(spark: SparkSession, sf: str) -> DataFrame:
    return marts.operator_performance(staged(spark, sf), sample.agencies(spark))


def top15_routes(spark: SparkSession, sf: str) -> DataFrame:
    return dashboard.top_charted(marts.busiest_routes(staged(spark, sf)), "route_short_name")


def top15_operators(spark: SparkSession, sf: str) -> DataFrame:
    return dashboard.top_charted(operator_performance(spark, sf), "operator_name", key="agency_id")


def dq_not_null(spark: SparkSession, sf: str) -> DataFrame:
    return quality.null_counts(staged(spark, sf), ["vehicle_id", "route_id"])


def dq_delay_range(spark: SparkSession, sf: str) -> DataFrame:
    rows = quality.delay_out_of_range(staged(spark, sf))
    return rows.select("vehicle_id", "event_time", "delay_seconds")


def _over(layer: Query, plan: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf: plan(layer(spark, sf))


QUERIES: dict[str, Query] = {
    "feed_fanout": feed_fanout,
    "decode_positions": decode_positions,
    "decode_trip_updates": decode_trip_updates,
    "route_split": route_split,
    "partition_keys": partition_key_columns,
    "haversine_pairs": haversine_pairs,
    "bearing_diff": bearing_diff,
    "attach_delay": last_known_delay,
    "bunching": bunching,
    "silver_events": silver,
    "staged_events": staged,
    "live_state": live,
    "live_state_decimal": live_state_decimal,
    "live_vehicles": live_vehicles,
    "live_vehicles_projected": live_vehicles_projected,
    "live_normalized": live_normalized,
    "valid_coordinates": valid_coordinates,
    "operator_names": operator_names,
    "delay_status": delay_status,
    "axis_labels": axis_labels,
    "vehicle_board": _over(board, dashboard.vehicle_board),
    "network_kpis": _over(board, dashboard.network_kpis),
    "selection_vs_network": selection_vs_network,
    "comparison_rows": comparison_rows,
    "route_options": _over(board, dashboard.route_options),
    "operator_options": _over(board, dashboard.operator_options),
    "view_bounds": view_bounds,
    "recent_history": recent_history,
    "recent_history_fallback": recent_history_fallback,
    "schema_union": schema_union,
    "retention_90d": retention_90d,
    "operator_history": operator_history,
    "kafka_arrivals": kafka_arrivals,
    "kafka_attach_delay": kafka_attach_delay,
    "compacted_day": compacted_day,
    "operator_performance_csv": operator_performance_csv,
    "dq_null_violations": _over(spoiled, lambda rows: quality.null_counts(rows, ["vehicle_id", "route_id"])),
    "dq_range_violations": dq_range_violations,
    "dq_unique_violations": _over(spoiled, quality.repeated_events),
    "delay_trend_1min": _over(silver, history.delay_trend),
    "route_trend_1min": route_trend,
    "busiest_routes": _over(staged, marts.busiest_routes),
    "delay_by_hour": _over(staged, marts.delay_by_hour),
    "operator_performance": operator_performance,
    "headway_gaps": _over(staged, marts.headway_gaps),
    "headway_adherence": _over(staged, marts.headway_adherence),
    "top_routes_by_delay": _over(staged, marts.top_routes_by_delay),
    "top15_routes": top15_routes,
    "top15_operators": top15_operators,
    "dq_not_null": dq_not_null,
    "dq_delay_range": dq_delay_range,
    "dq_unique_event": _over(staged, quality.repeated_events),
    "dq_stale_delay": _over(staged, quality.stale_delays),
}


# --- gold by day, the gate, and plain SQL -----------------------------------------------


def _daily(spark: SparkSession, sf: str) -> daily.DailyGold:
    """Gold of every day of the sample, each built from the events of that day alone."""
    root = scratch_folder(spark, "daily")
    staged(spark, sf).withColumn("event_day", daily.day_of(F.col("event_time"))).write.partitionBy("event_day").parquet(f"{root}/staged")
    gold = daily.DailyGold(spark, f"{root}/gold")
    for path in Folder(spark, f"{root}/staged").matching("event_day=*"):
        gold.build_day(spark.read.parquet(path), path.rpartition("=")[2])
    return gold


def daily_busiest_routes(spark: SparkSession, sf: str) -> DataFrame:
    return _daily(spark, sf).busiest_routes()


def daily_operator_performance(spark: SparkSession, sf: str) -> DataFrame:
    return _daily(spark, sf).operator_performance(sample.agencies(spark))


def daily_headway_adherence(spark: SparkSession, sf: str) -> DataFrame:
    return _daily(spark, sf).headway_adherence()


def gate_published(spark: SparkSession, sf: str) -> DataFrame:
    """Staged events in three batches, one of them spoiled by events without a vehicle: what readers see of them."""
    path, rows = scratch_folder(spark, "gate"), staged(spark, sf)
    third = F.pmod(F.substring("vehicle_id", 5, 10).cast("int"), F.lit(3))
    for batch in range(3):
        part = rows.filter(third == batch)
        if batch == 1:
            part = part.withColumn("vehicle_id", F.when(F.col("delay_seconds") == 0, F.lit(None)).otherwise(F.col("vehicle_id")))
        gate.publish_batch(part, path, str(batch))
    return gate.published(spark, path, schemas.ddl(rows.schema))


def _in_sql(spark: SparkSession, sf: str, query: str) -> DataFrame:
    """A query written in SQL alone, over a view of the positions and one of the staged events."""
    sample.positions(spark, sf).createOrReplaceTempView("tramline_positions")
    staged(spark, sf).createOrReplaceTempView("tramline_staged")
    catalog.register(spark, "tramline_staged")
    return spark.sql(query)


def sql_route_split(spark: SparkSession, sf: str) -> DataFrame:
    return _in_sql(spark, sf, """
        SELECT route_id, route_agency(route_id) AS agency_id, route_short(route_id) AS route_short_name, count(*) AS readings
        FROM tramline_positions GROUP BY route_id""")  # fmt: skip


def sql_haversine_pairs(spark: SparkSession, sf: str) -> DataFrame:
    lat, lon, _ = DEFAULTS.default_view
    return _in_sql(spark, sf, f"""
        SELECT arrival_seq, round(distance_m({lat}D, {lon}D, latitude, longitude), 3) AS from_centre_m
        FROM tramline_positions""")  # fmt: skip


def sql_bearing_diff(spark: SparkSession, sf: str) -> DataFrame:
    return _in_sql(spark, sf, "SELECT arrival_seq, bearing_gap(350D, bearing) AS gap_deg FROM tramline_positions")


def sql_busiest_routes(spark: SparkSession, sf: str) -> DataFrame:
    return _in_sql(spark, sf, "SELECT * FROM busiest(0)")


QUERIES |= {
    "daily_busiest_routes": daily_busiest_routes,
    "daily_operator_performance": daily_operator_performance,
    "daily_headway_adherence": daily_headway_adherence,
    "gate_published": gate_published,
    "sql_route_split": sql_route_split,
    "sql_haversine_pairs": sql_haversine_pairs,
    "sql_bearing_diff": sql_bearing_diff,
    "sql_busiest_routes": sql_busiest_routes,
}


# --- streams: the same rows, landed in two waves and taken up by restarted queries ------


def _waves(spark: SparkSession, rows: DataFrame, run: Callable[[DataFrame], object]) -> None:
    """Land the first half of the arrivals, run the stream to its end, then the second half."""
    landing, arrived = scratch_folder(spark, "landing"), scratch_folder(spark, "arrived")
    # The plan behind the rows runs once.
    rows.write.parquet(arrived)
    rows = spark.read.schema(rows.schema).parquet(arrived)
    low, high = rows.agg(F.min("arrival_seq"), F.max("arrival_seq")).first()
    middle = (low + high) // 2
    for wave in (F.col("arrival_seq") <= middle, F.col("arrival_seq") > middle):
        rows.filter(wave).write.mode("append").parquet(landing)
        started = run(topics.landed_files(spark, landing, rows.schema))
        for query in started if isinstance(started, list) else [started]:
            query.awaitTermination()


@contextmanager
def _state_store(spark: SparkSession) -> Iterator[None]:
    """The store that operators with state need, while a query starts."""
    setting, provider = stateful.STATE_STORE
    before = spark.conf.get(setting)
    spark.conf.set(setting, provider)
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def _streamed(spark: SparkSession, sf: str) -> Places:
    """The whole live path, from entities to bronze, silver and the live table."""
    places = Places.under(scratch_folder(spark, "stream"))
    _waves(
        spark,
        sample.messages(spark, sf),
        lambda stream: pipeline.start(spark, stream, stream, places, once=True),
    )
    return places


def _streamed_bronze(spark: SparkSession, sf: str) -> Places:
    places = Places.under(scratch_folder(spark, "bronze"))
    _waves(
        spark,
        sample.messages(spark, sf),
        lambda stream: pipeline.start_bronze(
            feed.decode_positions(stream), feed.decode_trip_updates(stream), places, once=True
        ),
    )
    return places


def stream_bronze_positions(spark: SparkSession, sf: str) -> DataFrame:
    places = _streamed_bronze(spark, sf)
    return spark.read.parquet(places.bronze_positions).select(schemas.POSITION.names)


def stream_bronze_updates(spark: SparkSession, sf: str) -> DataFrame:
    places = _streamed_bronze(spark, sf)
    return spark.read.parquet(places.bronze_updates).select(schemas.TRIP_UPDATE.names)


def stream_silver(spark: SparkSession, sf: str) -> DataFrame:
    rows = tables.read_silver(spark, _streamed(spark, sf).silver)
    return rows.select(schemas.SILVER.names)


def stream_live_state(spark: SparkSession, sf: str) -> DataFrame:
    return tables.read_live(spark, _streamed(spark, sf).live)


def stream_live_keyvalue(spark: SparkSession, sf: str) -> DataFrame:
    """The stored live table read with the key-value backend's types and projection."""
    return tables.read_live(spark, _streamed(spark, sf).live, Settings(live_backend="dynamodb"))


def stream_stateful(spark: SparkSession, sf: str) -> DataFrame:
    """Silver from the two operators that keep their state in Spark's state store."""
    root = scratch_folder(spark, "stateful")
    arrived = merged(sample.positions(spark, sf), sample.trip_updates(spark, sf))
    with _state_store(spark):
        _waves(
            spark,
            arrived,
            lambda stream: stateful.start(stream, f"{root}/silver", f"{root}/checkpoint", once=True),
        )
    return tables.read_silver(spark, f"{root}/silver").select(schemas.SILVER.names)


def stream_buffered_updates(spark: SparkSession, sf: str) -> DataFrame:
    """Trip updates that wait in state until the timers of their buffers hand them on."""
    root = scratch_folder(spark, "buffered")
    rows = sample.trip_updates(spark, sf)
    rows.write.parquet(f"{root}/landing")
    stored = spark.read.schema(rows.schema).parquet(f"{root}/landing").count()
    path = f"{root}/bronze"

    def written() -> DataFrame:
        parts = Folder(spark, path).matching("year=*/month=*/day=*/batch=*")
        if not parts:
            return spark.createDataFrame([], schemas.TRIP_UPDATE)
        return spark.read.schema(schemas.TRIP_UPDATE).parquet(*parts)

    with _state_store(spark):
        quick = Settings(flush_interval="1 second")
        stream = topics.landed_files(spark, f"{root}/landing", rows.schema)
        query = buffered.append_buffered(stream, path, f"{root}/checkpoint", wait_s=2, shards=4, settings=quick)
        try:
            # The query looks for timers until it is stopped.
            while query.isActive and written().count() < stored:
                query.awaitTermination(1)
        finally:
            query.stop()
    return written()


def _outgoing(rows: DataFrame) -> DataFrame:
    """The sample feed's messages as text: entities in JSON, sent at their arrival number's second."""
    topic = F.when(F.col("entity.vehicle").isNotNull(), DEFAULTS.positions_topic).otherwise(DEFAULTS.updates_topic)
    return rows.select(topic.alias("topic"), F.to_json("entity").alias("value"), F.timestamp_seconds("arrival_seq").alias("timestamp"))


def topic_published(spark: SparkSession, sf: str) -> DataFrame:
    """Fanned-out feed messages through the publishing sink and back, with the count that publishing returned."""
    path = scratch_folder(spark, "topics")
    sent = segments.publish(feed.fan_out(sample.snapshots(spark, sf), DEFAULTS.positions_topic), path, partitions=3)
    messages = segments.all_messages(spark, path, [DEFAULTS.positions_topic])
    places = messages.groupBy("arrival.topic", "arrival.partition").agg(
        F.count(F.lit(1)).alias("n"), F.max("arrival.offset").alias("last"), F.count_distinct("arrival.offset").alias("offsets")
    )
    gapless = F.bool_and((F.col("last") == F.col("n") - 1) & (F.col("offsets") == F.col("n")))
    return messages.select(
        F.col("arrival.topic").alias("topic"), "value", F.lit(sent).cast("long").alias("sent"), F.lit(places.agg(gapless).first()[0]).alias("gapless")
    )


def stream_from_latest(spark: SparkSession, sf: str) -> DataFrame:
    """The wired job over published topics: started at the newest messages after a backlog, stopped, and started again.

    Only what was published after its first start counts, though some of it was published while the job was down.
    """
    path, places = scratch_folder(spark, "topics"), Places.under(scratch_folder(spark, "live"))
    rows = sample.messages(spark, sf)
    low, high = rows.agg(F.min("arrival_seq"), F.max("arrival_seq")).first()
    third = (high - low + 1) // 3
    both = [DEFAULTS.positions_topic, DEFAULTS.updates_topic]
    checkpoint = f"{places.checkpoints}/live"
    for first, last in ((low, low + third), (low + third, low + 2 * third), (low + 2 * third, high + 1)):
        # Dealt out, so that a table that is stored in one piece is not sent by one task.
        wave = rows.filter(F.col("arrival_seq").between(first, last - 1)).repartition("arrival_seq")
        segments.publish(_outgoing(wave), path, partitions=2)
        messages = segments.new_messages(spark, path, both, checkpoint)
        entity = F.from_json("value", schemas.ENTITY).alias("entity")
        pipeline.start_live(spark, messages.select("arrival", "ingest_time", entity), places, once=True).awaitTermination()
    return tables.read_silver(spark, places.silver).select(schemas.SILVER.names)


def stream_staged(spark: SparkSession, sf: str) -> DataFrame:
    """Staged events kept up by a stream that corrects what it handed on when a preferred repeat arrives."""
    root = scratch_folder(spark, "stream-staged")
    with _state_store(spark):
        _waves(
            spark,
            silver(spark, sf).select(schemas.SILVER.names),
            lambda stream: dedupe.start(stream, f"{root}/staged", f"{root}/checkpoint", late_s=7 * 86_400, once=True),
        )
    return dedupe.read_staged(spark, f"{root}/staged")


QUERIES |= {
    "stream_staged": stream_staged,
    "stream_buffered_updates": stream_buffered_updates,
    "topic_published": topic_published,
    "stream_from_latest": stream_from_latest,
    "stream_bronze_positions": stream_bronze_positions,
    "stream_bronze_updates": stream_bronze_updates,
    "stream_silver": stream_silver,
    "stream_live_state": stream_live_state,
    "stream_live_keyvalue": stream_live_keyvalue,
    "stream_stateful": stream_stateful,
}
