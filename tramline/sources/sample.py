"""The analytics tables of the test data read as a transit feed.

The given tables hold no vehicles, so the `events` table is mapped: a user is a vehicle, an
`error` event is a trip update and every other event is a position. Its year is compressed
to three days around the end of daylight saving in Sydney on 2024-04-07.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline import schemas
from tramline.settings import DEFAULTS
from tramline.functions import labels

# An invented operator dimension. Three of the ten agencies are left out on
# purpose, one name is shared by two ids, one has a comma, one is longer than an axis label.
AGENCIES = [
    ("2501", "Alpha Lines"),
    ("2502", "Bravo Transit"),
    ("2503", "Alpha Lines"),
    ("2504", "Delta, Coaches"),
    ("2507", "Echo Buses"),
    ("2508", "Foxtrot Mobility Northern Region"),
    ("2509", "Golf Buses"),
]

EVENTS = (
    "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
)


def arrivals(spark: SparkSession, tables: str) -> DataFrame:
    """Every event with its fleet columns; `arrival_seq` is the event id."""
    events = spark.read.schema(EVENTS).parquet(f"{tables}/events.parquet")
    k = F.regexp_extract("props", "([0-9]+)", 1).cast("int")
    micros = F.timestamp_diff("MICROSECOND", F.expr("timestamp_ntz'1970-01-01 00:00:00'"), F.col("ts"))
    seconds = F.floor((micros / F.lit(1_000_000.0) - 1_704_067_200) / 10) + 1_712_275_200
    user = F.col("user_id")
    route = F.concat((2500 + user % 10).cast("string"), F.lit("_M"), (user % 15).cast("string"))
    no_fix = F.col("k") % 25 == 0
    return (
        events.select(
            F.col("event_id").alias("arrival_seq"),
            user,
            F.col("event_type") == "error",
            F.col("value"),
            k.alias("k"),
            seconds.alias("timestamp"),
        )
        .toDF("arrival_seq", "user_id", "is_update", "value", "k", "timestamp")
        .select(
            "arrival_seq",
            F.concat(F.lit("bus-"), user.cast("string")).alias("vehicle_id"),
            route.alias("route_id"),
            labels.route_agency(route).alias("agency_id"),
            labels.route_short_name(route).alias("route_short_name"),
            F.concat(
                F.lit("T"),
                user.cast("string"),
                F.lit("-"),
                F.floor(F.col("timestamp") / 14_400).cast("string"),
            ).alias("trip_id"),
            F.when(no_fix, 0.0).otherwise(-33.87 + (F.col("k") % 10) * 0.001).alias("latitude"),
            F.when(no_fix, 0.0).otherwise(151.2 + (user % 5) * 0.001).alias("longitude"),
            (F.col("k") * 37 % 360).cast("double").alias("bearing"),
            "timestamp",
            "is_update",
            (F.floor(F.col("value") * 10) - 200).alias("delay_seconds"),
        )
    )


def positions(spark: SparkSession, tables: str) -> DataFrame:
    return arrivals(spark, tables).filter(~F.col("is_update")).select(schemas.POSITION.names)


def trip_updates(spark: SparkSession, tables: str) -> DataFrame:
    return arrivals(spark, tables).filter("is_update").select(schemas.TRIP_UPDATE.names)


def repolled(enriched: DataFrame) -> DataFrame:
    """Silver rows as a feed polled faster than vehicles report leaves them behind.

    Every seventh reading was picked up twice, the second time with a delay 30 s higher.
    """
    polls = F.when(F.col("arrival_seq") % 7 == 0, F.array(F.lit(0), F.lit(30))).otherwise(
        F.array(F.lit(0))
    )
    return (
        enriched.withColumn("extra", F.explode(polls))
        .withColumn("delay_seconds", F.col("delay_seconds") + F.col("extra"))
        .drop("extra")
    )


def agencies(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(AGENCIES, schemas.AGENCY)


_NO_DELAY = "struct<delay:int>"


def _stop(arrival: Column, departure: Column) -> Column:
    return F.struct(arrival.alias("arrival"), departure.alias("departure"))


def _entity(trip_id: Column, route_id: Column, bearing: Column, stops: Column) -> Column:
    vehicle = F.struct(
        F.struct(trip_id, route_id),
        F.struct("vehicle_id"),
        F.struct(F.col("latitude"), F.col("longitude"), bearing),
        F.col("timestamp"),
    )
    update = F.struct(F.struct("trip_id"), stops)
    return F.struct(
        F.col("arrival_seq").cast("string"),
        F.when(~F.col("is_update"), vehicle),
        F.when(F.col("is_update"), update),
    ).cast(schemas.ENTITY)


def messages(spark: SparkSession, tables: str) -> DataFrame:
    """The arrivals as entities before decoding."""
    delay = F.struct(F.col("delay_seconds").cast("int").alias("delay"))
    stops = F.array(_stop(delay, F.lit(None).cast(_NO_DELAY)))
    entity = _entity(F.col("trip_id"), F.col("route_id"), F.col("bearing"), stops)
    return arrivals(spark, tables).select("arrival_seq", entity.alias("entity"))


def kafka_messages(spark: SparkSession, tables: str) -> DataFrame:
    """The same messages as a broker holds them: two topics of 1,500 partitions each.

    Messages of one second share their time, offsets pass 4,096, and both topics use the same
    partitions and offsets.
    """
    seq = F.col("arrival_seq")
    topic = F.when(F.col("is_update"), DEFAULTS.updates_topic).otherwise(DEFAULTS.positions_topic)
    arrival = F.struct(
        (F.col("timestamp") * 1000).alias("time"),
        topic.alias("topic"),
        (seq % 1500).cast("int").alias("partition"),
        (F.floor(seq / 1500) + 4094).alias("offset"),
    )
    return arrivals(spark, tables).select(
        arrival.alias("arrival"), seq.alias("sent"), "vehicle_id", "trip_id", "is_update", "delay_seconds"
    )


def messages_with_gaps(spark: SparkSession, tables: str) -> DataFrame:
    """The same messages with the gaps real feeds have.

    Some vehicles are on no trip, some have no route or no bearing; some updates give only a
    departure, a delay at a later stop only, or no stop at all.
    """
    seq = F.col("arrival_seq")
    delay = F.struct(F.col("delay_seconds").cast("int").alias("delay"))
    unset = F.lit(None).cast(_NO_DELAY)
    stops = (
        F.when(seq % 4 == 0, F.array(_stop(delay, unset)))
        .when(seq % 4 == 1, F.array(_stop(unset, delay)))
        .when(seq % 4 == 2, F.array(_stop(unset, unset), _stop(delay, delay)))
        .otherwise(F.array().cast(f"array<struct<arrival:{_NO_DELAY},departure:{_NO_DELAY}>>"))
    )
    entity = _entity(
        F.when(seq % 13 == 0, "").otherwise(F.col("trip_id")),
        F.when(seq % 19 != 0, F.col("route_id")),
        F.when(seq % 17 != 0, F.col("bearing")),
        stops,
    )
    return arrivals(spark, tables).select(seq, entity.alias("entity"))


def snapshots(spark: SparkSession, tables: str) -> DataFrame:
    """Feed polls: the position messages in runs of 500 arrivals, each an array of entities."""
    payload = F.encode(F.concat_ws("|", "vehicle_id", "trip_id", F.col("timestamp").cast("string")), "utf-8")
    entity = F.struct(F.col("arrival_seq").cast("string").alias("id"), payload.alias("payload"))
    return (
        arrivals(spark, tables)
        .filter(~F.col("is_update"))
        .groupBy(F.floor(F.col("arrival_seq") / 500).alias("snapshot_id"))
        .agg(F.collect_list(entity).alias("entities"))
    )
