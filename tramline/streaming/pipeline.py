"""The live path from decoded messages to bronze, silver and the live table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tramline.operators.arrival import numbered
from tramline.settings import DEFAULTS, Settings
from tramline.sources.feed import decode_positions, decode_trip_updates, entity_of
from tramline.sources.folders import VersionedTable
from tramline.sources.topics import kafka_messages
from tramline.streaming import microbatch
from tramline.streaming.arrivals import merged
from tramline.streaming.microbatch import Places
from tramline.streaming.sinks import append_parquet, flush_time, triggered


def start_bronze(
    positions: DataFrame,
    updates: DataFrame,
    places: Places,
    once: bool = False,
    settings: Settings = DEFAULTS,
) -> list[StreamingQuery]:
    """Decoded rows as they came, before any enrichment. Updates keep their arrival number,
    without which they could not be replayed."""
    checkpoints = places.checkpoints
    return [
        append_parquet(
            positions, places.bronze_positions, f"{checkpoints}/positions", once, settings
        ),
        append_parquet(updates, places.bronze_updates, f"{checkpoints}/updates", once, settings),
    ]


class LiveBatch:
    """One micro-batch of messages from all topics to bronze, silver and the live table.

    Messages are numbered here, from where the batch before ended. Bronze is written first and read back,
    so silver is made of exactly the rows that bronze holds.
    """

    def __init__(self, spark: SparkSession, places: Places, checkpoint: str, settings: Settings = DEFAULTS) -> None:
        self._spark, self._places, self._settings = spark, places, settings
        self._enricher = microbatch.BatchEnricher(spark, places, settings, checkpoint)
        self._ends = VersionedTable(spark, f"{places.state}/arrivals", "last bigint", settings.version_grace_s)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            facts = batch.agg(F.count(F.lit(1)).alias("n"), F.max("flushed").alias("flushed")).first()
            if facts["n"]:
                self._handle(batch, self._enricher.number_of(batch_id), facts["n"], facts["flushed"])
        finally:
            batch.unpersist()

    def _handle(self, batch: DataFrame, number: int, count: int, flushed: int) -> None:
        before = self._ends.before(number).agg(F.max("last")).first()[0]
        last = -1 if before is None else before
        messages = numbered(batch, after=last).persist()
        try:
            positions = self._landed(decode_positions(messages), self._places.bronze_positions, number, flushed)
            updates = self._landed(decode_trip_updates(messages), self._places.bronze_updates, number, flushed)
        finally:
            messages.unpersist()
        self._ends.write(self._spark.range(1).select(F.lit(last + count).alias("last")), number)
        arrivals = merged(positions, updates).withColumn("flushed", F.lit(flushed).cast("long"))
        self._enricher.enrich(arrivals, number, last + 1, flushed)

    def _landed(self, rows: DataFrame, path: str, number: int, flushed: int) -> DataFrame:
        day = dt.datetime.fromtimestamp(flushed, dt.timezone.utc)
        folder = f"{path}/{day:year=%Y/month=%m/day=%d}/batch={number}"
        rows.write.mode("overwrite").parquet(folder)
        return self._spark.read.schema(rows.schema).parquet(folder)


def start_live(
    spark: SparkSession, messages: DataFrame, places: Places, once: bool = False, settings: Settings = DEFAULTS
) -> StreamingQuery:
    """The wired job: one query, and so one start point, for the messages of all topics.

    `messages` has `arrival` (time, topic, partition, offset), `ingest_time` and `entity`; from Kafka it is
    `topics.kafka_messages(...)` with `entity` added by `feed.entity_of`. Bound the batch there.
    """
    checkpoint = f"{places.checkpoints}/live"
    writer = (
        messages.withColumn("flushed", flush_time())
        .writeStream.foreachBatch(LiveBatch(spark, places, checkpoint, settings))
        .option("checkpointLocation", checkpoint)
    )
    return triggered(writer, once, settings).start()


def start_kafka(
    spark: SparkSession, servers: str, descriptor: str, places: Places, per_batch: int, settings: Settings = DEFAULTS
) -> StreamingQuery:
    """The live job on its two topics."""
    both = [settings.positions_topic, settings.updates_topic]
    messages = kafka_messages(spark, servers, both, per_batch)
    return start_live(spark, messages.withColumn("entity", entity_of(F.col("value"), descriptor)), places, settings=settings)


def start(
    spark: SparkSession,
    position_messages: DataFrame,
    update_messages: DataFrame,
    places: Places,
    once: bool = False,
    settings: Settings = DEFAULTS,
) -> list[StreamingQuery]:
    """Start every query of the live path over messages that are numbered already.

    Messages have `arrival_seq` and `entity`.
    """
    positions, updates = decode_positions(position_messages), decode_trip_updates(update_messages)
    enrichment = microbatch.start(spark, merged(positions, updates), places, once, settings)
    return [*start_bronze(positions, updates, places, once, settings), enrichment]
