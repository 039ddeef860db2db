"""Enrichment per micro-batch with the batch operators and stored state.

Each micro-batch is enriched by the same plans as a batch job, with what earlier batches left
behind added as rows: the last delay of every trip and the last position of every vehicle on
every route. A hot trip or route is therefore split over tasks here as it is in batch. Of stored state a batch
writes the rows of keys with news, and reads the buckets that may hold what it needs;
`streaming.stateful` keeps state in a state store instead.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tramline import schemas
from tramline.operators.last_known import attach_delay
from tramline.operators.latest import latest_per_key
from tramline.operators.proximity import bunching_arrivals
from tramline.plans.enrich import with_flags
from tramline.settings import DEFAULTS, Settings
from tramline.sources.folders import BatchNumbers, KeyedTable, run_of
from tramline.sources.tables import live_table
from tramline.streaming.arrivals import positions_of, updates_of
from tramline.streaming.sinks import flush_time, triggered


@dataclass(frozen=True)
class Places:
    """The folders a pipeline owns."""

    bronze_positions: str
    bronze_updates: str
    silver: str
    live: str
    state: str
    checkpoints: str

    @classmethod
    def under(cls, root: str) -> Places:
        return cls(
            bronze_positions=f"{root}/bronze/vehicle-positions",
            bronze_updates=f"{root}/bronze/trip-updates",
            silver=f"{root}/silver/vehicle-events",
            live=f"{root}/live/vehicle-state",
            state=f"{root}/state",
            checkpoints=f"{root}/checkpoints",
        )


class BatchEnricher:
    """Handles one micro-batch; safe to run again for a batch that failed half way.

    Folders and versions are numbered by `BatchNumbers`, so a run on a new checkpoint adds to what
    earlier runs left. `checkpoint` names the checkpoint of the query that calls it.
    """

    def __init__(
        self, spark: SparkSession, places: Places, settings: Settings = DEFAULTS, checkpoint: str | None = None
    ) -> None:
        self._spark, self._places, self._settings = spark, places, settings
        self._checkpoint = checkpoint or f"{places.checkpoints}/enrich"
        self._numbers = BatchNumbers(spark, f"{places.state}/batches")
        self._delays = self._state("delays", schemas.TRIP_UPDATE, ["trip_id"])
        self._last_seen = self._state("last-positions", schemas.POSITION, ["route_id", "vehicle_id"])
        self._live = live_table(spark, places.live, settings)

    def _state(self, name: str, schema: schemas.T.StructType, keys: list[str]) -> KeyedTable:
        settings, columns = self._settings, f"{schemas.ddl(schema)}, flushed bigint"
        return KeyedTable(
            self._spark, f"{self._places.state}/{name}", columns, keys,
            settings.state_buckets, settings.state_segments, settings.version_grace_s,
        )

    def number_of(self, batch_id: int) -> int:
        taken = max([-1, *self._live.versions(), *self._delays.versions(), *self._last_seen.versions()])
        return self._numbers.of(run_of(self._spark, self._checkpoint), batch_id, above=taken)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        """A micro-batch of merged arrivals with `flushed`."""
        batch = batch.persist()
        try:
            facts = batch.agg(F.min("arrival_seq").alias("first"), F.max("flushed").alias("flushed"))
            first, flushed = facts.first()
            if first is not None:
                self.enrich(batch, self.number_of(batch_id), first, flushed)
        finally:
            batch.unpersist()

    def enrich(self, batch: DataFrame, number: int, first: int, flushed: int) -> None:
        def earlier(table: KeyedTable, asked: DataFrame | None = None) -> DataFrame:
            """What was known before this batch. Messages of a slow partition can have lower
            numbers than rows already handled; those rows still count as arrived before them."""
            place = F.least("arrival_seq", F.lit(first - 1))
            return table.before(number, asked).withColumn("arrival_seq", place)

        remembered = F.lit(True)
        if self._settings.state_ttl_s is not None:
            remembered = F.col("flushed") >= flushed - self._settings.state_ttl_s
        positions, news = positions_of(batch, "flushed"), updates_of(batch, "flushed")
        # Delays of the trips that positions ask for; the last positions of all, since any may be near.
        updates = earlier(self._delays, positions).filter(remembered).unionByName(news)
        known = earlier(self._last_seen).filter(remembered)

        # Readings further than the window from every new one can bunch with none of them, so the work follows
        # the vehicles that are about and not all there ever were.
        window = self._settings.bunching_window_s
        first_ts, last_ts = positions.agg(F.min("timestamp"), F.max("timestamp")).first()
        about = F.lit(False)
        if first_ts is not None:
            about = F.col("timestamp").between(first_ts - window, last_ts + window)
        enriched = with_flags(
            attach_delay(positions, updates, self._settings),
            bunching_arrivals(known.filter(about).unionByName(positions), self._settings),
        )
        # The batch has a folder of its own, so writing it again replaces what it wrote before,
        # and the live table is built from the written rows instead of enriching twice.
        day = dt.datetime.fromtimestamp(flushed, dt.timezone.utc)
        folder = f"{self._places.silver}/{day:year=%Y/month=%m/day=%d}/batch={number}"
        enriched.write.mode("overwrite").parquet(folder)

        # Rows of this batch are newer than all that is stored, whatever their numbers.
        self._delays.write(latest_per_key(news, ["trip_id"]), number)
        self._last_seen.write(latest_per_key(positions, ["route_id", "vehicle_id"]), number)
        written = self._spark.read.schema(schemas.SILVER).parquet(folder)
        vehicles = written.select("arrival_seq", *schemas.LIVE_COLUMNS)
        self._live.write(latest_per_key(vehicles, ["vehicle_id"]), number)


def start(
    spark: SparkSession,
    arrivals: DataFrame,
    places: Places,
    once: bool = False,
    settings: Settings = DEFAULTS,
) -> StreamingQuery:
    """Run the enrichment over a merged stream into the silver folder and the live table."""
    writer = (
        arrivals.withColumn("flushed", flush_time())
        .writeStream.foreachBatch(BatchEnricher(spark, places, settings))
        .option("checkpointLocation", f"{places.checkpoints}/enrich")
    )
    return triggered(writer, once, settings).start()
