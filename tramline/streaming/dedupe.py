"""Repeated readings removed as they come: of each vehicle and instant the preferred row, corrected when a better one arrives.

Staging keeps the row with the lowest delay, which is not known before the last repeat has come. So the first row of a
vehicle and instant is handed on at once, and a later one that is preferred is handed on as a correction; one that is not
hands the known row on again. It is a streaming aggregate of Spark's, whose state holds the preferred row; behind the watermark
nothing comes any more, and the row is forgotten. The corrections are written into a table by key, whose rows after the last batch are those that batch staging keeps.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tramline import schemas
from tramline.plans.staging import PREFERRED, stage_events
from tramline.settings import DEFAULTS, Settings
from tramline.sources.folders import BatchNumbers, KeyedTable, run_of
from tramline.streaming.sinks import triggered

_KEYS = ["vehicle_id", "timestamp"]
_REST = [name for name in schemas.SILVER.names if name not in PREFERRED]


def corrections(silver: DataFrame, late_s: int) -> DataFrame:
    """A stream of silver rows to the rows staging keeps so far, in output mode `update`: those of the keys a batch had rows of.
    Rows later than `late_s` seconds behind the newest are left out."""
    timed = silver.withColumn("event", F.timestamp_seconds("timestamp")).withWatermark("event", f"{late_s} seconds")
    # Ascending by the preferred columns, nulls last, as in staging.
    order = [F.struct(F.col(name).isNull().alias("unknown"), F.col(name).alias("value")).alias(name) for name in PREFERRED]
    best = timed.groupBy(*_KEYS, "event").agg(F.min(F.struct(*order, *_REST)).alias("best"))
    # The keys too are taken from the row: as columns of the aggregate they would bring its order along, which Spark cannot cache.
    return best.select(*[F.col(f"best.{name}.value" if name in PREFERRED else f"best.{name}").alias(name) for name in schemas.SILVER.names])


def preferred_table(spark: SparkSession, path: str, settings: Settings = DEFAULTS) -> KeyedTable:
    return KeyedTable(
        spark, path, schemas.ddl(schemas.SILVER), _KEYS, settings.state_buckets, settings.state_segments, settings.version_grace_s
    )


def read_staged(spark: SparkSession, path: str, settings: Settings = DEFAULTS) -> DataFrame:
    """Staged events as far as the stream has come."""
    return stage_events(preferred_table(spark, path, settings).before(), settings)


def start(
    silver: DataFrame, path: str, checkpoint: str, late_s: int, once: bool = False, settings: Settings = DEFAULTS
) -> StreamingQuery:
    """Keep the staged rows of a stream in the table at `path`. A batch writes the rows that are new or corrected."""
    spark = silver.sparkSession
    table, numbers = preferred_table(spark, path, settings), BatchNumbers(spark, f"{checkpoint}/numbers")

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            if not batch.isEmpty():
                table.write(batch, numbers.of(run_of(spark, checkpoint), batch_id, max([-1, *table.versions()])))
        finally:
            batch.unpersist()

    writer = corrections(silver, late_s).writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)
    return triggered(writer, once, settings).start()
