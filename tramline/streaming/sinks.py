"""Stream sinks: partitioned Parquet folders and the console."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tramline.functions.clock import partition_keys
from tramline.settings import DEFAULTS, Settings
from tramline.sources.folders import run_of

FOLDER_KEYS = ["year", "month", "day"]


def flush_time() -> Column:
    """The clock of the micro-batch, in epoch seconds.

    Inside a streaming plan it is fixed per micro-batch and kept in the offset log, so a batch
    that is run again gets the same one.
    """
    return F.unix_seconds(F.current_timestamp())


def triggered(
    writer: DataStreamWriter, once: bool = False, settings: Settings = DEFAULTS
) -> DataStreamWriter:
    """Flush every interval, or take all there is and stop."""
    if once:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=settings.flush_interval)


def append_parquet(
    rows: DataFrame, path: str, checkpoint: str, once: bool = False, settings: Settings = DEFAULTS
) -> StreamingQuery:
    """Append a stream to the UTC day folders of its flushes.

    Each micro-batch has a folder of its own, named by the checkpoint's id and the batch, which
    it replaces when it is tried again; so every row appears once. There is no list of files
    beside the folders, and old days can be removed or compacted at any time.
    """
    spark = rows.sparkSession

    def write(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, path, f"{run_of(spark, checkpoint)}-{batch_id}")

    writer = (
        rows.select("*", *partition_keys(flush_time()))
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
    )
    return triggered(writer, once, settings).start()


def write_batch(rows: DataFrame, path: str, batch: str) -> None:
    """Rows with folder keys into the folders of one batch, replacing what a failed try left."""
    (
        rows.withColumn("batch", F.lit(batch))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*FOLDER_KEYS, "batch")
        .parquet(path)
    )


def print_rows(rows: DataFrame, once: bool = False, settings: Settings = DEFAULTS) -> StreamingQuery:
    writer = rows.writeStream.format("console").option("truncate", "false")
    return triggered(writer, once, settings).start()
