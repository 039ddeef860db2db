"""Topics in and out: Kafka where its connector is installed, a folder of Parquet files else."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def kafka_messages(
    spark: SparkSession, servers: str, topics: list[str], per_batch: int | None = None
) -> DataFrame:
    """New messages of the topics as text, with their place in arrival order.

    One stream for all topics, so that they start at the same moment: at the newest offsets on the
    first run and at the checkpoint afterwards. `per_batch` bounds a micro-batch, so that catching
    up after an outage does not make one huge batch.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join(topics))
        .option("startingOffsets", "latest")
    )
    if per_batch:
        reader = reader.option("maxOffsetsPerTrigger", per_batch)
    return reader.load().select(
        F.col("value").cast("string").alias("value"),
        kafka_arrival().alias("arrival"),
        F.col("timestamp").alias("ingest_time"),
    )


def kafka_arrival() -> Column:
    """Where a message stands in arrival order: time, topic, partition, offset.

    The time is the topic's message time, which the producer sets unless the topic says
    LogAppendTime. The struct is unique and loses nothing; `operators.arrival.numbered` turns it
    into the dense numbers the operators work with.
    """
    return F.struct(
        F.unix_millis("timestamp").alias("time"),
        F.col("topic"),
        F.col("partition").cast("int").alias("partition"),
        F.col("offset").cast("long").alias("offset"),
    )


def landed_files(
    spark: SparkSession, path: str, schema: StructType, files_per_batch: int | None = None
) -> DataFrame:
    """A folder of Parquet files as a stream, oldest file first."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def publish(messages: DataFrame, servers: str) -> int:
    """Send `fan_out` messages to their topics and return how many there were."""
    sent, counted = count_while_writing(messages)
    (
        counted.select("topic", F.col("value").cast("binary").alias("value"))
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .save()
    )
    return sent.get["messages"]


def count_while_writing(messages: DataFrame) -> tuple[Observation, DataFrame]:
    """Counts rows as they pass, so that the count costs no second run of the plan."""
    sent = Observation()
    return sent, messages.observe(sent, F.count(F.lit(1)).alias("messages"))


def publish_stream(messages: DataFrame, servers: str, checkpoint: str) -> StreamingQuery:
    return (
        messages.select("topic", F.col("value").cast("binary").alias("value"))
        .writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("checkpointLocation", checkpoint)
        .start()
    )
