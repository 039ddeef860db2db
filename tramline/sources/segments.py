"""Topics as landed message segments: a source with offsets and a publishing sink, as Spark data sources.

A topic is a folder, each of its partitions a folder of segments. A segment is a Parquet file of messages in order, named by the
offset of its first message and their number, so that offsets need no column and no index. Streams begin at the
newest offsets or at the oldest; where they began is written down beside their checkpoint, so that nothing is
skipped when a stream is restarted before it has read anything.

A sink's tasks write segments aside. Its commit gives them their offsets, in a plan that is written before the first of them
is moved to its place; so a failed task leaves no message, and a batch that is committed again
finishes what its plan says. One writer at a time per folder.
"""

from __future__ import annotations

import json
import posixpath
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, DataSourceStreamArrowWriter, DataSourceStreamReader, InputPartition, WriterCommitMessage,
)
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

import tramline
from tramline.settings import DEFAULTS, Settings
from tramline.sources.folders import Folder
from tramline.sources.topics import count_while_writing, kafka_arrival
from tramline.streaming.sinks import triggered

FORMAT = "message_segments"
SCHEMA = "value string, topic string, partition int, offset long, timestamp timestamp"
_ROWS_AT_ONCE = 8192
# Most messages that one task reads: a segment is as long as what one task published, which may have been all.
MESSAGES_PER_SLICE = 1 << 17
_STORED = pa.schema([("value", pa.string()), ("timestamp", pa.timestamp("us", "UTC"))])


@dataclass(frozen=True)
class Segment:
    topic: str
    partition: int
    first: int
    count: int

    @property
    def end(self) -> int:
        return self.first + self.count

    @property
    def path(self) -> str:
        return f"{self.topic}/{self.partition}/{self.first:020d}-{self.count}.parquet"


class Topics:
    """A folder of topics on whatever file system its path names."""

    def __init__(self, path: str) -> None:
        self.files, self.root = fs.FileSystem.from_uri(path if "://" in path else posixpath.abspath(path.removeprefix("file:")))

    def segments(self, topic: str) -> list[Segment]:
        found = self.files.get_file_info(fs.FileSelector(f"{self.root}/{topic}", recursive=True, allow_not_found=True))
        out = []
        for info in found:
            if info.is_file and info.extension == "parquet":
                folder, name = posixpath.split(info.path)
                first, count = name.removesuffix(".parquet").split("-")
                out.append(Segment(topic, int(posixpath.basename(folder)), int(first), int(count)))
        return sorted(out, key=lambda s: (s.partition, s.first))

    def ends(self, topics: Sequence[str]) -> dict[str, int]:
        """The next offset of each partition that has messages, by `topic/partition`."""
        ends: dict[str, int] = {}
        for topic in topics:
            for segment in self.segments(topic):
                key = f"{topic}/{segment.partition}"
                ends[key] = max(segment.end, ends.get(key, 0))
        return ends

    def names(self) -> list[str]:
        found = self.files.get_file_info(fs.FileSelector(self.root, allow_not_found=True))
        return sorted(info.base_name for info in found if info.type == fs.FileType.Directory and info.base_name[0] != "_")

    def read_text(self, path: str) -> str | None:
        if self.files.get_file_info(path).type == fs.FileType.NotFound:
            return None
        with self.files.open_input_stream(path) as file:
            return file.read().decode()

    def write_text(self, path: str, text: str) -> None:
        """Complete or not there at all."""
        self.files.create_dir(posixpath.dirname(path))
        aside = f"{path}.{uuid.uuid4().hex}"
        with self.files.open_output_stream(aside) as file:
            file.write(text.encode())
        self.files.move(aside, path)


@dataclass
class Slice(InputPartition):
    """Messages of one segment from offset `start` to before `stop`."""

    segment: Segment
    start: int
    stop: int


class _Reader:
    def __init__(self, options: dict[str, str]) -> None:
        self._path = options["path"]
        self._topics = [topic.strip() for topic in options["topics"].split(",")]

    def slices(self, start: dict[str, int], end: dict[str, int]) -> list[Slice]:
        out = []
        topics = Topics(self._path)
        for topic in self._topics:
            here = {key for key in end if key.rpartition("/")[0] == topic}
            reached = {key: start.get(key, 0) for key in here}
            for segment in topics.segments(topic):
                key = f"{topic}/{segment.partition}"
                if key not in here or segment.end <= reached[key] or segment.first >= end[key]:
                    continue
                if segment.first > reached[key]:
                    raise RuntimeError(f"messages {reached[key]} to {segment.first} of {key} are gone")
                stop = min(segment.end, end[key])
                for start_at in range(reached[key], stop, MESSAGES_PER_SLICE):
                    out.append(Slice(segment, start_at, min(start_at + MESSAGES_PER_SLICE, stop)))
                reached[key] = segment.end
            if missing := [key for key in here if reached[key] < end[key]]:
                raise RuntimeError(f"messages of {missing} are gone")
        return out

    def read(self, partition: Slice) -> Iterator[pa.RecordBatch]:
        segment, topics = partition.segment, Topics(self._path)
        with topics.files.open_input_file(f"{topics.root}/{segment.path}") as file:
            stored = pq.ParquetFile(file)
            # Only the row groups that hold some of the slice.
            groups, at, end = [], segment.first, segment.first
            for group in range(stored.num_row_groups):
                rows = stored.metadata.row_group(group).num_rows
                if end < partition.stop and end + rows > partition.start:
                    groups.append(group)
                elif not groups:
                    at = end + rows
                end += rows
            for batch in stored.iter_batches(_ROWS_AT_ONCE, row_groups=groups) if groups else ():
                low, high = max(partition.start - at, 0), min(partition.stop - at, batch.num_rows)
                if low < high:
                    part = batch.slice(low, high - low)
                    offsets = pa.array(range(at + low, at + high), pa.int64())
                    columns = [
                        part.column("value"), pa.array([segment.topic] * part.num_rows), pa.array([segment.partition] * part.num_rows, pa.int32()),
                        offsets, part.column("timestamp"),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, ["value", "topic", "partition", "offset", "timestamp"])
                at += batch.num_rows


class BatchReader(_Reader, DataSourceReader):
    """All messages there are."""

    def partitions(self) -> Sequence[InputPartition]:
        topics = Topics(self._path)
        oldest: dict[str, int] = {}
        for topic in self._topics:
            for segment in topics.segments(topic):
                oldest.setdefault(f"{topic}/{segment.partition}", segment.first)
        # Without messages there still has to be a partition to read nothing from.
        return self.slices(oldest, topics.ends(self._topics)) or [Slice(Segment("", 0, 0, 0), 0, 0)]

    def read(self, partition: Slice) -> Iterator[pa.RecordBatch]:
        return _Reader.read(self, partition) if partition.segment.count else iter(())


class StreamReader(_Reader, DataSourceStreamReader):
    """Messages by offset of each partition."""

    def __init__(self, options: dict[str, str]) -> None:
        super().__init__(options)
        self._from_oldest = options.get("startingOffsets", "latest") == "earliest"
        self._began = options.get("began")

    def initialOffset(self) -> dict:
        """Where the stream began; found once, and then kept in the file that the option `began` names."""
        topics = Topics(self._path)
        kept = Topics(posixpath.dirname(self._began)) if self._began else None
        file = f"{kept.root}/{posixpath.basename(self._began)}" if kept else ""
        if kept and (text := kept.read_text(file)) is not None:
            return json.loads(text)
        begin = {"": 0}
        if self._from_oldest:
            for topic in self._topics:
                for segment in topics.segments(topic):
                    begin.setdefault(f"{topic}/{segment.partition}", segment.first)
        else:
            begin |= topics.ends(self._topics)
        if kept:
            kept.write_text(file, json.dumps(begin))
        return begin

    def latestOffset(self) -> dict:
        # Never an empty record: the first entry stands for a topic without messages.
        return {"": 0} | Topics(self._path).ends(self._topics)

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        return self.slices(start, end)


@dataclass
class Written(WriterCommitMessage):
    """What a task has put aside: per topic a file and its number of messages."""

    task: int
    files: list[tuple[str, str, int]]


class _Writer:
    def __init__(self, options: dict[str, str]) -> None:
        self._path, self._partitions = options["path"], int(options.get("partitions", 1))
        self._run = options.get("run") or uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        topics, task = Topics(self._path), TaskContext.get().partitionId()
        aside = f"{topics.root}/_aside/{uuid.uuid4().hex}"
        topics.files.create_dir(aside)
        writers: dict[str, tuple[str, pq.ParquetWriter]] = {}
        counts: dict[str, int] = {}
        try:
            for batch in iterator:
                for topic in pc.unique(batch.column("topic")).to_pylist():
                    part = batch.filter(pc.equal(batch.column("topic"), topic))
                    if topic not in writers:
                        file = f"{aside}/{len(writers)}.parquet"
                        writers[topic] = (file, pq.ParquetWriter(file, _STORED, filesystem=topics.files))
                    stored = pa.Table.from_batches([part]).select(_STORED.names).cast(_STORED)
                    writers[topic][1].write_table(stored)
                    counts[topic] = counts.get(topic, 0) + part.num_rows
        finally:
            for _, writer in writers.values():
                writer.close()
        return Written(task, [(topic, writers[topic][0], counts[topic]) for topic in sorted(writers)])

    def publish(self, messages: Sequence[WriterCommitMessage | None], batch: str) -> None:
        """Moves what the tasks wrote to the ends of its partitions, once for a batch."""
        topics = Topics(self._path)
        plan_file = f"{topics.root}/_plans/{batch}.json"
        written = sorted((m for m in messages if m is not None), key=lambda m: m.task)
        text = topics.read_text(plan_file)
        if text is None:
            ends = topics.ends(sorted({topic for m in written for topic, *_ in m.files}))
            plan = []
            for message in written:
                for topic, file, count in message.files:
                    partition = message.task % self._partitions
                    first = ends.get(f"{topic}/{partition}", 0)
                    ends[f"{topic}/{partition}"] = first + count
                    plan.append((file, Segment(topic, partition, first, count).path))
            topics.write_text(plan_file, json.dumps(plan))
        else:
            # This batch has its plan from an earlier try, whose files count.
            plan = json.loads(text)
            self.discard([m for m in written if not any(file == planned for _, file, _ in m.files for planned, _ in plan)])
        for file, place in plan:
            if topics.files.get_file_info(f"{topics.root}/{place}").type == fs.FileType.NotFound:
                topics.files.create_dir(posixpath.dirname(f"{topics.root}/{place}"))
                topics.files.move(file, f"{topics.root}/{place}")

    def discard(self, messages: Sequence[WriterCommitMessage | None]) -> None:
        topics = Topics(self._path)
        for message in messages:
            for _, file, _ in message.files if message is not None else ():
                if topics.files.get_file_info(file).is_file:
                    topics.files.delete_file(file)


class BatchWriter(_Writer, DataSourceArrowWriter):
    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        self.publish(messages, self._run)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        self.discard(messages)


class StreamWriter(_Writer, DataSourceStreamArrowWriter):
    def commit(self, messages: list[WriterCommitMessage | None], batchId: int) -> None:
        self.publish(messages, f"{self._run}-{batchId}")

    def abort(self, messages: list[WriterCommitMessage | None], batchId: int) -> None:
        self.discard(messages)


class MessageSegments(DataSource):
    """Options: `path`, `topics` (read; comma-separated), `startingOffsets`, `began` (streams), `partitions`, `run` (written)."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        return BatchReader(self.options)

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return StreamReader(self.options)

    def writer(self, schema: StructType, overwrite: bool) -> BatchWriter:
        return BatchWriter(self.options)

    def streamWriter(self, schema: StructType, overwrite: bool) -> StreamWriter:
        return StreamWriter(self.options)


def register(spark: SparkSession) -> None:
    # The classes travel to the workers as code, which need not have this package installed.
    cloudpickle.register_pickle_by_value(tramline)
    spark.dataSource.register(MessageSegments)


def _as_messages(rows: DataFrame) -> DataFrame:
    return rows.select("value", kafka_arrival().alias("arrival"), F.col("timestamp").alias("ingest_time"))


def all_messages(spark: SparkSession, path: str, topics: list[str]) -> DataFrame:
    """All messages of the topics, as `kafka_messages` gives them."""
    register(spark)
    return _as_messages(spark.read.format(FORMAT).option("topics", ",".join(topics)).load(path))


def new_messages(spark: SparkSession, path: str, topics: list[str], checkpoint: str, oldest: bool = False) -> DataFrame:
    """New messages of the topics as a stream, as `kafka_messages` gives them, for the query with this checkpoint.

    It begins at the newest offsets of its first start, or at the `oldest`, and goes on from its checkpoint afterwards.
    """
    register(spark)
    reader = spark.readStream.format(FORMAT).option("topics", ",".join(topics)).option("began", f"{checkpoint}/began/{'+'.join(topics)}.json")
    return _as_messages(reader.option("startingOffsets", "earliest" if oldest else "latest").load(path))


def _outgoing(messages: DataFrame) -> DataFrame:
    time = F.col("timestamp") if "timestamp" in messages.columns else F.current_timestamp()
    return messages.select("topic", F.col("value").cast("string").alias("value"), time.cast("timestamp").alias("timestamp"))


def publish(messages: DataFrame, path: str, partitions: int = 1) -> int:
    """Send messages (`topic, value`, and `timestamp` or the time of sending) and return how many there were."""
    register(messages.sparkSession)
    sent, counted = count_while_writing(_outgoing(messages))
    counted.write.format(FORMAT).option("partitions", partitions).mode("append").save(path)
    return sent.get["messages"]


def publish_stream(
    messages: DataFrame, path: str, checkpoint: str, partitions: int = 1, once: bool = False, settings: Settings = DEFAULTS
) -> StreamingQuery:
    """Send a stream's messages, each batch once however often it is tried."""
    spark = messages.sparkSession
    register(spark)
    # Batches are known by a number of this checkpoint, not by its path: a new one in the same place starts to count again.
    folder = Folder(spark, checkpoint)
    if not (runs := folder.matching("run=*")):
        folder.make(f"{folder.path}/run={uuid.uuid4().hex}")
        runs = folder.matching("run=*")
    writer = (
        _outgoing(messages).writeStream.format(FORMAT).option("path", path).option("partitions", partitions)
        .option("run", runs[0].rpartition("=")[2]).option("checkpointLocation", checkpoint)
    )
    return triggered(writer, once, settings).start()
