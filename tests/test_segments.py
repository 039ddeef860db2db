"""Published messages and where streams begin."""

from __future__ import annotations

import datetime as dt

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tramline.operators.arrival import numbered
from tramline.sources import segments, topics
from tramline.sources.folders import Folder


def batch(spark, low, high, topic="positions"):
    return spark.range(low, high, 1, 3).select(
        F.lit(topic).alias("topic"), F.concat(F.lit("m"), "id").alias("value"), F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id")).alias("timestamp")
    )


def values(rows):
    return sorted(int(r.value[1:]) for r in rows.select("value").collect())


def drained(stream, out, checkpoint):
    stream.select("value").writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out).awaitTermination()


def test_offsets_are_gapless_over_batches_and_partitions(spark, tmp_path):
    path = str(tmp_path / "topics")
    assert segments.all_messages(spark, path, ["positions"]).count() == 0
    assert [segments.publish(batch(spark, 0, 50), path, 2), segments.publish(batch(spark, 50, 51), path, 2)] == [50, 1]
    assert segments.publish(batch(spark, 0, 7, "updates"), path, 2) == 7
    assert segments.publish(batch(spark, 0, 0), path, 2) == 0
    rows = segments.all_messages(spark, path, ["positions", "updates"])
    places = {}
    for r in rows.collect():
        places.setdefault((r.arrival.topic, r.arrival.partition), []).append(r.arrival.offset)
    assert set(places) == {("positions", 0), ("positions", 1), ("updates", 0), ("updates", 1)}
    assert all(sorted(offsets) == list(range(len(offsets))) for offsets in places.values())
    assert values(rows.filter("arrival.topic = 'positions'")) == list(range(51))
    # Arrival numbers follow the messages' times.
    ordered = numbered(rows.filter("arrival.topic = 'positions'").cache()).orderBy("arrival_seq").collect()
    assert [(r.arrival_seq, r.value) for r in ordered] == [(n, f"m{n}") for n in range(51)]


def test_a_failed_task_leaves_no_message(spark, tmp_path):
    path = str(tmp_path / "topics")
    segments.publish(batch(spark, 0, 10), path)
    spoiled = batch(spark, 10, 40).withColumn("value", F.when(F.col("value") == "m35", F.raise_error(F.lit("broken"))).otherwise(F.col("value")))
    with pytest.raises(PySparkException):
        segments.publish(spoiled, path)
    assert values(segments.all_messages(spark, path, ["positions"])) == list(range(10))
    segments.publish(batch(spark, 10, 40), path)
    assert values(segments.all_messages(spark, path, ["positions"])) == list(range(40))


def test_a_batch_is_published_once_however_often_it_is_committed(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    path = tmp_path / "topics"
    writer = segments._Writer({"path": str(path), "run": "r"})

    def aside(name, *found):
        (path / "_aside").mkdir(parents=True, exist_ok=True)
        file = str(path / "_aside" / name)
        pq.write_table(pa.table({"value": list(found), "timestamp": pa.array([0] * len(found), pa.timestamp("us", "UTC"))}), file)
        return segments.Written(0, [("positions", file, len(found))])

    first = aside("a", "m0", "m1")
    writer.publish([first], "r-0")
    writer.publish([first], "r-0")
    # Tried again as a whole after a crash: the first try's plan holds, the second one's files go.
    writer.publish([aside("b", "m0", "m1")], "r-0")
    writer.publish([aside("c", "m2"), None], "r-1")
    assert values(segments.all_messages(spark, str(path), ["positions"])) == [0, 1, 2]
    assert not list((path / "_aside").glob("*"))
    # A crash between the plan and the moves is finished by the next try.
    last = aside("d", "m3")
    segments.Topics(str(path)).write_text(f"{path}/_plans/r-2.json", f'[["{last.files[0][1]}", "positions/0/{3:020d}-1.parquet"]]')
    writer.publish([aside("e", "m3")], "r-2")
    assert values(segments.all_messages(spark, str(path), ["positions"])) == [0, 1, 2, 3]


def test_a_stream_begins_at_the_newest_message_and_restarts_without_loss(spark, tmp_path):
    path, out, check = (str(tmp_path / name) for name in ("topics", "out", "check"))
    segments.publish(batch(spark, 0, 100), path, 2)
    stream = lambda: segments.new_messages(spark, path, ["positions"], check)
    drained(stream(), out, check)
    # Published while the stream is down, before it has read anything.
    segments.publish(batch(spark, 100, 130), path, 2)
    drained(stream(), out, check)
    segments.publish(batch(spark, 130, 140), path, 2)
    segments.publish(batch(spark, 140, 141), path, 3)
    drained(stream(), out, check)
    drained(stream(), out, check)
    assert values(spark.read.parquet(out)) == list(range(100, 141))
    again, check = str(tmp_path / "again"), str(tmp_path / "check2")
    drained(segments.new_messages(spark, path, ["positions"], check, oldest=True), again, check)
    assert values(spark.read.parquet(again)) == list(range(141))


def test_removed_messages_are_noticed(spark, tmp_path):
    path, out, check = (str(tmp_path / name) for name in ("topics", "out", "check"))
    segments.publish(batch(spark, 0, 3).coalesce(1), path)
    drained(segments.new_messages(spark, path, ["positions"], check, oldest=True), out, check)
    segments.publish(batch(spark, 3, 6).coalesce(1), path)
    segments.publish(batch(spark, 6, 9).coalesce(1), path)
    folder = Folder(spark, path)
    folder.remove(f"{path}/positions/0/{3:020d}-3.parquet")
    with pytest.raises(Exception, match="gone"):
        drained(segments.new_messages(spark, path, ["positions"], check), out, check)


def test_a_stream_is_published_once(spark, tmp_path):
    landing, path, check = (str(tmp_path / name) for name in ("landing", "topics", "check"))
    for low in (0, 20):
        batch(spark, low, low + 20).write.mode("append").parquet(landing)
        stream = topics.landed_files(spark, landing, batch(spark, 0, 1).schema)
        segments.publish_stream(stream, path, check, partitions=2, once=True).awaitTermination()
    assert values(segments.all_messages(spark, path, ["positions"])) == list(range(40))


def test_a_long_segment_is_read_by_several_tasks(tmp_path, monkeypatch):
    """One task published all; each message is read once, from whatever row groups hold it."""
    monkeypatch.setattr(segments, "MESSAGES_PER_SLICE", 10, raising=False)
    times = [dt.datetime(2024, 4, 7, tzinfo=dt.timezone.utc)] * 47
    table = pa.table({"value": [f"m{n}" for n in range(100, 147)], "timestamp": times}, schema=segments._STORED)
    for rows_of_group in (1, 4, 10, 13, 47):
        root = tmp_path / f"groups-of-{rows_of_group}"
        (root / "a" / "0").mkdir(parents=True)
        pq.write_table(table, root / "a" / "0" / f"{100:020d}-47.parquet", row_group_size=rows_of_group)
        options = {"path": str(root), "topics": "a"}
        reader = segments.StreamReader(options)
        for start, stop in ((100, 147), (103, 147), (100, 121), (119, 120)):
            slices = reader.slices({"a/0": start}, {"a/0": stop})
            assert len(slices) == -(-(stop - start) // 10) and max(s.stop - s.start for s in slices) <= 10
            read = [(value, offset) for s in slices for batch in reader.read(s) for value, offset in zip(batch.column("value").to_pylist(), batch.column("offset").to_pylist())]
            assert read == [(f"m{n}", n) for n in range(start, stop)]
        whole = [(s.start, s.stop) for s in segments.BatchReader(options).partitions()]
        assert whole == [(100, 110), (110, 120), (120, 130), (130, 140), (140, 147)]
