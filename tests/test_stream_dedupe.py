"""Staged events kept up by a stream."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from test_plans import silver
from checks import registry
from tramline import schemas
from tramline.plans.staging import stage_events
from tramline.settings import Settings
from tramline.sources import topics
from tramline.sources.folders import Folder
from tramline.streaming import dedupe, stateful

FEW = Settings(state_buckets=4, state_segments=3)


@pytest.fixture
def store(spark):
    setting, provider = stateful.STATE_STORE
    before, partitions = spark.conf.get(setting), spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set(setting, provider)
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set(setting, before)
    spark.conf.set("spark.sql.shuffle.partitions", partitions)


def waves(spark, tmp_path, parts, late_s):
    landing, table, check = (str(tmp_path / name) for name in ("in", "table", "check"))
    for part in parts:
        frame = silver(spark, part).coalesce(1)
        frame.write.mode("append").parquet(landing)
        stream = topics.landed_files(spark, landing, frame.schema)
        dedupe.start(stream, table, check, late_s, once=True, settings=FEW).awaitTermination()
    return dedupe.read_staged(spark, table, FEW)


def test_the_table_equals_staging_after_the_last_batch(spark, store, tmp_path):
    rng = random.Random(12)
    rows = [
        (rng.choice([f"v{rng.randrange(5)}", None]), rng.choice(["1_x", "2_y", None]), "t", 1000 + rng.randrange(9), rng.choice([None, rng.randrange(-9, 9)]), rng.choice([True, False, None]))
        for _ in range(240)
    ]
    got = waves(spark, tmp_path, [rows[:100], rows[100:101], rows[101:]], late_s=86_400)
    want = stage_events(silver(spark, rows))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    versions = Folder(spark, str(tmp_path / "table")).matching("version=*")
    assert len(versions) >= 2


def test_rows_behind_the_watermark_are_forgotten(spark, store, tmp_path):
    first = [("v", "1_x", "t", 1000, 50, False)]
    far = [("v", "1_x", "t", 9000, 7, False)]
    later = [("w", "1_x", "t", 9001, 7, False), ("v", "1_x", "t", 1000, 10, False), ("v", "1_x", "t", 8950, 3, False)]
    got = {(r.vehicle_id, r.delay_seconds) for r in waves(spark, tmp_path, [first, far, later], late_s=100).collect()}
    # The repeat of 1000 came 8,000 seconds late; that of 8950 came in time.
    assert got == {("v", 50), ("v", 7), ("w", 7), ("v", 3)}


def test_keys_are_not_handled_one_by_one_in_python(spark):
    stream = spark.readStream.format("rate").load().select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schemas.SILVER.fields])
    plan = dedupe.corrections(stream, 100)._jdf.queryExecution().analyzed().toString()
    assert "Aggregate" in plan and "TransformWithState" not in plan and "Python" not in plan


def test_landing_in_waves_runs_the_plan_once(spark):
    runs = spark.sparkContext.accumulator(0)

    def seen(chunks):
        for chunk in chunks:
            runs.add(len(chunk))
            yield chunk

    rows = spark.range(10, numPartitions=1).toDF("arrival_seq").mapInPandas(seen, "arrival_seq long")
    landed = []

    def run(stream):
        query = stream.writeStream.foreachBatch(lambda batch, _: landed.append(batch.count())).trigger(availableNow=True).start()
        return query

    registry._waves(spark, rows, run)
    assert runs.value == 10 and sum(landed) == 5 + 10


def test_rows_without_a_time_do_not_cost_others(spark, store, tmp_path):
    rng = random.Random(5)
    rows = [
        (rng.choice([f"v{n % 90}", f"v{n % 90}", None]), "1_x", "t", rng.choice([1000 + n % 50, 1000 + n % 50, None]), rng.randrange(9), False)
        for n in range(600)
    ]
    got = waves(spark, tmp_path, [rows[:300], rows[300:]], late_s=86_400)
    want = stage_events(silver(spark, rows))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
