"""Write, audit, publish: a batch of staged events is seen by readers only if no data test of error severity fails.

The batch is written once, beside the published ones. Tests of single rows are counted by that write as rows pass; tests of
groups run over the written rows, two narrow columns sets with map-side partials. Violations of `warn` severity are
recorded with the batch and do not stop it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tramline.plans import quality
from tramline.settings import DEFAULTS, Settings
from tramline.sources.folders import Folder

REPORT = "batch string, test string, severity string, violations bigint, published boolean"


@dataclass(frozen=True)
class Audit:
    """What the tests found, by their names; `published` tells whether readers see the batch."""

    violations: dict[str, int]
    published: bool


def publish_batch(staged: DataFrame, path: str, batch: str, settings: Settings = DEFAULTS) -> Audit:
    """Writes a batch of staged events, audits it and moves it to its place; a batch that is tried again replaces itself."""
    spark = staged.sparkSession
    folder = Folder(spark, path)
    pending = f"{folder.path}/_pending/batch={batch}"
    seen = Observation()
    on_rows = {
        "vehicle_id is present": F.col("vehicle_id").isNull(),
        "route_id is present": F.col("route_id").isNull(),
        "delay_seconds is plausible": ~F.col("delay_seconds").between(settings.delay_floor_s, settings.delay_ceiling_s),
    }
    counts = [F.count_if(F.coalesce(broken, F.lit(False))).alias(name) for name, broken in on_rows.items()]
    staged.observe(seen, *counts).write.mode("overwrite").parquet(pending)
    written = spark.read.schema(staged.schema).parquet(pending)
    found = dict(seen.get) | {
        "one event per vehicle and time": quality.repeated_events(written).count(),
        "delays keep changing": quality.stale_delays(written, settings).count(),
    }
    severity = {test.name: test.severity for test in quality.data_tests(written, settings)}
    published = not any(found[name] for name, level in severity.items() if level == "error")
    report = [(batch, name, severity[name], found[name], published) for name in severity]
    spark.createDataFrame(report, REPORT).coalesce(1).write.mode("overwrite").parquet(f"{folder.path}/_audits/batch={batch}")
    if published:
        folder.remove(f"{folder.path}/batch={batch}")
        folder.move(pending, f"{folder.path}/batch={batch}")
    return Audit(found, published)


def published(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The events of all published batches."""
    batches = Folder(spark, path).matching("batch=*")
    return spark.read.schema(schema).parquet(*batches) if batches else spark.createDataFrame([], schema)


def audits(spark: SparkSession, path: str) -> DataFrame:
    """Every batch's tests, also of batches that were held back."""
    reports = Folder(spark, path).matching("_audits/batch=*")
    return spark.read.schema(REPORT).parquet(*reports) if reports else spark.createDataFrame([], REPORT)
