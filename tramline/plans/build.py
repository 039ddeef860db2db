"""The batch build: staging once, every gold table from it, then the data tests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tramline.plans.marts import build_marts
from tramline.plans.quality import DataTest, data_tests
from tramline.plans.staging import stage_events
from tramline.settings import DEFAULTS, Settings

STAGED_VIEW = "stg_vehicle_events"


def rebuild_gold(
    spark: SparkSession,
    silver: DataFrame,
    agencies: DataFrame,
    staging_path: str,
    settings: Settings = DEFAULTS,
) -> list[DataTest]:
    """Replace the gold tables and return the data tests over the staged events.

    Staging is written before it is read nine times: as a plain view its de-duplication would
    run again for each table and test, and a cached one would be lost with its executors.
    """
    stage_events(silver, settings).write.mode("overwrite").parquet(staging_path)
    staged = spark.read.parquet(staging_path)
    staged.createOrReplaceTempView(STAGED_VIEW)
    save_gold(build_marts(staged, agencies, settings) | {"agency_lookup": agencies})
    return data_tests(staged, settings)


def save_gold(tables: dict[str, DataFrame]) -> None:
    for name, rows in tables.items():
        rows.write.mode("overwrite").saveAsTable(name)


def read_gold(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)
