"""Reads of stored tables: silver folders, the agency dimension and the live table."""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, DataFrameReader, SparkSession

from tramline import schemas
from tramline.plans import dashboard
from tramline.schemas import HISTORY_COLUMNS
from tramline.settings import DEFAULTS, Settings
from tramline.sources.folders import Folder, KeyedTable


def read_silver(spark: SparkSession, path: str) -> DataFrame:
    """All silver folders with their partition columns; columns a file lacks come back null."""
    return _silver_reader(spark).parquet(path)


def _silver_reader(spark: SparkSession) -> DataFrameReader:
    """The schema is declared, so no file footers are merged and old files need no rewrite."""
    return spark.read.schema(f"{schemas.ddl(schemas.SILVER)}, year INT, month INT, day INT")


def read_merged(spark: SparkSession, path: str) -> DataFrame:
    """Files of differing schemas united by column name, for folders without a declared schema."""
    return spark.read.option("mergeSchema", "true").parquet(path)


def read_history(
    spark: SparkSession, path: str, today: dt.date, settings: Settings = DEFAULTS
) -> DataFrame:
    """The dashboard's history: the last days, else everything, else no rows.

    The recent read names the folders of those days, so no other is listed or opened. `today` is
    the UTC date, because folders are named by it. Rows are in time order; the arrival number
    behind it lets one frequent timestamp be split over several sort tasks.
    """
    folder = Folder(spark, path)
    days = [today - dt.timedelta(days=back) for back in range(settings.recent_days)]
    there = [found for day in days for found in folder.matching(f"{day:year=%Y/month=%m/day=%d}")]
    chosen = None
    if there:
        chosen = _silver_reader(spark).option("basePath", path).parquet(*there)
    if chosen is None or chosen.isEmpty():
        try:
            chosen = read_silver(spark, path)
        except AnalysisException:
            chosen = spark.createDataFrame([], schemas.SILVER)
    return chosen.orderBy("timestamp", "arrival_seq").select(HISTORY_COLUMNS)


def read_agencies(spark: SparkSession, path: str) -> DataFrame:
    """The agency dimension from CSV. Ids stay text: some are not numbers."""
    return spark.read.csv(path, header=True, schema=schemas.AGENCY)


def live_table(spark: SparkSession, path: str, settings: Settings = DEFAULTS) -> KeyedTable:
    """The latest row per vehicle, with the arrival number that decides which row is latest."""
    columns = f"arrival_seq bigint, {schemas.ddl(schemas.LIVE)}"
    return KeyedTable(
        spark, path, columns, ["vehicle_id"], settings.state_buckets, settings.state_segments, settings.version_grace_s
    )


def read_live(spark: SparkSession, path: str, settings: Settings = DEFAULTS) -> DataFrame:
    """Live rows, normalised; no rows where no stream has written any yet.

    The key-value backend is read without the trip id, over all of its rows.
    """
    live = live_table(spark, path).before().select(schemas.LIVE_COLUMNS)
    if settings.live_backend == "dynamodb":
        live = dashboard.as_keyvalue_values(live).drop("trip_id")
    return dashboard.normalize_live(live)
