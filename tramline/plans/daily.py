"""Gold kept up by day: what a day adds is stored once, and gold is merged from the days.

A day is a local date of staged events. Building it reads that day's events only; merging reads summaries,
which are as small as there are routes and agencies. Sums and counts add up. Distinct counts are bitmaps over numbered
ids, which merge exactly in any order; sketches are a smaller, approximate choice. Headways keep the first and the last departure of a route's
day beside their sums, and merging adds the gap between two days.

A trip counts on the first day it is seen, so days are built in order; a day that changes is built again, and
those after it that may share trips with it.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tramline.functions.labels import add_operator_name
from tramline.plans import marts
from tramline.settings import DEFAULTS, Settings
from tramline.sources.folders import Folder

# The day of events without a time.
NO_DAY = "none"
# Ids are numbered in so many buckets, each by itself.
BUCKETS = 64

_ROUTE, _AGENCY = "route_short_name", "agency_id"
_SUMS = "readings bigint, delays bigint, delay_sum bigint, bunched bigint"
_TABLES = {
    "routes": f"{_ROUTE} string, {_SUMS}",
    "agencies": f"{_AGENCY} string, {_SUMS}",
    "distinct": "counted string, key string, part bigint, bits binary",
    "sketches": "counted string, key string, sketch binary",
    "trips": f"{_ROUTE} string, trip_id string, first_seen_at timestamp_ntz",
    "headways": f"{_ROUTE} string, first_second bigint, last_second bigint, trip_count bigint, gap_sum bigint, square_sum bigint",
}
_NUMBERS = "kind string, id string, bucket int, place bigint"
# What is counted: the name of the count, the column it is grouped by and the ids.
_COUNTS = [("route_vehicles", _ROUTE, "vehicle_id"), ("agency_vehicles", _AGENCY, "vehicle_id"), ("agency_routes", _AGENCY, "route_id")]


def day_of(event_time: Column) -> Column:
    return F.coalesce(F.date_format(event_time, "yyyy-MM-dd"), F.lit(NO_DAY)).alias("event_day")


class DailyGold:
    """Summaries by day in a folder, and the gold tables merged from them."""

    def __init__(self, spark: SparkSession, path: str, sketches: bool = False, settings: Settings = DEFAULTS) -> None:
        self._spark, self._folder, self._sketches, self._settings = spark, Folder(spark, path), sketches, settings

    def days(self) -> list[str]:
        found = self._folder.matching("headways/day=*/_SUCCESS")
        return sorted(path.split("day=")[1].split("/")[0] for path in found)

    def build_day(self, events: DataFrame, day: str) -> None:
        """Replaces what a day adds. `events` are the staged events of that day alone."""
        # Summed per vehicle and trip first, in the only pass over the events: all that follows runs over that smaller result.
        each = events.groupBy(_ROUTE, _AGENCY, "vehicle_id", "route_id", "trip_id").agg(
            F.count(F.lit(1)).alias("readings"), F.count("delay_seconds").alias("delays"),
            F.coalesce(F.sum("delay_seconds"), F.lit(0)).alias("delay_sum"), F.count_if("is_bunching").alias("bunched"),
            F.min("event_time").alias("first_seen_at"),
        ).persist()
        try:
            sums = [F.sum(name).alias(name) for name in ("readings", "delays", "delay_sum", "bunched")]
            self._write(each.groupBy(_ROUTE).agg(*sums), "routes", day)
            self._write(each.groupBy(_AGENCY).agg(*sums), "agencies", day)
            if self._sketches:
                self._write(self._union(self._sketch(each, *count) for count in _COUNTS), "sketches", day)
            else:
                self._write(self._bitmaps(each, self._numbers(each)), "distinct", day)
            seen = each.groupBy(_ROUTE, "trip_id").agg(F.min("first_seen_at").alias("first_seen_at"))
            self._write(seen, "trips", day)
        finally:
            each.unpersist()
        here, earlier = self._read("trips", [day]), self._read("trips", [d for d in self._stored("trips") if d < day])
        same = here[_ROUTE].eqNullSafe(earlier[_ROUTE]) & here["trip_id"].eqNullSafe(earlier["trip_id"])
        gaps = marts.departures(here.join(earlier, same, "left_anti"))
        summary = gaps.groupBy(_ROUTE).agg(
            F.min("second").alias("first_second"), F.max("second").alias("last_second"), *marts.gap_sums(self._settings)
        )
        # The last to be written: a day without headways is not there.
        self._write(summary, "headways", day)

    def busiest_routes(self, days: Iterable[str] | None = None) -> DataFrame:
        sums = self._sums("routes", _ROUTE, days)
        merged = self._with_counts(sums, _ROUTE, days, active_vehicle_count="route_vehicles")
        return merged.select(
            _ROUTE, "active_vehicle_count", _average().alias("average_delay_seconds"), F.col("bunched").alias("bunching_events")
        ).orderBy(F.desc("active_vehicle_count"), _ROUTE)

    def operator_performance(self, agencies: DataFrame, days: Iterable[str] | None = None) -> DataFrame:
        sums = self._sums("agencies", _AGENCY, days)
        merged = self._with_counts(sums, _AGENCY, days, active_vehicle_count="agency_vehicles", route_count="agency_routes")
        per_agency = merged.filter(F.col("active_vehicle_count") >= self._settings.min_vehicles).select(
            _AGENCY, "active_vehicle_count", "route_count", F.col("readings").alias("reading_count"),
            _average().alias("average_delay_seconds"), F.col("bunched").alias("bunching_events"),
        )
        return add_operator_name(per_agency, agencies).select("operator_name", *per_agency.columns).orderBy(
            F.desc("average_delay_seconds"), _AGENCY
        )

    def headway_adherence(self, days: Iterable[str] | None = None) -> DataFrame:
        # One row per route and day. A day begins where the route's last departure before it left off.
        before = F.lag("last_second").over(Window.partitionBy(_ROUTE).orderBy("first_second"))
        gap = F.col("first_second") - before
        gap = F.when(gap < self._settings.headway_break_s, gap)
        sums = self._read("headways", days).withColumn("between", gap).groupBy(_ROUTE).agg(
            F.sum(F.col("trip_count") + F.when(F.col("between").isNotNull(), 1).otherwise(0)).alias("trip_count"),
            F.sum(F.col("gap_sum") + F.coalesce("between", F.lit(0))).alias("gap_sum"),
            F.sum(F.col("square_sum") + F.coalesce(F.col("between") * F.col("between"), F.lit(0))).alias("square_sum"),
        )
        return marts.adherence(sums, self._settings)

    def _stored(self, table: str) -> list[str]:
        return sorted(path.split("day=")[1] for path in self._folder.matching(f"{table}/day=*"))

    def _write(self, rows: DataFrame, table: str, day: str) -> None:
        rows.write.mode("overwrite").parquet(f"{self._folder.path}/{table}/day={day}")

    def _read(self, table: str, days: Iterable[str] | None = None) -> DataFrame:
        paths = [f"{self._folder.path}/{table}/day={day}" for day in (self.days() if days is None else days)]
        if not paths:
            return self._spark.createDataFrame([], _TABLES[table])
        return self._spark.read.schema(_TABLES[table]).parquet(*paths)

    def _union(self, parts: Iterable[DataFrame]) -> DataFrame:
        first, *rest = parts
        for part in rest:
            first = first.unionByName(part)
        return first

    def _sums(self, table: str, key: str, days: Iterable[str] | None) -> DataFrame:
        return self._read(table, days).groupBy(key).agg(*[F.sum(n).alias(n) for n in ("readings", "delays", "delay_sum", "bunched")])

    def _numbers(self, each: DataFrame) -> DataFrame:
        """Every id with its number, old ones as they are. Each bucket of ids goes on from its own last place."""
        path = f"{self._folder.path}/numbers"
        known = self._spark.createDataFrame([], _NUMBERS)
        if batches := self._folder.matching("numbers/batch=*/_SUCCESS"):
            known = self._spark.read.schema(_NUMBERS).parquet(*[batch.rpartition("/")[0] for batch in batches])
        ids = self._union(
            each.select(F.lit(kind).alias("kind"), F.col(kind).alias("id")) for kind in ("vehicle_id", "route_id")
        ).filter(F.col("id").isNotNull()).distinct()
        new = ids.join(known, ["kind", "id"], "left_anti").withColumn("bucket", F.pmod(F.xxhash64("id"), F.lit(BUCKETS)).cast("int"))
        ends = known.groupBy("kind", "bucket").agg((F.max("place") + 1).alias("end"))
        at = F.row_number().over(Window.partitionBy("kind", "bucket").orderBy("id")) - 1
        placed = new.withColumn("at", at).join(F.broadcast(ends), ["kind", "bucket"], "left").select(
            "kind", "id", "bucket", (F.coalesce("end", F.lit(0)) + F.col("at")).alias("place")
        )
        # A batch that failed half way has no _SUCCESS, and its numbers were never used.
        number = 1 + max([-1, *(int(batch.split("batch=")[1].split("/")[0]) for batch in batches)])
        placed.write.mode("overwrite").parquet(f"{path}/batch={number}")
        rows = known.unionByName(self._spark.read.schema(_NUMBERS).parquet(f"{path}/batch={number}"))
        return rows.select("kind", "id", (F.col("place") * BUCKETS + F.col("bucket")).alias("number"))

    def _bitmaps(self, each: DataFrame, numbers: DataFrame) -> DataFrame:
        """All counts at once, so that ids meet their numbers in one join."""
        counts = [F.struct(F.lit(counted).alias("counted"), F.col(key).alias("key"), F.lit(kind).alias("kind"), F.col(kind).alias("id")) for counted, key, kind in _COUNTS]
        pairs = each.select(F.inline(F.array(*counts))).distinct().join(numbers, ["kind", "id"])
        return pairs.groupBy("counted", "key", F.bitmap_bucket_number("number").alias("part")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits")
        ).select("counted", "key", "part", "bits")

    def _sketch(self, each: DataFrame, counted: str, key: str, kind: str) -> DataFrame:
        return each.filter(F.col(kind).isNotNull()).groupBy(F.col(key).alias("key")).agg(F.hll_sketch_agg(kind).alias("sketch")).select(
            F.lit(counted).alias("counted"), "key", "sketch"
        )

    def _with_counts(self, sums: DataFrame, key: str, days: Iterable[str] | None, **counts: str) -> DataFrame:
        days = None if days is None else list(days)
        for name, counted in counts.items():
            if self._sketches:
                merged = self._read("sketches", days).filter(F.col("counted") == counted).groupBy("key").agg(
                    F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias(name)
                )
            else:
                merged = (
                    self._read("distinct", days).filter(F.col("counted") == counted)
                    .groupBy("key", "part").agg(F.bitmap_count(F.bitmap_or_agg("bits")).alias("ids"))
                    .groupBy("key").agg(F.sum("ids").alias(name))
                )
            sums = sums.join(merged, sums[key].eqNullSafe(merged["key"]), "left").drop("key").fillna(0, name)
        return sums


def _average() -> Column:
    return F.try_divide(F.col("delay_sum"), F.col("delays"))
