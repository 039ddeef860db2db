"""Folders on whatever file system the path names, and tables kept as numbered versions or as changes by key."""

from __future__ import annotations

import datetime as dt
import json
import re
import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.operators.latest import first_per_key
from tramline.settings import DEFAULTS, Settings


class Folder:
    def __init__(self, spark: SparkSession, path: str) -> None:
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.path = path.rstrip("/")

    def _at(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def _fs(self):
        return self._at(self.path).getFileSystem(self._conf)

    def matching(self, pattern: str) -> list[str]:
        """Paths under the folder that match a glob pattern."""
        found = self._fs().globStatus(self._at(f"{self.path}/{pattern}"))
        return [status.getPath().toString() for status in found or []]

    def remove(self, path: str) -> None:
        self._fs().delete(self._at(path), True)

    def make(self, path: str) -> None:
        self._fs().mkdirs(self._at(path))

    def move(self, path: str, to: str) -> None:
        if not self._fs().rename(self._at(path), self._at(to)):
            raise OSError(f"cannot move {path} to {to}")

    def bytes(self, path: str) -> int:
        return self._fs().getContentSummary(self._at(path)).getLength()

    def age_s(self, path: str) -> float:
        return time.time() - self._fs().getFileStatus(self._at(path)).getModificationTime() / 1000


class VersionedTable:
    """A small table rewritten as a whole: version N is written beside N-1, then read instead.

    Readers never see a half-written version, and writing a version again gives the same rows,
    so a batch that is retried after a failure leaves the table as if it had run once.
    """

    KEPT = 3

    def __init__(
        self, spark: SparkSession, path: str, schema: str, grace_s: int = DEFAULTS.version_grace_s
    ) -> None:
        self._spark = spark
        self._folder = Folder(spark, path)
        self._schema = schema
        self._grace_s = grace_s

    def versions(self) -> list[int]:
        done = self._folder.matching("version=*/_SUCCESS")
        return sorted(int(re.search(r"version=(\d+)/_SUCCESS$", path)[1]) for path in done)

    def before(self, version: int | None = None) -> DataFrame:
        """The newest version, or the newest one older than `version`; empty if there is none."""
        known = [v for v in self.versions() if version is None or v < version]
        if not known:
            return self._spark.createDataFrame([], self._schema)
        return self._spark.read.schema(self._schema).parquet(self._path(known[-1]))

    def write(self, rows: DataFrame, version: int) -> None:
        """Older versions go once they are out of the newest few and a reader had time to finish."""
        rows.write.mode("overwrite").parquet(self._path(version))
        for old in self.versions():
            if old <= version - self.KEPT and self._folder.age_s(self._path(old)) >= self._grace_s:
                self._folder.remove(self._path(old))

    def _path(self, version: int) -> str:
        return f"{self._folder.path}/version={version}"


class KeyedTable:
    """One row per key, of which a version holds only what changed: bytes written follow the keys with news.

    Keys are hashed into buckets. A version adds a segment of new rows to the buckets it touches; a bucket that
    has gathered `segments` of them is written whole again. A key's newest row is that of the newest
    version, so a version that is written again after a failure leaves the same table. Buckets that hold
    none of the keys asked for are not read.
    """

    KEPT = 3

    def __init__(
        self, spark: SparkSession, path: str, schema: str, keys: list[str], buckets: int = DEFAULTS.state_buckets,
        segments: int = DEFAULTS.state_segments, grace_s: int = DEFAULTS.version_grace_s,
    ) -> None:
        self._spark, self._folder, self._schema, self._keys = spark, Folder(spark, path), schema, keys
        self._buckets, self._segments, self._grace_s = buckets, segments, grace_s

    def versions(self) -> list[int]:
        done = self._folder.matching("version=*/_SUCCESS")
        return sorted(int(re.search(r"version=(\d+)/_SUCCESS$", path)[1]) for path in done)

    def before(self, version: int | None = None, asked: DataFrame | None = None) -> DataFrame:
        """The newest row of every key, of versions older than `version`. With `asked`, a frame with the key columns, rows of
        other buckets than theirs are left out."""
        only = None if asked is None else {r["bucket"] for r in asked.select(self._bucket()).distinct().collect()}
        return self._newest(self._listed(version), only)

    def write(self, news: DataFrame, version: int) -> None:
        """New rows of some keys, one per key."""
        held = self._listed(version)
        due = [bucket for bucket, parts in held.items() if len(parts) >= self._segments]
        rows = news.select("*", self._bucket()).withColumn("whole", F.col("bucket").isin(due))
        if due:
            stored = self._newest({bucket: held[bucket] for bucket in due})
            same = [stored[key].eqNullSafe(news[key]) for key in self._keys]
            old = stored.join(news, same, "left_anti")
            touched = F.broadcast(rows.filter("whole").select("bucket").distinct())
            old = old.select("*", self._bucket()).join(touched, "bucket", "left_semi").withColumn("whole", F.lit(True))
            rows = rows.unionByName(old)
        path = f"{self._folder.path}/version={version}"
        rows.repartition("bucket").write.mode("overwrite").partitionBy("whole", "bucket").parquet(path)
        self._remove_replaced(version)

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self._keys), F.lit(self._buckets)).cast("int").alias("bucket")

    def _listed(self, version: int | None) -> dict[int, list[tuple[int, bool, str]]]:
        """Per bucket its last whole segment and those after it, as (version, whole, path)."""
        done = {v for v in self.versions() if version is None or v < version}
        held: dict[int, list[tuple[int, bool, str]]] = {}
        for path in self._folder.matching("version=*/whole=*/bucket=*"):
            number, whole, bucket = re.search(r"version=(\d+)/whole=(\w+)/bucket=(\d+)$", path).groups()
            if int(number) in done:
                held.setdefault(int(bucket), []).append((int(number), whole == "true", path))
        for bucket, parts in held.items():
            parts.sort()
            last = max((n for n, part in enumerate(parts) if part[1]), default=0)
            held[bucket] = parts[last:]
        return held

    def _newest(self, held: dict[int, list[tuple[int, bool, str]]], only: set[int] | None = None) -> DataFrame:
        paths = [path for bucket, parts in held.items() if only is None or bucket in only for *_, path in parts]
        if not paths:
            return self._spark.createDataFrame([], self._schema)
        rows = (
            self._spark.read.schema(f"{self._schema}, version bigint, whole boolean, bucket int")
            .option("basePath", self._folder.path)
            .parquet(*paths)
        )
        newest = first_per_key(rows, self._keys, [F.desc("version")])
        return newest.drop("version", "whole", "bucket")

    def _remove_replaced(self, version: int) -> None:
        """Segments behind a whole one that itself is out of the newest few, once a reader had time to finish."""
        needed = {part[2] for parts in self._listed(version - self.KEPT + 1).values() for part in parts}
        for path in self._folder.matching("version=*/whole=*/bucket=*"):
            number = int(re.search(r"version=(\d+)/", path)[1])
            if number <= version - self.KEPT and path not in needed and self._folder.age_s(path) >= self._grace_s:
                self._folder.remove(path)


class BatchNumbers:
    """A number for every micro-batch, larger than those of all batches before it.

    Spark counts batches from 0 again on a new checkpoint, so folders and versions named by that count would
    replace rows of an earlier run. Here a batch is known by its run (the checkpoint's id) and count;
    a batch that is tried again gets the number it had.
    """

    KEPT = 100

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._folder = Folder(spark, path)

    def of(self, run: str, batch_id: int, above: int = -1) -> int:
        """`above`: numbers that are taken already, by tables older than this record."""
        given = {}
        for path in self._folder.matching("number=*/run=*/batch=*"):
            number, its_run, its_batch = re.search(r"number=(\d+)/run=([^/]+)/batch=(-?\d+)$", path).groups()
            given[int(number)] = (its_run, int(its_batch))
        for number, batch in given.items():
            if batch == (run, batch_id):
                return number
        number = max([above, *given]) + 1
        self._folder.make(f"{self._folder.path}/number={number}/run={run}/batch={batch_id}")
        for old in given:
            if old <= number - self.KEPT:
                self._folder.remove(f"{self._folder.path}/number={old}")
        return number


def run_of(spark: SparkSession, checkpoint: str) -> str:
    """The id of the query a checkpoint belongs to; a new checkpoint has a new one."""
    if not Folder(spark, checkpoint).matching("metadata"):
        return "direct"
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]


def compact(spark: SparkSession, path: str, day: dt.date, target_bytes: int = 256 << 20) -> int:
    """Rewrite a finished day's `batch=` folders as one, and return how many there were.

    For days that no stream writes any more and no reader reads at that moment. The new folder is complete before the old ones
    go, and stays hidden until then; a run that was interrupted is finished by the next one.
    """
    folder = Folder(spark, f"{path.rstrip('/')}/{day:year=%Y/month=%m/day=%d}")
    hidden = f"{folder.path}/_compacted"
    if not folder.matching("_compacted/_SUCCESS"):
        parts = folder.matching("batch=*")
        if len(parts) < 2:
            return 0
        size = sum(folder.bytes(part) for part in parts)
        spark.read.parquet(*parts).coalesce(max(1, -(-size // target_bytes))).write.mode("overwrite").parquet(hidden)
    parts = [part for part in folder.matching("batch=*") if not part.endswith("batch=compacted")]
    for part in parts:
        folder.remove(part)
    # A day may be compacted again after late batches: the old result was one of the inputs.
    folder.remove(f"{folder.path}/batch=compacted")
    folder.move(hidden, f"{folder.path}/batch=compacted")
    return len(parts)


def drop_expired(
    spark: SparkSession, path: str, today: dt.date, settings: Settings = DEFAULTS
) -> list[str]:
    """Remove the day folders past retention and return their paths. Reads no data.

    Works on any folder written here: no sink keeps a list of its files.
    """
    folder, oldest = Folder(spark, path), today - dt.timedelta(days=settings.retention_days)
    expired = []
    for day in folder.matching("year=*/month=*/day=*"):
        parts = re.search(r"year=(\d+)/month=(\d+)/day=(\d+)$", day)
        if dt.date(*map(int, parts.groups())) < oldest:
            folder.remove(day)
            expired.append(day)
    return expired
