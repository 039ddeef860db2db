"""What several operators need: landed tables, gapless numbering, fixed patterns."""

from __future__ import annotations

import ctypes
import os
import shutil
import tempfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tramline.session import scratch_folder
from tramline.sources.folders import Folder

# Fixed value: a word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

# Most rows of one key that a numbering window sees at once.
ROWS_PER_WINDOW = 4096

# A filter is gathered in pieces of so many bits.
_FILTER_CHUNK = 1 << 15


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


_shipped: set[str] = set()
# The setting, what it is where nothing is set, and what it becomes.
_BATCH_BYTES = ("spark.sql.execution.arrow.maxBytesPerBatch", "67108864b", "4m")


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package wherever they run, and hand them texts in batches of few bytes.

    Spark's own bound on a batch is 64 MB, which a task holds several times over, in the JVM and in its worker. A bound
    that the session has set stays.
    """
    if spark.conf.get(_BATCH_BYTES[0]) == _BATCH_BYTES[1]:
        spark.conf.set(_BATCH_BYTES[0], _BATCH_BYTES[2])
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
        name = os.path.join(tempfile.mkdtemp(prefix="tramline-"), "tramline")
        context.addPyFile(shutil.make_archive(name, "zip", root, "tramline"))
        _shipped.add(context.applicationId)


def in_slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut into short ones, so that a worker holds few texts as Python objects."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def handing_back(step: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """`step`, a function for mapInArrow, so that its worker gives freed memory back to the system when a task ends.

    Workers outlive their tasks. What their allocators keep of a task would stand beside the JVM's memory in the stages that follow.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from step(batches)
        pa.default_memory_pool().release_unused()
        # Only glibc has it; others do without.
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim:
            trim(0)

    return run


def no_rows(spark: SparkSession, schema: str) -> DataFrame:
    """An empty table of the schema. One made from a list in Python would start a Python worker in each stage that reads it."""
    nulls = [F.lit(None).cast(kind).alias(name) for name, kind in (field.split(maxsplit=1) for field in schema.split(", "))]
    return spark.range(0).limit(0).select(*nulls)


def landed(rows: DataFrame, purpose: str) -> DataFrame:
    """The same rows read back from a table in the cluster's shared folder.

    Cuts lineage: a lost executor costs a reread and not a recomputation, and Spark knows the
    size of what it reads next.
    """
    path = scratch_folder(rows.sparkSession, purpose)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def removed(*tables: DataFrame) -> None:
    """Removes landed tables once what was made from them is landed itself, so that no recovery reads them again."""
    for rows in tables:
        for folder in {os.path.dirname(file) for file in rows.inputFiles()}:
            Folder(rows.sparkSession, folder).remove(folder)


def bit_filter(keys: DataFrame, bits: int) -> np.ndarray:
    """A bit for each long of the only column: `bits` in all, packed, however many keys there are."""
    (name,) = keys.columns
    bit = F.pmod(name, F.lit(bits))
    places = keys.select((bit / _FILTER_CHUNK).cast("int").alias("chunk"), F.pmod(bit, F.lit(_FILTER_CHUNK)).cast("int").alias("bit"))

    def packed(key: tuple, table: pa.Table) -> pa.Table:
        flags = np.zeros(_FILTER_CHUNK, np.uint8)
        flags[table.column("bit").to_numpy()] = 1
        return pa.table({"chunk": pa.array([key[0].as_py()], pa.int32()), "flags": pa.array([np.packbits(flags).tobytes()], pa.binary())})

    out = np.zeros(bits // 8, np.uint8)
    size = _FILTER_CHUNK // 8
    for row in places.distinct().groupBy("chunk").applyInArrow(packed, "chunk int, flags binary").collect():
        out[row["chunk"] * size : (row["chunk"] + 1) * size] = np.frombuffer(row["flags"], np.uint8)
    return out


def in_filter(flags: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which of the int64 keys may be in a filter made by `bit_filter`."""
    bit = np.mod(keys, np.int64(len(flags) * 8))
    return (flags[bit >> 3] >> (7 - (bit & 7)).astype(np.uint8)) & 1 > 0


def code_point_key(column: str) -> Column:
    """A join key that never is null: nulls equal each other and differ from any string."""
    value = F.col(column).cast("string")
    return F.when(value.isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), value))


def last_at_most(
    ordered: Column, value: Column, key: Callable[[Column], Column] = lambda entry: entry, steps: int = 21
) -> Column:
    """Index of the last entry of a sorted array whose key is `value` or less, -1 if none is.

    Halves the array; `steps` is enough for two million entries.
    """
    middle = lambda at: F.shiftright(at["lo"] + at["hi"] + 1, 1)

    def halve(at: Column, _: Column) -> Column:
        right = key(F.get(ordered, middle(at))) <= value
        return F.when(at["lo"] + 1 >= at["hi"], at).otherwise(
            F.struct(
                F.when(right, middle(at)).otherwise(at["lo"]).alias("lo"),
                F.when(right, at["hi"]).otherwise(middle(at)).alias("hi"),
            )
        )

    whole = F.struct(F.lit(-1).alias("lo"), F.size(ordered).alias("hi"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), whole, halve, lambda at: at["lo"])


def with_parts(rows: DataFrame, keys: list[str], row: str, into: str, per_part: int | None = None) -> DataFrame:
    """Adds `into`: 0 for rows whose `keys` few others share, else a part of about `per_part` of the rows that share them.

    `row` numbers the landed rows and deals them into parts, so that one key with any share of all rows is spread. Few
    keys can have so many rows, and only these are joined.
    """
    per_part = per_part or ROWS_PER_WINDOW
    key = F.xxhash64(*keys)
    heavy = landed(
        rows.groupBy(key.alias("_key")).agg(F.count(F.lit(1)).alias("_held")).filter(F.col("_held") > per_part), "heavy"
    )
    part = F.pmod(F.xxhash64(F.col(row)), F.ceil(F.col("_held") / F.lit(per_part)))
    return (
        rows.withColumn("_key", key).join(heavy, "_key", "left").withColumn(into, F.coalesce(part, F.lit(0).cast("long"))).drop("_key", "_held")
    )


def numbered(
    rows: DataFrame,
    within: list[str],
    order: list[str],
    into: str,
    per_window: int | None = None,
    deal: Column | None = None,
    row: str | None = None,
) -> DataFrame:
    """Rows with a gapless number from 0 within the columns `within`, which are never null.

    No window holds a whole group: rows are dealt into buckets by `deal`, a hash of `order`, about
    `per_window` to a bucket, the buckets' counts are summed up, and rows are numbered inside
    their bucket. Rows that agree in every column of `order` may swap numbers; where more of them agree
    than a window holds, `row`, a number for every row, deals them. `rows` is read
    twice, so it should be a landed table.
    """
    per_window = per_window or ROWS_PER_WINDOW
    hashed = F.xxhash64(*order) if deal is None else deal
    if row:
        rows = with_parts(rows, [*within, *order], row, "_part", per_window)
        hashed = F.xxhash64(hashed, "_part")
    if within:
        # Landed, so that both sides of the join are plain shuffles, of which Spark splits hot keys.
        sizes = landed(rows.groupBy(*within).agg(F.count(F.lit(1)).alias("_n")), "sizes")
        dealt = rows.join(sizes, within)
    else:
        dealt = rows.withColumn("_n", F.lit(rows.count()))
    dealt = dealt.withColumn(
        "_bucket", F.pmod(hashed, F.ceil(F.col("_n") / F.lit(per_window)))
    ).drop("_n")
    counts = dealt.groupBy(*within, "_bucket").agg(F.count(F.lit(1)).alias("_here"))
    upto = Window.partitionBy(*within).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn("_before", F.coalesce(F.sum("_here").over(upto), F.lit(0))).drop("_here")
    inside = Window.partitionBy(*within, "_bucket").orderBy(hashed, *order)
    # Dealt out by bucket explicitly: after a join on `within` Spark would keep a whole group in one task.
    return (
        dealt.repartition(*within, "_bucket")
        .withColumn("_at", F.row_number().over(inside) - 1)
        .join(starts, [*within, "_bucket"])
        .withColumn(into, F.col("_before") + F.col("_at"))
        .drop("_bucket", "_at", "_before", *(["_part"] if row else []))
    )
