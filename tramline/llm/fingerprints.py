"""Document fingerprints by winnowing.

Every run of `GRAM` code points has a rolling hash; of each window of `WINDOW` hashes the
smallest is kept, the rightmost of equals, with its position. Any passage of
`GRAM + WINDOW - 1` code points that two texts share therefore leaves a common fingerprint.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.llm.common import in_slices, ship_package

GRAM = 8
WINDOW = 16
# Ranges of doc_id are put together, until they hold so many bytes, from finer ones that hold equally many rows.
BYTES_PER_TASK = 16 << 20
FINE = 8
# Ranges never exceed this number; beyond it tasks grow instead.
MOST_TASKS = 20_000

_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)
_UPPER = np.uint64(0xFFFFFFFF00000000)
_LOWER = np.uint64(0xFFFFFFFF)


def gram_hashes(codes: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """A 32-bit hash, in the upper half of 64 bits, of every run of `gram` code points."""
    codes = (codes.astype(np.uint64) + np.uint64(1)) * _MIX
    out = np.zeros(len(codes) - gram + 1, np.uint64)
    # Windowed polynomial by doubling: a run of 2n is two runs of n.
    length, run, power, at = 1, codes, _BASE, 0
    with np.errstate(over="ignore"):
        while True:
            if gram & length:
                out = out * power + run[at : at + len(out)]
                at += length
            if 2 * length > gram:
                break
            run = run[:-length] * power + run[length:]
            power = power * power
            length *= 2
        out ^= out >> np.uint64(29)
        out *= _MIX
        out ^= out >> np.uint64(32)
        out *= _BASE
    return out & _UPPER


def winnow(text: str, gram: int = GRAM, window: int = WINDOW) -> np.ndarray:
    """Kept (hash, position) pairs by position. A text shorter than a gram is one gram; an empty one has none."""
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    if not len(codes):
        return np.zeros((0, 2), np.uint32)
    hashes = gram_hashes(codes, min(gram, len(codes)))
    # The smallest of these values has the smallest hash and, of equals, the last position.
    ranked = hashes | (_LOWER - np.arange(len(hashes), dtype=np.uint64))
    if len(ranked) <= window:
        kept = ranked.min(keepdims=True)
    else:
        padded = np.full(-(-len(ranked) // window) * window, np.iinfo(np.uint64).max, np.uint64)
        padded[: len(ranked)] = ranked
        blocks = padded.reshape(-1, window)
        forth = np.minimum.accumulate(blocks, axis=1).ravel()
        back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        count = len(ranked) - window + 1
        least = np.minimum(back[:count], forth[window - 1 : window - 1 + count])
        kept = least[np.flatnonzero(np.diff(least, prepend=~least[:1]))]
    return np.stack([(kept >> np.uint64(32)), _LOWER - (kept & _LOWER)], axis=1).astype(np.uint32)


def as_text(kept: np.ndarray) -> str:
    """Sixteen hex digits for each pair: eight of the hash, eight of the position."""
    return kept.astype(">u4").tobytes().hex()


def likeness(one: np.ndarray, other: np.ndarray) -> float:
    """Jaccard likeness of the kept hashes; two empty texts are alike."""
    a, b = np.unique(one[:, 0]), np.unique(other[:, 0])
    if not len(a) and not len(b):
        return 1.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def edited(text: str, following: str) -> str:
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


_OUT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def fingerprint_pairs(documents: DataFrame) -> DataFrame:
    """Fingerprints of every document, of its edited text, and their likeness.

    The following document is the one with the next smaller doc_id, after the last the first.
    Documents are dealt into ranges of doc_id, one a task and of about as many bytes each, and streamed in order; the first
    document of each range is sent to the range before it too, so one shuffle of the texts is enough. Null texts
    are empty. Equal doc_ids go by text and stay in one range, and a null doc_id comes last.
    """
    spark = documents.sparkSession
    ship_package(spark)
    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("key"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    keys = rows.select("key", (F.octet_length("text") + 1).cast("long").alias("bytes"))
    total = keys.agg(F.sum("bytes")).first()[0] or 0
    tasks = max(1, min(MOST_TASKS, -(-total // BYTES_PER_TASK)))
    fine = FINE * tasks
    cuts = keys.agg(F.percentile_approx("key", [i / fine for i in range(1, fine)], 5 * fine)).first()[0] or []
    fine_range = _range_of(spark, sorted(set(cuts)))
    held = keys.groupBy(fine_range("key").alias("fine")).agg(F.max("key").alias("last"), F.sum("bytes").alias("bytes"))
    # From the largest keys down; a range ends where the next fine one would make it too large. At most FINE * MOST_TASKS rows.
    ends, firsts, used = [], [], 0
    for row in held.orderBy(F.desc("fine")).collect():
        if not firsts or used + row["bytes"] > max(BYTES_PER_TASK, total // tasks):
            firsts.append(row["last"])
            used = 0
        used += row["bytes"]
    ends = sorted(firsts)
    ranged = _range_of(spark, ends)
    # Who is sent where besides its own range: the first of each to the range before it, in descending order.
    sent = [(first, len(ends) - 1 - (at - 1) % len(ends)) for at, first in enumerate(firsts)]
    also = spark.createDataFrame(sent, "key long, also int")
    places = F.array_compact(
        F.array(
            F.struct(F.col("range"), F.lit(0).alias("guest")),
            F.when(F.col("also").isNotNull(), F.struct(F.col("also").alias("range"), F.lit(1).alias("guest"))),
        )
    )
    dealt = (
        rows.withColumn("range", ranged("key")).join(F.broadcast(also), "key", "left")
        .select("doc_id", "key", "text", F.explode(places).alias("place"))
        .select("doc_id", "key", "text", "place.range", "place.guest")
        .repartitionById(max(1, len(ends)), F.col("range"))
        .sortWithinPartitions("range", "guest", F.desc("key"), "text")
        .select("doc_id", "range", "guest", "text")
    )
    return dealt.mapInArrow(_streamed, _OUT)


def _range_of(spark: SparkSession, upper: list[int]) -> Callable[[str], Column]:
    """The number of the first of the ascending `upper` that is not below a key; those above all go to the last."""
    shared = spark.sparkContext.broadcast(np.array(upper, np.int64))

    @F.pandas_udf("int")
    def place(key: pd.Series) -> pd.Series:
        return pd.Series(np.minimum(np.searchsorted(shared.value, key.to_numpy()), max(0, len(shared.value) - 1)).astype(np.int32))

    return place


def _streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    names = [field.split()[0] for field in _OUT.split(", ")]
    before = None
    for batch in in_slices(batches):
        done = []
        columns = [batch.column(name).to_pylist() for name in ("doc_id", "range", "guest", "text")]
        for doc_id, place, guest, text in zip(*columns):
            kept = winnow(text)
            if before is not None and before[1] == place and not before[2]:
                done.append(_row(before, text, kept))
            before = (doc_id, place, guest, text, kept)
        arrays = [pa.array(c, t) for c, t in zip(zip(*done) if done else [[]] * len(names), types)]
        yield pa.RecordBatch.from_arrays(arrays, names)


def _row(document: tuple, following: str, following_kept: np.ndarray) -> tuple:
    doc_id, _, _, text, kept = document
    changed = edited(text, following)
    changed_kept = winnow(changed)
    digest = hashlib.sha256(changed.encode()).hexdigest()
    return (
        doc_id, len(text), digest, as_text(kept), as_text(changed_kept),
        likeness(kept, changed_kept), likeness(kept, following_kept),
    )
