"""Rows held in state until a timer that their first one set goes off.

The first row that comes into an empty buffer sets a processing-time timer; rows that follow wait with
it; the timer hands all of them on and leaves the buffer empty, without a timer. So a buffer
is flushed a whole interval after its first row, however long it was empty before, while a trigger
flushes by the clock. What waits is part of the checkpoint and survives a restart.

Buffers are split into shards by arrival number, so that no task holds all rows of an interval; one
shard gives one flush of everything. `stateful.STATE_STORE` has to be on.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.types import IntegralType, StructField, StructType, TimestampType

import tramline
from tramline.settings import DEFAULTS, Settings
from tramline.streaming.sinks import append_parquet

ROWS_AT_ONCE = 10_000
FLUSHED_AT = StructField("flushed_at", TimestampType())


class Buffer(StatefulProcessor):
    """Keyed by shard: a list of rows and, while it has any, one timer."""

    def __init__(self, schema: StructType, wait_ms: int) -> None:
        self._schema, self._wait_ms = schema, wait_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._rows = handle.getListState("rows", self._schema)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        armed = self._rows.exists()
        arrived = False
        for chunk in rows:
            values = self._as_values(chunk)
            if values:
                arrived = True
                self._rows.appendList(values)
        if arrived and not armed:
            self._handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self._wait_ms)
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        held = list(self._rows.get())
        self._rows.clear()
        at = pd.Timestamp(timerValues.getCurrentProcessingTimeInMs(), unit="ms")
        for start in range(0, len(held), ROWS_AT_ONCE):
            part = [tuple(row) for row in held[start : start + ROWS_AT_ONCE]]
            frame = pd.DataFrame(part, columns=self._schema.names, dtype=object)
            yield frame.assign(**{FLUSHED_AT.name: at})

    def _as_values(self, chunk: pd.DataFrame) -> list[tuple]:
        """Rows as Python values: pandas has no null in columns of numbers."""
        columns = []
        for field in self._schema.fields:
            values = chunk[field.name].astype(object)
            values = values.where(values.notna(), None).tolist()
            if isinstance(field.dataType, IntegralType):
                values = [None if value is None else int(value) for value in values]
            columns.append(values)
        return list(zip(*columns))

    def close(self) -> None:
        pass


def buffered(rows: DataFrame, wait_s: float, shards: int = 1, spread: str = "arrival_seq") -> DataFrame:
    """A stream's rows, each after its buffer's timer, with `flushed_at`: the time of the batch whose timer handed it on."""
    # The processor travels to the workers as code, which need not have this package installed.
    cloudpickle.register_pickle_by_value(tramline)
    shard = F.pmod(F.xxhash64(spread), F.lit(shards)).alias("_shard")
    return rows.select(shard, *rows.columns).groupBy("_shard").transformWithStateInPandas(
        Buffer(rows.schema, int(wait_s * 1000)),
        outputStructType=StructType([*rows.schema.fields, FLUSHED_AT]),
        outputMode="Append",
        timeMode="ProcessingTime",
    )


def append_buffered(
    rows: DataFrame, path: str, checkpoint: str, wait_s: float, shards: int = 1, settings: Settings = DEFAULTS
) -> StreamingQuery:
    """Append a stream's buffers to the UTC day folders of their flushes, one folder a flush.

    The query goes on until it is stopped: an empty batch looks for timers at every trigger.
    """
    return append_parquet(buffered(rows, wait_s, shards).drop(FLUSHED_AT.name), path, checkpoint, settings=settings)
