"""Outages reported by a timer: a site that falls silent raises an event by itself.

Every site keeps the time of its newest message and one event-time timer, set to
that time plus the timeout. The timer goes off when the watermark, which the other
sites push on, passes it; no message from the silent site is needed. A message
that comes after a reported silence ends it, and an event says how long it lasted.
State and timers live in the checkpoint, so a restart in between loses nothing.

Before the stateful step every task reduces its rows to stretches without a gap
above the timeout, so what meets the state of a busy site is a row or two per
batch of rows.
Timers need a state store that can keep them: the session's
`spark.sql.streaming.stateStore.providerClass` must name the RocksDB provider.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime, timezone

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from plantpulse.contract import Timing

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER_SETTING = "spark.sql.streaming.stateStore.providerClass"
EVENTS = "factory_id string, type string, silent_since timestamp, at timestamp"
_STRETCHES = "factory_id string, first long, last long"


def _stretches(timeout: int):
    """Per site the stretches of a batch of rows whose gaps are at most the timeout, in microseconds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = pa.table(batch.filter(pc.is_valid(batch.column("seen")))).sort_by([("factory_id", "ascending"), ("seen", "ascending")])
            if rows.num_rows:
                seen = rows.column("seen").to_numpy()
                site = rows.column("factory_id").combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy()
                new = np.ones(len(seen), dtype=bool)
                new[1:] = (site[1:] != site[:-1]) | (seen[1:] - seen[:-1] > timeout)
                first = np.flatnonzero(new)
                last = np.append(first[1:], len(seen)) - 1
                sites = rows.column("factory_id").combine_chunks().take(pa.array(first))
                yield pa.RecordBatch.from_arrays([sites, pa.array(seen[first]), pa.array(seen[last])], names=["factory_id", "first", "last"])

    return run


def _time(micros: int) -> datetime:
    return datetime.fromtimestamp(micros / 1000000, tz=timezone.utc)


def _event(site: str, kind: str, since: int, at: int) -> Row:
    return Row(factory_id=site, type=kind, silent_since=_time(since), at=_time(at))


class SilenceProcessor(StatefulProcessor):
    """State of a site: newest time, and whether its silence has been reported."""

    def __init__(self, timeout_seconds: int):
        self.timeout = timeout_seconds * 1000000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("silence", "newest long, reported boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        (site,) = key
        newest, reported = self.state.get() if self.state.exists() else (None, False)
        for first, last in sorted((row["first"], row["last"]) for row in rows):
            if newest is not None and first - newest > self.timeout:
                # Other sites may not have pushed the watermark over the gap yet.
                if not reported:
                    yield _event(site, "silent", newest, newest + self.timeout)
                yield _event(site, "back", newest, first)
                reported = False
            if newest is None or last > newest:
                newest, reported = last, False
        self.state.update((newest, reported))
        for old in list(self.handle.listTimers()):
            self.handle.deleteTimer(old)
        if not reported:
            self.handle.registerTimer((newest + self.timeout) // 1000 + 1)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        newest, reported = self.state.get()
        if not reported:
            self.state.update((newest, True))
            yield _event(key[0], "silent", newest, newest + self.timeout)

    def close(self) -> None:
        pass


def silence_events(messages: DataFrame, timeout_seconds: int, timing: Timing = Timing()) -> DataFrame:
    """`silent` and `back` events of a stream with factory_id and source_timestamp.

    Messages behind the watermark are ignored: what they would say about a
    silence has been said. Rows without a time or site count for nothing.
    """
    spark = messages.sparkSession
    if spark.conf.get(PROVIDER_SETTING, None) != PROVIDER:
        raise ValueError(f"set {PROVIDER_SETTING} to {PROVIDER}")
    rows = messages.where("factory_id is not null").select("factory_id", F.unix_micros("source_timestamp").alias("seen"))
    stretches = rows.mapInArrow(_stretches(timeout_seconds * 1000000), _STRETCHES)
    timed = stretches.withColumn("source_timestamp", F.timestamp_micros("last")).withWatermark(
        "source_timestamp", f"{timing.lateness} seconds"
    )
    return timed.groupBy("factory_id").transformWithState(
        SilenceProcessor(timeout_seconds), outputStructType=EVENTS, outputMode="Append", timeMode="EventTime"
    )
