"""Streaming flows: thin wrappers that run the batch operators on a stream.

Stateless and windowed work uses Structured Streaming directly.  Work that
needs the stored current state (upsert, previous state, last known infra, late
rows) runs per micro-batch with the same sliced operators as batch jobs, so
a site that sends a third of all rows is still spread over many tasks; a
per-key state function would process that site in one task.

Per-batch outputs go to `batch=<id>` folders in overwrite mode: a repeated
batch replaces its own output.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from plantpulse.contract import Timing
from plantpulse.functions import clock
from plantpulse.operators.sliced import Series, with_previous
from plantpulse.operators.state import NEWEST, asof_infra, latest_per_factory
from plantpulse.sources import lake, latest

ORDER = ("source_timestamp", "message_id")


# --- sources and sinks -----------------------------------------------------------------
def read_raw_stream(spark: SparkSession, root: str, fmt: str = "json", max_files: int | None = None) -> DataFrame:
    """The raw archive as a stream; typed, so nothing is inferred."""
    reader = spark.readStream.schema(lake.raw_schema()).format(fmt)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(root)


def run_to_files(df: DataFrame, path: str, checkpoint: str, partitions: Sequence[str] = ()) -> StreamingQuery:
    """Process what is there and stop; exactly-once file sink."""
    writer = df.writeStream.format("parquet").option("checkpointLocation", checkpoint).option("path", path)
    if partitions:
        writer = writer.partitionBy(*partitions)
    return writer.outputMode("append").trigger(availableNow=True).start()


def run_batches(df: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    return (
        df.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def both_sinks(messages: DataFrame, raw_root: str, handle: Callable[[DataFrame, int], None], checkpoint: str) -> list[StreamingQuery]:
    """Raw archive and processor as two queries, each with its own checkpoint.

    The archive has no watermark: it keeps every message.
    """
    archive = run_to_files(lake.raw_rows(messages), raw_root, f"{checkpoint}/raw", lake.RAW_PARTITIONS)
    return [archive, run_batches(messages, handle, f"{checkpoint}/processor")]


def _batch_path(root: str, batch_id: int) -> str:
    return f"{root}/batch={batch_id}"


@contextmanager
def kept(batch: DataFrame):
    """Keep a micro-batch while a handler reads it more than once."""
    batch.persist()
    try:
        yield batch
    finally:
        batch.unpersist()


@contextmanager
def kept_in_files(batch: DataFrame, path: str, dealt: bool = False):
    """The same through a folder that is dropped afterwards.

    The number of its files follows the size of the batch, while a kept batch
    stays in as many parts as a shuffle has, small or not. Wide nested rows make
    every part dear, and a read opens only the columns it needs. A batch whose
    last shuffle has `dealt` its rows already is written as it lies, without
    another one.
    """
    (batch if dealt else batch.hint("rebalance")).write.mode("overwrite").parquet(path)
    try:
        yield batch.sparkSession.read.schema(batch.schema).parquet(path)
    finally:
        lake.drop_folder(batch.sparkSession, path)


def write_batch(df: DataFrame, root: str, batch_id: int) -> None:
    df.write.mode("overwrite").parquet(_batch_path(root, batch_id))


# --- event time, windows, duplicates, sessions -------------------------------------------
def with_event_time(df: DataFrame, timing: Timing = Timing()) -> DataFrame:
    return df.withWatermark("source_timestamp", f"{timing.lateness} seconds")


def windowed_last(df: DataFrame, seconds: int, timing: Timing = Timing()) -> DataFrame:
    """Last row per site and tumbling window; emitted when the window closes."""
    rest = [c for c in df.columns if c != "factory_id"]
    return (
        with_event_time(df, timing)
        .groupBy("factory_id", F.window("source_timestamp", f"{seconds} seconds").alias("_w"))
        .agg(F.max_by(F.struct(*rest), F.struct(*NEWEST)).alias("_row"))
        .select("factory_id", F.col("_w.end").alias("bucket"), "_row.*")
    )


def windowed_mean(df: DataFrame, value: str, seconds: int, timing: Timing = Timing()) -> DataFrame:
    """Count and mean per site and tumbling window."""
    return (
        with_event_time(df, timing)
        .groupBy("factory_id", F.window("source_timestamp", f"{seconds} seconds").alias("_w"))
        .agg(F.count(value).alias("sample_count"), F.avg(value).alias("mean_value"))
        .select("factory_id", F.col("_w.start").alias("window_start"), "sample_count", "mean_value")
    )


def stream_dedup(df: DataFrame, timing: Timing = Timing(), salt: int = 16) -> DataFrame:
    """First copy of every message_id within the allowed lateness.

    A much repeated id would send all its copies to one task, so copies are
    first dropped per (id, salt) and the few that remain per id.  The salt is
    a hash of the copy's own times, hence the same on a retry; `salt=1` skips
    that step.
    """
    timed = with_event_time(df, timing)
    if salt > 1:
        spread = F.pmod(F.xxhash64("published_at", "received_at"), F.lit(salt))
        timed = (
            timed.withColumn("_salt", spread).dropDuplicatesWithinWatermark(["message_id", "_salt"]).drop("_salt")
        )
    return timed.dropDuplicatesWithinWatermark(["message_id"])


def arrival_sessions(df: DataFrame, gap_seconds: int, timing: Timing = Timing()) -> DataFrame:
    """Stretches of continuous arrival; what lies between them is an outage.

    Sessions are merged inside each task before the shuffle, so a busy site
    sends one row per stretch and task and not one per message.
    """
    df.sparkSession.conf.set("spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true")
    return (
        with_event_time(df, timing)
        .groupBy("factory_id", F.session_window("source_timestamp", f"{gap_seconds} seconds").alias("_s"))
        .agg(F.count(F.lit(1)).alias("messages"))
        .select(
            "factory_id",
            F.col("_s.start").alias("session_start"),
            clock.plus_seconds("_s.end", -gap_seconds).alias("last_arrival"),
            "messages",
        )
    )


# --- current state ------------------------------------------------------------------------
def latest_writer(root: str, keys: Sequence[str] = ("factory_id",)) -> Callable[[DataFrame, int], None]:
    """Handler that keeps the newest row per key in the store at `root`."""
    return lambda batch, batch_id: latest.upsert_latest(batch, root, batch_id, keys)


def asof_writer(root: str, store: str, slice_seconds: int) -> Callable[[DataFrame, int], None]:
    """Join each factory message of a batch with the last infra state.

    The stored state stands in for infra messages of earlier batches.
    `batch` has both source types and the sections heartbeat, nodes,
    workloads and devices.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        stored = latest.read_before(batch, store, batch_id)
        with kept(batch):
            infra = batch.where(F.col("source_type") == "infra_state")
            known = infra if stored is None else infra.unionByName(stored)
            factory = batch.where(F.col("source_type") == "factory_state").select("factory_id", *NEWEST)
            write_batch(asof_infra(factory, known, slice_seconds), root, batch_id)
            latest.upsert_latest(infra, store, batch_id)

    return handle


# --- previous state, duration, silence ---------------------------------------------------
def state_changes(rows: DataFrame, stored: DataFrame | None, slice_seconds: int, state: str = "risk_level") -> tuple[DataFrame, DataFrame]:
    """(changes, new stored state) from new rows and the stored state.

    stored: factory_id, source_timestamp, message_id, state, since (the start
    of the running state).  A change carries how long the state before lasted.
    """
    series = Series(("factory_id",), ORDER, slice_seconds)
    cols = ["factory_id", *ORDER, state]
    base = rows.select(*cols, F.lit(False).alias("_old"), F.lit(None).cast("timestamp").alias("since"))
    if stored is not None:
        base = base.unionByName(stored.select(*cols, F.lit(True).alias("_old"), "since"))
    stepped = with_previous(base, series, [state])
    was = F.col(f"prev_{state}")
    # A run starts at a change, or where the series itself starts; the stored
    # row stands for the start of its run.
    starts = stepped.where(F.col("_old") | was.isNull() | (was != F.col(state))).select(
        "factory_id",
        F.coalesce("since", "source_timestamp").alias("source_timestamp"),
        "message_id",
        state,
        was.alias("was"),
        "_old",
    )
    runs = with_previous(starts, series, ["source_timestamp"])
    changes = runs.where(~F.col("_old") & F.col("was").isNotNull()).select(
        "factory_id",
        "source_timestamp",
        "message_id",
        F.col("was").alias("from_state"),
        F.col(state).alias("to_state"),
        clock.age_seconds("source_timestamp", "prev_source_timestamp").alias("lasted_seconds"),
    )
    newest = latest_per_factory(base.drop("since", "_old"), ("factory_id",), ORDER)
    since = starts.groupBy("factory_id").agg(F.max("source_timestamp").alias("since"))
    return changes, newest.join(since, "factory_id")


def change_writer(root: str, store: str, slice_seconds: int, state: str = "risk_level") -> Callable[[DataFrame, int], None]:
    """Handler that appends state changes and keeps the running state."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        stored = latest.read_before(batch, store, batch_id)
        with kept(batch):
            changes, now = state_changes(batch, stored, slice_seconds, state)
            write_batch(changes, root, batch_id)
            # `now` already merges the stored sites with those of the batch.
            latest.write_version(now, store, batch_id)

    return handle


def silent_sites(running: DataFrame, seen_until, timeout_seconds: int) -> DataFrame:
    """Sites whose last message is older than the timeout at `seen_until`."""
    age = clock.age_seconds(clock.as_timestamp(seen_until), F.col("source_timestamp"))
    return running.where(age > timeout_seconds).select(
        "factory_id", F.col("source_timestamp").alias("silent_since"), age.alias("silent_seconds")
    )


# --- late rows ---------------------------------------------------------------------------------
def split_late(batch: DataFrame, seen: DataFrame, timing: Timing = Timing()) -> tuple[DataFrame, DataFrame]:
    """(on time, late) against the newest event time of each site in earlier batches.

    `seen` has factory_id and source_timestamp, one row per site. A site that is
    new is on time; a row without an event time is late.
    """
    limits = seen.select("factory_id", clock.plus_seconds("source_timestamp", -timing.lateness).alias("_limit"))
    known = batch.join(limits, "factory_id", "left")
    late = F.col("source_timestamp").isNull() | F.coalesce(F.col("source_timestamp") < F.col("_limit"), F.lit(False))
    return known.where(~late).drop("_limit"), known.where(late).drop("_limit")


def late_writer(root: str, late_root: str, store: str, timing: Timing = Timing()) -> Callable[[DataFrame, int], None]:
    """Handler that sends late rows to a table of their own."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        stored = latest.read_before(batch, store, batch_id)
        with kept(batch):
            seen = batch.where(F.lit(False)) if stored is None else stored
            on_time, late = split_late(batch, seen, timing)
            write_batch(on_time, root, batch_id)
            write_batch(late, late_root, batch_id)
            timed = batch.where(F.col("source_timestamp").isNotNull())
            latest.upsert_latest(timed.select("factory_id", *NEWEST), store, batch_id)

    return handle
