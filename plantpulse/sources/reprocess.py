"""Results of an archive under named rules, day by day, only where they are missing.

The archive is cut by day of receipt, and so are the results: a run of a day lies
in `results/version=<v>/day=<d>/run=<r>`, below it the sites and days of the events. The
manifest has a row for every finished run, with a fingerprint of the archived
files it was made from. A day is computed if the manifest has no run of it under
that version, or if its files have changed since. The manifest row is written
after the run's files, as one atomic append, and readers take only what the
manifest names: a run that was cut off is invisible, and the next call goes on
with the days that are still missing. An outdated day gets a new run beside the
old one, so readers of the old one are not disturbed.

A message archived more than once counts on the day it was received first. Days
are computed in order, a bounded number at a time; ids stored by earlier days
are looked up in the event days that the days touch, because an id holds the
time of its message. If an outdated day gains a message whose copy a later day
has already counted, that later day is outdated too.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plantpulse.sources import lake

#: Days whose results are made by one job.
DAYS_AT_ONCE = 16
EVENT_DAY = ("factory_id", "yyyy", "mm", "dd")
RESULT_PARTITIONS = ("version", "day", "run", *EVENT_DAY)
_MANIFEST = "version string, day string, run string, files long, bytes long, changed_at timestamp, number long"
_DAY = r"yyyy=(\d+)/mm=(\d+)/dd=(\d+)"


@dataclass(frozen=True)
class Finished:
    """What one call computed and what it found done."""

    computed: tuple[str, ...]
    skipped: tuple[str, ...]


def archived_days(spark: SparkSession, raw: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """day, files, bytes, changed_at of the archive: a listing, no file is opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(raw).select(
        "path", "length", "modificationTime"
    )
    parts = [F.regexp_extract("path", _DAY, n) for n in (1, 2, 3)]
    days = files.select(F.concat_ws("-", *parts).alias("day"), "length", "modificationTime").where("day <> '--'")
    if start is not None:
        days = days.where(F.col("day") >= start)
    if end is not None:
        days = days.where(F.col("day") <= end)
    return days.groupBy("day").agg(
        F.count(F.lit(1)).alias("files"),
        F.sum("length").alias("bytes"),
        F.max("modificationTime").alias("changed_at"),
    )


def manifest(spark: SparkSession, root: str, version: str | None = None) -> DataFrame:
    """The valid run of every (version, day): the one with the largest number."""
    path = f"{root}/manifest"
    rows = spark.read.schema(_MANIFEST).parquet(path) if lake.exists(spark, path) else spark.createDataFrame([], _MANIFEST)
    if version is not None:
        rows = rows.where(F.col("version") == version)
    newest = Window.partitionBy("version", "day").orderBy(F.col("number").desc(), "run")
    return rows.withColumn("_n", F.row_number().over(newest)).where("_n = 1").drop("_n")


def publish(spark: SparkSession, root: str, entries: list[tuple]) -> None:
    """Make runs visible: one file, so all of them or none."""
    spark.createDataFrame(entries, _MANIFEST).coalesce(1).write.mode("append").parquet(f"{root}/manifest")


def due_days(spark: SparkSession, raw: str, root: str, version: str, start=None, end=None) -> tuple[list, list[str]]:
    """(rows of days to compute, days that are done), in order. One small row per day reaches the driver."""
    done = manifest(spark, root, version).select(
        "day", "number", *[F.col(c).alias(f"_{c}") for c in ("files", "bytes", "changed_at")]
    )
    same = F.lit(True)
    for c in ("files", "bytes", "changed_at"):
        same &= F.col(c).eqNullSafe(F.col(f"_{c}"))
    rows = archived_days(spark, raw, start, end).join(done, "day", "left").withColumn("_same", same).orderBy("day").collect()
    return [r for r in rows if not r._same], [r.day for r in rows if r._same]


def read_results(
    spark: SparkSession, root: str, version: str, days: Sequence[str] | None = None, schema: T.StructType | None = None
) -> DataFrame | None:
    """Results of a version: of all finished days or of some; None before the first.

    Only folders of valid runs are listed and read.
    """
    valid = manifest(spark, root, version)
    if days is not None:
        valid = valid.where(F.col("day").isin(list(days)))
    paths = [f"{root}/results/version={version}/day={r.day}/run={r.run}" for r in valid.orderBy("day").collect()]
    paths = [p for p in paths if lake.exists(spark, p)]  # a day without results has no folder
    if not paths:
        return None
    found = spark.read.parquet(paths[0]).schema if schema is None else schema
    # Partition values stay text: `01` must not become 1.
    text = [T.StructField(n, T.StringType()) for n in RESULT_PARTITIONS]
    fields = [f for f in found.fields if f.name not in RESULT_PARTITIONS]
    return spark.read.schema(T.StructType(fields + text)).option("basePath", f"{root}/results").parquet(*paths)


_ID = T.StructType([T.StructField("message_id", T.StringType())])
_PLACE = ["message_id", *EVENT_DAY]


def reprocess(
    spark: SparkSession,
    raw: str,
    root: str,
    version: str,
    score: Callable[[DataFrame], DataFrame],
    start: str | None = None,
    end: str | None = None,
    fmt: str = "json",
    days_at_once: int = DAYS_AT_ONCE,
    stop_after: int | None = None,
) -> Finished:
    """Compute the missing or outdated days of receipt from `start` to `end` (ISO dates).

    `score` turns archived messages into results, row by row; it keeps
    message_id, factory_id, event_timestamp and day. `stop_after` ends the call after
    so many jobs, as a maintenance window would; the next call goes on.
    """
    due, skipped = due_days(spark, raw, root, version, start, end)
    waiting, computed, jobs = {r.day: r for r in due}, [], 0
    while waiting and (stop_after is None or jobs < stop_after):
        finished = _finished(spark, root, version)
        days = _together(sorted(waiting), finished, days_at_once)
        part = [waiting.pop(day) for day in days]
        run = uuid.uuid4().hex
        day = F.concat_ws("-", "yyyy", "mm", "dd")
        rows = spark.read.schema(lake.raw_schema()).format(fmt).load(raw).where(day.isin(days)).withColumn("day", day)
        first = Window.partitionBy("message_id").orderBy("received_at", "published_at")
        rows = rows.withColumn("_copy", F.row_number().over(first)).where("_copy = 1").drop("_copy", "yyyy", "mm", "dd")
        parts = lake.with_date_parts(rows, "source_timestamp")
        touched = parts.select(*EVENT_DAY).distinct()
        others = [d for d in finished if d not in days]
        before, after = [d for d in others if d < days[0]], [d for d in others if d > days[0]]
        known = read_results(spark, root, version, before, _ID) if before else None
        if known is not None:
            stored = known.join(touched, list(EVENT_DAY), "left_semi")
            parts = parts.join(stored.select("message_id"), "message_id", "left_anti")
        results = score(parts.drop(*EVENT_DAY[1:]))
        results = lake.with_date_parts(results, "event_timestamp").withColumns(
            {"version": F.lit(version), "run": F.lit(run)}
        )
        lake.spread_over_folders(results, RESULT_PARTITIONS).write.mode("append").partitionBy(*RESULT_PARTITIONS).parquet(
            f"{root}/results"
        )
        entries = [(version, r.day, run, r.files, r.bytes, r.changed_at, (r.number or 0) + 1) for r in part]
        publish(spark, root, entries)
        computed += days
        jobs += 1
        later = read_results(spark, root, version, after, _ID) if after else None
        made = read_results(spark, root, version, days, _ID) if later is not None else None
        if made is not None:
            for d in _sharing(made, later):
                waiting.setdefault(d, _entry(spark, raw, root, version, d))
                skipped = [s for s in skipped if s != d]
    return Finished(tuple(computed), tuple(skipped))


def _finished(spark: SparkSession, root: str, version: str) -> list[str]:
    return [r.day for r in manifest(spark, root, version).select("day").collect()]


def _together(waiting: list[str], finished: list[str], most: int) -> list[str]:
    """The first waiting days that no finished day lies between."""
    end = min((d for d in finished if d > waiting[0] and d not in waiting), default=None)
    return [d for d in waiting if end is None or d < end][:most]


def _sharing(made: DataFrame, later: DataFrame) -> list[str]:
    """Later days that hold a copy of what has just been made."""
    found = later.join(made.select(*_PLACE), _PLACE, "left_semi")
    return [r.day for r in found.select("day").distinct().collect()]


def _entry(spark: SparkSession, raw: str, root: str, version: str, day: str):
    """Today's listing of a day together with the number of its last run."""
    last = manifest(spark, root, version).select("day", "number")
    return archived_days(spark, raw, day, day).join(last, "day", "left").first()
