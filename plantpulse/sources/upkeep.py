"""Upkeep of an archive by day of receipt, while readers go on.

Compaction rewrites chosen days only. The large files of a day lie in a run of
their own, and a day counts as compacted when the manifest names that run and
the fingerprint of the small files it was made from. The manifest row is one
atomic append, so a reader sees either the small files of a day or its run. A
message that arrives for a compacted day changes the fingerprint: the day is
read from its small files again until the next compaction, which opens no other
day. Small files whose day is compacted can be deleted; the run then stands alone.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plantpulse.sources import lake, reprocess

VERSION = "compact"
_FINGERPRINT = ("files", "bytes", "changed_at")
_ORDER = ("factory_id", "source_type", "source_timestamp")


def _state(spark: SparkSession, raw: str, root: str) -> tuple[dict, dict]:
    """(days of the small files, valid runs by day): small rows, one per day."""
    listed = {r.day: r for r in reprocess.archived_days(spark, raw).collect()} if lake.exists(spark, raw) else {}
    runs = {r.day: r for r in reprocess.manifest(spark, root, VERSION).collect()}
    same = lambda a, b: all(a[c] == b[c] for c in _FINGERPRINT)
    return listed, {day: r for day, r in runs.items() if day not in listed or same(r, listed[day])}


def compact_days(
    spark: SparkSession,
    raw: str,
    root: str,
    days: Sequence[str] | None = None,
    fmt: str = "json",
    days_at_once: int = reprocess.DAYS_AT_ONCE,
    records_per_file: int = 1000000,
) -> list[str]:
    """Compact the chosen days (all by default) that are not, or have changed since; returns them.

    Within a day rows are range partitioned by site and time, so a busy site
    spans several tasks and files carry useful statistics.
    """
    listed, valid = _state(spark, raw, root)
    due = sorted(d for d in listed if d not in valid and (days is None or d in days))
    numbers = {r.day: r.number for r in reprocess.manifest(spark, root, VERSION).collect()}
    for start in range(0, len(due), days_at_once):
        part, run = due[start : start + days_at_once], uuid.uuid4().hex
        day = F.concat_ws("-", "yyyy", "mm", "dd")
        rows = spark.read.schema(lake.raw_schema()).format(fmt).load(raw).where(day.isin(part))
        rows = rows.withColumns({"version": F.lit(VERSION), "day": day, "run": F.lit(run)}).drop("yyyy", "mm", "dd")
        (
            rows.repartitionByRange("day", *_ORDER)
            .sortWithinPartitions("day", *_ORDER)
            .write.mode("append")
            .option("maxRecordsPerFile", records_per_file)
            .partitionBy("version", "day", "run")
            .parquet(f"{root}/results")
        )
        entries = [
            (VERSION, d, run, *[listed[d][c] for c in _FINGERPRINT], numbers.get(d, 0) + 1) for d in part
        ]
        reprocess.publish(spark, root, entries)
    return due


def read_archive(spark: SparkSession, raw: str, root: str, days: Sequence[str] | None = None, fmt: str = "json") -> DataFrame | None:
    """The archive: compacted days from their runs, the others from the small files. None if there are no days."""
    listed, valid = _state(spark, raw, root)
    wanted = sorted(d for d in {*listed, *valid} if days is None or d in days)
    columns = [f.name for f in lake.raw_schema().fields if f.name not in ("yyyy", "mm", "dd")]
    parts = []
    done = [f"{root}/results/version={VERSION}/day={d}/run={valid[d].run}" for d in wanted if d in valid]
    if done:
        parts.append(spark.read.option("basePath", f"{root}/results").parquet(*done).select(*columns))
    rest = [d for d in wanted if d not in valid]
    if rest:
        rows = spark.read.schema(lake.raw_schema()).format(fmt).load(raw)
        parts.append(rows.where(F.concat_ws("-", "yyyy", "mm", "dd").isin(rest)).select(*columns))
    if not parts:
        return None
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def removable_days(spark: SparkSession, raw: str, root: str) -> list[str]:
    """Days whose small files are no longer read."""
    listed, valid = _state(spark, raw, root)
    return sorted(d for d in listed if d in valid)
