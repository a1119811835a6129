"""What to keep, move or delete, and when."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantpulse.functions import clock
from plantpulse.operators.sliced import Series, with_previous

# Days of the life-cycle rules.
RAW_ARCHIVE_DAYS = 90
PROCESSED_INFREQUENT_DAYS = 365
NONCURRENT_DAYS = 90
LATEST_NONCURRENT_DAYS = 30
SNAPSHOT_HOURS = 24
PURGE_HOUR = 3
PURGE_ZONE = "Asia/Seoul"


def expire_history(history: DataFrame, as_of_time) -> DataFrame:
    """History rows still alive at `as_of_time`."""
    return history.where(F.col("ttl") > F.unix_seconds(clock.as_timestamp(as_of_time)))


def retain(df: DataFrame, as_of_time, days: int = 1, ts: str = "ts") -> DataFrame:
    """Rows of the last `days` days; on a date-partitioned table also filter the date."""
    now = clock.as_timestamp(as_of_time)
    return df.where(F.col(ts) >= clock.plus_seconds(now, -days * 86400))


def prefix(key: Column | str = "key") -> Column:
    return F.split(key, "/", 2)[0]


def age_days(as_of_time, ts: str = "last_modified") -> Column:
    return F.floor(clock.age_seconds(clock.as_timestamp(as_of_time), F.col(ts)) / 86400)


def lifecycle_tier(
    inventory: DataFrame,
    as_of_time,
    raw_days: int = RAW_ARCHIVE_DAYS,
    processed_days: int = PROCESSED_INFREQUENT_DAYS,
) -> DataFrame:
    """Storage tier of every object, from its prefix and age."""
    age, where = age_days(as_of_time), prefix()
    return inventory.select(
        "*",
        where.alias("prefix"),
        F.when((where == "raw") & (age >= raw_days), "archive")
        .when((where == "processed") & (age >= processed_days), "infrequent")
        .otherwise("standard")
        .alias("tier"),
    )


def tier_bytes(tiered: DataFrame) -> DataFrame:
    return tiered.groupBy("prefix", "tier").agg(
        F.count(F.lit(1)).alias("objects"), F.sum("size").alias("total_bytes")
    )


def noncurrent_versions(inventory: DataFrame, slice_seconds: int = 86400) -> DataFrame:
    """Every replaced version with the time its successor was written.

    Seen from the successor: the row before it in the key's history became
    non-current at that moment.  Time slices keep a key with very many
    versions out of a single task.
    """
    fields = ("version_id", "size", "last_modified")
    series = Series(("key",), ("last_modified", "version_id"), slice_seconds)
    rows = with_previous(inventory.select("key", *fields), series, fields)
    return rows.where(F.col("prev_version_id").isNotNull()).select(
        "key", *[F.col(f"prev_{f}").alias(f) for f in fields], F.col("last_modified").alias("noncurrent_since")
    )


def expire_noncurrent(
    inventory: DataFrame,
    as_of_time,
    days: int = NONCURRENT_DAYS,
    latest_days: int = LATEST_NONCURRENT_DAYS,
    slice_seconds: int = 86400,
) -> DataFrame:
    """Old versions that are due for deletion."""
    age = age_days(as_of_time, "noncurrent_since")
    limit = F.when(prefix() == "latest", latest_days).otherwise(days)
    return noncurrent_versions(inventory, slice_seconds).where(age >= limit)


def expire_snapshots(files: DataFrame, as_of_time, hours: int = SNAPSHOT_HOURS) -> DataFrame:
    """Image files older than the limit."""
    image = F.lower("path").rlike(r"\.(jpg|jpeg|png)$")
    return files.where(image & (clock.age_seconds(clock.as_timestamp(as_of_time), F.col("last_modified")) > hours * 3600))


def daily_purge(files: DataFrame, as_of_time) -> DataFrame:
    """Everything written before the latest 03:00 local purge."""
    local = F.from_utc_timestamp(clock.as_timestamp(as_of_time), PURGE_ZONE)
    at = F.date_trunc("day", clock.plus_seconds(local, -PURGE_HOUR * 3600))
    cut = F.to_utc_timestamp(clock.plus_seconds(at, PURGE_HOUR * 3600), PURGE_ZONE)
    return files.where(F.col("last_modified") < cut)
