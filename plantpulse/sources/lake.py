"""Raw archive and processed results as partitioned files.

Raw is partitioned by the day of receipt, processed by the hour of the event.
Writers add a rebalance hint: adaptive execution then splits the partition of
a busy site over several tasks and merges small ones, so neither one huge file
nor many tiny ones arise.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plantpulse import contract as C
from plantpulse.functions import clock

# How far a source clock may run ahead of the receiver's.
CLOCK_AHEAD = timedelta(seconds=C.CLOCK_AHEAD_SECONDS)
RAW_PARTITIONS = ("factory_id", "source_type", "yyyy", "mm", "dd")
PROCESSED_PARTITIONS = ("factory_id", "yyyy", "mm", "dd", "hh")
PROCESSED_DATASETS = ("risk-score", "factory-state", "infra-state")
JSON_TIMESTAMP = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
# Partition values stay text: `01` must not become 1.
_PARTITION_FIELDS = [T.StructField(n, T.StringType()) for n in ("yyyy", "mm", "dd")]


def with_date_parts(df: DataFrame, ts, hours: bool = False) -> DataFrame:
    parts = {"yyyy": "yyyy", "mm": "MM", "dd": "dd", **({"hh": "HH"} if hours else {})}
    return df.select("*", *[F.date_format(ts, fmt).alias(name) for name, fmt in parts.items()])


def spread_over_folders(df: DataFrame, partitions, tasks: int | None = None) -> DataFrame:
    """Bring the rows of a folder together before a partitioned write.

    Default: rebalance, which splits a folder that is large and merges folders
    that are small into one task; right for a batch that touches few folders.
    With `tasks`, folders are hashed over that many tasks; right for a backfill
    into very many folders, where each folder is itself a small time slice.
    """
    columns = [F.col(p) for p in partitions]
    return df.hint("rebalance", *columns) if tasks is None else df.repartition(tasks, *columns)


def backfill_tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _write(df: DataFrame, root: str, partitions, fmt: str, mode: str, tasks: int | None = None) -> None:
    writer = spread_over_folders(df, partitions, tasks).write.mode(mode).format(fmt)
    if fmt == "json":
        # The default format would cut timestamps to milliseconds.
        writer = writer.option("timestampFormat", JSON_TIMESTAMP).option("timeZone", "UTC")
    writer.partitionBy(*partitions).save(root)


def raw_rows(messages: DataFrame) -> DataFrame:
    """Messages as archived: contract fields, receipt in epoch ms, date of receipt."""
    return with_date_parts(
        messages.select(
            *[f.name for f in C.MESSAGE.fields], F.unix_millis("received_at").alias("received_at")
        ),
        F.timestamp_millis("received_at"),
    )


def write_raw(messages: DataFrame, root: str, fmt: str = "json", mode: str = "append") -> None:
    """Archive messages under factory / source type / day of receipt."""
    _write(raw_rows(messages), root, RAW_PARTITIONS, fmt, mode)


def raw_schema() -> T.StructType:
    return T.StructType(C.RAW_MESSAGE.fields + _PARTITION_FIELDS)


def _days(day, start: datetime | None, end: datetime | None) -> list:
    """Partition-column predicates for the days from `start` to `end`, either of which may be open."""
    found = []
    if start is not None:
        found.append(day >= start.strftime("%Y-%m-%d"))
    if end is not None:
        found.append(day <= end.strftime("%Y-%m-%d"))
    return found


def between(df: DataFrame, ts: str, start: datetime | None, end: datetime | None) -> DataFrame:
    """Closed interval; an end that is None is open."""
    if start is not None:
        df = df.where(F.col(ts) >= F.lit(start))
    if end is not None:
        df = df.where(F.col(ts) <= F.lit(end))
    return df


def _where(df: DataFrame, predicates) -> DataFrame:
    for predicate in predicates:
        df = df.where(predicate)
    return df


_DAY = ("yyyy", "mm", "dd")


def read_raw(
    spark: SparkSession,
    root: str,
    factory: str | None = None,
    source_type: str | None = None,
    start: datetime | None = None,
    end: datetime | None = None,
    received_until: datetime | None = None,
    fmt: str = "json",
    clock_ahead: timedelta = CLOCK_AHEAD,
) -> DataFrame:
    """Pruned scan of the archive.

    `start` and `end` are source times (UTC). The archive is cut by day of
    receipt, and a message may be received long after its time, from a spool:
    days before `start` are pruned, later ones only with `received_until`. A
    source clock may run ahead of ours by `clock_ahead`, so days are pruned from
    that much before `start`; `checks.with_errors` rejects what is further ahead.
    """
    df = spark.read.schema(raw_schema()).format(fmt).load(root)
    if factory is not None:
        df = df.where(F.col("factory_id") == factory)
    if source_type is not None:
        df = df.where(F.col("source_type") == source_type)
    df = _where(df, _days(F.concat_ws("-", *_DAY), None if start is None else start - clock_ahead, received_until))
    if received_until is not None:
        df = df.where(F.timestamp_millis("received_at") <= F.lit(received_until))
    return between(df, "source_timestamp", start, end)


def write_processed(
    df: DataFrame, root: str, dataset: str, ts: str = "event_timestamp", mode: str = "append", tasks: int | None = None
) -> None:
    """Append results of one of the three datasets, partitioned down to the hour."""
    if dataset not in PROCESSED_DATASETS:
        raise ValueError(f"unknown dataset: {dataset}")
    _write(with_date_parts(df, ts, hours=True), f"{root}/{dataset}", PROCESSED_PARTITIONS, "parquet", mode, tasks)


def read_processed(
    spark: SparkSession,
    root: str,
    dataset: str,
    schema: T.StructType,
    factory: str | None = None,
    start: datetime | None = None,
    end: datetime | None = None,
) -> DataFrame:
    fields = schema.fields + [T.StructField(n, T.StringType()) for n in ("yyyy", "mm", "dd", "hh")]
    df = spark.read.schema(T.StructType(fields)).parquet(f"{root}/{dataset}")
    if factory is not None:
        df = df.where(F.col("factory_id") == factory)
    return between(_where(df, _days(F.concat_ws("-", *_DAY), start, end)), "event_timestamp", start, end)


def _folder(spark: SparkSession, root: str):
    """(file system, path) of a folder."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def exists(spark: SparkSession, root: str) -> bool:
    fs, path = _folder(spark, root)
    return fs.exists(path)


def drop_folder(spark: SparkSession, root: str) -> None:
    fs, path = _folder(spark, root)
    fs.delete(path, True)


def stored_batches(spark: SparkSession, root: str, more: str = "") -> DataFrame | None:
    """Ids, and columns of the schema text `more`, that micro-batches have stored under `batch=<id>` folders.

    None before the first batch.
    """
    if not exists(spark, root):
        return None
    fields = [T.StructField("message_id", T.StringType()), T.StructField("batch", T.LongType())]
    fields += T.StructType.fromDDL(more).fields if more else []
    fields += [T.StructField(n, T.StringType()) for n in PROCESSED_PARTITIONS]
    return spark.read.schema(T.StructType(fields)).parquet(root)


def processed_detail(processed: DataFrame, message_id: str) -> DataFrame:
    """One calculation result; site and hour are read off the id for pruning."""
    factory, _, _, stamp = message_id.split(":", 3)
    date, time = stamp.split("T")
    yyyy, mm, dd = date.split("-")
    return processed.where(
        (F.col("factory_id") == factory)
        & (F.col("yyyy") == yyyy)
        & (F.col("mm") == mm)
        & (F.col("dd") == dd)
        & (F.col("hh") == time[:2])
        & (F.col("message_id") == message_id)
    )


def compact_raw(spark: SparkSession, source: str, target: str, records_per_file: int = 1000000, fmt: str = "json", target_fmt: str = "parquet") -> None:
    """Merge many small objects into few files, ordered by site and time.

    The range partitioning samples its bounds, so a busy site spans several
    output tasks, and the order gives Parquet useful min/max statistics.
    """
    rows = spark.read.schema(raw_schema()).format(fmt).load(source)
    (
        rows.repartitionByRange("factory_id", "source_type", "yyyy", "mm", "dd", "source_timestamp")
        .sortWithinPartitions("factory_id", "source_type", "yyyy", "mm", "dd", "source_timestamp")
        .write.mode("overwrite")
        .option("maxRecordsPerFile", records_per_file)
        .format(target_fmt)
        .partitionBy(*RAW_PARTITIONS)
        .save(target)
    )


def history_partitioned(history: DataFrame) -> DataFrame:
    return history.withColumn("date", F.date_format("timestamp", "yyyy-MM-dd"))


def append_history(history: DataFrame, root: str, kind: str, mode: str = "append") -> None:
    """Append to HISTORY#<kind>, partitioned by site and date."""
    _write(history_partitioned(history), f"{root}/{kind}", ("factory_id", "date"), "parquet", mode)


def read_history(
    spark: SparkSession,
    root: str,
    kind: str,
    schema: T.StructType,
    factory: str | None = None,
    start: datetime | None = None,
    end: datetime | None = None,
) -> DataFrame:
    """Range read; partition columns are filtered as well as the time."""
    full = T.StructType(schema.fields + [T.StructField("date", T.StringType())])
    df = spark.read.schema(full).parquet(f"{root}/{kind}")
    if factory is not None:
        df = df.where(F.col("factory_id") == factory)
    return between(_where(df, _days(F.col("date"), start, end)), "timestamp", start, end)


BATCH_PARTITIONS = ("date", "factory_id", "batch")


def write_history_batch(rows: DataFrame, root: str, kind: str, batch_id: int) -> None:
    """Rows of a micro-batch under date, site and batch; running the batch again replaces its folders."""
    dated = rows.select("*", F.date_format("source_timestamp", "yyyy-MM-dd").alias("date"))
    _write_batch_folders(dated, f"{root}/{kind}", BATCH_PARTITIONS, batch_id)


def _write_batch_folders(rows: DataFrame, path: str, partitions, batch_id: int) -> None:
    """Replace the folders of this batch, and no others."""
    (
        spread_over_folders(rows.withColumn("batch", F.lit(batch_id)), partitions)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partitions)
        .parquet(path)
    )


def write_parts(parts: DataFrame, path: str, batch_id: int) -> None:
    """Parts of day summaries under date and batch."""
    _write_batch_folders(parts, path, ("date", "batch"), batch_id)


def read_parts(spark: SparkSession, path: str, start: datetime | None = None, end: datetime | None = None) -> DataFrame:
    return _where(_read_dated(spark, path), _days(F.col("date"), start, end))


def _read_dated(spark: SparkSession, path: str) -> DataFrame:
    """A table under `date=` folders; partition values stay text."""
    found = spark.read.parquet(path).schema
    kinds = {"date": T.StringType(), "factory_id": T.StringType(), "batch": T.LongType()}
    fields = [T.StructField(f.name, kinds.get(f.name, f.dataType)) for f in found.fields]
    return spark.read.schema(T.StructType(fields)).parquet(path)


def read_history_batches(
    spark: SparkSession, root: str, kind: str, factory: str | None = None, start: datetime | None = None, end: datetime | None = None
) -> DataFrame:
    """What `write_history_batch` wrote, by source time; dates outside the range are not opened."""
    df = _read_dated(spark, f"{root}/{kind}")
    if factory is not None:
        df = df.where(F.col("factory_id") == factory)
    return between(_where(df, _days(F.col("date"), start, end)), "source_timestamp", start, end)


def drop_dates(spark: SparkSession, root: str, before: datetime) -> list[str]:
    """Delete the `date=` folders that end at `before` or earlier; a listing, no data is read."""
    fs, path = _folder(spark, root)
    gone = []
    for status in fs.listStatus(path) if fs.exists(path) else []:
        name = status.getPath().getName()
        if name.startswith("date=") and datetime.fromisoformat(name[5:]) + timedelta(days=1) <= before:
            fs.delete(status.getPath(), True)
            gone.append(f"{root}/{name}")
    return sorted(gone)


def rewrite_alive(spark: SparkSession, source: str, target: str, as_of_time, partitions=("factory_id", "date")) -> None:
    """Write the unexpired rows to a new location (L1 on a file table)."""
    alive = spark.read.parquet(source).where(F.col("ttl") > F.unix_seconds(clock.as_timestamp(as_of_time)))
    _write(alive, target, partitions, "parquet", "overwrite")


def long_history(history: DataFrame, processed: DataFrame, as_of_time, ttl_seconds: int = C.HISTORY_TTL_SECONDS) -> DataFrame:
    """History within its lifetime, processed results before it."""
    cut = clock.plus_seconds(clock.as_timestamp(as_of_time), -ttl_seconds)
    recent = history.where(F.col("timestamp") > cut)
    older = processed.where(F.col("timestamp") <= cut)
    shared = [c for c in history.columns if c in processed.columns]
    return recent.select(*shared, F.lit("history").alias("origin")).unionByName(
        older.select(*shared, F.lit("processed").alias("origin"))
    )
