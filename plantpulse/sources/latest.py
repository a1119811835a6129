"""The current-state table: one row per key, kept as numbered versions.

Each update reads the newest complete version that is not its own, keeps the
newer row per key, and writes the next one. Versions have a rising number of
their own, and their folder also names the writer and its micro-batch: a batch
that is run again finds its version and writes it again from the same
predecessor, so nothing is applied twice, while a new checkpoint, whose batch
ids start again at 0, goes on from the newest version. A version counts only
with its `_SUCCESS` marker.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from plantpulse.operators.state import NEWEST, latest_per_factory


def _path(spark: SparkSession, text: str):
    return spark._jvm.org.apache.hadoop.fs.Path(text)


def _file_system(spark: SparkSession, root: str):
    return _path(spark, root).getFileSystem(spark._jsc.hadoopConfiguration())


class Version(NamedTuple):
    number: int
    writer: str
    batch_id: int

    @property
    def folder(self) -> str:
        return f"v={self.number}-{self.writer}-{self.batch_id}"


def writer_of(df: DataFrame) -> str:
    """The running streaming query, or `batch` outside one."""
    found = df.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    return found.replace("-", "") if found else "batch"


def complete(spark: SparkSession, root: str) -> list[Version]:
    """Complete versions, oldest first (a listing of names, not of data)."""
    fs, base = _file_system(spark, root), _path(spark, root)
    if not fs.exists(base):
        return []
    found = []
    for status in fs.listStatus(base):
        name = status.getPath().getName()
        if name.startswith("v=") and fs.exists(_path(spark, f"{root}/{name}/_SUCCESS")):
            number, writer, batch_id = name[2:].split("-")
            found.append(Version(int(number), writer, int(batch_id)))
    return sorted(found)


def versions(spark: SparkSession, root: str) -> list[int]:
    return [v.number for v in complete(spark, root)]


def read_latest(spark: SparkSession, root: str, version: int | None = None) -> DataFrame | None:
    known = [v for v in complete(spark, root) if version is None or v.number == version]
    return spark.read.parquet(f"{root}/{known[-1].folder}") if known else None


def _next(spark: SparkSession, root: str, writer: str, batch_id: int) -> tuple[Version | None, Version]:
    """(predecessor, own version) of a micro-batch."""
    known = complete(spark, root)
    own = next((v for v in known if (v.writer, v.batch_id) == (writer, batch_id)), None)
    before = [v for v in known if own is None or v.number < own.number]
    last = before[-1] if before else None
    return last, own or Version(last.number + 1 if last else 0, writer, batch_id)


def read_before(df: DataFrame, root: str, batch_id: int) -> DataFrame | None:
    """The state that a micro-batch starts from."""
    spark = df.sparkSession
    last, _ = _next(spark, root, writer_of(df), batch_id)
    return spark.read.parquet(f"{root}/{last.folder}") if last else None


def write_version(df: DataFrame, root: str, batch_id: int, keep: int = 3) -> None:
    """Write a micro-batch's version and drop the oldest ones beyond `keep`."""
    spark = df.sparkSession
    _, own = _next(spark, root, writer_of(df), batch_id)
    df.write.mode("overwrite").parquet(f"{root}/{own.folder}")
    fs = _file_system(spark, root)
    for old in [v for v in complete(spark, root) if v.number < own.number][:-keep]:
        fs.delete(_path(spark, f"{root}/{old.folder}"), True)


def upsert_latest(
    updates: DataFrame,
    root: str,
    batch_id: int,
    keys: Sequence[str] = ("factory_id",),
    order: Sequence[str] = NEWEST,
    keep: int = 3,
) -> None:
    """Merge a batch of messages into the table.

    Batch winners are reduced first, so what meets the stored table is one
    row per key.
    """
    winners = latest_per_factory(updates, keys, order)
    stored = read_before(updates, root, batch_id)
    if stored is not None:
        winners = latest_per_factory(stored.select(*winners.columns).unionByName(winners), keys, order)
    write_version(winners, root, batch_id, keep)
