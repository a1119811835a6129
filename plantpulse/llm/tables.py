"""What the operators share: row identity, shared storage, streaming Arrow helpers.

A row of `documents` is known by (doc_id, row_key). row_key is a 64-bit hash of
the id and the text, so rows that repeat both are one document and get one
answer each, while rows that repeat only the id stay apart. A null text counts
as empty; a null doc_id is one document that comes after all others.
"""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Stands for a null doc_id inside tasks; sorts after every id.
LAST = (1 << 63) - 1
#: Rows that a task hands back at once.
OUT_ROWS = 1 << 16


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    Taken from the session. Where it is unset a local session gets a temporary
    folder; a cluster without one is an error, because its machines could not
    see each other's files.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all machines of the cluster share")
    return tempfile.mkdtemp(prefix="plantpulse-")


def kept(df: DataFrame) -> DataFrame:
    """df written once to the shared folder and read back: cuts the lineage and
    survives lost executors."""
    path = f"{shared_folder(df.sparkSession)}/plantpulse-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """`name`, with underscores in front until no column of df is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def row_key() -> Column:
    return F.xxhash64(F.col("doc_id").cast("long"), F.coalesce(F.col("text"), F.lit("")))


def keep_rows(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows of docs whose row_key is in `keys`, one each, with their columns as they are."""
    key = fresh(docs, "row_key")
    found = docs.withColumn(key, row_key()).join(keys.select(F.col("row_key").alias(key)).distinct(), key, "left_semi")
    number = fresh(found, "number")
    first = Window.partitionBy(key).orderBy(key)
    return found.withColumn(number, F.row_number().over(first)).filter(F.col(number) == 1).select(*docs.columns)


def identified(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id, text (never null), row_key and the columns asked for."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        text.alias("text"),
        row_key().alias("row_key"),
        *more,
    )


def texts(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    return [text or "" for text in batch.column(column).to_pylist()]


def longs(batch: pa.RecordBatch, column: str, null: int = LAST):
    """A whole-number column as numpy, with a stand-in for null."""
    return batch.column(column).cast(pa.int64()).fill_null(null).to_numpy(zero_copy_only=False)


def id_column(values) -> pa.Array:
    """Back from stand-ins to nulls."""
    found = pa.array(values, pa.int64())
    return pa.compute.if_else(pa.compute.equal(found, LAST), pa.scalar(None, pa.int64()), found)


def forget(memory: dict, most: int) -> None:
    """Keeps a task's memory of words bounded: beyond `most` only short ones stay, which come most often."""
    if len(memory) > most:
        short = {word: found for word, found in memory.items() if len(word) <= 7}
        memory.clear()
        if len(short) <= most // 2:
            memory.update(short)


def give_back() -> None:
    """Hands freed memory back to the machine: a Python worker keeps what the stages before have used,
    and Spark keeps the worker."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc only
    if trim:
        trim(0)


def slabs(items: list[bytes], most: int) -> Iterator[tuple[int, int]]:
    """Index ranges of consecutive items of at most `most` bytes together, one item at least."""
    start = total = 0
    for i, item in enumerate(items):
        if i > start and total + len(item) > most:
            yield start, i
            start, total = i, 0
        total += len(item)
    if start < len(items):
        yield start, len(items)
