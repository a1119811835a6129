"""Exact duplicates by polynomial fingerprints that compose over chunks.

The fingerprint of a text is a polynomial in its bytes, after deletion of ASCII
white space. Chunks are hashed apart and combined by shifting with a power of
the base, H(ab) = H(a) * base^|b| + H(b), so a huge document is never hashed in
one piece and chunks may be hashed anywhere. Texts with equal fingerprint and
length are then compared chunk by chunk: a chunk's smallest and largest version
must be the same bytes. These are aggregates with map-side combine, so a group
of copies with a third of all rows meets in no single task.

Defined results. Null counts as empty; all empty texts are equal. Of equal texts
the one with most code points in the original stays, then the smallest doc_id; a
null doc_id loses against any other. Rows that repeat id and text tie: exactly
one of them is marked kept. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantpulse.llm.tables import identified, kept, texts

#: The deleted characters, two primes below 2^31 and their bases.
SPACE = b" \t\n\x0b\x0c\r"
FIELDS = ((2147483647, 1000003), (2147483629, 754974721))
#: Bytes hashed at once; 255 * 2^31 * CHUNK stays below 2^63.
CHUNK = 1 << 16
COMPARED = 1 << 14

SIGNATURE = pa.schema(
    [("doc_id", pa.int64()), ("row_key", pa.int64()), ("points", pa.int64()), ("bytes", pa.int64()),
     ("fingerprint", pa.int64()), ("text_sha256", pa.string())]
)


@lru_cache
def _powers(field: int) -> np.ndarray:
    """base^(CHUNK-1) down to base^0."""
    prime, base = FIELDS[field]
    powers = np.ones(1, dtype=np.uint64)
    while len(powers) < CHUNK:
        step = np.uint64(pow(base, len(powers), prime))
        powers = np.concatenate([powers * step % np.uint64(prime), powers])
    return powers


def hash_chunk(data: bytes, field: int) -> int:
    """The polynomial of at most CHUNK bytes."""
    values = np.frombuffer(data, dtype=np.uint8).astype(np.uint64)
    return int((values * _powers(field)[CHUNK - len(values) :]).sum() % np.uint64(FIELDS[field][0]))


def combine(left: int, right: int, right_bytes: int, field: int) -> int:
    """The polynomial of a text from those of its two parts."""
    prime, base = FIELDS[field]
    return (left * pow(base, right_bytes, prime) + right) % prime


def fingerprint(data: bytes, chunk: int = CHUNK) -> int:
    """Both polynomials in one 62-bit number; the same for any chunk size."""
    total = 0
    for field in range(len(FIELDS)):
        value = 0
        for start in range(0, len(data), chunk):
            part = data[start : start + chunk]
            value = combine(value, hash_chunk(part, field), len(part), field)
        total = total << 31 | value
    return total


def normalised(text: str) -> bytes:
    return text.encode().translate(None, SPACE)


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = texts(batch)
        data = [normalised(text) for text in found]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("row_key"),
                pa.array([len(text) for text in found], pa.int64()),
                pa.array([len(x) for x in data], pa.int64()),
                pa.array([fingerprint(x) for x in data], pa.int64()),
                pa.array([hashlib.sha256(x).hexdigest() for x in data], pa.string()),
            ],
            schema=SIGNATURE,
        )


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("fingerprint", pa.int64()), ("bytes", pa.int64()), ("chunk", pa.int64()), ("content", pa.binary())])
    for batch in batches:
        rows = []
        for text, mark in zip(texts(batch), batch.column("fingerprint").to_pylist(), strict=True):
            data = normalised(text)
            rows += [(mark, len(data), at, data[at : at + COMPARED]) for at in range(0, len(data), COMPARED)]
        columns = list(zip(*rows, strict=True)) or [()] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def sign(docs: DataFrame) -> DataFrame:
    """One small row per document; kept in the shared folder, since the steps below read it several times."""
    rows = identified(docs).mapInArrow(
        _signatures,
        "doc_id long, row_key long, points long, bytes long, fingerprint long, text_sha256 string",
    )
    return kept(rows.withColumn("row", F.monotonically_increasing_id()))


def differing(docs: DataFrame, signed: DataFrame) -> DataFrame:
    """(fingerprint, bytes) under which different texts met, found by comparing all their chunks."""
    key = ["fingerprint", "bytes"]
    shared = signed.groupBy(*key).agg(F.count("*").alias("n")).filter("n > 1")
    members = signed.join(shared, key, "left_semi").select("row_key", "fingerprint").distinct()
    chunks = (
        identified(docs)
        .select("row_key", "text")
        .join(members, "row_key")
        .select("text", "fingerprint")
        .mapInArrow(_chunks, "fingerprint long, bytes long, chunk long, content binary")
    )
    compared = chunks.groupBy(*key, "chunk").agg(F.min("content").alias("low"), F.max("content").alias("high"))
    return compared.filter("low <> high").select(*key).distinct()


def exact_groups(docs: DataFrame) -> DataFrame:
    """Every row's doc_id, row_key, keep_id, group_size, kept and text_sha256."""
    signed = sign(docs)
    odd = differing(docs, signed).withColumn("odd", F.lit(True))
    classes = signed.join(odd, ["fingerprint", "bytes"], "left").withColumn(
        "content", F.when(F.col("odd"), F.col("text_sha256")).otherwise(F.lit(""))
    )
    key = ["fingerprint", "bytes", "content"]
    first = F.struct((-F.col("points")).alias("fewest"), F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row")
    groups = classes.groupBy(*key).agg(F.min(first).alias("first"), F.count("*").alias("group_size"))
    return classes.join(groups, key).select(
        "doc_id",
        "row_key",
        F.col("first.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("first.row")).alias("kept"),
        "text_sha256",
    )
