"""SimHash near duplicates, found through Golay-coded fingerprint segments.

A fingerprint of 64 bits is cut into segments of 22, 21 and 21 bits. Two
fingerprints at two or fewer differing bits agree in at least one whole segment,
and differ in at most two bits of the next one, where they share a Golay key.
So a key is (segment, its bits, a Golay key of the next segment): about 34 bits,
16 keys for a fingerprint on average. Distinct fingerprints meet on keys and are
verified by their differing bits.

In a crowded key pairs would grow with the square of the group. There, every
fingerprint names the points one bit away from it and itself instead: two
fingerprints at two or fewer bits share such a point, and two that share one are
at two or fewer bits. All around a point are linked to the smallest of them;
that is 65 points each and exactly the same components.

Defined results. Null counts as empty; texts without words have fingerprint
zero, which links like any other. Fewer words than a shingle: the whole sequence
is one shingle. A null doc_id is never a component's smallest; alone it has a
null component_id. Repeated rows are answered each. An empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantpulse.llm import golay
from plantpulse.llm.components import components
from plantpulse.llm.tables import identified, kept, texts

#: The hash seed, segment widths from the top, bits that may differ.
SEED = 42
WIDTHS = (22, 21, 21)
MAX_BITS = 2
#: Shingles whose bits are counted at once.
COUNTED = 1 << 16
#: Fingerprints of a key that are compared pair by pair; beyond it, by shared points.
CROWD = 32


def fingerprint(text: str, words_each: int = 3) -> int:
    words = text.encode().lower().split()  # of bytes: A-Z and ASCII white space only
    if not words:
        return 0
    if len(words) < words_each:
        shingles = iter([b" ".join(words)])
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(words_each))))  # noqa: B905
    hashed = b"".join(map(partial(xxhash.xxh64_digest, seed=SEED), shingles))
    digests = np.frombuffer(hashed, dtype=np.uint8).reshape(-1, 8)
    ones = np.zeros(64, dtype=np.int64)
    for start in range(0, len(digests), COUNTED):
        ones += np.unpackbits(digests[start : start + COUNTED], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(digests)).tobytes(), "big", signed=True)


def _fingerprints(words_each: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = pa.array([fingerprint(text, words_each) for text in texts(batch)], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("row_key"), marks], names=["doc_id", "row_key", "fingerprint"]
            )

    return run


def segment_keys(marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which fingerprint, key) for signed 64-bit fingerprints."""
    unsigned, segments, below = marks.view(np.uint64), [], 64
    for width in WIDTHS:
        below -= width
        segments.append((unsigned >> np.uint64(below) & np.uint64((1 << width) - 1)).astype(np.int64))
    owners, keys = [], []
    for n, exact in enumerate(segments):
        owner, near = golay.neighbour_keys(segments[(n + 1) % len(segments)])
        owners.append(owner)
        keys.append(n << 40 | exact[owner] << 12 | near)
    return np.concatenate(owners), np.concatenate(keys)


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        marks = batch.column("fingerprint").to_numpy(zero_copy_only=False).astype(np.int64)
        if len(marks):
            owner, keys = segment_keys(marks)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(marks[owner])], names=["key", "fingerprint"])


def sign(docs: DataFrame, words_each: int = 3) -> DataFrame:
    """(doc_id, row_key, fingerprint) of every row, in the shared folder."""
    schema = "doc_id long, row_key long, fingerprint long"
    return kept(identified(docs).mapInArrow(_fingerprints(words_each), schema))


def near_links(marks: DataFrame) -> DataFrame:
    """Links (a, b) whose components are those of fingerprints at MAX_BITS or fewer bits.

    `marks` holds distinct fingerprints.
    """
    keyed = marks.mapInArrow(_keyed, "key long, fingerprint long")
    sizes = keyed.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    met = kept(keyed.join(sizes, "key"))
    few = met.filter(F.col("n") <= CROWD)
    pairs = (
        few.select("key", F.col("fingerprint").alias("a"))
        .join(few.select("key", F.col("fingerprint").alias("b")), "key")
        .filter((F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= MAX_BITS))
    )
    points = F.array(F.lit(0).cast("long"), *(F.lit(-(1 << 63) if bit == 63 else 1 << bit).cast("long") for bit in range(64)))
    crowd = met.filter(F.col("n") > CROWD).select("fingerprint").distinct()
    stars = crowd.select(
        F.col("fingerprint").alias("a"),
        F.explode(F.transform(points, lambda bit: F.col("fingerprint").bitwiseXOR(bit))).alias("b"),
    )
    # Points with one fingerprint around them link nothing; the others link all of theirs to the smallest.
    shared = stars.groupBy("b").agg(F.min("a").alias("first"), F.max("a").alias("last")).filter("first < last")
    around = stars.join(shared, "b").filter("a <> first").select("a", F.col("first").alias("b"))
    return pairs.select("a", "b").union(around).distinct()


def near_groups(docs: DataFrame, words_each: int = 3) -> DataFrame:
    """Every row's doc_id, row_key, fingerprint, component (a fingerprint) and component_id."""
    signed = sign(docs, words_each)
    marks = signed.groupBy("fingerprint").agg(F.min("doc_id").alias("first"))
    grouped = components(near_links(marks.select("fingerprint")))
    known = marks.join(grouped.withColumnRenamed("node", "fingerprint"), "fingerprint", "left").withColumn(
        "component", F.coalesce("component", "fingerprint")
    )
    smallest = known.groupBy("component").agg(F.min("first").alias("component_id"))
    answers = known.join(smallest, "component").select("fingerprint", "component", "component_id")
    return signed.join(answers, "fingerprint").select("doc_id", "row_key", "fingerprint", "component", "component_id")


def one_of_each(groups: DataFrame) -> DataFrame:
    """row_key of the document with the smallest doc_id in each component."""
    first = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row_key")
    return groups.groupBy("component").agg(F.min(first).alias("first")).select("first.row_key")


def hex_fingerprint(column: str):
    return F.lpad(F.lower(F.hex(column)), 16, "0")
