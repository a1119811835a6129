"""Line deduplication across documents: only the first document keeps a line.

Lines are hashed, dealt out by ranges of the hash and sorted by (hash, document,
position); each task then streams its range and sees the first document of a
line before all others. The hash is uniform, so equal ranges of it are even
without sampling. Before the shuffle every Arrow batch settles what it can: a
line whose batch holds an earlier document is dropped for certain, so a line
that a third of all documents share sends one row per batch. What comes back
is one compressed bitmap per document that loses lines, never text.

Defined results. A null or empty text is one empty line. Lines shorter than
`min_points` code points after stripping are never dropped. Documents with the
same doc_id count as one document; a null doc_id comes last. Rows that repeat
id and text get the same answer each. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantpulse.llm.tables import LAST, OUT_ROWS, id_column, identified, longs, texts

SPACE = b" \t\n\x0b\x0c\r"
MIN_POINTS = 10

LINES = "settled boolean, high long, low long, doc_id long, row_key long, positions array<int>"
_LINES = pa.schema(
    [("settled", pa.bool_()), ("high", pa.int64()), ("low", pa.int64()), ("doc_id", pa.int64()),
     ("row_key", pa.int64()), ("positions", pa.list_(pa.int32()))]
)
_DROPS = pa.schema([("row_key", pa.int64()), ("positions", pa.list_(pa.int32()))])


def line_keys(text: str, min_points: int = MIN_POINTS) -> dict[bytes, list[int]]:
    """Positions of each key of the text, by the key's 128-bit hash."""
    found: dict[bytes, list[int]] = {}
    for at, line in enumerate(text.encode().split(b"\n")):
        key = line.strip(SPACE).lower()  # of bytes: A-Z only
        if len(key) >= 4 * min_points or len(key) >= min_points and len(key.decode()) >= min_points:
            found.setdefault(xxhash.xxh3_128_digest(key), []).append(at)
    return found


def _hashed(min_points: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys = longs(batch, "doc_id").tolist(), batch.column("row_key").to_pylist()
            # The batch's first document of a line asks; later ones lose it whatever the rest holds.
            asking: dict[bytes, tuple[int, int, list[int]]] = {}
            lost: dict[int, list[int]] = {}
            same: list[tuple[bytes, int, int, list[int]]] = []
            for n in sorted(range(len(ids)), key=lambda n: ids[n]):
                text = batch.column("text")[n].as_py()
                for mark, positions in line_keys(text, min_points).items():
                    first = asking.get(mark)
                    if first is None:
                        asking[mark] = (ids[n], keys[n], positions)
                    elif first[0] < ids[n]:
                        lost.setdefault(keys[n], []).extend(positions)
                    elif first[1] != keys[n]:
                        same.append((mark, ids[n], keys[n], positions))
            rows = [(mark, *rest) for mark, rest in asking.items()] + same
            for start in range(0, len(rows), OUT_ROWS):
                part = rows[start : start + OUT_ROWS]
                marks = np.frombuffer(b"".join(r[0] for r in part), dtype=">i8").astype(np.int64).reshape(-1, 2)
                yield _lines(False, marks[:, 0], marks[:, 1], [r[1] for r in part], [r[2] for r in part], [r[3] for r in part])
            if lost:
                spread = np.array(list(lost), dtype=np.int64)
                yield _lines(True, spread, spread, [LAST] * len(lost), list(lost), list(lost.values()))

    return run


def _lines(settled, high, low, ids, keys, positions) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(len(keys), settled)),
            pa.array(high, pa.int64()),
            pa.array(low, pa.int64()),
            id_column(ids),
            pa.array(keys, pa.int64()),
            pa.array(positions, pa.list_(pa.int32())),
        ],
        schema=_LINES,
    )


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (hash, document): what follows a line's first document is dropped."""
    last = (None, None, 0)
    for batch in batches:
        if not batch.num_rows:
            continue
        high, low, ids = (longs(batch, c) for c in ("high", "low", "doc_id"))
        settled = batch.column("settled").to_numpy(zero_copy_only=False)
        new = np.ones(len(high), dtype=bool)
        new[1:] = (high[1:] != high[:-1]) | (low[1:] != low[:-1]) | (settled[1:] != settled[:-1])
        new[0] = (high[0], low[0], settled[0]) != last[:3]
        starts = np.maximum.accumulate(np.where(new, np.arange(len(high)), -1))
        first = np.where(starts < 0, last[3] if len(last) > 3 else 0, ids[np.maximum(starts, 0)])
        last = (high[-1], low[-1], settled[-1], first[-1])
        drop = settled | (ids > first)
        yield batch.filter(pa.array(drop)).select(["row_key", "positions"]).cast(_DROPS)


def _bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        maps = [pack_drops(np.concatenate([np.asarray(p) for p in drops])) for drops in batch.column("drops").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("row_key"), pa.array(maps, pa.binary())], names=["row_key", "bitmap"])


def pack_drops(positions: np.ndarray) -> bytes:
    """Keep bitmap up to the last dropped line; lines beyond it stay."""
    keep = np.ones(int(positions.max()) + 1, dtype=bool)
    keep[positions] = False
    return zlib.compress(len(keep).to_bytes(4, "little") + np.packbits(keep).tobytes(), 1)


def unpack_keep(bitmap: bytes | None, n_lines: int) -> np.ndarray:
    keep = np.ones(n_lines, dtype=bool)
    if bitmap:
        data = zlib.decompress(bitmap)
        n = int.from_bytes(data[:4], "little")
        keep[:n] = np.unpackbits(np.frombuffer(data[4:], dtype=np.uint8), count=n)
    return keep


def line_bitmaps(docs: DataFrame, min_points: int = MIN_POINTS) -> DataFrame:
    """(row_key, bitmap) of the documents that lose lines."""
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = identified(docs).mapInArrow(_hashed(min_points), LINES)
    # Equal ranges of the upper 31 bits of the hash.
    part = F.shiftright(F.shiftrightunsigned("high", 33) * F.lit(n), 31).cast("int")
    drops = (
        rows.repartitionById(n, part)
        .sortWithinPartitions("settled", "high", "low", F.col("doc_id").asc_nulls_last(), "row_key")
        .mapInArrow(_stream, "row_key long, positions array<int>")
    )
    return drops.groupBy("row_key").agg(F.collect_list("positions").alias("drops")).mapInArrow(_bitmaps, "row_key long, bitmap binary")


def _applied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for text, bitmap in zip(texts(batch), batch.column("bitmap").to_pylist(), strict=True):
            split = text.split("\n")
            keep = unpack_keep(bitmap, len(split))
            rows.append((len(split), int(len(split) - keep.sum()), "\n".join(x for x, k in zip(split, keep.tolist(), strict=True) if k)))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array([r[0] for r in rows], pa.int64()),
                pa.array([r[1] for r in rows], pa.int64()),
                pa.array([r[2] for r in rows], pa.string()),
            ],
            names=["doc_id", "n_lines", "n_dropped", "kept_text"],
        )


def drop_repeated_lines(docs: DataFrame, min_points: int = MIN_POINTS) -> DataFrame:
    """Every row's doc_id, n_lines, n_dropped and kept_text."""
    joined = identified(docs).join(line_bitmaps(docs, min_points), "row_key", "left").select("doc_id", "text", "bitmap")
    return joined.mapInArrow(_applied, "doc_id long, n_lines long, n_dropped long, kept_text string")


def sha256_hex(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()
