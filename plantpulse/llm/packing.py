"""Token sequences packed by bounded-space online best fit.

Documents become token ids and an end id; only those longer than a sequence are
cut: the first piece takes the remainder, so all further pieces fill a sequence
each. Small rows (document, piece, length) are dealt out by hash, longest first,
and every task packs its share as they come: the bin with the least sufficient
free space takes the piece. Open bins are kept in a bitset by free space, so the
best fit is one shift and one lowest bit. At most OPEN bins are open; then the
fullest closes. Packing tasks share nothing; each may leave a few bins unfilled,
so their number follows the tokens and not the session's partitions alone.

Ids come in units: a space and what follows up to the next. No token of the
vocabulary's splitter reaches across such a border, unless white space stands on
both sides of the space, and units repeat, so a task remembers their ids. Texts
with such places or with the strings of special tokens are encoded whole.

Defined results. Null counts as empty: one piece with the end id alone. Repeated
rows are packed each. An empty table gives an empty result. Sequence ids are
unique, without order or density. The vocabulary is passed as bytes.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from plantpulse.llm.tables import OUT_ROWS, forget, identified, kept, texts

LENGTH = 2048
END = 0
#: Bins open at once in a task; units remembered by a worker, and the longest of them.
OPEN = 1 << 16
CACHED = 300_000
#: Sequences that a packing task should fill at least.
SEQUENCES = 4000
LONGEST = 48
#: Fixed value: how the byte-level vocabulary splits text before merging.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


#: A space between white space.
AMID = re.compile(r" (?<=\s )\s")


class Units:
    """Ids of a text as little-endian unsigned 32-bit numbers."""

    def __init__(self, vocabulary: bytes):
        self.whole = Tokenizer.from_buffer(vocabulary)
        self.special = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        letters = _byte_letters()
        ranks = {
            bytes(letters[c] for c in token): i
            for token, i in json.loads(vocabulary)["model"]["vocab"].items()
            if token not in self.special
        }
        self.ranks = tiktoken.Encoding("units", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
        self.memory: dict[str, bytes] = {}

    def __call__(self, text: str) -> bytes:
        units = text.split(" ")
        # The last unit is empty behind a space at the end.
        if not units[-1] or AMID.search(text) or any(s in text for s in self.special):
            return _packed(self.whole.encode(text, add_special_tokens=False).ids)
        first, rest = units[0], units[1:]
        memory, out = self.memory, [self._ids(first)]
        forget(memory, CACHED)
        for unit in rest:
            ids = memory.get(unit)
            if ids is None:
                ids = self._ids(" " + unit)
                if len(unit) <= LONGEST:
                    memory[unit] = ids
            out.append(ids)
        return b"".join(out)

    def _ids(self, unit: str) -> bytes:
        return _packed(self.ranks.encode_ordinary(unit))


def _packed(ids: list[int]) -> bytes:
    return np.array(ids, dtype="<u4").tobytes()


def _byte_letters() -> dict[str, int]:
    """The letter that byte-level vocabularies write for each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + n): b for n, b in enumerate(hidden)}


@lru_cache(maxsize=1)
def units(vocabulary: bytes) -> Units:
    return Units(vocabulary)


def cut(n_tokens: int, length: int = LENGTH) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces; the first takes the remainder."""
    head = n_tokens % length or min(n_tokens, length)
    return [(0, head)] + [(start, length) for start in range(head, n_tokens, length)]


PIECES = pa.schema(
    [("doc_id", pa.int64()), ("row_key", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
     ("length", pa.int64()), ("ids_crc32", pa.int64())]
)


def pieces(docs: DataFrame, vocabulary: bytes, length: int = LENGTH, end: int = END) -> DataFrame:
    """One row per piece with its place in the document and the checksum of its ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, last = units(vocabulary), _packed([end])
        for batch in batches:
            rows = []
            ids, keys = batch.column("doc_id").to_pylist(), batch.column("row_key").to_pylist()
            for doc, key, text in zip(ids, keys, texts(batch), strict=True):
                data = encode(text) + last
                for n, (start, size) in enumerate(cut(len(data) // 4, length)):
                    rows.append((doc, key, n, start, size, zlib.crc32(data[4 * start : 4 * (start + size)])))
            columns = zip(*rows, strict=True) if rows else [()] * len(PIECES)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, PIECES, strict=True)], schema=PIECES)

    schema = "doc_id long, row_key long, piece int, start long, length long, ids_crc32 long"
    return identified(docs).mapInArrow(run, schema)


class OpenBins:
    """Best fit among a bounded number of open bins."""

    def __init__(self, length: int, most: int):
        self.length, self.most = length, most
        self.free = 0  # bit f: some open bin has f places left
        self.by_free: list[list[int]] = [[] for _ in range(length + 1)]
        self.open = self.started = 0

    def put(self, size: int) -> tuple[int, int]:
        """(bin, offset) for a piece of this size."""
        fitting = self.free >> size
        if fitting:
            left = size + (fitting & -fitting).bit_length() - 1
            number = self._take(left)
        else:
            if self.open == self.most:
                self._take((self.free & -self.free).bit_length() - 1)  # the fullest closes
            left, number = self.length, self.started
            self.started += 1
        if left > size:
            self.by_free[left - size].append(number)
            self.free |= 1 << left - size
            self.open += 1
        return number, self.length - left

    def _take(self, left: int) -> int:
        bins = self.by_free[left]
        number = bins.pop()
        self.open -= 1
        if not bins:
            self.free ^= 1 << left
        return number


def _packed_bins(length: int, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = OpenBins(length, most)
        base = TaskContext.get().partitionId() << 40
        for batch in batches:
            for start in range(0, batch.num_rows, OUT_ROWS):
                part = batch.slice(start, OUT_ROWS)
                places = [bins.put(size) for size in part.column("length").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array([base + b for b, _ in places], pa.int64()), pa.array([o for _, o in places], pa.int64())],
                    names=[*part.schema.names, "sequence_id", "offset"],
                )

    return run


def pack(docs: DataFrame, vocabulary: bytes, length: int = LENGTH, most_open: int = OPEN, end: int = END) -> DataFrame:
    """Every piece with its sequence and its place in it."""
    rows = kept(pieces(docs, vocabulary, length, end))
    schema = "doc_id long, row_key long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    # Every packer leaves some bins unfilled, so each gets enough pieces for that not to count.
    tokens = rows.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    most = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(1, min(most, tokens // (SEQUENCES * length)))
    return (
        rows.repartition(parts, "row_key", "piece")
        .sortWithinPartitions(F.desc("length"), "row_key", "piece")
        .mapInArrow(_packed_bins(length, most_open), schema)
    )
