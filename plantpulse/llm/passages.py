"""Repeated passages removed through fixed-block anchors.

A window of `window` words goes if the same words also start in a document with
a smaller doc_id. Every document is cut into non-overlapping blocks of about half
a window, so each window holds at least one whole block of its own document.

1. Documents are packed into slabs, written once. Copies of a whole document are
   found by a digest; later ones go entirely and take no further part.
2. Index and probe. The hashes of every rolling run of block length in a slab,
   sorted and without repeats, are sent by ranges of the hash as one small
   compressed row per range and slab, with a bit for each that is a block. A
   range is joined at once: a run that equals a block elsewhere is a hit. Back
   goes one bit per hash, so neither texts nor places travel.
3. Extend. A hit tells that block length words agree; the words to its left and
   right decide how far the repeat goes. All windows that hold the hit are
   looked at: blocks offer digests of theirs, runs that hit ask for theirs, and
   an offer from a smaller doc_id answers. Within a slab this is settled before
   the shuffle, so a passage that a third of all documents share sends a row or
   two per slab. Windows that are found and touch make a maximal exact repeat.

Runs that more than CROWD slabs or places hold meet by the digest of a window
instead of the hash of a block, so no group grows with the corpus; what such a
task remembers is one document per window. The hash of step 2 is cut short and
may only let too much through; step 3 decides by 128 bits of hashes.

Defined results. Words are maximal runs of other bytes than white space, kept
as they are; null texts have none. Windows are judged on the input. A null
doc_id comes last; rows that repeat a doc_id do not remove each other's words.
An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantpulse.llm.tables import LAST, id_column, kept, longs, slabs, texts
from plantpulse.llm.words import MIX, SPACES, hashes, joined, mixed, places

WINDOW = 13
#: Bytes of texts in a slab; hashes that a range should hold; slabs or places that make a run crowded.
SLAB = 1 << 21
RANGE = 1 << 20
CROWD = 64
#: Bits of a hash beyond those that number all runs: a false hit is this rare.
SPARE = 8
#: Odd multipliers of the two rolling hashes.
STEPS = (0x9E3779B97F4A7C15, 0xA0761D6478BD642F)

SLABS = "slab long, words long, ids array<long>, sizes array<long>, digests array<binary>, settled array<int>, data binary"
_SLABS = pa.schema(
    [("slab", pa.int64()), ("words", pa.int64()), ("ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())),
     ("digests", pa.list_(pa.binary())), ("settled", pa.list_(pa.int32())), ("data", pa.binary())]
)


def block_words(window: int) -> int:
    """The longest block of which every window holds a whole one."""
    return (window + 1) // 2


def _slabs(window: int, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            data, ids = [t.encode() for t in texts(batch)], longs(batch, "doc_id")
            for low, high in slabs(data, most):
                split = [t.split() for t in data[low:high]]
                # Texts that are too short for a window lose nothing and have no digest.
                digests = [xxhash.xxh3_128_digest(b" ".join(w)) if len(w) >= window else None for w in split]
                # Of copies within a slab only the smallest id asks; the others go for certain.
                own, first = ids[low:high].tolist(), {}
                for i, d in zip(own, digests, strict=True):
                    first[d] = min(first.get(d, i), i)
                settled = [n for n, d in enumerate(digests) if d is not None and own[n] > first[d]]
                for n in settled:
                    digests[n] = None
                row = (number, sum(map(len, split)), own, [len(t) for t in data[low:high]], digests, settled,
                       zstandard.ZstdCompressor(level=3).compress(b"".join(data[low:high])))
                yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(row, _SLABS, strict=True)], schema=_SLABS)
                number += 1

    return run


class Slab:
    """Word places and rolling hashes of a slab's documents."""

    def __init__(self, row: dict, window: int):
        data = zstandard.ZstdDecompressor().decompress(row["data"])
        ends = np.cumsum(row["sizes"])
        self.texts = [data[end - size : end] for end, size in zip(ends.tolist(), row["sizes"], strict=True)]
        self.ids = np.array(row["ids"], dtype=np.int64)
        self.window, self.block = window, block_words(window)
        self.bytes, offsets = joined(self.texts)
        self.starts, self.ends = places(self.bytes, SPACES_OUT)
        #: First word of each document, and the document of each word.
        self.first = np.searchsorted(self.starts, np.append(offsets, len(self.bytes)))
        self.owner = np.repeat(np.arange(len(self.texts)), np.diff(self.first))
        self.within = np.arange(len(self.starts)) - self.first[self.owner]
        self.left = np.diff(self.first)[self.owner] - self.within  # words from here to the document's end

    def rolling(self, length: int, which: int) -> np.ndarray:
        """Hash of the `length` words from each word on; the last words of the slab have none."""
        part = hashes(self.bytes, self.starts, self.ends, which)
        n = max(0, len(part) - length + 1)
        found = np.zeros(n, dtype=np.uint64)
        for k in range(length):
            found *= np.uint64(STEPS[which])
            found += part[k : k + n]
        return mixed(found)

    def runs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(distinct hashes in order, places in their order, where each hash starts among these).

        Only documents that hold a window take part.
        """
        hash_ = self.rolling(self.block, 0)
        n = len(hash_)
        inside = (self.left[:n] >= self.block) & (self.left[:n] + self.within[:n] >= self.window)
        place = np.flatnonzero(inside)
        order = np.argsort(hash_[place], kind="stable")
        place = place[order]
        ordered = hash_[place]
        new = np.ones(len(ordered), dtype=bool)
        new[1:] = ordered[1:] != ordered[:-1]
        first = np.flatnonzero(new)
        return ordered[first], place, first

    def is_block(self, place: np.ndarray) -> np.ndarray:
        return self.within[place] % self.block == 0


SPACES_OUT = ~SPACES


def _bits(words: int, partitions: int) -> tuple[int, int]:
    """Bits of a hash that are compared, and those of them that number its range."""
    range_bits = max(math.ceil(math.log2(max(partitions, 2))), math.ceil(math.log2(max(words / RANGE, 1))))
    return min(64, max(range_bits + 8, words.bit_length() + SPARE)), range_bits


_SENT = pa.schema([("range", pa.int32()), ("slab", pa.int64()), ("number", pa.int32()), ("sent", pa.binary())])
SENT = "range int, slab long, number int, sent binary"


def _pack(values: np.ndarray, *flags: np.ndarray) -> bytes:
    gaps = np.diff(values, prepend=np.uint64(0)).astype("<u8")
    planes = gaps.view(np.uint8).reshape(-1, 8).T.tobytes()
    return zstandard.ZstdCompressor(level=1).compress(planes + b"".join(np.packbits(f).tobytes() for f in flags))


def _unpack(data: bytes, number: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=np.uint8)
    gaps = np.ascontiguousarray(raw[: 8 * number].reshape(8, number).T).view("<u8")[:, 0]
    size = (number + 7) // 8
    block, heavy = (np.unpackbits(raw[8 * number + n * size :][:size], count=number).astype(bool) for n in (0, 1))
    return np.cumsum(gaps, dtype=np.uint64), block, heavy


def _ranges(distinct: np.ndarray, range_bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(range, first, end) of the hashes, given in order, for ranges that have any."""
    own = (distinct >> np.uint64(64 - range_bits)).astype(np.int64)
    new = np.ones(len(own), dtype=bool)
    new[1:] = own[1:] != own[:-1]
    first = np.flatnonzero(new)
    return own[first], first, np.append(first[1:], len(own))


def _probes(window: int, bits: int, range_bits: int, crowd: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n in range(batch.num_rows):
                row = {c: batch.column(c)[n].as_py() for c in ("slab", "ids", "sizes", "data")}
                slab = Slab(row, window)
                distinct, place, first = slab.runs()
                if not len(distinct):
                    continue
                block = np.logical_or.reduceat(slab.is_block(place), first)
                heavy = np.diff(first, append=len(place)) > crowd
                values = (distinct << np.uint64(range_bits)) >> np.uint64(range_bits + 64 - bits)
                out = [
                    (r, row["slab"], e - s, _pack(values[s:e], block[s:e], heavy[s:e]))
                    for r, s, e in zip(*(x.tolist() for x in _ranges(distinct, range_bits)), strict=True)
                ]
                columns = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _SENT, strict=True)], schema=_SENT)

    return run


_HITS = pa.schema([("slab", pa.int64()), ("range", pa.int32()), ("hits", pa.binary())])


def _joined(rows: list[tuple[int, int, bytes]], range_: int, crowd: int) -> pa.RecordBatch | None:
    """Which hashes of (slab, number, sent) equal a block of another slab, and which of those are crowded."""
    parts = [_unpack(sent, number) for _, number, sent in rows]
    values, block, heavy = (np.concatenate(x) for x in zip(*parts, strict=True))
    sizes = np.array([number for _, number, _ in rows])
    order = np.argsort(values, kind="stable")
    ordered = values[order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = ordered[1:] != ordered[:-1]
    first = np.flatnonzero(new)
    held = np.diff(first, append=len(order))
    hit = (held > 1) & np.logical_or.reduceat(block[order], first)
    crowded = hit & ((held > crowd) | np.logical_or.reduceat(heavy[order], first))
    answer = np.zeros((2, len(order)), dtype=bool)
    answer[:, order] = np.repeat(np.stack([hit, crowded]), held, axis=1)
    out, end = [], 0
    for (slab, _, _), size in zip(rows, sizes.tolist(), strict=True):
        own = answer[:, end : end + size]
        end += size
        if own[0].any():
            out.append((slab, range_, zstandard.ZstdCompressor(level=1).compress(np.packbits(own, axis=1).tobytes())))
    if not out:
        return None
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), _HITS, strict=True)], schema=_HITS)


def _hits(crowd: int):
    """Rows come in order of their range; one range is joined at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, []
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("range", "slab", "number", "sent"))
            for range_, slab, number, sent in zip(*columns, strict=True):
                if range_ != last and held:
                    found = _joined(held, last, crowd)
                    if found is not None:
                        yield found
                    held = []
                last = range_
                held.append((slab, number, sent))
        if held:
            found = _joined(held, last, crowd)
            if found is not None:
                yield found

    return run


def _flags(distinct: np.ndarray, marks: list[dict] | None, range_bits: int) -> np.ndarray:
    """[hit, crowded] of the distinct hashes."""
    out = np.zeros((2, len(distinct)), dtype=bool)
    own = {m["range"]: m["hits"] for m in marks or ()}
    for r, s, e in zip(*(x.tolist() for x in _ranges(distinct, range_bits)), strict=True):
        if r in own:
            raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(own[r]), dtype=np.uint8)
            out[:, s:e] = np.unpackbits(raw.reshape(2, -1), axis=1, count=e - s).astype(bool)
    return out


#: place is word << 32 | offered windows << 16 | asked windows; a window is known by its words before the hit.
ASKED = "key long, doc_id long, slab long, place long, digests binary"
_ASKED = pa.schema([("key", pa.int64()), ("doc_id", pa.int64()), ("slab", pa.int64()), ("place", pa.int64()), ("digests", pa.binary())])
#: A document's windows that are settled without a shuffle have this in place of a key.
_COVERED = pa.schema([("slab", pa.int64()), ("place", pa.int64())])


def _occurrences(window: int, range_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n in range(batch.num_rows):
                row = {c: batch.column(c)[n].as_py() for c in ("slab", "ids", "sizes", "settled", "data", "marks", "copies")}
                yield from _slab_occurrences(Slab(row, window), row, range_bits)

    return run


def _slab_occurrences(slab: Slab, row: dict, range_bits: int) -> Iterator[pa.RecordBatch]:
    window, ways = slab.window, slab.window - slab.block + 1
    distinct, place, first = slab.runs()
    if not len(distinct):
        return
    fresh = np.ones(len(slab.texts), dtype=bool)
    fresh[np.array(row["settled"] + (row["copies"] or []), dtype=np.int64)] = False
    held = np.diff(first, append=len(place))
    hit, crowded = np.repeat(_flags(distinct, row["marks"], range_bits), held, axis=1)
    # What other slabs do not hold may still come again here.
    block = slab.is_block(place)
    touched = hit | np.repeat((held > 1) & np.logical_or.reduceat(block, first), held)
    touched &= fresh[slab.owner[place]]
    key = np.repeat(distinct, held)[touched]
    place, block, hit, crowded = place[touched], block[touched], hit[touched], crowded[touched]
    if not len(place):
        return
    # Windows that hold a touched run: [run, words before it].
    start = place[:, None] - np.arange(ways)
    valid = (slab.within[place][:, None] >= np.arange(ways)) & (slab.left[place][:, None] + np.arange(ways) >= window)
    digest = slab.rolling(window, 1)
    windows = np.unique(start[valid])
    if not len(windows):
        return
    marks, doc = digest[windows], np.where(slab.ids[slab.owner[windows]] == LAST, LAST, slab.ids[slab.owner[windows]])
    order = np.lexsort((doc, marks))
    new = np.ones(len(order), dtype=bool)
    new[1:] = marks[order][1:] != marks[order][:-1]
    least = np.repeat(doc[order][new], np.diff(np.flatnonzero(new), append=len(order)))
    settled = np.zeros(len(windows), dtype=bool)
    settled[order] = doc[order] > least
    if settled.any():
        yield _asked(np.zeros(settled.sum(), dtype=np.uint64), doc[settled], row["slab"], windows[settled] << 32, None)
    open_ = np.zeros(len(slab.starts) + 1, dtype=bool)
    open_[windows[~settled]] = True
    # A block offers the windows in which it is the first one; a hit asks for all that are open.
    ours = valid & open_[np.where(valid, start, -1)] & hit[:, None]
    offers = ours & block[:, None] & (np.arange(ways) < slab.block)
    bit = 1 << np.arange(ways)
    some = ours.any(axis=1) & ~crowded
    found = place[some] << 32 | (offers[some] * bit).sum(axis=1) << 16 | (ours[some] * bit).sum(axis=1)
    data = np.where(ours[some], digest[np.where(valid[some], start[some], 0)], np.uint64(0))
    yield _asked(key[some], slab.ids[slab.owner[place[some]]], row["slab"], found, data)
    # Crowded runs: one row for each of their windows.
    wide = ours & crowded[:, None]
    asks = np.unique(start[wide])
    if len(asks):
        offered = np.isin(asks, start[wide & offers])
        found = asks << 32 | offered.astype(np.int64) << 16 | 1
        yield _asked(digest[asks] * np.uint64(MIX), slab.ids[slab.owner[asks]], row["slab"], found, digest[asks][:, None])


def _asked(key, ids, slab: int, place, digests) -> pa.RecordBatch:
    """Rows of one slab; without digests they are settled."""
    n = len(place)
    if digests is None:
        data = pa.nulls(n, pa.binary())
    else:
        digests = np.ascontiguousarray(digests)
        width = 8 * digests.shape[1]
        data = pa.Array.from_buffers(pa.binary(width), n, [None, pa.py_buffer(digests.tobytes())]).cast(pa.binary())
    arrays = [pa.array(key.view(np.int64)), id_column(ids), pa.array(np.full(n, slab)), pa.array(place), data]
    return pa.RecordBatch.from_arrays(arrays, schema=_ASKED)


def _answers(ways: int):
    """Rows come by key and then by document: an offer answers what larger documents ask for."""
    bit = 1 << np.arange(ways)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carried = (np.empty(0, dtype=np.int64), np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64))
        for batch in batches:
            if not batch.num_rows:
                continue
            settled = batch.column("digests").is_null().to_numpy(zero_copy_only=False)
            if settled.any():
                done = batch.filter(pa.array(settled))
                yield pa.RecordBatch.from_arrays([done.column("slab"), pa.array(longs(done, "place") | 1)], schema=_COVERED)
                batch = batch.filter(pa.array(~settled))
                if not batch.num_rows:
                    continue
            key, doc, slab, place = (longs(batch, c) for c in ("key", "doc_id", "slab", "place"))
            digests = np.zeros((len(key), ways), dtype=np.uint64)
            parts = batch.column("digests").to_pylist()
            width = np.array([len(p) for p in parts]) // 8
            for w in np.unique(width).tolist():
                own = np.flatnonzero(width == w)
                digests[own, :w] = np.frombuffer(b"".join(parts[i] for i in own.tolist()), dtype=np.uint64).reshape(-1, w)
            offer, o_way = np.nonzero((place >> 16 & 0xFFFF)[:, None] & bit)
            ask, a_way = np.nonzero((place & 0xFFFF)[:, None] & bit)
            offers = [np.concatenate(x) for x in zip(carried, (key[offer], digests[offer, o_way], doc[offer]), strict=True)]
            # Per key and digest the smallest document that offers.
            order = np.lexsort((offers[2], offers[1], offers[0]))
            offers = [x[order] for x in offers]
            new = np.ones(len(order), dtype=bool)
            new[1:] = (offers[0][1:] != offers[0][:-1]) | (offers[1][1:] != offers[1][:-1])
            offers = [x[new] for x in offers]
            covered = _smaller(offers, key[ask], digests[ask, a_way]) < doc[ask]
            mask = np.zeros(len(key), dtype=np.int64)
            np.add.at(mask, ask[covered], bit[a_way[covered]])
            some = mask > 0
            if some.any():
                yield pa.RecordBatch.from_arrays([pa.array(slab[some]), pa.array(place[some] >> 32 << 32 | mask[some])], schema=_COVERED)
            last = offers[0] == key[-1]
            carried = tuple(x[last] for x in offers)

    return run


def _smaller(offers: list[np.ndarray], key: np.ndarray, digest: np.ndarray) -> np.ndarray:
    """The document offered for each (key, digest); the largest number where there is none."""
    if not len(offers[0]):
        return np.full(len(key), LAST)
    # One number per distinct pair of both sides.
    keys, both = np.concatenate([offers[0], key]), np.concatenate([offers[1], digest])
    order = np.lexsort((both, keys))
    new = np.ones(len(order), dtype=np.int64)
    new[1:] = (keys[order][1:] != keys[order][:-1]) | (both[order][1:] != both[order][:-1])
    number = np.empty(len(order), dtype=np.int64)
    number[order] = np.cumsum(new)
    found = np.full(len(order) + 1, LAST)
    found[number[: len(offers[0])]] = offers[2]
    return found[number[len(offers[0]) :]]


RESULT = "doc_id long, n_words long, n_removed long, spans array<struct<start:long,end:long>>, kept_text string"
_SPAN = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _cut(window: int):
    ways = window - block_words(window) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n in range(batch.num_rows):
                row = {c: batch.column(c)[n].as_py() for c in ("ids", "sizes", "settled", "data", "copies")}
                covered = batch.column("covered")[n]
                data = zstandard.ZstdDecompressor().decompress(row["data"])
                words, end = [], 0
                for size in row["sizes"]:
                    words.append(data[end : end + size].split())
                    end += size
                first = np.cumsum([0, *map(len, words)])
                change = np.zeros(first[-1] + 1, dtype=np.int64)
                if covered.is_valid:
                    place = covered.values.to_numpy(zero_copy_only=False)
                    at, way = np.nonzero((place & 0xFFFF)[:, None] & (1 << np.arange(ways)))
                    start = (place >> 32)[at] - way
                    np.add.at(change, start, 1)
                    np.add.at(change, start + window, -1)
                gone = np.cumsum(change[:-1]) > 0
                for copy in row["settled"] + (row["copies"] or []):
                    gone[first[copy] : first[copy + 1]] = True
                out = []
                for d, own in enumerate(words):
                    mask = gone[first[d] : first[d + 1]]
                    edges = np.flatnonzero(np.diff(np.concatenate([[False], mask, [False]]).astype(np.int8)))
                    spans = [{"start": s, "end": e} for s, e in edges.reshape(-1, 2).tolist()]
                    out.append((len(own), int(mask.sum()), spans, b" ".join(compress(own, ~mask)).decode()))
                columns = list(zip(*out, strict=True))
                kinds = [pa.int64(), pa.int64(), _SPAN, pa.string()]
                yield pa.RecordBatch.from_arrays(
                    [id_column(row["ids"]), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))],
                    names=["doc_id", "n_words", "n_removed", "spans", "kept_text"],
                )

    return run


def drop_passages(docs: DataFrame, window: int = WINDOW, slab: int = SLAB, crowd: int = CROWD) -> DataFrame:
    """Every row's doc_id, n_words, n_removed, spans (removed word ranges) and kept_text."""
    ways = window - block_words(window) + 1
    if not 1 < window or ways > 16:
        raise ValueError("window must have 2 to 31 words")
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    table = kept(rows.mapInArrow(_slabs(window, slab), SLABS))
    bits, range_bits = _bits(table.agg(F.coalesce(F.sum("words"), F.lit(0))).first()[0], partitions)

    rows = table.select("slab", F.posexplode(F.arrays_zip("ids", "digests")).alias("at", "x")).select("slab", "at", "x.ids", "x.digests")
    rows = rows.filter("digests is not null")
    originals = rows.groupBy("digests").agg(F.min("ids").alias("first"), F.count("*").alias("rows")).filter("rows > 1")
    copies = kept(rows.join(originals, "digests").filter(F.col("ids") > F.col("first")).groupBy("slab").agg(F.collect_list("at").alias("copies")))

    part = F.shiftright(F.col("range").cast("long") * F.lit(partitions), range_bits).cast("int")
    texts_only = table.select("slab", "ids", "sizes", "settled", "data")
    hits = (
        texts_only.mapInArrow(_probes(window, bits, range_bits, crowd), SENT)
        .repartitionById(partitions, part)
        .sortWithinPartitions("range")
        .mapInArrow(_hits(crowd), "slab long, range int, hits binary")
    )
    marks = kept(hits.groupBy("slab").agg(F.collect_list(F.struct("range", "hits")).alias("marks")))

    marked = texts_only.join(marks, "slab", "left").join(copies, "slab", "left")
    answers = (
        marked.mapInArrow(_occurrences(window, range_bits), ASKED)
        .repartition(partitions, F.when(F.col("digests").isNull(), F.xxhash64("slab", "place")).otherwise(F.xxhash64("key")))
        .sortWithinPartitions("key", F.col("doc_id").asc_nulls_last())
        .mapInArrow(_answers(ways), "slab long, place long")
    )
    covered = kept(answers.groupBy("slab").agg(F.collect_list("place").alias("covered")))
    return texts_only.join(covered, "slab", "left").join(copies, "slab", "left").mapInArrow(_cut(window), RESULT)
