"""Repeated byte strings removed by ranks of their windows, first copies kept.

A byte goes if it lies in a string of `least` bytes that also starts earlier: in
a smaller doc_id, or in the same document before. Position i of the corpus has
such a string if the window of `least` bytes there equals an earlier one. That is
all the answer needs, so no longest-previous-factor array and no match lengths
are computed: windows of equal rank, digest or bytes are grouped. The suffixes of a whole corpus meet in no single task; they are brought
together by content:

1. Every window of `least` bytes names an anchor, the smallest hash among the
   grams inside it. Equal windows have equal anchors at the same distance, and
   neighbouring windows mostly share theirs, so there is one small row per run
   of about 35 windows.
2. Anchors are sorted by hash and streamed; those found only once cannot belong
   to a repeated window. A slab of documents settles beforehand what repeats
   within it, so an anchor with a third of all rows sends one row per slab.
3. The text around the anchors left over goes to the task of its hash, once per
   slab for equal text: later copies in the slab are removed for certain. So are
   later equal texts there.
4. Where different texts surround an anchor, the suffixes of a block of them are
   ranked to a depth of `least` bytes by doubling, ties by position. All but the
   first position of a rank are repeats.
   An anchor with more text than CROWD bytes is settled by digests of its
   windows instead, as an aggregate with map-side combine.

Texts are shuffled by row twice, compressed: to cut out what stands around
anchors, and to remove spans.

Defined results. Texts are UTF-8 bytes, null counts as empty, matches do not
cross documents. A null doc_id comes last; documents that repeat the id are
ordered by their hash, and rows that repeat id and text are one document and get
the same answer each. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plantpulse.llm.tables import LAST, fresh, id_column, identified, kept, longs, row_key, slabs, texts

LEAST = 100
GRAM = 20
#: Bytes hashed at once and window starts of a piece of a long document, so that
#: the arrays stay in a processor's cache; bytes that settle their own repeats.
HASHED = 1 << 16
PIECE = 1 << 16
SLAB = 1 << 22
#: Bytes of snippets whose suffixes are ordered together, and of a crowded anchor.
BLOCK = 1 << 20
CROWD = 1 << 23
#: Odd multipliers of the rolling hash.
BASE = 0x9E3779B97F4A7C15
MIX = 0xD6E8FEB86659FD93
WRAP = 1 << 64

SINGLE, PROBE, SETTLED = 0, 1, 2
_PLACE = np.uint64((1 << 22) - 1)  # low bits of a hash that hold its position in a slab


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hashes of the GRAM bytes from each position on, put together from powers of two."""
    part, size = (data.astype(np.uint64) + np.uint64(1)) * np.uint64(MIX), 1
    found, done = None, 0
    while True:
        if GRAM & size:
            n = len(data) - (done + size) + 1
            shifted = part[done : done + n]
            found = shifted.copy() if found is None else found[:n] * np.uint64(pow(BASE, size, WRAP)) + shifted
            done += size
        if done == GRAM:
            break
        part = part[:-size] * np.uint64(pow(BASE, size, WRAP)) + part[size:]
        size *= 2
    found ^= found >> np.uint64(32)
    found *= np.uint64(MIX)
    found ^= found >> np.uint64(29)
    return found


def window_runs(data: np.ndarray, offsets: np.ndarray, sizes: np.ndarray, least: int):
    """Runs of windows with one anchor: (hash, first window, number, anchor's distance).

    `data` holds several texts of these offsets and sizes; windows stay inside.
    """
    none = np.empty(0, dtype=np.int64)
    if len(data) < least:
        return none, none, none, none
    hashes = gram_hashes(data)
    # Smallest hash first, the rightmost of equals: the position is stored in the low bits.
    least_hash = hashes & ~_PLACE | _PLACE - np.arange(len(hashes), dtype=np.uint64)
    width, size = least - GRAM + 1, 1
    while size * 2 <= width:
        least_hash = np.minimum(least_hash[:-size], least_hash[size:])
        size *= 2
    if size < width:
        least_hash = np.minimum(least_hash[: len(least_hash) - (width - size)], least_hash[width - size :])
    anchor = (_PLACE - (least_hash & _PLACE)).astype(np.int64)
    inside = np.zeros(len(anchor) + 1, dtype=np.int32)
    long = sizes >= least
    np.add.at(inside, offsets[long], 1)
    np.add.at(inside, offsets[long] + sizes[long] - least + 1, -1)
    valid = np.cumsum(inside[:-1]) > 0
    first = valid.copy()
    first[1:] &= ~valid[:-1] | (anchor[1:] != anchor[:-1])
    starts = np.flatnonzero(first)
    ends = valid.copy()
    ends[:-1] &= ~valid[1:] | first[1:]
    return hashes[anchor[starts]].view(np.int64), starts, np.flatnonzero(ends) - starts + 1, anchor[starts] - starts


def _anchors(least: int):
    schema = pa.schema([("hash", pa.int64()), ("row_key", pa.int64()), ("place", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = longs(batch, "row_key")
            parts, owners, bases = [], [], []
            for n, text in enumerate(texts(batch)):
                data = text.encode()
                if len(data) >= least:
                    for base in range(0, len(data) - least + 1, PIECE):
                        parts.append(data[base : base + PIECE + least - 1])
                        owners.append(n)
                        bases.append(base)
            for low, high in slabs(parts, SLAB):
                found = []
                for first, last in slabs(parts[low:high], HASHED):
                    first, last = low + first, low + last
                    sizes = np.array([len(p) for p in parts[first:last]])
                    offsets = np.cumsum(sizes) - sizes
                    data = np.frombuffer(b"".join(parts[first:last]), dtype=np.uint8)
                    hashes, starts, counts, distance = window_runs(data, offsets, sizes, least)
                    which = np.searchsorted(offsets, starts, "right") - 1
                    start = starts - offsets[which] + np.array(bases[first:last])[which]
                    row = keys[np.array(owners[first:last])[which]]
                    found.append((hashes, row, start << 24 | counts << 16 | distance << 8))
                hashes, row, place = map(np.concatenate, zip(*found, strict=True))
                order = np.argsort(hashes, kind="stable")
                hashes, row, place = hashes[order], row[order], place[order]
                again = np.zeros(len(hashes), dtype=bool)
                again[1:] = hashes[1:] == hashes[:-1]
                state = np.zeros(len(hashes), dtype=np.int64)
                state[:-1][again[1:]] = PROBE
                state[again] = SETTLED
                yield pa.RecordBatch.from_arrays([pa.array(hashes), pa.array(row), pa.array(place | state)], schema=schema)

    return run


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Out of rows sorted by hash those whose hash comes again or is known to."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = batch if held is None else pa.concat_batches([held, batch])
        hashes, place = longs(table, "hash"), longs(table, "place")
        keep = place & 0xFF > SINGLE
        same = hashes[1:] == hashes[:-1]
        keep[1:] |= same
        keep[:-1] |= same
        # The last row waits for its neighbour; it is told whether it has one on this side.
        if keep[-1]:
            place = place.copy()
            place[-1] |= PROBE if place[-1] & 0xFF == SINGLE else 0
        held = pa.RecordBatch.from_arrays(
            [table.column("hash")[-1:], table.column("row_key")[-1:], pa.array(place[-1:])], names=table.schema.names
        )
        yield table.slice(0, table.num_rows - 1).filter(pa.array(keep[:-1]))
    if held is not None and held.column("place")[0].as_py() & 0xFF > SINGLE:
        yield held


_SNIPPETS = pa.schema(
    [("hash", pa.int64()), ("doc_id", pa.int64()), ("row_key", pa.int64()), ("start", pa.int64()), ("end", pa.int64()),
     ("snippet", pa.binary())]
)
SNIPPETS = "hash long, doc_id long, row_key long, start long, end long, snippet binary"


def _snippets(least: int, key: str, found_in: str):
    """Text of the runs of windows; equal text of later documents is settled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys = longs(batch, "doc_id").tolist(), longs(batch, key).tolist()
            data = [x or b"" for x in _data(batch)]
            marks = batch.column(found_in)
            for low, high in slabs(data, 2 * SLAB):
                seen: dict[bytes, tuple[int, int]] = {}
                rows = []
                for n in sorted(range(low, high), key=lambda n: (ids[n], keys[n])):
                    hashes, places = (marks[n].values.field(f).to_numpy() for f in ("hash", "place"))
                    order = np.argsort(places, kind="stable")
                    span = None  # settled runs that touch make one
                    for h, place in zip(hashes[order].tolist(), places[order].tolist(), strict=True):
                        start = place >> 24
                        end = start + (place >> 16 & 0xFF) + least - 1
                        snippet = data[n][start:end]
                        here = (keys[n], start)
                        first = seen.setdefault(snippet, here)
                        if first is here:
                            rows.append((h, ids[n], keys[n], start, end, snippet))
                        elif first != here:
                            if span and start <= span[4]:
                                span[4] = max(end, span[4])
                            else:
                                span = [keys[n], ids[n], keys[n], start, end, None]
                                rows.append(span)
                if rows:
                    columns = list(zip(*rows, strict=True))
                    arrays = [pa.array(c, f.type) for c, f in zip(columns, _SNIPPETS, strict=True)]
                    arrays[1] = id_column(arrays[1])
                    yield pa.RecordBatch.from_arrays(arrays, schema=_SNIPPETS)

    return run


def suffix_ranks(data: np.ndarray, depth: int) -> np.ndarray:
    """A number for each position by the order of its `depth` bytes, by doubling from five."""
    bits, size = max(1, (len(data) - 1).bit_length()), 5
    padded = np.concatenate([data, np.zeros(size, dtype=np.uint8)]).astype(np.uint64)
    words = np.zeros(len(data), dtype=np.uint64)
    for n in range(size):
        words = words << np.uint64(8) | padded[n : n + len(data)]
    ranks = _dense(words, bits)
    while size < depth:
        step = min(size, depth - size)
        behind = np.zeros(len(ranks), dtype=np.uint64)
        behind[:-step] = ranks[step:]
        ranks = _dense(ranks << np.uint64(bits) | behind, bits)
        size += step
    return ranks


def _dense(values: np.ndarray, bits: int) -> np.ndarray:
    """Ranks of the values; where value and position fit one number, that is sorted in place of an order."""
    if 3 * bits <= 64:
        ordered = np.sort(values << np.uint64(bits) | np.arange(len(values), dtype=np.uint64))
        order = (ordered & np.uint64((1 << bits) - 1)).astype(np.int64)
        ordered >>= np.uint64(bits)
    else:
        order = np.argsort(values)
        ordered = values[order]
    new = np.empty(len(values), dtype=np.uint64)
    new[:1] = 0
    new[1:] = ordered[1:] != ordered[:-1]
    ranks = np.empty(len(values), dtype=np.uint64)
    ranks[order] = np.cumsum(new, dtype=np.uint64)
    return ranks


def repeats(snippets: list[bytes], least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, window, is a repeat) for the windows of snippets given in document order."""
    sizes = np.array([len(s) for s in snippets])
    counts = sizes - least + 1
    row = np.repeat(np.arange(len(snippets)), counts)
    window = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
    ranks = suffix_ranks(np.frombuffer(b"".join(snippets), dtype=np.uint8), least)[(np.cumsum(sizes) - sizes)[row] + window]
    order = np.argsort(ranks, kind="stable")  # suffix order to this depth, then by position
    repeat = np.zeros(len(row), dtype=bool)
    repeat[order[1:]] = ranks[order[1:]] == ranks[order[:-1]]
    return row, window, repeat


_SPANS = pa.schema(
    [("crowded", pa.bool_()), ("doc_id", pa.int64()), ("row_key", pa.int64()), ("start", pa.int64()), ("end", pa.int64()),
     ("high", pa.int64()), ("low", pa.int64())]
)
SPANS = "crowded boolean, doc_id long, row_key long, start long, end long, high long, low long"


def _spans(crowded, ids, keys, starts, ends, high=None, low=None) -> pa.RecordBatch:
    n = len(keys)
    arrays = [
        pa.array(np.full(n, crowded)), id_column(ids), pa.array(keys, pa.int64()), pa.array(starts, pa.int64()), pa.array(ends, pa.int64()),
        *(pa.nulls(n, pa.int64()) if x is None else pa.array(x) for x in (high, low)),
    ]
    return pa.RecordBatch.from_arrays(arrays, schema=_SPANS)


def _block(rows: list[tuple], least: int) -> pa.RecordBatch:
    """Spans of the repeats among (doc_id, row_key, start, snippet)."""
    rows = sorted(rows)
    row, window, repeat = repeats([r[3] for r in rows], least)
    row, window = row[repeat], window[repeat]
    new = np.ones(len(row), dtype=bool)
    new[1:] = (row[1:] != row[:-1]) | (window[1:] != window[:-1] + 1)
    starts = np.flatnonzero(new)
    ends = np.append(starts[1:], len(row)) - 1 if len(row) else starts
    keys, begin = np.array([r[1] for r in rows]), np.array([r[2] for r in rows])
    of = row[starts]
    return _spans(False, np.full(len(of), LAST), keys[of], begin[of] + window[starts], begin[of] + window[ends] + least)


def _windows(group: dict[bytes, tuple], least: int) -> pa.RecordBatch:
    """Digests of all windows of a crowded anchor."""
    found = [
        (r[0], r[1], r[2] + n, xxhash.xxh3_128_digest(r[3][n : n + least]))
        for r in group.values()
        for n in range(len(r[3]) - least + 1)
    ]
    digests = np.frombuffer(b"".join(f[3] for f in found), dtype=">i8").astype(np.int64).reshape(-1, 2)
    starts = np.array([f[2] for f in found])
    return _spans(True, [f[0] for f in found], [f[1] for f in found], starts, starts + least, digests[:, 0], digests[:, 1])


def _factors(least: int, block: int, crowd: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple] = []  # rows of anchors with different text around them
        group: dict[bytes, tuple] = {}  # of one anchor, by text
        last, held, size, crowded = None, 0, 0, False
        for batch in batches:
            hashes, ids, keys, starts, ends = (longs(batch, c) for c in ("hash", "doc_id", "row_key", "start", "end"))
            settled = batch.column("snippet").is_null().to_numpy(zero_copy_only=False)
            if settled.any():
                yield _spans(False, np.full(settled.sum(), LAST), keys[settled], starts[settled], ends[settled])
            rest = batch.filter(pa.array(~settled))
            rows = zip(*(x[~settled].tolist() for x in (ids, keys, starts)), rest.column("snippet").to_pylist(), strict=True)
            copies = []
            for mark, row in zip(hashes[~settled].tolist(), rows, strict=True):
                if mark != last:
                    if crowded:
                        yield _windows(group, least)
                    elif len(group) > 1:
                        waiting += group.values()
                        held += size
                    if held >= block:
                        yield _block(waiting, least)
                        waiting, held = [], 0
                    last, group, size, crowded = mark, {}, 0, False
                first = group.setdefault(row[3], row)
                if first is row:
                    size += len(row[3])
                    if size > crowd:
                        crowded = True
                        yield _windows(group, least)
                        group, size = {}, 0
                elif first[1:3] != row[1:3]:
                    copies.append((row[1], row[2], row[2] + len(row[3])))  # rows come in document order
            if copies:
                copied = np.array(copies, dtype=np.int64)
                yield _spans(False, np.full(len(copied), LAST), copied[:, 0], copied[:, 1], copied[:, 2])
        if crowded:
            yield _windows(group, least)
        elif len(group) > 1:
            waiting += group.values()
        if waiting:
            yield _block(waiting, least)

    return run


def _squeezed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    squeeze = zstandard.ZstdCompressor(level=3).compress
    for batch in batches:
        at = batch.schema.get_field_index("text")
        small = pa.array([None if t is None else squeeze(t.encode()) for t in batch.column("text").to_pylist()], pa.binary())
        yield batch.set_column(at, "text", small)


def _data(batch: pa.RecordBatch) -> list[bytes | None]:
    """The bytes of squeezed texts."""
    spread = zstandard.ZstdDecompressor().decompress
    return [None if t is None else spread(t) for t in batch.column("text").to_pylist()]


def _keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """All columns and the row key, text as compressed bytes."""
    key = fresh(docs, "row_key")
    keyed = docs.withColumn(key, row_key())
    schema = T.StructType([T.StructField("text", T.BinaryType()) if f.name == "text" else f for f in keyed.schema])
    return keyed.mapInArrow(_squeezed, schema), key


def repeated_spans(docs: DataFrame, least: int = LEAST, block: int = BLOCK, crowd: int = CROWD) -> DataFrame:
    """(row_key, spans): byte ranges to remove, of the documents that have any."""
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    anchors = identified(docs).mapInArrow(_anchors(least), "hash long, row_key long, place long")
    # Anchors are the smallest hashes of their windows, so they are hashed again before they are dealt out.
    settled = F.col("place").bitwiseAND(F.lit(0xFF)) == SETTLED
    repeated = (
        anchors.repartition(n, F.when(settled, F.xxhash64("row_key", "place")).otherwise(F.xxhash64("hash")))
        .sortWithinPartitions("hash")
        .mapInArrow(_repeated, "hash long, row_key long, place long")
    )
    marks = repeated.groupBy("row_key").agg(F.collect_list(F.struct("hash", "place")).alias("marks"))
    keyed, key = _keyed(docs)
    found_in = fresh(keyed, "marks")
    marked = keyed.join(marks.select(F.col("row_key").alias(key), F.col("marks").alias(found_in)), key)
    snippets = marked.mapInArrow(_snippets(least, key, found_in), SNIPPETS)
    # Written once: three steps read it, and what led to it can be cleared away.
    found = kept(
        snippets.repartition(n, "hash")
        .sortWithinPartitions("hash", F.col("doc_id").asc_nulls_last(), "row_key", "start")
        .mapInArrow(_factors(least, block, crowd), SPANS)
    )
    windows = found.filter("crowded").withColumn("order", F.struct(F.col("doc_id").isNull(), "doc_id", "row_key", "start"))
    first = windows.groupBy("high", "low").agg(F.min("order").alias("first"))
    late = windows.join(first, ["high", "low"]).filter(F.col("order") > F.col("first"))
    spans = found.filter("not crowded").select("row_key", "start", "end").union(late.select("row_key", "start", "end"))
    return spans.groupBy("row_key").agg(F.collect_list(F.struct("start", "end")).alias("spans"))


def cut(data: bytes, spans: list[tuple[int, int]]) -> tuple[bytes, int]:
    """The bytes outside the spans, and the number of maximal removed runs."""
    rest, runs, at = [], 0, 0
    for start, end in sorted(spans):
        if start > at or not runs:
            rest.append(data[at:start])
            runs += 1
        at = max(at, end)
    rest.append(data[at:])
    return b"".join(rest), runs


def _ranges(spans: pa.Scalar) -> list[tuple[int, int]]:
    if not spans.is_valid:
        return []
    return list(zip(*(spans.values.field(f).to_pylist() for f in ("start", "end")), strict=True))


def _cut(key: str, found_in: str):
    schema = pa.schema(
        [("doc_id", pa.int64()), ("row_key", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()),
         ("n_spans", pa.int64()), ("kept_bytes", pa.binary())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, spans in zip(_data(batch), batch.column(found_in), strict=True):
                data = text or b""
                rest, runs = cut(data, _ranges(spans))
                rows.append((len(data), len(data) - len(rest), runs, rest))
            columns = list(zip(*rows, strict=True)) or [()] * 4
            arrays = [pa.array(c, f.type) for c, f in zip(columns, list(schema)[2:], strict=True)]
            ids = batch.column("doc_id").cast(pa.int64())
            yield pa.RecordBatch.from_arrays([ids, batch.column(key), *arrays], schema=schema)

    return run


def _replaced(names: list[str], found_in: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rest = [
                # A character that lost some of its bytes goes with them.
                None if data is None else cut(data, _ranges(spans))[0].decode(errors="ignore")
                for data, spans in zip(_data(batch), batch.column(found_in), strict=True)
            ]
            columns = {name: batch.column(name) for name in names} | {"text": pa.array(rest, pa.string())}
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=names)

    return run


def _with_spans(docs: DataFrame, least: int, block: int, crowd: int) -> tuple[DataFrame, str, str]:
    keyed, key = _keyed(docs)
    found_in = fresh(keyed, "spans")
    spans = repeated_spans(docs, least, block, crowd).select(F.col("row_key").alias(key), F.col("spans").alias(found_in))
    return keyed.join(spans, key, "left"), key, found_in


def drop_repeats(docs: DataFrame, least: int = LEAST, block: int = BLOCK, crowd: int = CROWD) -> DataFrame:
    """Every row's doc_id, row_key, n_bytes, n_removed, n_spans and kept_bytes."""
    joined, key, found_in = _with_spans(docs.select("doc_id", "text"), least, block, crowd)
    schema = "doc_id long, row_key long, n_bytes long, n_removed long, n_spans long, kept_bytes binary"
    return joined.mapInArrow(_cut(key, found_in), schema)


def without_repeats(docs: DataFrame, least: int = LEAST, block: int = BLOCK, crowd: int = CROWD) -> DataFrame:
    """The rows and columns of docs, the repeats cut out of text."""
    joined, _, found_in = _with_spans(docs, least, block, crowd)
    return joined.mapInArrow(_replaced(docs.columns, found_in), docs.schema)
