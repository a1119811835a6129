"""Ranked lexical search by hashed max-sketches.

Index. Every document has one sketch: its terms are hashed to coordinates and a
coordinate keeps the largest frequency of the terms that fall on it. What a term
adds to a score, its impact, grows with the frequency while the rest of the
formula belongs to the document, so a maximum of frequencies is a maximum of
impacts, and the sketch need not be rebuilt when the corpus grows. A sketch has
eight or more coordinates for each distinct term, so it is as loose for a long
document as for a short one. Next to the sketches lie counts of documents per
term. Both are written in one pass over the texts.

Search. Queries come in blocks of bounded size. Looking up the coordinates of a
query's terms in a sketch bounds the score from above: a term is at most as
frequent as its coordinate says. The documents with the highest bounds of each
query are scored exactly; the tenth of those scores is a threshold that the
answer cannot fall below. Then every document whose bound reaches the threshold
is scored exactly, from its text. There is no limit on how many those are.

Scores are whole numbers, as stated in `impact` and `weight`.

Defined results. Terms are runs of letters, digits and characters beyond ASCII,
A-Z lower-cased; null texts have none. Every row is a document of its own, also
if it repeats another; a null doc_id comes after all others among equal scores.
Every row of the queries is answered, null ids included; a query without known
terms has no result. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plantpulse.llm.tables import id_column, kept, longs, slabs, texts
from plantpulse.llm.words import hashes, joined, places

TOP = 10
#: Documents scored first for each query, and coordinates for each distinct term.
FIRST = 16
WIDTH = 8
#: Bytes of texts that are cut into words together, cells of sketches looked at together.
SLAB = 1 << 20
CELLS = 1 << 21
#: Bytes of query texts in a block.
BLOCK = 1 << 18
#: A sketch's largest frequency stands for all above; impacts stay below the limit.
MOST, LIMIT = 255, 1_000_000

TERM = np.zeros(256, dtype=bool)
TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def length_factor(n: int, documents: int, terms: int) -> int:
    return 100 - 75 + (75 * n * documents) // terms


def impact(tf, m):
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def cut(parts: list[bytes], both: bool = False):
    """(number of the text, hash[, other hash]) of every term of the texts."""
    data, offsets = joined(parts)
    data = LOWER[data]
    starts, ends = places(data, TERM)
    owner = np.searchsorted(offsets, starts, "right") - 1
    first = hashes(data, starts, ends)
    return (owner, first, hashes(data, starts, ends, 1)) if both else (owner, first)


def runs(*keys: np.ndarray) -> np.ndarray:
    """Starts of the runs of equal keys."""
    new = np.ones(len(keys[0]), dtype=bool)
    if len(new):
        new[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
    return np.flatnonzero(new)


def bits_of(distinct: int) -> int:
    return max(6, (WIDTH * distinct - 1).bit_length())


def sketch(terms: np.ndarray, tf: np.ndarray, bits: int) -> bytes:
    """Coordinates in order as gaps, byte plane by byte plane, then the largest frequency of each."""
    at = terms >> np.uint64(64 - bits)
    order = np.argsort(at, kind="stable")
    at, tf = at[order], np.minimum(tf[order], MOST)
    first = runs(at)
    gaps = np.diff(at[first], prepend=np.uint64(0)).astype("<u4")
    most = np.maximum.reduceat(tf, first).astype(np.uint8)
    return zstandard.ZstdCompressor(level=1).compress(gaps.view(np.uint8).reshape(-1, 4).T.tobytes() + most.tobytes())


def unfolded(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Coordinates and frequencies of a sketch."""
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=np.uint8).reshape(5, -1)
    gaps = np.ascontiguousarray(planes[:4].T).view("<u4")[:, 0]
    return np.cumsum(gaps, dtype=np.int64), planes[4]


INDEX = "doc_id long, high long, low long, n long, bits int, sketch binary, terms array<long>, holding array<long>"
_INDEX = pa.schema(
    [("doc_id", pa.int64()), ("high", pa.int64()), ("low", pa.int64()), ("n", pa.int64()), ("bits", pa.int32()),
     ("sketch", pa.binary()), ("terms", pa.list_(pa.int64())), ("holding", pa.list_(pa.int64()))]
)


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per document that has terms, and per slab one row of documents per term."""
    for batch in batches:
        data = [t.encode() for t in texts(batch)]
        for low, high in slabs(data, SLAB):
            owner, terms = cut(data[low:high])
            if not len(terms):
                continue
            order = np.lexsort((terms, owner))
            owner, terms = owner[order], terms[order]
            first = runs(owner, terms)
            tf = np.diff(first, append=len(terms))
            owner, terms = owner[first], terms[first]
            starts = runs(owner)
            ends = np.append(starts[1:], len(owner))
            n = np.add.reduceat(tf, starts)
            bits = [bits_of(e - s) for s, e in zip(starts.tolist(), ends.tolist(), strict=True)]
            found = [sketch(terms[s:e], tf[s:e], b) for s, e, b in zip(starts, ends, bits, strict=True)]
            spread = np.sort(terms)
            at = runs(spread)
            rows = batch.take(pa.array(low + owner[starts]))
            none = pa.nulls(len(found), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), rows.column("high"), rows.column("low"), pa.array(n), pa.array(bits, pa.int32()), pa.array(found, pa.binary()), none, none],
                schema=_INDEX,
            )
            counts = [pa.array([x], pa.list_(pa.int64())) for x in (spread[at].view(np.int64), np.diff(at, append=len(spread)))]
            yield pa.RecordBatch.from_arrays([*(pa.nulls(1, f.type) for f in list(_INDEX)[:6]), *counts], schema=_INDEX)


def _identified(docs: DataFrame) -> DataFrame:
    """doc_id, text and 128 bits that know the row by both."""
    id_, text = F.col("doc_id").cast("long"), F.coalesce(F.col("text"), F.lit(""))
    return docs.select(id_.alias("doc_id"), text.alias("text"), F.xxhash64(id_, text).alias("high"), F.xxhash64(text, id_, F.lit(1)).alias("low"))


@dataclass(frozen=True)
class Index:
    sketches: DataFrame  # doc_id, high, low, n, bits, sketch
    holding: DataFrame  # term, holding: documents per term
    documents: int
    terms: int


def build_index(docs: DataFrame) -> Index:
    """Sketches of all documents with terms and the counts that weights need."""
    written = kept(_identified(docs).mapInArrow(_sketched, INDEX))
    sketches = written.filter("sketch is not null").select("doc_id", "high", "low", "n", "bits", "sketch")
    counts = written.filter("sketch is null").select(F.explode(F.arrays_zip("terms", "holding")).alias("x"))
    holding = kept(counts.groupBy(F.col("x.terms").alias("term")).agg(F.sum("x.holding").alias("holding")))
    documents, terms = sketches.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    return Index(sketches, holding, documents, terms)


@dataclass(frozen=True)
class Block:
    """A bounded block of queries: distinct terms in hash order, and per query its terms and weights."""

    documents: int
    total: int
    term: np.ndarray
    other: np.ndarray
    at: tuple[np.ndarray, ...]
    weights: tuple[np.ndarray, ...]

    def factors(self, n: np.ndarray) -> np.ndarray:
        found = {x: min(length_factor(x, self.documents, self.total), 1 << 50) for x in np.unique(n).tolist()}
        return np.array([found[x] for x in n.tolist()], dtype=np.int64)


def _block(index: Index, queries: list[str]) -> Block:
    owner, first, second = cut([q.encode() for q in queries], both=True)
    term, where = np.unique(first, return_index=True)
    spark = index.holding.sparkSession
    asked = spark.createDataFrame(pa.table({"term": pa.array(term.view(np.int64))}))
    known = {r.term: r.holding for r in index.holding.join(asked, "term").collect()}
    weights = np.array([weight(index.documents, known[t]) if t in known else 0 for t in term.view(np.int64).tolist()], dtype=np.int64)
    place = np.searchsorted(term, first)
    at, own = [], []
    for q in range(len(queries)):
        mine, times = np.unique(place[owner == q], return_counts=True)
        used = weights[mine] > 0
        at.append(mine[used])
        own.append((weights[mine] * times)[used])
    return Block(index.documents, index.terms, term, second[where], tuple(at), tuple(own))


def bounds(block: Block, n: np.ndarray, bits: int, sketches: list[bytes]) -> np.ndarray:
    """[query, document] upper bounds of the scores of documents with equally wide sketches."""
    cells = np.zeros((1 << bits, len(sketches)))
    factors = block.factors(n)
    for d, data in enumerate(sketches):
        at, tf = unfolded(data)
        cells[at, d] = np.where(tf == MOST, LIMIT, impact(tf.astype(np.int64), factors[d]))
    place = (block.term >> np.uint64(64 - bits)).astype(np.int64)
    return np.stack([w.astype(np.float64) @ cells[place[at]] for at, w in zip(block.at, block.weights, strict=True)])


def _bounded(block: Block, batches: Iterator[pa.RecordBatch]):
    """(rows of a batch, their bounds), in groups of sketches of one width."""
    for batch in batches:
        n, bits = longs(batch, "n"), batch.column("bits").to_numpy()
        for width in np.unique(bits).tolist():
            rows = np.flatnonzero(bits == width)
            step = max(1, CELLS >> width)
            for start in range(0, len(rows), step):
                part = rows[start : start + step]
                data = batch.column("sketch").take(pa.array(part)).to_pylist()
                yield batch.take(pa.array(part)), bounds(block, n[part], width, data)


CANDIDATES = "query int, high long, low long, bound double"
_CANDIDATES = pa.schema([("query", pa.int32()), ("high", pa.int64()), ("low", pa.int64()), ("bound", pa.float64())])


def _candidates(query, high, low, bound) -> pa.RecordBatch:
    arrays = [pa.array(x, f.type) for x, f in zip((query, high, low, bound), _CANDIDATES, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=_CANDIDATES)


def _highest(block: Block, most: int):
    """Per task and query the documents with the highest bounds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = np.empty((len(block.at), 0))
        keys = np.empty((2, len(block.at), 0), dtype=np.int64)
        for rows, found in _bounded(block, batches):
            own = np.broadcast_to(np.stack([longs(rows, "high"), longs(rows, "low")])[:, None, :], (2, *found.shape))
            best, keys = np.concatenate([best, found], axis=1), np.concatenate([keys, own], axis=2)
            if best.shape[1] > most:
                at = np.argpartition(-best, most - 1, axis=1)[:, :most]
                best, keys = np.take_along_axis(best, at, 1), np.take_along_axis(keys, np.broadcast_to(at, (2, *at.shape)), 2)
        query, place = np.nonzero(best > 0)
        yield _candidates(query, keys[0][query, place], keys[1][query, place], best[query, place])

    return run


def _reaching(block: Block, threshold: np.ndarray):
    """Every document whose bound reaches the threshold of a query."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, found in _bounded(block, batches):
            query, place = np.nonzero(found >= threshold[:, None])
            yield _candidates(query, longs(rows, "high")[place], longs(rows, "low")[place], found[query, place])

    return run


SCORED = "query int, doc_id long, score long"
_SCORED = pa.schema([("query", pa.int32()), ("doc_id", pa.int64()), ("score", pa.int64())])


def exact_scores(block: Block, parts: list[bytes], asked: list[list[int]]) -> list[tuple[int, int, int]]:
    """(number of the text, query, score) of the texts for the queries asked of each."""
    owner, first, second = cut(parts, both=True)
    n = np.bincount(owner, minlength=len(parts))
    factors = block.factors(n)
    at = np.minimum(np.searchsorted(block.term, first), max(len(block.term) - 1, 0))
    held = (block.term[at] == first) & (block.other[at] == second) if len(block.term) else np.zeros(len(first), dtype=bool)
    pair, tf = np.unique(owner[held] * len(block.term) + at[held], return_counts=True)
    place, term = np.divmod(pair, max(len(block.term), 1))
    out = []
    for t, queries in enumerate(asked):
        low, high = np.searchsorted(place, [t, t + 1])
        own = np.zeros(len(block.term), dtype=np.int64)
        own[term[low:high]] = impact(tf[low:high], factors[t])
        out += [(t, q, int((own[block.at[q]] * block.weights[q]).sum())) for q in queries]
    return out


def _scored(block: Block, threshold: np.ndarray, top: int):
    """Exact scores; of a batch and query only the best can be among the best of all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = longs(batch, "doc_id").tolist()
            data, queries = [t.encode() for t in texts(batch)], batch.column("queries").to_pylist()
            rows: list[tuple[int, int, int]] = []
            for low, high in slabs(data, SLAB):
                found = exact_scores(block, data[low:high], queries[low:high])
                rows += [(q, -score, ids[low + t]) for t, q, score in found if score > 0 and score >= threshold[q]]
            rows.sort()
            best = [r for n, r in enumerate(rows) if n < top or rows[n - top][0] != r[0]]
            columns = list(zip(*best, strict=True)) or [()] * 3
            arrays = [pa.array(columns[0], pa.int32()), id_column(columns[2]), pa.array([-s for s in columns[1]], pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, schema=_SCORED)

    return run


def _ranked(scored: DataFrame, top: int) -> DataFrame:
    best = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return scored.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top)


def _exact(docs: DataFrame, candidates: DataFrame, block: Block, threshold: np.ndarray, top: int) -> DataFrame:
    asked = candidates.groupBy("high", "low").agg(F.collect_set("query").alias("queries"))
    joined_rows = _identified(docs).join(asked, ["high", "low"]).select("doc_id", "text", "queries")
    return _ranked(joined_rows.mapInArrow(_scored(block, threshold, top), SCORED), top)


def search_block(docs: DataFrame, index: Index, queries: list[str], top: int = TOP, first: int = FIRST) -> DataFrame:
    """(query, doc_id, score, rank) for a block of queries, known by their numbers."""
    block = _block(index, queries)
    highest = index.sketches.mapInArrow(_highest(block, max(first, top)), CANDIDATES)
    order = Window.partitionBy("query").orderBy(F.col("bound").desc(), "high", "low")
    seeds = kept(highest.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= max(first, top)).drop("place"))
    threshold = np.ones(len(queries), dtype=np.int64)
    for row in _exact(docs, seeds, block, threshold, top).filter(F.col("rank") == top).collect():
        threshold[row["query"]] = row["score"]
    reaching = kept(index.sketches.mapInArrow(_reaching(block, threshold), CANDIDATES))
    return _exact(docs, reaching, block, threshold, top)


def blocks(items: DataFrame, id_column: str, text: str | Column, most: int) -> Iterator[list[tuple]]:
    """(id, text) of the items, in lists of a bounded number of bytes."""
    held, size = [], 0
    for row in items.select(id_column, text).toLocalIterator():
        held.append((row[0], row[1] or ""))
        size += len(held[-1][1]) + 64
        if size >= most:
            yield held
            held, size = [], 0
    if held:
        yield held


def search(docs: DataFrame, items: DataFrame, top: int = TOP, first: int = FIRST, block: int = BLOCK) -> DataFrame:
    """item_id, rank, doc_id and score: the best documents for every row of items (item_id, text)."""
    index = build_index(docs)
    spark = docs.sparkSession
    found = None
    for part in blocks(items.select(F.col("item_id").cast("long").alias("item_id"), "text"), "item_id", "text", block):
        numbered = spark.createDataFrame([(n, i) for n, (i, _) in enumerate(part)], "query int, item_id long")
        ranked = search_block(docs, index, [text for _, text in part], top, first).join(numbered, "query")
        written = kept(ranked.select("item_id", "rank", "doc_id", "score"))
        found = written if found is None else found.union(written)
    return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long") if found is None else found
