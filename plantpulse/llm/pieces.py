"""SentencePiece encoding and decoding for merge-type vocabularies.

Encoding follows an agenda: all adjacent symbol pairs whose concatenation is a
piece wait in order of score, best first, leftmost among equals; the best one is
merged and its new neighbours join the agenda. Texts fall apart into segments
where no piece spans the border (before a word's space, around line ends), and
each distinct segment is encoded once per task. New segments of an Arrow batch
advance together: each keeps its own agenda as a row of pair ranks, and every
round merges the best pair of every segment. Long segments take an agenda on a
heap. With `check` the new segments of every Arrow batch are also encoded by the
sentencepiece library, and a difference fails the task.

Symbols that are no piece become the byte pieces of their UTF-8 form. Decoding
joins the pieces, turns runs of byte pieces back into text and drops the space
that encoding puts in front.

Defined results. Null counts as empty and has no ids. Repeated rows are answered
each. An empty table gives an empty result. The model is passed as bytes, so
executors need no file.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from plantpulse.llm.tables import forget, identified, texts

#: The visible space, and what a byte that is no text decodes to.
SPACE = "▁"
UNREADABLE = "�"
#: Segments kept by a task, the longest segment that is kept, symbols advanced at once.
CACHED = 1_000_000
LONGEST = 48
TOGETHER = 1 << 18

NONE = np.iinfo(np.int32).max
#: Before a space that follows a word, and around line ends.
SEGMENT = re.compile(f"\n|{SPACE}*[^{SPACE}\n]+|{SPACE}+")


class Pieces:
    """A merge-type vocabulary read from a model file's bytes."""

    def __init__(self, model: bytes):
        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        size = self.library.get_piece_size()
        names = self.library.id_to_piece(list(range(size)))
        plain = [
            not (self.library.is_control(i) or self.library.is_unknown(i) or self.library.is_byte(i) or self.library.is_unused(i))
            for i in range(size)
        ]
        self.ids = {name: i for i, name in enumerate(names) if plain[i]}
        self.scores = {name: self.library.get_score(i) for name, i in self.ids.items()}
        self.byte_ids = [self.library.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.bytes = dict(zip(self.byte_ids, range(256), strict=True))
        self.text = [name if plain[i] else "" for i, name in enumerate(names)]
        self.text[self.library.unk_id()] = " ⁇ "
        # A byte below 128 is a character wherever it stands; the others need their neighbours.
        for byte, i in enumerate(self.byte_ids[:128]):
            self.text[i] = chr(byte)
        self.high_bytes = frozenset(self.byte_ids[128:])
        self.decimal = [str(i) for i in range(size)]
        #: Whether cutting a text into segments changes nothing: no piece spans a border.
        self.cuts = not any("\n" in p or SPACE in p.lstrip(SPACE) for p in self.ids)
        self._pairs()

    def _pairs(self) -> None:
        """Hash table from two ids to the rank and the id of their merge."""
        left, right, merged = [], [], []
        for name, i in self.ids.items():
            for at in range(1, len(name)):
                a, b = self.ids.get(name[:at]), self.ids.get(name[at:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    merged.append(i)
        scores = np.array([self.scores.get(name, 0.0) for name in self.text])
        order = np.unique(-scores, return_inverse=True)[1].astype(np.int32)
        self.slots = 1 << max(4, (4 * len(left)).bit_length())
        self.keys = np.full(self.slots, -1, dtype=np.int64)
        self.merged = np.zeros(self.slots, dtype=np.int32)
        self.rank = np.full(self.slots, NONE, dtype=np.int32)
        keys = np.array(left, dtype=np.int64) << 32 | np.array(right, dtype=np.int64)
        waiting, at = np.arange(len(keys)), self._slot(keys)
        while len(waiting):
            free = self.keys[at] < 0
            slot, first = np.unique(np.where(free, at, -1), return_index=True)
            first = first[slot >= 0]
            put = waiting[first]
            self.keys[at[first]] = keys[put]
            self.merged[at[first]] = np.array(merged, dtype=np.int32)[put]
            self.rank[at[first]] = order[np.array(merged)[put]]
            rest = np.ones(len(waiting), dtype=bool)
            rest[first] = False
            waiting, at = waiting[rest], (at[rest] + 1) % self.slots

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(40)).astype(np.int64) % self.slots

    def merges(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, id) of each pair's merge; rank NONE where there is none."""
        keys = left << 32 | right
        at = self._slot(keys)
        while True:
            found = self.keys[at]
            missed = (found != keys) & (found >= 0)
            if not missed.any():
                break
            at = np.where(missed, (at + 1) % self.slots, at)
        return np.where(found == keys, self.rank[at], NONE), self.merged[at]

    def agenda(self, segment: str) -> list[str]:
        """The symbols of one segment, merged by a heap of adjacent pairs."""
        symbols: list[str] = list(segment)
        after = list(range(1, len(symbols) + 1))
        before = list(range(-1, len(symbols) - 1))
        scores, waiting = self.scores, []

        def meet(i: int, j: int) -> None:
            if i >= 0 and j < len(symbols):
                score = scores.get(symbols[i] + symbols[j])
                if score is not None:
                    waiting.append((-score, i, j, len(symbols[i]) + len(symbols[j])))

        for i in range(len(symbols) - 1):
            meet(i, i + 1)
        heapq.heapify(waiting)
        while waiting:
            _, i, j, size = heapq.heappop(waiting)
            if not symbols[i] or not symbols[j] or after[i] != j or len(symbols[i]) + len(symbols[j]) != size:
                continue  # one side has been merged meanwhile
            symbols[i] += symbols[j]
            symbols[j] = ""
            after[i] = after[j]
            if after[j] < len(symbols):
                before[after[j]] = i
            for a, b in ((before[i], i), (i, after[i])):
                n = len(waiting)
                meet(a, b)
                if len(waiting) > n:
                    heapq.heappush(waiting, waiting.pop())
        return [s for s in symbols if s]

    def heap_ids(self, segment: str) -> list[int]:
        return list(chain.from_iterable(self._ids_of(s) for s in self.agenda(segment)))

    def _ids_of(self, symbol: str) -> list[int]:
        found = self.ids.get(symbol)
        return [found] if found is not None else [self.byte_ids[b] for b in symbol.encode()]

    def rows_ids(self, segments: list[str]) -> list[list[int]]:
        """Ids of many short segments, whose agendas advance together."""
        if not segments:
            return []
        sizes = np.array([len(s) for s in segments])
        width = int(sizes.max())
        # Characters that are no piece get numbers behind the vocabulary and never merge.
        points = np.frombuffer("".join(segments).encode("utf-32-le"), dtype=np.uint32)
        letters, inverse = np.unique(points, return_inverse=True)
        size = len(self.text)
        numbers = np.array([self.ids.get(chr(c), size + n) for n, c in enumerate(letters)], dtype=np.int64)
        symbols = np.full((len(segments), width + 1), -1, dtype=np.int64)
        inside = np.arange(width) < sizes[:, None]
        symbols[:, :width][inside] = numbers[inverse]
        ranks = np.full((len(segments), width), NONE, dtype=np.int32)
        both = inside.copy()
        both[:, :-1] &= inside[:, 1:]
        both[:, -1] = False
        r, c = np.nonzero(both)
        ranks[r, c] = self.merges(symbols[r, c], symbols[r, c + 1])[0]
        row = np.arange(len(segments))
        places = np.arange(width)
        done = np.empty((len(segments), width + 1), dtype=np.int64)
        while len(row):
            best = ranks.argmin(axis=1)  # the leftmost of equals
            n = np.arange(len(row))
            active = ranks[n, best] < NONE
            if not active.all():
                done[row[~active]] = symbols[~active]
                row, symbols, ranks, best = row[active], symbols[active], ranks[active], best[active]
                n = np.arange(len(row))
                if not len(row):
                    break
            joined = self.merges(symbols[n, best], symbols[n, best + 1])[1]
            # Close the gap: what stands right of the pair moves up by one.
            shift = places > best[:, None]
            symbols[:, :width][shift] = symbols[:, 1:][shift]
            symbols[:, width] = -1
            symbols[n, best] = joined
            moved = np.full_like(ranks, NONE)
            moved[:, :-1] = ranks[:, 1:]
            ranks = np.where(places >= best[:, None], moved, ranks)
            for at, fits in ((best - 1, best > 0), (best, symbols[n, best + 1] >= 0)):
                k, p = n[fits], at[fits]
                ranks[k, p] = self.merges(symbols[k, p], symbols[k, p + 1])[0]
            ranks[n[symbols[n, best + 1] < 0], best[symbols[n, best + 1] < 0]] = NONE
        spelled = {size + n: [self.byte_ids[b] for b in chr(c).encode()] for n, c in enumerate(letters)}
        out = []
        for line, count in zip(done.tolist(), (done >= 0).sum(axis=1).tolist(), strict=True):
            ids = line[:count]
            if max(ids) >= size:
                ids = list(chain.from_iterable([i] if i < size else spelled[i] for i in ids))
            out.append(ids)
        return out

    def segments(self, text: str) -> list[str]:
        if not text:
            return []
        marked = SPACE + text.replace(" ", SPACE)
        return SEGMENT.findall(marked) if self.cuts else [marked]

    def encode(self, text: str) -> list[int]:
        return list(chain.from_iterable(self.heap_ids(s) for s in self.segments(text)))

    def decode(self, ids: list[int]) -> str:
        pieces, names = [], self.text
        if not self.high_bytes.isdisjoint(ids):
            run = bytearray()
            for i in ids:
                value = self.bytes.get(i)
                if value is not None:
                    run.append(value)
                    continue
                if run:
                    pieces.append(readable(bytes(run)))
                    run.clear()
                pieces.append(names[i])
            if run:
                pieces.append(readable(bytes(run)))
        else:
            pieces = [names[i] for i in ids]
        # The space in front belongs to the first piece that has text.
        text = "".join(pieces)
        if ids and text.startswith(SPACE) and ids[0] not in self.bytes:
            text = text[1:]
        return text.replace(SPACE, " ")


def readable(data: bytes) -> str:
    """UTF-8, with one mark for each byte that belongs to no character."""
    try:
        return data.decode()
    except UnicodeDecodeError as error:
        return data[: error.start].decode() + UNREADABLE + readable(data[error.start + 1 :])


class Encoder:
    """Encodes Arrow batches with a bounded memory of segments."""

    def __init__(self, pieces: Pieces, check: bool):
        self.pieces, self.check, self.memory = pieces, check, {}

    def __call__(self, batch: list[str]) -> Iterator[list[int]]:
        memory = self.memory
        for start in range(0, len(batch), 256):
            part = [self.pieces.segments(text) for text in batch[start : start + 256]]
            forget(memory, CACHED)
            fresh = self._encode(list({s for segments in part for s in segments if s not in memory}))
            if self.check:
                self._compare(fresh)
            memory.update((s, np.array(ids, dtype=np.uint32).tobytes()) for s, ids in fresh.items())
            for segments in part:
                yield np.frombuffer(b"".join(map(memory.__getitem__, segments)), dtype=np.uint32).tolist()
            for s in fresh:
                if len(s) > LONGEST:
                    del memory[s]

    def _encode(self, new: list[str]) -> dict[str, list[int]]:
        found = {s: self.pieces.heap_ids(s) for s in new if len(s) > LONGEST}
        short = sorted((s for s in new if len(s) <= LONGEST), key=len)
        while short:
            n = max(1, TOGETHER // len(short[-1]))
            part, short = short[-n:], short[:-n]
            found.update(zip(part, self.pieces.rows_ids(part), strict=True))
        return found

    def _compare(self, fresh: dict[str, list[int]]) -> None:
        """Against the library. It puts a space in front of what it encodes, so others are left out."""
        ours = [s for s in fresh if s.startswith(SPACE) and len(s) > 1]
        theirs = self.pieces.library.encode([s[1:].replace(SPACE, " ") for s in ours], num_threads=1)
        for s, ids in zip(ours, theirs, strict=True):
            if fresh[s] != ids:
                raise AssertionError(f"segment {s!r}: {fresh[s]} here, {ids} by the library")


@lru_cache(maxsize=2)
def encoder(model: bytes, check: bool) -> Encoder:
    """One per Python worker: later tasks of a worker find its segments encoded."""
    return Encoder(Pieces(model), check)


SCHEMA = "doc_id long, row_key long, ids array<int>, decoded string"
DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def encode_documents(docs: DataFrame, model: bytes, check: bool = True) -> DataFrame:
    """Every row's doc_id, row_key, ids and decoded text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(model, check)
        for batch in batches:
            rows = list(encode(texts(batch)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("row_key"), pa.array(rows, pa.list_(pa.int32())),
                 pa.array([encode.pieces.decode(ids) for ids in rows], pa.string())],
                names=["doc_id", "row_key", "ids", "decoded"],
            )

    return identified(docs).mapInArrow(run, SCHEMA)


def digest_documents(docs: DataFrame, model: bytes, check: bool = True) -> DataFrame:
    """The same encoding, with digests instead of ids and text leaving the tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(model, check)
        decimal, decode = encode.pieces.decimal, encode.pieces.decode
        for batch in batches:
            counts, ids_hex, text_hex = [], [], []
            for ids in encode(texts(batch)):
                counts.append(len(ids))
                ids_hex.append(hashlib.sha256(",".join([decimal[i] for i in ids]).encode()).hexdigest())
                text_hex.append(hashlib.sha256(decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(ids_hex, pa.string()), pa.array(text_hex, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return identified(docs).mapInArrow(run, DIGESTS)
