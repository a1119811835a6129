"""Token counts under a unigram vocabulary, by forward scores over a trie.

The count of a pre-token is the number of pieces of its best segmentation. The
best score of a prefix depends on the prefix alone, so distinct pre-tokens are
put in a trie and every node's forward score and count are computed once, from
the nodes above it; a word's count is stored at its last node. A document's
count is the sum over its pre-tokens. What a task remembers is bounded: beyond
WORDS counts it starts anew, and nothing but work is lost.

Pre-tokens are runs without the space, each with the space in front; line ends
stand alone. A character outside the vocabulary costs its UTF-8 bytes, one token
each. Of equally good segmentations the one with fewer pieces counts.

Defined results. Null counts as empty and has no tokens. Repeated rows are
answered each. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from plantpulse.llm.pieces import SEGMENT, SPACE
from plantpulse.llm.tables import forget, identified, texts

#: Counts remembered by a worker, the longest word among them, and what an
#: unknown character scores below the worst piece.
WORDS = 1_000_000
LONGEST = 48
UNKNOWN = 10.0


def rank_scores(model: bytes) -> dict[str, float]:
    """Log-probabilities of the pieces of a vocabulary that is ordered by frequency.

    A piece of rank r has a probability in proportion to 1 / r.
    """
    library = sentencepiece.SentencePieceProcessor(model_proto=model)
    plain = [
        library.id_to_piece(i)
        for i in range(library.get_piece_size())
        if not (library.is_control(i) or library.is_unknown(i) or library.is_byte(i))
    ]
    total = math.log(sum(1 / r for r in range(1, len(plain) + 1)))
    return {piece: -math.log(r) - total for r, piece in enumerate(plain, 1)}


class Trie:
    """Counts of pre-tokens; each node holds the forward score and count of its prefix.

    Words are inserted in alphabetical order, so only the path to the last word
    is needed: a node off it is never visited again. Counts of words stay.
    """

    def __init__(self, scores: dict[str, float], words: int = WORDS):
        self.scores, self.most = scores, words
        self.unknown = min(scores.values(), default=0.0) - UNKNOWN
        #: Longest piece by its last two letters.
        self.longest: dict[str, int] = {}
        for piece in scores:
            self.longest[piece[-2:]] = max(self.longest.get(piece[-2:], 1), len(piece))
        self.terminal: dict[str, int] = {}

    def insert(self, words: list[str]) -> dict[str, int]:
        """Counts of distinct words, each shared prefix scored once."""
        found, last = {}, ""
        best, counts = [0.0], [0]
        for word in sorted(words):
            shared = 0
            for a, b in zip(last, word, strict=False):
                if a != b:
                    break
                shared += 1
            del best[shared + 1 :], counts[shared + 1 :]
            for end in range(shared + 1, len(word) + 1):
                self._forward(word, end, best, counts)
            found[word], last = counts[-1], word
        return found

    def _forward(self, word: str, end: int, best: list[float], counts: list[int]) -> None:
        """Adds the node of word[:end]."""
        scores = self.scores
        start = end - 1
        piece = scores.get(word[start:end])
        if piece is None:
            top, fewest = best[start] + self.unknown, counts[start] + len(word[start].encode())
        else:
            top, fewest = best[start] + piece, counts[start] + 1
        for start in range(max(0, end - self.longest.get(word[end - 2 : end], 1)), end - 1):
            piece = scores.get(word[start:end])
            if piece is not None:
                score = best[start] + piece
                if score > top or score == top and counts[start] + 1 < fewest:
                    top, fewest = score, counts[start] + 1
        best.append(top)
        counts.append(fewest)

    def totals(self, texts: list[list[str]]) -> list[int]:
        """Tokens of each list of pre-tokens."""
        out = []
        for start in range(0, len(texts), 256):
            part = texts[start : start + 256]
            forget(self.terminal, self.most)
            new = {w for words in part for w in words if w not in self.terminal}
            fresh = self.insert(list(new))
            self.terminal |= {w: n for w, n in fresh.items() if len(w) <= LONGEST}
            lookup = self.terminal.__getitem__ if all(len(w) <= LONGEST for w in new) else (self.terminal | fresh).__getitem__
            out += [sum(map(lookup, words)) for words in part]
        return out


def pre_tokens(text: str) -> list[str]:
    return SEGMENT.findall(SPACE + text.replace(" ", SPACE)) if text else []


@lru_cache(maxsize=2)
def trie(scores: tuple[tuple[str, float], ...]) -> Trie:
    """One per Python worker."""
    return Trie(dict(scores))


def count_tokens(docs: DataFrame, scores: dict[str, float]) -> DataFrame:
    """Every row's doc_id, row_key, n_pre_tokens and n_tokens."""
    fixed = tuple(scores.items())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counted = trie(fixed)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                words = [pre_tokens(text) for text in texts(part)]
                columns = ([len(found) for found in words], counted.totals(words))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("row_key"), *(pa.array(c, pa.int64()) for c in columns)],
                    names=["doc_id", "row_key", "n_pre_tokens", "n_tokens"],
                )

    return identified(docs).mapInArrow(run, "doc_id long, row_key long, n_pre_tokens long, n_tokens long")
