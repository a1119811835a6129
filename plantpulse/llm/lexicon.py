"""Levenshtein automata intersected with a trie of terms.

The automaton that accepts all strings within a few edits of some term is run as
a table that grows on demand: a state is a set of (trie node, edits so far), and
a transition is computed once and remembered. Most words leave the automaton
after a few letters. A whole term allows edits by its length; a stem must stand
at the start of the word letter by letter and accepts whatever follows.
"""

from __future__ import annotations

from collections.abc import Iterable

#: Shortest terms that allow one and two edits.
ONE_EDIT = 4
TWO_EDITS = 9
#: Positions in remembered states before the table starts anew.
POSITIONS = 300_000


def edits_allowed(term: str) -> int:
    return (len(term) >= ONE_EDIT) + (len(term) >= TWO_EDITS)


class Automaton:
    def __init__(self, words: Iterable[str], stems: Iterable[str] = ()):
        self.children: list[dict[str, int]] = [{}]
        self.word: list[str] = [""]
        self.stem: list[str] = [""]
        self.reach: list[int] = [0]  # most edits that a term below allows
        for term in sorted(set(words)):
            self.word[self._insert(term, edits_allowed(term))] = term
        for term in sorted(set(stems)):
            self.stem[self._insert(term, 0)] = term
        self._restart()

    def _insert(self, term: str, allowed: int) -> int:
        node = 0
        self.reach[0] = max(self.reach[0], allowed)
        for letter in term:
            following = self.children[node].get(letter)
            if following is None:
                following = self.children[node][letter] = len(self.children)
                self.children.append({})
                self.word.append("")
                self.stem.append("")
                self.reach.append(0)
            node = following
            self.reach[node] = max(self.reach[node], allowed)
        return node

    def _restart(self) -> None:
        self.known: dict[frozenset, int] = {}
        self.sets: list[frozenset] = []
        self.steps: list[dict[str, int]] = []
        self.ends: list[tuple[int, str] | None] = []
        self.stems: list[str] = []
        self.positions = 0
        self.start = self._state({(0, 0)})

    def _state(self, items: set[tuple[int, int]]) -> int:
        """The number of a set of positions; -1 for the empty one."""
        waiting = list(items)
        while waiting:  # letters of the term that the word leaves out
            node, edits = waiting.pop()
            for below in self.children[node].values():
                if edits < self.reach[below] and (below, edits + 1) not in items:
                    items.add((below, edits + 1))
                    waiting.append((below, edits + 1))
        least: dict[int, int] = {}
        for node, edits in items:
            least[node] = min(edits, least.get(node, edits))
        key = frozenset(least.items())
        if not key:
            return -1
        number = self.known.get(key)
        if number is None:
            number = self.known[key] = len(self.sets)
            self.sets.append(key)
            self.positions += len(key)
            self.steps.append({})
            ends = [(e, self.word[n]) for n, e in key if self.word[n] and e <= edits_allowed(self.word[n])]
            self.ends.append(min(ends, default=None))
            self.stems.append(max((self.stem[n] for n, e in key if e == 0), key=len, default=""))
        return number

    def _follow(self, state: int, letter: str) -> int:
        items = set()
        for node, edits in self.sets[state]:
            below = self.children[node].get(letter)
            if below is not None:
                items.add((below, edits))
            if edits < self.reach[node]:
                items.add((node, edits + 1))  # a letter too many
            for other in self.children[node].values():
                if edits < self.reach[other]:
                    items.add((other, edits + 1))  # another letter
        return self._state(items)

    def match(self, word: str) -> tuple[str, int] | None:
        """(term, edits) of the nearest whole term, or (stem, -1); None for neither."""
        if self.positions > POSITIONS:
            self._restart()
        state, stem = self.start, ""
        for letter in word:
            steps = self.steps[state]
            following = steps.get(letter)
            if following is None:
                following = steps[letter] = self._follow(state, letter)
            state = following
            if state < 0:
                return (stem, -1) if stem else None
            stem = self.stems[state] or stem
        end = self.ends[state]
        if end is not None and (end[0] == 0 or not stem):
            return end[1], end[0]
        return (stem, -1) if stem else None
