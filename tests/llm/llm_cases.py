"""Rows that every operator must cope with, and brute-force versions to compare with."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import xxhash

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long, row_key string, marks string, spans string, score string"
SPACE = " \t\n\x0b\x0c\r"
LAST = (1 << 63) - 1


def documents(spark, pairs):
    """A documents table with extra columns whose names the operators use inside."""
    rows = [(i, t, None if n % 3 else "en", None, n, "a", None, "c", "d") for n, (i, t) in enumerate(pairs)]
    return spark.createDataFrame(rows, DOCUMENTS).repartition(3)


def sentence(rng, n, words=40):
    return " ".join(f"w{rng.randrange(words)}{'aeiou'[rng.randrange(5)]}" for _ in range(n))


def odd_pairs():
    """Null ids and texts, empty and blank texts, repeats, ties, line ends, a long text."""
    rng = random.Random(7)
    base = sentence(rng, 60, 4000)
    shared = sentence(rng, 30, 4000)
    pairs = [
        (1, base),
        (2, base),
        (2, base),
        (3, base + " end"),
        (4, None),
        (5, ""),
        (6, " \n\t\r\x0b\x0c "),
        (None, base),
        (None, None),
        (7, "Line one is long enough\nshort\n  LINE ONE is long enough \nLine one is long enough"),
        (8, "line one is long enough\nother\r\nshort"),
        (9, f"{sentence(rng, 20, 9000)} {shared} {sentence(rng, 20, 9000)}"),
        (10, f"{shared}{sentence(rng, 25, 9000)} {shared}"),
        (11, "é日本" * 60 + shared + "\U0001f600" * 30),
        (11, "the same id again, other text é"),
        (12, "a" * 500),
        (13, "ab" * 300 + "\x00" * 300),
        (14, sentence(rng, 4000, 12) + "\n" + base),
        (-3, base.upper()),
    ]
    return pairs


def order(pair):
    return (LAST if pair[0] is None else pair[0], row_key(*pair))


def row_key(doc_id, text):
    """The row key as Spark has it: the hash of the id seeds that of the text."""
    seed = 42 if doc_id is None else xxhash.xxh64_intdigest(int(doc_id).to_bytes(8, "little", signed=True), 42)
    found = xxhash.xxh64_intdigest((text or "").encode(), seed)
    return found - (1 << 64) if found >> 63 else found


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def sorted_rows(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((x is None, str(type(x)), x) if x is not None else (True, "", 0) for x in r))


def brute_lines(pairs, least=10):
    def keys(text):
        table = {c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
        return [line.strip(SPACE).translate(str.maketrans(table)) for line in (text or "").split("\n")]

    first = {}
    for i, t in pairs:
        for key in keys(t):
            if len(key) >= least:
                first[key] = min(first.get(key, LAST), LAST if i is None else i)
    out = []
    for i, t in pairs:
        lines = (t or "").split("\n")
        stays = [x for x, key in zip(lines, keys(t), strict=True) if len(key) < least or first[key] == (LAST if i is None else i)]
        out.append((i, len(lines), len(lines) - len(stays), sha("\n".join(stays))))
    return out


def brute_exact(pairs):
    groups = {}
    for i, t in pairs:
        groups.setdefault(re.sub(f"[{SPACE}]", "", t or ""), []).append((-len(t or ""), i is None, i or 0, i))
    best = {key: min(g)[3] for key, g in groups.items()}
    keys = [re.sub(f"[{SPACE}]", "", t or "") for _, t in pairs]
    return [(i, best[k], len(groups[k]), sha(k)) for (i, _), k in zip(pairs, keys, strict=True)]


def brute_repeats(pairs, least=100):
    """(id, bytes, removed, runs, digest of the rest) and the rest itself."""
    seen, gone = {}, {}
    distinct = sorted(set(pairs), key=order)
    for pair in distinct:
        data = (pair[1] or "").encode()
        gone[pair] = np.zeros(len(data), dtype=bool)
        for at in range(len(data) - least + 1):
            piece = data[at : at + least]
            if piece in seen:
                gone[pair][at : at + least] = True
            seen.setdefault(piece, (pair, at))
    out, rest = [], []
    for pair in pairs:
        data, mask = (pair[1] or "").encode(), gone[pair]
        left = bytes(np.frombuffer(data, dtype=np.uint8)[~mask])
        runs = int((np.diff(np.concatenate([[False], mask]).astype(int)) == 1).sum())
        out.append((pair[0], len(data), int(mask.sum()), runs, sha(left)))
        rest.append(left)
    return out, rest


def brute_fingerprint(text, words_each=3):
    table = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(table))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + words_each]) for i in range(max(1, len(words) - words_each + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups_of(n, linked):
    """The smallest index reachable from each of n nodes."""
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in linked:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def brute_simhash(pairs, most=2):
    marks = [brute_fingerprint(t) for _, t in pairs]
    near = [(a, b) for a in range(len(pairs)) for b in range(a) if (marks[a] ^ marks[b]).bit_count() <= most]
    root = groups_of(len(pairs), near)
    least = {}
    for (i, _), r in zip(pairs, root, strict=True):
        if i is not None:
            least[r] = min(least.get(r, i), i)
    return [(i, f"{m:016x}", least.get(r)) for (i, _), m, r in zip(pairs, marks, root, strict=True)], root
