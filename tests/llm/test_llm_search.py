"""Repeated passages, hard negatives and ranked search against brute force."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from llm_cases import LAST, documents, odd_pairs, sentence, sha, sorted_rows
from pyspark.sql import functions as F

from plantpulse.llm import negatives, passages, ranking, words


def brute_passages(pairs, window):
    """(id, words, removed, digest of the rest) of each row."""
    split = [(LAST if i is None else i, (t or "").encode().split()) for i, t in pairs]
    first = {}
    for i, own in split:
        for at in range(len(own) - window + 1):
            key = tuple(own[at : at + window])
            first[key] = min(first.get(key, i), i)
    out = []
    for i, own in split:
        gone = set()
        for at in range(len(own) - window + 1):
            if first[tuple(own[at : at + window])] < i:
                gone.update(range(at, at + window))
        rest = b" ".join(w for at, w in enumerate(own) if at not in gone)
        out.append((None if i == LAST else i, len(own), len(gone), sha(rest)))
    return out


def passage_pairs():
    rng = random.Random(12)
    common = sentence(rng, 40, 900)
    pairs = odd_pairs()
    for i in range(100, 220):
        parts = [sentence(rng, rng.randrange(0, 60), 5)]
        if i % 3 == 0:
            parts.append(common)
        if i % 10 == 0:
            parts.append(" ".join(common.split()[rng.randrange(20) :][: rng.randrange(5, 20)]))
        parts.append(sentence(rng, rng.randrange(0, 40), 900))
        pairs.append((i, rng.choice([" ", "\n", " \t "]).join(parts)))
    pairs += [(300 + i, common) for i in range(30)] + [(250, pairs[30][1]), (250, pairs[40][1]), (250, pairs[40][1])]
    pairs += [(400 + i, "the same few words again and again " * i) for i in range(6)]
    pairs += [(500, sentence(rng, 30_000, 60)), (501, f"{'x' * 70_000} {common}"), (502, f"{'x' * 70_000} {common} y")]
    return pairs


@pytest.mark.parametrize(("window", "slab", "crowd"), [(13, 1 << 21, 64), (13, 3000, 2), (12, 3000, 0), (2, 20_000, 3), (31, 3000, 64)])
def test_passages(spark, window, slab, crowd):
    pairs = passage_pairs()
    found = passages.drop_passages(documents(spark, pairs), window, slab, crowd)
    rows = found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256)).collect()
    expected = brute_passages(pairs, window)
    assert sorted_rows(rows) == sorted_rows(expected)
    assert sum(e[2] for e in expected) > 1000
    for r in found.filter("n_removed > 0").collect():
        assert sum(s.end - s.start for s in r.spans) == r.n_removed
        assert all(a.end < b.start for a, b in zip(r.spans, r.spans[1:], strict=False))


def test_passages_of_nothing(spark):
    assert passages.drop_passages(documents(spark, [(1, "x")]).filter("false")).collect() == []
    rows = passages.drop_passages(documents(spark, [(1, None), (2, ""), (None, " \n")])).collect()
    assert sorted_rows((r.doc_id, r.n_words, r.n_removed, r.spans, r.kept_text) for r in rows) == sorted_rows((i, 0, 0, [], "") for i in (1, 2, None))
    with pytest.raises(ValueError):
        passages.drop_passages(documents(spark, [(1, "x")]), 32)


def test_word_hashes_know_words():
    texts = [b"", b"  one two ", b"two\tone\r\ntwo \xc3\xa9\xc2\xa0 x", b"y" * 70_000 + b" " + b"y" * 70_001, b"one"]
    data, offsets = words.joined(texts)
    starts, ends = words.places(data, ~words.SPACES)
    found = [data[s:e].tobytes() for s, e in zip(starts, ends, strict=True)]
    assert found == [w for t in texts for w in t.split()]
    for which in (0, 1):
        marks = words.hashes(data, starts, ends, which).tolist()
        assert len(set(marks)) == len(set(found))
        assert len({(w, h) for w, h in zip(found, marks, strict=True)}) == len(set(found))
    assert words.hashes(data, starts, ends, 0).tolist() != words.hashes(data, starts, ends, 1).tolist()
    assert len(offsets) == len(texts)


VECTORS = "vec_id long, label long, vector array<long>, anchor boolean, node string, leaf string"


def vector_rows():
    """Clusters, a hot vector, ties, repeats, other lengths, huge components and rows that take no part."""
    rng = np.random.default_rng(9)
    centres = rng.normal(0, 60, (6, 12))
    rows = []
    for i in range(700):
        vector = np.floor(centres[i % 6] + rng.normal(0, 25, 12)).astype(int).tolist()
        if i % 4 == 0:
            vector = [50, 60, -20, 10, 0, 0, 5, 5, 5, 5, 5, 100]  # a quarter of all rows
        rows.append((i, int(rng.integers(4)) if i % 5 else 1, vector, i % 20 == 0))
    rows += [(20, 1, [1] * 12, True), (20, 1, [1] * 12, True), (None, 1, [80] * 12, True), (None, 2, [60] * 12, False)]
    rows += [(900 + i, i % 2, [i, 40, 7], i % 3 == 0) for i in range(15)]
    rows += [(950, 1, [], True), (951, 1, [], True), (952, 2, [], False), (953, None, [1] * 12, True), (954, 1, None, True), (955, 1, [1, None], True)]
    rows += [(960, 7, [1 << 40] + [0] * 11, True), (961, 7, [1 << 40] + [0] * 11, False), (962, 8, [(1 << 40) - 5] + [0] * 11, False), (963, 8, [(1 << 40) * 9 // 10] + [0] * 11, False)]
    return rows


def brute_negatives(rows, positives=5, negatives_=3, low=50, high=95):
    use = [(n, *r) for n, r in enumerate(rows) if r[1] is not None and r[2] is not None and None not in r[2]]
    order = lambda s, r: (-s, LAST if r[1] is None else r[1])
    out = []
    for a in use:
        if not a[4] or a[1] is None:
            continue
        scored = []
        for b in use:
            if b[0] != a[0] and len(b[3]) == len(a[3]):
                s = sum(x * y for x, y in zip(a[3], b[3], strict=True))
                scored.append((min(max(s, -(1 << 63)), (1 << 63) - 1), b))
        scored.sort(key=lambda x: order(*x))
        for p, best in [x for x in scored if x[1][2] == a[2]][:positives]:
            found = [(s, b) for s, b in scored if b[2] != a[2] and low * p <= 100 * s <= high * p][:negatives_]
            out += [(a[1], best[1], rank, b[1], p, s) for rank, (s, b) in enumerate(found, 1)]
    return out


@pytest.mark.parametrize("sizes", [{}, {"sample_rows": 200, "fanout": 4, "leaf": 20, "block": 16}, {"sample_rows": 0}])
def test_hard_negatives(spark, sizes):
    rows = vector_rows()
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], VECTORS).repartition(3)
    found = negatives.hard_negatives(df, **sizes).collect()
    # Which of equal rows without a different id is taken is free, so ids are compared only where they differ.
    assert sorted_rows(found) == sorted_rows(brute_negatives(rows))
    assert negatives.hard_negatives(df.filter("false")).collect() == []
    assert negatives.hard_negatives(df.filter("not anchor")).collect() == []


def test_tree_leaves_out_only_what_cannot_answer():
    rng = np.random.default_rng(4)
    rows = np.floor(rng.normal(0, 10, (3000, 3)) + rng.integers(-3, 4, (3000, 1)) * 90).astype(np.int64)
    nodes = negatives.grow(rows[:500], len(rows), 6, 60)
    leaf, visits = negatives._descended(nodes, rows)
    low = [np.full((len(n.points),) * 2, np.inf) for n in nodes]
    high = [np.full((len(n.points),) * 2, -np.inf) for n in nodes]
    least, most = [np.full(len(n.points), np.inf) for n in nodes], [np.full(len(n.points), -np.inf) for n in nodes]
    norms = (rows * rows).sum(axis=1)
    for at, who, far, nearest in visits:
        for child in np.unique(nearest):
            inside = nearest == child
            low[at][:, child] = np.minimum(low[at][:, child], far[inside].min(axis=0))
            high[at][:, child] = np.maximum(high[at][:, child], far[inside].max(axis=0))
            least[at][child] = min(least[at][child], norms[who[inside]].min())
            most[at][child] = max(most[at][child], norms[who[inside]].max())
    tree = negatives.Tree(3, nodes, tuple(low), tuple(high), tuple(least), tuple(most))
    anchors = rows[::100]
    scores = anchors @ rows.T
    lowest, highest = np.quantile(scores, 0.97, axis=1)[:, None], np.quantile(scores, 0.99, axis=1)[:, None]
    visited = {(at, int(q)) for at, asking in negatives.surviving(tree, anchors, lowest, highest) for q in asking}
    needed = {(int(leaf[n]), q) for q in range(len(anchors)) for n in np.flatnonzero((scores[q] >= lowest[q]) & (scores[q] <= highest[q]))}
    assert needed <= visited
    assert len(visited) < 0.7 * len(anchors) * (leaf.max() + 1)


TERMS = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_search(pairs, items, top=10):
    counts = [(i, Counter(TERMS.findall((t or "").translate(FOLD)))) for i, t in pairs]
    counts = [(i, c) for i, c in counts if c]
    n_docs, total = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(term for _, c in counts for term in c)
    out = []
    for item, text in items:
        asked = Counter(TERMS.findall((text or "").translate(FOLD)))
        scored = []
        for i, c in counts:
            m = 25 + (75 * sum(c.values()) * n_docs) // total
            s = sum(
                times * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
                for t, times in asked.items()
                if t in c
            )
            if s > 0:
                scored.append((-s, LAST if i is None else i))
        out += [(item, r, None if i == LAST else i, -s) for r, (s, i) in enumerate(sorted(scored)[:top], 1)]
    return out


def search_tables():
    rng = random.Random(3)
    pairs = odd_pairs() + [(100 + i, sentence(rng, rng.randrange(1, 300), 400)) for i in range(300)]
    pairs += [(1000 + i, "Equal texts Ééé tie; by 2 ids") for i in range(40)]
    pairs += [(2000, "often " * 700 + "rare"), (2001, "often rare"), (2002, "_often_ Rare\x7frare")]
    items = [(i, sentence(rng, rng.randrange(1, 40), 450)) for i in range(30)]
    items += [(50, None), (51, ""), (52, "?!"), (53, "unknownterm"), (None, "often rare"), (54, "RARE rare often"), (54, "RARE rare often")]
    items += [(55, "equal Texts ééé"), (56, pairs[50][1]), (57, "w1a " * 30)]
    return pairs, items


@pytest.mark.parametrize(("first", "block"), [(16, 1 << 18), (1, 300)])
def test_search(spark, first, block):
    pairs, items = search_tables()
    table = spark.createDataFrame([(*i, "x", "y") for i in items], "item_id long, text string, query string, rank string").repartition(2)
    docs = documents(spark, pairs)
    found = ranking.search(docs, table, first=first, block=block)
    assert sorted_rows(found.select("item_id", "rank", "doc_id", "score").collect()) == sorted_rows(brute_search(pairs, items))
    assert ranking.search(docs.filter("false"), table).collect() == []
    assert ranking.search(docs, table.filter("false")).collect() == []


def test_bounds_are_bounds():
    pairs, items = search_tables()
    data = [(t or "").encode() for _, t in pairs]
    owner, first, second = ranking.cut([(t or "").encode() for _, t in items], both=True)
    term, where = np.unique(first, return_index=True)
    at = [np.searchsorted(term, np.unique(first[owner == q])) for q in range(len(items))]
    block = ranking.Block(len(pairs), 50_000, term, second[where], tuple(at), tuple(np.full(len(a), 3) for a in at))
    tight = loose = 0
    for t, text in enumerate(data):
        own, terms = ranking.cut([text])
        terms, tf = np.unique(terms, return_counts=True)
        if len(terms):
            bits = ranking.bits_of(len(terms))
            bound = ranking.bounds(block, np.array([tf.sum()]), bits, [ranking.sketch(terms, tf, bits)])[:, 0]
            for _, q, score in ranking.exact_scores(block, [text], [list(range(len(items)))]):
                assert bound[q] >= score
                tight, loose = tight + score, loose + bound[q]
    assert loose < 4 * tight  # most terms of these queries are in no document
