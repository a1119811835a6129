"""Near duplicates by word shingles against brute force."""

import ctypes
import random
from pathlib import Path

import pytest
from llm_cases import documents, groups_of, odd_pairs, sentence

from plantpulse.llm import resembling
from plantpulse.llm.simhash import one_of_each


def shingle_set(text):
    words = (text or "").encode().lower().split()
    each = min(5, len(words))
    return {tuple(words[i : i + each]) for i in range(len(words) - each + 1)} if words else set()


def brute_groups(pairs):
    sets = [shingle_set(text) for _, text in pairs]
    near = [
        (i, j)
        for i, a in enumerate(sets)
        for j, b in enumerate(sets[:i])
        if (not a and not b) or (a and b and 5 * len(a & b) >= 4 * len(a | b))
    ]
    return groups_of(len(pairs), near), near


def near_copies():
    """Copies around 4/5, a crowd around one original, and a passage that all share."""
    rng = random.Random(8)
    passage = sentence(rng, 30, 3000)
    pairs = [(i, f"{passage} {sentence(rng, rng.randrange(20, 120), 3000)}") for i in range(60)]
    for base in range(20):
        words = pairs[base][1].split()
        for _ in range(3):
            copy = list(words)
            for at in rng.sample(range(len(copy)), rng.randrange(1, 5)):
                copy[at] = "changed"
            pairs.append((len(pairs), " ".join(copy)))
    words = sentence(rng, 150, 3000).split()
    for _ in range(90):
        copy = list(words)
        for at in rng.sample(range(len(copy)), rng.randrange(0, 6)):
            copy[at] = f"own{rng.randrange(10**6)}"
        pairs.append((len(pairs), " ".join(copy)))
    return pairs


@pytest.mark.parametrize(("crowd", "left"), [(32, 8), (2, 0), (2, 10**9)])
def test_all_pairs_at_four_fifths(spark, monkeypatch, crowd, left):
    monkeypatch.setattr(resembling, "LEFT", left)
    pairs = near_copies() + [(1000 + i, text) for i, (_, text) in enumerate(odd_pairs())]
    root, near = brute_groups(pairs)
    assert len(near) > 500
    rows = resembling.near_groups(documents(spark, pairs), crowd=crowd).cache()
    component = {(r.doc_id, r.row_key): r.component for r in rows.collect()}
    keys = {r.row_key: r.component for r in rows.collect()}
    by_id = {}
    for (doc_id, _), found in component.items():
        by_id.setdefault(doc_id, set()).add(found)
    assert all(by_id[pairs[i][0]] & by_id[pairs[j][0]] for i, j in near)  # recall is whole
    assert len(set(keys.values())) == len(set(root))
    assert one_of_each(rows).count() == len(set(root))


def test_pipeline_stage_drops_copies_beyond_two_bits(spark, tmp_path):
    import corpus_pipeline

    pairs = near_copies()
    root, _ = brute_groups(pairs)
    rows = corpus_pipeline.STAGES[2][1](spark, documents(spark, pairs), str(tmp_path)).collect()
    assert sorted(r.doc_id for r in rows) == sorted({min(p[0] for p, r in zip(pairs, root, strict=True) if r == of) for of in set(root)})


def far_copies(rng, families, each, n_words=150, changes=(4, 6)):
    """Changed copies of one text, too far from it and from other families, with `each` near ones in a family."""
    words = sentence(rng, n_words, 3000).split()
    found = [" ".join(words)]
    for family in range(families):
        head = list(words)
        for at in rng.sample(range(n_words), rng.randrange(*changes)):
            head[at] = f"family{family}x{at}"
        for member in range(each):
            copy = list(head)
            if member:
                copy[rng.randrange(n_words)] = f"own{rng.randrange(10**9)}"
            found.append(" ".join(copy))
    return found


def test_families_that_are_far_from_their_pivot(spark, monkeypatch):
    monkeypatch.setattr(resembling, "LEFT", 0)
    rng = random.Random(11)
    texts = far_copies(rng, 30, 3) + far_copies(rng, 3, 40) + far_copies(rng, 40, 2, n_words=60, changes=(1, 4))
    pairs = list(enumerate(texts))
    root, _ = brute_groups(pairs)
    rows = resembling.near_groups(documents(spark, pairs), crowd=8).collect()
    component = {r.doc_id: r.component for r in rows}
    assert len(set(root)) > 50
    assert len(set(zip((component[i] for i in range(len(pairs))), root, strict=True))) == len(set(root)) == len(set(component.values()))


def test_pairs_of_a_crowd_do_not_grow_with_its_square(spark, monkeypatch):
    seen, verified = [], resembling._verified

    def counted(pairs, docs, signed):
        seen.append(pairs.count())
        return verified(pairs, docs, signed)

    monkeypatch.setattr(resembling, "_verified", counted)
    texts = far_copies(random.Random(12), 400, 1)
    rows = resembling.near_groups(documents(spark, list(enumerate(texts))))
    assert rows.select("component").distinct().count() > 350
    assert sum(seen) < 4 * len(texts)


def test_passages_that_a_sample_misses_crowd_no_keys(spark, monkeypatch):
    monkeypatch.setattr(resembling, "SAMPLE", 1)
    around, crowds = resembling._around, []

    def counted(crowded):
        crowds.append(crowded.count())
        return around(crowded)

    monkeypatch.setattr(resembling, "_around", counted)
    rng = random.Random(13)
    passage = sentence(rng, 12, 3000)
    pairs = [(i, f"{sentence(rng, 60, 3000)} {passage} {sentence(rng, 60, 3000)}") for i in range(300)]
    pairs += [(300 + i, f"{text} more") for i, (_, text) in enumerate(pairs[:40])]
    root, near = brute_groups(pairs)
    assert len(near) == 40
    component = {r.doc_id: r.component for r in resembling.near_groups(documents(spark, pairs)).collect()}
    assert len(set(component.values())) == len(set(root)) == len({(component[i], r) for i, r in enumerate(root)})
    assert not crowds


def test_limits_of_what_is_known_to_be_frequent_lose_no_pair(spark, monkeypatch):
    monkeypatch.setattr(resembling, "SAMPLE", 1)
    monkeypatch.setattr(resembling, "FREQUENT", 3)
    pairs = near_copies()
    root, near = brute_groups(pairs)
    assert len(near) > 500
    component = {r.doc_id: r.component for r in resembling.near_groups(documents(spark, pairs)).collect()}
    assert len(set(component.values())) == len(set(root)) == len({(component[i], r) for i, r in enumerate(root)})


def resident():
    return sum(int(x.split()[1]) for x in Path("/proc/self/smaps_rollup").read_text().splitlines() if x.startswith("Pss_Anon:"))


@pytest.mark.skipif(not Path("/proc/self/smaps_rollup").exists() or not hasattr(ctypes.CDLL(None), "malloc_trim"), reason="needs Linux and glibc")
def test_a_worker_gives_back_what_earlier_stages_used():
    blocks = [bytes(2000) for _ in range(100_000)]
    last = blocks.pop()  # holds the heap's end
    blocks.clear()
    before = resident()
    assert list(resembling._hashed([], None)(iter([]))) == []
    assert before - resident() > 100_000
    assert len(last) == 2000


def test_runs_over_several_batches():
    import numpy as np
    import pyarrow as pa

    rng = np.random.default_rng(3)
    sizes = [1, 40, 2, 3, 40, 4, 100, 1, 5]
    key = np.repeat(np.arange(len(sizes)), sizes).astype(np.int64)
    n, node = np.full(len(key), 50, np.int32), rng.permutation(len(key)).astype(np.int64)
    table = {"key": key, "n": n, "node": node}
    for step in (1, 3, 7, 1000):
        batches = [pa.RecordBatch.from_pydict({c: v[i : i + step] for c, v in table.items()}) for i in range(0, len(key), step)]
        rows = [r for b in resembling._meetings(4)(iter(batches)) for r in b.to_pylist()]
        crowded = sorted((r["key"], r["a"]) for r in rows if r["b"] is None)
        assert crowded == sorted((k, x) for k, x in zip(key.tolist(), node.tolist(), strict=True) if sizes[k] > 4)
        assert len([r for r in rows if r["b"] is not None]) == sum(s * (s - 1) // 2 for s in sizes if s <= 4)


def test_empty(spark):
    assert resembling.near_groups(documents(spark, [(1, "x")]).filter("false")).collect() == []
