"""Line, exact, SimHash and suffix deduplication against brute force."""

import random

import pytest
from llm_cases import (
    brute_exact,
    brute_lines,
    brute_repeats,
    brute_simhash,
    documents,
    odd_pairs,
    sentence,
    sorted_rows,
)
from pyspark.sql import functions as F

from plantpulse.llm import components, exact, golay, lines, simhash, suffixes


@pytest.fixture(scope="module")
def pairs():
    return odd_pairs()


@pytest.fixture(scope="module")
def docs(spark, pairs):
    return documents(spark, pairs).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return documents(spark, [(1, "x")]).filter("false")


def test_lines(docs, pairs, empty):
    def run(d):
        return lines.drop_repeated_lines(d).select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256)).collect()

    assert sorted_rows(run(docs)) == sorted_rows(brute_lines(pairs))
    assert run(empty) == []


def test_lines_hot(spark):
    rng = random.Random(1)
    hot = "this line is everywhere"
    pairs = [(i, "\n".join(rng.choice([hot, f"own line number {rng.randrange(60)}", "x"]) for _ in range(5))) for i in range(300)]
    rng.shuffle(pairs)
    found = lines.drop_repeated_lines(documents(spark, pairs)).select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256))
    assert sorted_rows(found.collect()) == sorted_rows(brute_lines(pairs))


def test_bitmaps_round_trip():
    import numpy as np

    dropped = np.array([0, 3, 9])
    keep = lines.unpack_keep(lines.pack_drops(dropped), 12)
    assert np.flatnonzero(~keep).tolist() == [0, 3, 9]
    assert lines.unpack_keep(None, 2).tolist() == [True, True]


def test_exact(docs, pairs, empty):
    rows = exact.exact_groups(docs).collect()
    found = [(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in rows]
    assert sorted_rows(found) == sorted_rows(brute_exact(pairs))
    groups = {r.text_sha256 for r in rows}
    kept = [r for r in rows if r.kept]
    assert sorted(r.text_sha256 for r in kept) == sorted(groups)  # one of each, repeated rows too
    assert all(r.doc_id == r.keep_id for r in kept)
    assert exact.exact_groups(empty).collect() == []


def test_exact_survives_equal_fingerprints(docs, pairs, monkeypatch):
    sign = exact.sign

    def clashing(d):
        return sign(d).withColumn("fingerprint", F.lit(1).cast("long"))  # only lengths differ

    monkeypatch.setattr(exact, "sign", clashing)
    found = [(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in exact.exact_groups(docs).collect()]
    assert sorted_rows(found) == sorted_rows(brute_exact(pairs))


def test_fingerprints_compose():
    data = bytes(random.Random(3).randrange(256) for _ in range(150_000))
    assert len({exact.fingerprint(data, chunk) for chunk in (1 << 16, 1000, 77)}) == 1
    for field in range(2):
        left, right = (exact.hash_chunk(x, field) for x in (data[:100], data[100:350]))
        assert exact.combine(left, right, 250, field) == exact.hash_chunk(data[:350], field)
    assert exact.fingerprint(b"\x00") == exact.fingerprint(b"") == 0  # lengths tell them apart


def test_golay_keys_are_shared_within_two_bits():
    import numpy as np

    rng = np.random.default_rng(5)
    words = rng.integers(0, 1 << 23, 200)
    for flips in range(3):
        others = words.copy()
        for n in range(len(words)):
            for bit in rng.choice(23, flips, replace=False):
                others[n] ^= 1 << int(bit)
        keys = [{}, {}]
        for side, values in enumerate((words, others)):
            for owner, key in zip(*golay.neighbour_keys(values), strict=True):
                keys[side].setdefault(int(owner), set()).add(int(key))
        assert all(keys[0][n] & keys[1][n] for n in range(len(words)))
        assert {len(k) for k in keys[0].values()} <= {1, 6}


@pytest.mark.parametrize("crowd", [32, 0])
def test_simhash(spark, docs, pairs, monkeypatch, crowd):
    monkeypatch.setattr(simhash, "CROWD", crowd)
    near = [(100 + i, " ".join(w if (n * 7 + i * 13) % 997 else "zz" for n, w in enumerate(sentence(random.Random(4), 700, 3000).split()))) for i in range(40)]
    both = pairs + near
    rows = simhash.near_groups(documents(spark, both)).cache()
    found = rows.select("doc_id", simhash.hex_fingerprint("fingerprint"), "component_id").collect()
    expected, root = brute_simhash(both)
    assert sorted_rows(found) == sorted_rows(expected)
    assert len({tuple(r)[2] for r in found if r[0] and r[0] >= 100}) < 40  # some are linked
    assert simhash.one_of_each(rows).count() == len(set(root))


def test_simhash_empty(empty):
    assert simhash.near_groups(empty).collect() == []


def test_components(spark):
    rng = random.Random(2)
    links = [(i, i + 1) for i in range(60)] + [(rng.randrange(100, 160), rng.randrange(100, 160)) for _ in range(40)]
    links += [(5, 5), (None, 3), (4, None), (61, 60), (200, 201), (200, 201)]
    found = dict(map(tuple, components.components(spark.createDataFrame(links, "a long, b long")).collect()))
    from llm_cases import groups_of

    root = groups_of(202, [(a, b) for a, b in links if a is not None and b is not None])
    nodes = {x for a, b in links if a is not None and b is not None and a != b for x in (a, b)}
    assert found == {x: root[x] for x in nodes}
    assert components.components(spark.createDataFrame([], "a long, b long")).collect() == []


@pytest.mark.parametrize("crowd", [suffixes.CROWD, 300])
def test_suffixes(docs, pairs, empty, crowd):
    found = suffixes.drop_repeats(docs, crowd=crowd).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept_bytes", 256))
    assert sorted_rows(found.collect()) == sorted_rows(brute_repeats(pairs)[0])
    assert suffixes.drop_repeats(empty, crowd=crowd).collect() == []


@pytest.mark.parametrize(("block", "crowd"), [(suffixes.BLOCK, suffixes.CROWD), (1000, 500), (10, 3000)])
def test_suffixes_random(spark, block, crowd):
    rng = random.Random(11)
    parts = [sentence(rng, 12, 3000) for _ in range(25)]
    pairs = [(i, "".join(rng.choice(parts) + rng.choice(["", " ", "é"]) for _ in range(rng.randrange(1, 6)))) for i in range(120)]
    found = suffixes.drop_repeats(documents(spark, pairs), block=block, crowd=crowd).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept_bytes", 256)
    )
    assert sorted_rows(found.collect()) == sorted_rows(brute_repeats(pairs)[0])


def test_suffixes_keep_columns(docs, pairs):
    rows = suffixes.without_repeats(docs)
    assert rows.columns == docs.columns
    rest = [(p[0], left.decode(errors="ignore")) for p, left in zip(pairs, brute_repeats(pairs)[1], strict=True)]
    assert sorted_rows((r.doc_id, r.text or "") for r in rows.collect()) == sorted_rows(rest)


def test_long_documents_are_cut_into_pieces():
    """Windows of a text are the same whether it is hashed whole or in overlapping pieces."""
    import numpy as np

    data = np.frombuffer(sentence(random.Random(9), 3000, 900).encode(), dtype=np.uint8)

    def windows(parts, bases):
        sizes = np.array([len(p) for p in parts])
        offsets = np.cumsum(sizes) - sizes
        _, starts, counts, distance = suffixes.window_runs(np.concatenate(parts), offsets, sizes, 100)
        found = {}
        for start, n, d in zip(starts, counts, distance, strict=True):
            which = np.searchsorted(offsets, start, "right") - 1
            for k in range(n):
                found[int(start + k - offsets[which] + bases[which])] = int(start + d - offsets[which] + bases[which])
        return found

    size = 1000
    bases = list(range(0, len(data) - 99, size))
    assert windows([data], [0]) == windows([data[b : b + size + 99] for b in bases], bases)
    assert len(windows([data], [0])) == len(data) - 99
