"""SentencePiece coding, packing and token counts against the libraries and brute force."""

import math
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import documents, odd_pairs, sha, sorted_rows
from pyspark.sql import functions as F

from plantpulse.llm import catalog, packing, pieces, token_counts
from plantpulse.llm.catalog import vocabulary

TEXTS = ["", " ", "  ", "a", "\n", "a\n\nb\t▁x  y   z     ", "日本語テキスト" * 50, "<s></s><unk><0x41>", " lead", "trail ",
         "a" * 500, "x" * 49, "▁▁▁", "a\0b", "x<|endoftext|>y", "a \n b", "\xa0 \xa0 b", "it's don't 'S", "²x 12³"]
ALPHABET = st.text(st.sampled_from(" \n\tab'sé日▁\xa0\u3000\x1c1!T\U0001f600"), max_size=30)


@pytest.fixture(scope="module")
def pieces_model():
    return vocabulary("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def vocab(pieces_model):
    return pieces.Pieces(pieces_model)


@pytest.fixture(scope="module")
def units():
    return packing.Units(vocabulary("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def pairs():
    return odd_pairs()


@pytest.fixture(scope="module")
def docs(spark, pairs):
    return documents(spark, pairs).cache()


def test_pieces_as_the_library(vocab):
    found = list(pieces.Encoder(vocab, check=True)(TEXTS))
    assert found == vocab.library.encode(TEXTS, num_threads=1)
    assert [vocab.decode(ids) for ids in found] == vocab.library.decode(found)
    assert [vocab.encode(text) for text in TEXTS] == found


@settings(max_examples=200, deadline=None)
@given(text=ALPHABET)
def test_pieces_of_any_text(vocab, text):
    ids = vocab.library.encode(text)
    assert next(iter(pieces.Encoder(vocab, check=True)([text]))) == ids == vocab.encode(text)
    assert vocab.decode(ids) == vocab.library.decode(ids)


@settings(max_examples=200, deadline=None)
@given(ids=st.lists(st.one_of(st.integers(0, 260), st.integers(0, 31999)), max_size=12))
def test_decode_of_any_ids(vocab, ids):
    assert vocab.decode(ids) == vocab.library.decode(ids)


def test_a_difference_to_the_library_fails(vocab):
    encode = pieces.Encoder(vocab, check=True)
    encode._encode = lambda new: {s: [0] for s in new}
    with pytest.raises(AssertionError):
        list(encode(["some text"]))


def test_encode_documents(docs, pairs, pieces_model, vocab):
    rows = pieces.digest_documents(docs, pieces_model).collect()
    expected = []
    for i, t in pairs:
        ids = vocab.library.encode(t or "")
        expected.append((i, len(ids), sha(",".join(map(str, ids))), sha(vocab.library.decode(ids))))
    assert sorted_rows(rows) == sorted_rows(expected)
    full = pieces.encode_documents(docs, pieces_model).collect()
    assert sorted_rows((r.doc_id, len(r.ids), r.decoded) for r in full) == sorted_rows(
        (i, len(vocab.library.encode(t or "")), vocab.library.decode(vocab.library.encode(t or ""))) for i, t in pairs
    )
    assert pieces.digest_documents(docs.filter("false"), pieces_model).collect() == []


def test_units_as_the_library(units):
    for text in TEXTS:
        assert units(text) == np.array(units.whole.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()


@settings(max_examples=400, deadline=None)
@given(text=ALPHABET)
def test_units_of_any_text(units, text):
    assert units(text) == np.array(units.whole.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()


def test_pack(docs, pairs, units):
    rows = packing.pack(docs, vocabulary("byte_bpe_50k.json"), length=64).collect()
    expected = []
    for i, t in pairs:
        ids = [*units.whole.encode(t or "", add_special_tokens=False).ids, 0]
        for n, (start, size) in enumerate(packing.cut(len(ids), 64)):
            expected.append((i, n, start, size, zlib.crc32(np.array(ids[start : start + size], dtype="<u4").tobytes())))
    assert sorted_rows((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == sorted_rows(expected)
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in sequences.values():
        at = 0
        for offset, size in sorted(places):
            assert offset == at
            at += size
        assert at <= 64
    assert len(sequences) <= -(-sum(r.length for r in rows) // 64) + 16
    assert packing.pack(docs.filter("false"), vocabulary("byte_bpe_50k.json")).collect() == []


def test_cut():
    assert packing.cut(1) == [(0, 1)]
    assert packing.cut(2048) == [(0, 2048)]
    assert packing.cut(4097) == [(0, 1), (1, 2048), (2049, 2048)]


def test_open_bins_are_best_fit():
    rng = random.Random(1)
    for most in (1, 3, 100):
        bins, mine, started = packing.OpenBins(50, most), {}, 0
        for _ in range(400):
            size = rng.randrange(1, 51)
            fitting = [f for f in mine.values() if f >= size]
            number, offset = bins.put(size)
            if fitting:
                assert mine[number] == min(fitting) and offset == 50 - mine[number]
            else:
                assert number == started and offset == 0
                started += 1
                if len(mine) == most:
                    del mine[next(n for n, f in mine.items() if f == min(mine.values()) and n not in bins.by_free[f])]
                mine[number] = 50
            mine[number] -= size
            if not mine[number]:
                del mine[number]
            assert bins.open == len(mine) <= most


def brute_count(word, scores, unknown):
    best = [(0.0, 0)]
    for end in range(1, len(word) + 1):
        options = []
        for start in range(end):
            score, size = scores.get(word[start:end]), 1
            if score is None:
                if start < end - 1:
                    continue
                score, size = unknown, len(word[start].encode())
            options.append((best[start][0] + score, -(best[start][1] + size)))
        top = max(options)
        best.append((top[0], -top[1]))
    return best[-1][1]


def test_counts(docs, pairs, pieces_model):
    scores = token_counts.rank_scores(pieces_model)
    trie = token_counts.Trie(scores)
    rows = token_counts.count_tokens(docs, scores).collect()
    expected = []
    for i, t in pairs:
        words = token_counts.pre_tokens(t or "")
        expected.append((i, len(words), sum(brute_count(w, scores, trie.unknown) for w in words)))
    assert sorted_rows((r.doc_id, r.n_pre_tokens, r.n_tokens) for r in rows) == sorted_rows(expected)
    assert token_counts.count_tokens(docs.filter("false"), scores).collect() == []


@settings(max_examples=100, deadline=None)
@given(words=st.sets(st.text("abc", min_size=1, max_size=9), max_size=20))
def test_shared_prefixes(words):
    scores = {"a": -1.0, "b": -1.0, "ab": -1.5, "abc": -2.5, "ca": -2.0, "bb": -2.0, "aab": -3.5}
    trie = token_counts.Trie(scores, 5)
    assert trie.insert(list(words)) == {w: brute_count(w, scores, trie.unknown) for w in words}


@pytest.mark.parametrize("partitions", ["4", "200"])
def test_few_sequences_at_any_partition_number(spark, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        found = catalog.op3_best_fit_packing(spark, "/root/testdata/sf0.01")
        least, used = found.agg(F.sum("length") / 2048, F.countDistinct("sequence_id")).first()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert used <= 1.01 * math.ceil(least)
