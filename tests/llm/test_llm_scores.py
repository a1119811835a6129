"""Toxicity, embeddings, urls and the pipeline."""

import math
import random

import numpy as np
import pytest
from llm_cases import brute_exact, brute_repeats, documents, groups_of, odd_pairs, order, sorted_rows
from pyspark.sql import functions as F
from test_llm_resembling import brute_groups

from plantpulse.llm import catalog, lexicon, toxicity, urls, vectors


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_automaton_accepts_what_is_near():
    rng = random.Random(3)
    words = ["idiot", "moron", "disgusting", "scum", "worthless"]
    automaton = lexicon.Automaton(words, ["veq"])
    for _ in range(3000):
        letters = list(rng.choice(words))
        for _ in range(rng.randrange(4)):
            at = rng.randrange(len(letters) + 1)
            letters[at : at + rng.randrange(2)] = rng.choice(["", "x", "i"])
        word = "".join(letters)
        near = [(edit_distance(word, w), w) for w in words if edit_distance(word, w) <= lexicon.edits_allowed(w)]
        found = automaton.match(word)
        assert found == ((min(near)[1], min(near)[0]) if near else None), word
    assert automaton.match("vequille") == ("veq", -1)
    assert automaton.match("veidiot") is None
    assert automaton.match("") is None


def test_context_of_hits():
    matcher = toxicity.Matcher({"idiot": 5.0}, {})
    plain, quoted, addressed, reported = (
        matcher.sums(t)[3] for t in ("an idiot here", 'an "idiot" here', "you idiot here", "he said idiot here")
    )
    assert quoted < plain < addressed and reported == quoted
    assert matcher.sums("> what an idiot")[3] == quoted
    assert matcher.sums("an idjot here")[2] > 0
    assert toxicity.Matcher({"idiot": 5.0}, {}, frozenset({"idjot"})).sums("an idjot here") == [0.0] * 6


def toxic_table(spark, n=600):
    rng = random.Random(5)
    docs, labels = [], []
    for i in range(n):
        words = [f"w{rng.randrange(300)}" for _ in range(rng.randrange(5, 60))]
        toxic = i % 7 == 0
        if toxic:
            words[1:1] = rng.choices(["grobnik", "schlimmel", "zatorix"], k=3)
        docs.append((i, " ".join(words)))
        if i % 2 or toxic:
            labels.append((i, 1, int(toxic), "x"))
    labels += [(None, 1, 1, "x"), (3, 0, None, "x"), (5, 0, 0, "x"), (10**9, 1, 1, "x")]
    docs += odd_pairs()
    return docs, documents(spark, docs), spark.createDataFrame(labels, "doc_id long, quality int, toxic int, text string")


def test_toxicity(spark):
    pairs, docs, labels = toxic_table(spark)
    rows = toxicity.judge(docs, labels).collect()
    assert len(rows) == len(pairs)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    import zlib

    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    by_id = {r.doc_id: r for r in rows if r.doc_id is not None and r.doc_id > 14}
    assert np.mean([r.predicted == (i % 7 == 0) for i, r in by_id.items()]) == 1.0
    model = toxicity.fit(docs, labels)
    misspelt = documents(spark, [(1, "so ein grobnick und schlimel und zatorixx hier"), (2, "w1 w2 w3"), (3, None)])
    assert {r.doc_id: r.score >= 0.5 for r in toxicity.score_texts(misspelt, model).collect()} == {1: True, 2: False, 3: False}
    left = toxicity.accepted(docs, model)
    assert left.columns == docs.columns
    assert left.count() == sum(not r.predicted for r in rows)


def test_toxicity_without_labels(spark):
    docs = documents(spark, odd_pairs())
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score for r in toxicity.judge(docs, labels).collect()} == {0.0}
    assert toxicity.judge(docs.filter("false"), labels).collect() == []
    ones = spark.createDataFrame([(i, 1, 1) for i in range(1, 14)], labels.schema)
    assert {r.score for r in toxicity.judge(docs, ones).collect()} == {1.0}


def area(positive, negative):
    return sum((p > n) + (p == n) / 2 for p in positive for n in negative) / (len(positive) * len(negative))


@pytest.mark.parametrize(("folder", "least_area", "missed", "false"), [("sf0.1", 0.95, 0.07, 0.005), ("sf0.01", 0.8, 0.4, 0.02)])
def test_held_out_errors(spark, folder, least_area, missed, false):
    """Answering 0 always would miss all; answering by noise would accuse many."""
    folder = f"/root/testdata/{folder}"
    labels = spark.read.parquet(f"{folder}/labels.parquet").filter("toxic IS NOT NULL")
    rows = catalog.op8_toxicity(spark, folder).filter("held_out").join(labels, "doc_id").collect()
    toxic, clean = ([r for r in rows if r.toxic == side] for side in (1, 0))
    assert area([r.score for r in toxic], [r.score for r in clean]) >= least_area
    assert sum(not r.predicted for r in toxic) <= missed * len(toxic)
    assert sum(r.predicted for r in clean) <= false * len(clean)


def test_terms_by_chance_are_not_chosen(spark):
    """Labels without any reason: nothing is learnt."""
    rng = random.Random(8)
    pairs = [(i, " ".join(f"w{rng.randrange(3000)}" for _ in range(rng.randrange(20, 200)))) for i in range(600)]
    labels = spark.createDataFrame([(i, 1, int(rng.random() < 0.15)) for i in range(600)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(documents(spark, pairs), labels)
    assert len(model.words) + len(model.stems) <= 2


def test_forms_are_judged_by_both_classes(spark):
    rng = random.Random(9)
    word = lambda: f"w{rng.randrange(400)}"
    pairs, labels = [], []
    for i in range(900):
        words = [word() for _ in range(40)]
        if i % 6 == 0:
            words[3:3] = ["grobnik", rng.choice(["grobnok", "grobnyk"])]
        elif i == 7:
            words[3] = "grobnok"  # once in a clean document
        elif i % 5 == 0:
            words[3] = "grobnak"  # a word of its own
        pairs.append((i, " ".join(words)))
        labels.append((i, 1, int(i % 6 == 0)))
    model = toxicity.fit(documents(spark, pairs), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert "grobnak" in model.clean_forms and "grobnok" not in model.clean_forms
    rows = documents(spark, [(1, f"so ein grobnyk {word()}"), (2, f"so ein grobnak {word()}"), (3, f'er sagte "grobnik" {word()}'), (4, f"du grobnik {word()}")])
    score = {r.doc_id: r.score for r in toxicity.score_texts(rows, model).collect()}
    assert score[1] > score[2] and score[4] > score[3]


def brute_sums(text, words, stems, clean_forms):
    """The sums of a document with every word compared with every term."""

    def hit(word):
        near = sorted((edit_distance(word, w), w) for w in words if edit_distance(word, w) <= lexicon.edits_allowed(w))
        if near and near[0][0] == 0:
            return 0, words[near[0][1]]
        begins = [s for s in stems if word.startswith(s) and len(word) >= len(s)]
        found = toxicity.Matcher(words, stems, clean_forms).automaton.match(word)
        if found and found[1] < 0:
            assert found[0] in begins
            return 1, stems[found[0]]
        if near and word not in clean_forms:
            return 2, words[near[0][1]] / (1 + near[0][0])
        return None

    matcher = toxicity.Matcher(words, stems, clean_forms)
    matcher.known = hit
    return matcher.sums(text)


def test_scores_against_brute_force(spark):
    pairs, docs, labels = toxic_table(spark, 200)
    model = toxicity.fit(docs, labels)
    rng = random.Random(2)
    letters = "abcdefghijklmnopqrstuvwxyz"
    texts = [t or "" for _, t in pairs[:40]]
    for _ in range(40):
        words = [rng.choice(["grobnik", "schlimmel", "zatorix", "w17", "you", "said", '"']) for _ in range(12)]
        at = rng.randrange(len(words))
        words[at] = words[at].replace(rng.choice(letters), rng.choice(letters))
        texts.append(" ".join(words))
    found = {r.doc_id: r.score for r in toxicity.score_texts(documents(spark, list(enumerate(texts))), model).collect()}
    expected = model.score([brute_sums(t, model.words, model.stems, model.clean_forms) for t in texts])
    assert [found[n] for n in range(len(texts))] == pytest.approx(list(expected))


def vector_rows():
    rng = np.random.default_rng(4)
    rows, n = [], 0
    for label in (0, 1, None):
        for _ in range(12):
            centre = rng.standard_normal(16)
            for _ in range(rng.integers(1, 7)):
                rows.append((n, (centre + rng.standard_normal(16) * rng.choice([0.02, 0.1, 0.2])).tolist(), label))
                n += 1
    first = rows[0][1]
    rows += [
        (n, first, 0), (n + 1, first, 0), (n + 1, first, 0), (n + 2, [2 * x for x in first], 0), (n + 3, first, 1), (None, first, 0),
        (n + 4, None, 0), (n + 5, [0.0] * 16, 0), (n + 6, [math.nan, *first[1:]], 0), (n + 7, [math.inf, *first[1:]], 0),
        (n + 8, [None, *first[1:]], 0), (n + 9, first[:8], 0), (n + 10, [], 0), (n + 11, first[:8], 0), (n + 12, [1e-30] * 16, 1),
        (n + 13, [1e30] * 16, 1),
    ]
    return rows


def brute_vectors(rows, threshold=0.98):
    def good(r):
        return r[2] is not None and r[1] and all(x is not None and math.isfinite(x) for x in r[1]) and any(r[1])

    def cosine(a, b):
        a, b = (np.array(x, dtype=np.float32).astype(np.float64) for x in (a, b))
        a, b = a / np.abs(a).max(), b / np.abs(b).max()
        return a @ b / np.linalg.norm(a) / np.linalg.norm(b)

    links = [
        (i, j) for i, a in enumerate(rows) for j, b in enumerate(rows[:i])
        if good(a) and good(b) and a[2] == b[2] and len(a[1]) == len(b[1]) and cosine(a[1], b[1]) >= threshold
    ]
    root = groups_of(len(rows), links)
    least, count = {}, [0] * len(rows)
    for i, j in links:
        count[i] += 1
        count[j] += 1
    for r, g in zip(rows, root, strict=True):
        if r[0] is not None:
            least[g] = min(least.get(g, r[0]), r[0])
    return [(r[0], c, least.get(g), r[0] == least.get(g)) for r, c, g in zip(rows, count, root, strict=True)]


@pytest.mark.parametrize("block", [1024, 4])
def test_vectors(spark, block):
    rows = vector_rows()
    table = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<float>, label int, node string, links int")
    assert sorted_rows(vectors.near_vectors(table, block=block).collect()) == sorted_rows(brute_vectors(rows))
    assert vectors.near_vectors(table.filter("false"), block=block).collect() == []
    bad = table.filter("label is null")
    assert {(r.n_links, r.kept) for r in vectors.near_vectors(bad, block=block).collect()} == {(0, True)}


URLS = [
    None, "", "no scheme", "http://", "http://Example.NET/en/x", "https://a.b.example.net/en/", "http://example.net/fr/", "ftp://net",
    "http://net/", "http://xnet/", "http://a.org/fr/x?y=/en/", "http://org/fr", "http://www.example.com/de/7#top", "http://example.com",
    "http://example.com?x=://y/de/", "x://h/a://b", "http://..net//", "http://example.net:80/en/", "http://a.example.net" + "/en" * 2000,
    "http://a.example.com/de/\n/x",
]


def brute_urls(rows, rules):
    out = []
    for page, url in rows:
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
        host, tail = rest[:cut], rest[cut:]
        path = tail[: min((tail.find(c) for c in "?#" if c in tail), default=len(tail))]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
        fits = [
            (len(h + p), v == "block", h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)
        ]
        best = max(fits, default=(0, False, None, "allow"))
        out.append((page, host, path, best[2], best[3]))
    return out


def test_urls(spark):
    rows = list(enumerate(URLS)) + [(None, URLS[4]), (4, URLS[4])]
    pages = spark.createDataFrame([(*r, "h", "x", 1) for r in rows], "page_id long, url string, html string, host string, row int")
    rules = [*catalog.URL_RULES, ("example.net", "/en/en/en/x", "block"), ("example.com", "", "allow"), ("net", "/en/", "block")]
    table = spark.createDataFrame([*rules, (None, "/", "block"), ("net", None, "block"), rules[0]], "host string, path string, verdict string")
    assert sorted_rows(urls.judge_urls(pages, table).collect()) == sorted_rows(brute_urls(rows, rules))
    none = urls.judge_urls(pages, table.filter("false")).collect()
    assert len(none) == len(rows) and {(r.rule, r.verdict) for r in none} == {(None, "allow")}
    assert urls.judge_urls(pages.filter("false"), table).collect() == []


def test_urls_run_no_python(spark):
    plan = catalog.op10_url_filters(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "CartesianProduct"))


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    from plantpulse.llm.packing import Units, cut

    pairs, docs, labels = toxic_table(spark, 150)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    model = toxicity.fit(docs, labels)
    left = [(r.doc_id, r.text) for r in toxicity.accepted(docs, model).collect()]
    assert not any("grobnik" in (t or "") for _, t in left)
    exact = {}
    for pair, row in zip(left, brute_exact(left), strict=True):
        if pair[0] == row[1]:
            best = exact.setdefault(row[3], pair)
            if len(pair[1] or "") > len(best[1] or ""):
                exact[row[3]] = pair
    left = list(exact.values())
    root, _ = brute_groups(left)
    left = [min((p for p, r in zip(left, root, strict=True) if r == g), key=order) for g in sorted(set(root))]
    left = [(p[0], rest.decode(errors="ignore")) for p, rest in zip(left, brute_repeats(left)[1], strict=True)]
    units = Units(catalog.vocabulary("byte_bpe_50k.json"))
    expected = [(i, n, size) for i, t in left for n, (_, size) in enumerate(cut(len(units(t)) // 4 + 1))]
    rows = corpus_pipeline.run(spark, str(tmp_path)).select("doc_id", "piece", "length").collect()
    assert sorted_rows(rows) == sorted_rows(expected)


def test_stages_keep_columns(spark, tmp_path):
    import corpus_pipeline

    docs = documents(spark, odd_pairs())
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        for table in (docs, docs.filter("false")):
            out = stage(spark, table, str(tmp_path))
            assert out.columns == docs.columns, name
            assert out.count() <= docs.count()
        if name.startswith("suffix"):
            lengths = stage(spark, docs, str(tmp_path)).select((F.col("n_chars") == F.length(F.coalesce("text", F.lit("")))).alias("ok"))
            assert {r.ok for r in lengths.collect()} == {True}


def test_registered_queries_read_whole_tables(spark, sf_dir):
    n = spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    for name in ("op1_sentencepiece", "op2_line_dedup", "op4_token_counts", "op5_suffix_dedup", "op6_simhash_dedup", "op7_exact_dedup"):
        assert catalog.queries()[name](spark, sf_dir).count() == n, name
