"""Toxicity from a learned lexicon, misspellings and the context of each hit.

Fitting takes at most FIT_ROWS labelled rows outside the held-out fold, those
with the smallest hash of their id. Terms are whole words and stems (the first
letters of words) that occur in far more toxic than clean documents, and in more
than chance explains: the test allows for the number of terms looked at and for
the length of documents. Words are matched by Levenshtein automata intersected
with the trie of terms. A misspelt form that clean documents use about as often
as toxic ones is a word of its own and counts for nothing. Every
hit is judged by a window of words around it: inside quotation marks, in a line
that starts as a quotation or next to a word of reporting it counts little; next
to a word of address it counts more. A logistic regression on the sums turns
hits into a score.

Inputs of a score are the text alone. Defined results. Null counts as empty;
empty texts get the score of a document without hits. Labels that are null are
left out; of repeated labels the larger counts. Without usable labels of both
kinds every score is the share of toxic labels, or 0. Repeated rows are answered
each. An empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantpulse.llm.lexicon import Automaton
from plantpulse.llm.tables import forget, identified, kept, texts

#: Labelled rows that the lexicon and the regression are fitted on, at most.
FIT_ROWS = 20_000
#: Folds by crc32 of the id; fold 0 is held out.
FOLDS = 5
#: Terms of each kind, documents that must use one, and least log-odds.
TERMS = 400
LEAST_DOCS = 4
LEAST_ODDS = 2.0
#: Terms that may be chosen by chance, and log-odds below which a form that clean documents use is a word of its own.
CHANCE = 0.1
FORM_ODDS = 1.0
STEM_LETTERS = (4, 5, 6, 7)
#: Words of context on either side, and what a hit counts by its context.
WINDOW = 6
QUOTED, PLAIN, ADDRESSED = 0.2, 1.0, 1.5
#: Documents whose terms are counted together.
COUNTED = 256
#: Words remembered by a worker, and the longest of them.
CACHED = 200_000
LONGEST = 48

WORD = re.compile(r"[^\W_]+")
QUOTES = re.compile("[\"“”„«»‹›]")
#: Words of reporting and of address.
REPORTING = frozenset(
    "said says called calls wrote quote quoted quotes word words term terms sagte nannte wort wörter zitat "
    "dit appelé mot mots citation dijo llamó palabra palabras cita".split()
)
ADDRESS = frozenset("you your yours youre u du dich dir dein ihr euch tu te toi ton vous votre tú ti usted vosotros".split())


@dataclass(frozen=True)
class Model:
    """What fitting finds; a few hundred terms and a handful of numbers."""

    words: dict[str, float] = field(default_factory=dict)
    stems: dict[str, float] = field(default_factory=dict)
    clean_forms: frozenset[str] = frozenset()
    centre: tuple[float, ...] = ()
    scale: tuple[float, ...] = ()
    weights: tuple[float, ...] = ()
    base: float = 0.0

    def key(self):
        return (tuple(self.words.items()), tuple(self.stems.items()), self.clean_forms)

    def score(self, sums: list[list[float]]) -> np.ndarray:
        x = (np.array(sums).reshape(len(sums), len(self.centre)) - self.centre) / np.array(self.scale)
        return 1 / (1 + np.exp(-np.clip(x @ np.array(self.weights[:-1]) + self.weights[-1], -30, 30)))


class Matcher:
    """Weights of words, remembered, and the sums of a document."""

    def __init__(self, words: dict[str, float], stems: dict[str, float], clean_forms: frozenset[str] = frozenset()):
        self.words, self.stems, self.clean_forms = words, stems, clean_forms
        self.automaton = Automaton(words, stems)
        self.memory: dict[str, tuple[int, float] | None] = {}

    def hit(self, word: str) -> tuple[int, float] | None:
        """(kind, weight): 0 a term, 1 a stem, 2 a misspelt term."""
        found = self.automaton.match(word)
        if found is None:
            return None
        term, edits = found
        if edits < 0:
            return 1, self.stems[term]
        if edits == 0:
            return 0, self.words[term]
        return None if word in self.clean_forms else (2, self.words[term] / (1 + edits))

    def known(self, word: str) -> tuple[int, float] | None:
        if word not in self.memory:
            found = self.hit(word)
            if len(word) > LONGEST:
                return found
            forget(self.memory, CACHED)
            self.memory[word] = found
        return self.memory[word]

    def sums(self, text: str) -> list[float]:
        """Of each kind the weighted hits, then the number of hits, their share and the largest weight."""
        lower = text.lower()
        words = WORD.findall(lower)
        known = self.known
        hits = {w: h for w in set(words) if (h := known(w))}
        if not hits:
            return [0.0] * 6
        kinds, count, top = [0.0, 0.0, 0.0], 0.0, 0.0
        places = [(m.start(), m.group()) for m in WORD.finditer(lower)]
        quotes = [m.start() for m in QUOTES.finditer(lower)]
        passed, line_start, quote_line = 0, 0, lower.startswith(">")
        for n, (at, word) in enumerate(places):
            found = hits.get(word)
            if not found:
                continue
            while passed < len(quotes) and quotes[passed] < at:
                passed += 1
            last_line = lower.rfind("\n", line_start, at) + 1
            if last_line > line_start:
                line_start, quote_line = last_line, lower.startswith(">", last_line)
            near = {w for _, w in places[max(0, n - WINDOW) : n + WINDOW + 1]}
            if passed % 2 and passed < len(quotes) or quote_line or near & REPORTING:
                factor = QUOTED
            else:
                factor = ADDRESSED if near & ADDRESS else PLAIN
            kind, weight = found
            kinds[kind] += factor * weight
            count += factor
            top = max(top, factor * weight)
        return [*map(math.log1p, kinds), math.log1p(count), 1000 * count / (100 + len(words)), top]


@lru_cache(maxsize=1)
def matcher(words, stems, clean_forms) -> Matcher:
    """One per Python worker and model."""
    return Matcher(dict(words), dict(stems), clean_forms)


def document_terms(text: str) -> set[str]:
    """Whole words as they are, stems with a star behind."""
    found = set(WORD.findall(text.lower()))
    return found | {w[:n] + "*" for w in found for n in STEM_LETTERS if len(w) > n}


def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in (b.slice(at, COUNTED) for b in batches for at in range(0, b.num_rows, COUNTED)):
        counts: dict[int, Counter] = {0: Counter(), 1: Counter()}
        for text, toxic in zip(texts(batch), batch.column("toxic").to_pylist(), strict=True):
            counts[toxic].update(document_terms(text))
        terms = list(counts[0].keys() | counts[1].keys())
        columns = [terms, [counts[1][t] for t in terms], [counts[0][t] for t in terms]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int64()), strict=True)],
            names=["term", "toxic", "clean"],
        )


def choose_terms(rows: list[tuple[str, float]]) -> tuple[dict[str, float], dict[str, float]]:
    """Words and stems out of (term, log-odds); a longer stem must say more than a shorter one."""
    words = {t: odds for t, odds in rows if not t.endswith("*")}
    stems: dict[str, float] = {}
    for term, odds in sorted((t[:-1], odds) for t, odds in rows if t.endswith("*")):
        if not any(stems.get(term[:n], -math.inf) >= odds - 1 for n in STEM_LETTERS if n < len(term)):
            stems[term] = odds
    return words, stems


def surprise(toxic, both, share: float):
    """Bound on the log of how unlikely so many toxic documents of a term are by chance.

    By chance each of its documents is toxic with probability `share`, the part
    of all terms that toxic documents hold, so that long documents weigh more.
    """
    part = toxic / both
    rest = F.when(part < 1, (1 - part) * F.log((1 - part) / (1 - share))).otherwise(0.0)
    return both * (part * F.log(part / share) + rest)


def _forms(words: dict[str, float]):
    """Misspelt forms of terms, once for each document that uses one, with its label."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = Automaton(words)
        for batch in batches:
            found = [
                (w, toxic)
                for text, toxic in zip(texts(batch), batch.column("toxic").to_pylist(), strict=True)
                for w in sorted(set(WORD.findall(text.lower())))
                if (m := terms.match(w)) and m[1] > 0
            ]
            columns = list(zip(*found, strict=True)) or [(), ()]
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int32())], names=["form", "toxic"])

    return run


def _sums(model_key):
    schema = "doc_id long, row_key long, sums array<double>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = matcher(*model_key).sums
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("row_key"), pa.array([sums(t) for t in texts(batch)], pa.list_(pa.float64()))],
                names=["doc_id", "row_key", "sums"],
            )

    return run, schema


def regress(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic regression in which no feature lowers the score; the last weight is the constant."""
    used = np.ones(x.shape[1], dtype=bool)
    while True:
        weights = np.zeros(x.shape[1] + 1)
        weights[np.append(used, True)] = _newton(x[:, used], y)
        if (weights[:-1] >= 0).all():
            return weights
        used &= weights[:-1] >= 0


def _newton(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    x = np.hstack([x, np.ones((len(x), 1))])
    weights = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (p - y) + penalty * weights
        bend = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(bend, slope)
        weights -= step
        if np.abs(step).max() < 1e-8:
            break
    return weights


def held_out(doc_id) -> F.Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> Model:
    """A model of at most `rows` labelled documents outside the held-out fold."""
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    # At most `rows` rows of two numbers, whatever the size of the labels.
    sample = kept(identified(docs).join(F.broadcast(chosen), "doc_id"))
    totals = dict(sample.groupBy("toxic").count().collect())
    toxic, clean = totals.get(1, 0), totals.get(0, 0)
    if not toxic or not clean:
        return Model(base=toxic / max(1, toxic + clean))
    counts = sample.select("text", "toxic").mapInArrow(_term_counts, "term string, toxic long, clean long")
    odds = F.log((F.col("toxic") + 0.5) / (toxic + 1)) - F.log((F.col("clean") + 0.5) / (clean + 1))
    stem = F.col("term").endswith("*")
    totals_of = kept(counts.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).withColumn("stem", stem))
    both = F.col("toxic") + F.col("clean")
    candidates = {
        r["stem"]: (r["share"], r["number"])
        for r in totals_of.groupBy("stem")
        .agg((F.sum("toxic") / F.sum(both)).alias("share"), F.count_if(both >= LEAST_DOCS).alias("number"))
        .collect()
    }
    best = []
    for kind, (share, number) in candidates.items():
        good = (
            totals_of.filter((F.col("stem") == kind) & (F.col("toxic") >= LEAST_DOCS))
            .withColumn("odds", odds)
            .filter((F.col("odds") >= LEAST_ODDS) & (surprise(F.col("toxic"), both, share) >= math.log(max(number, 1) / CHANCE)))
            .withColumn("gain", F.col("toxic") * F.col("odds"))
        )
        best.append(good.orderBy(F.desc("gain"), "term").limit(TERMS).select("term", "odds"))
    words, stems = choose_terms([tuple(r) for part in best for r in part.collect()])
    # At most FIT_ROWS documents and a few edits around TERMS words.
    forms = (
        sample.select("text", "toxic").mapInArrow(_forms(words), "form string, toxic int")
        .groupBy("form").agg(F.sum("toxic").alias("toxic"), F.sum(1 - F.col("toxic")).alias("clean"))
        .filter((F.col("clean") > 0) & (odds < FORM_ODDS))
    )
    unsure = Model(words, stems, frozenset(r["form"] for r in forms.collect()))
    run, schema = _sums(unsure.key())
    # Likewise bounded by FIT_ROWS rows of six numbers.
    found = sample.select("doc_id", "row_key", "text").mapInArrow(run, schema).join(
        sample.select("row_key", "toxic").distinct(), "row_key"
    )
    data = sorted((r["row_key"], r["sums"], r["toxic"]) for r in found.collect())
    x, y = np.array([d[1] for d in data]), np.array([d[2] for d in data], dtype=float)
    centre, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-9)
    weights = regress((x - centre) / scale, y)
    return Model(words, stems, unsure.clean_forms, tuple(centre), tuple(scale), tuple(weights))


def score_texts(docs: DataFrame, model: Model) -> DataFrame:
    """Every row's doc_id, row_key and score."""
    if not model.weights:
        return identified(docs).select("doc_id", "row_key", F.lit(float(model.base)).alias("score"))
    key, score = model.key(), model.score

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = matcher(*key).sums
        for batch in batches:
            scores = pa.array(score([sums(text) for text in texts(batch)]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("row_key"), scores], names=["doc_id", "row_key", "score"]
            )

    return identified(docs).mapInArrow(run, "doc_id long, row_key long, score double")


def accepted(docs: DataFrame, model: Model, limit: float = 0.5) -> DataFrame:
    """The rows and columns of docs whose score is below `limit`, without a shuffle."""
    if not model.weights:
        return docs.filter(F.lit(float(model.base) < limit))
    key, score = model.key(), model.score

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = matcher(*key).sums
        for batch in batches:
            yield batch.filter(pa.array(score([sums(text) for text in texts(batch)]) < limit))

    return docs.mapInArrow(run, docs.schema)


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Every row's doc_id, row_key, held_out, score and predicted."""
    scored = score_texts(docs, fit(docs, labels))
    return scored.select(
        "doc_id",
        "row_key",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
