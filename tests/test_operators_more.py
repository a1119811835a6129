"""Rules in time, score deltas, look-back, distributions, reconciliation and backward reads against brute force."""

import datetime as dt
import random
import statistics

import pytest
from pyspark.sql import functions as F

from plantpulse.contract import Timing
from plantpulse.operators import distributions, metrics, reconcile, rulebook
from plantpulse.plans import backward
from plantpulse.sources import feed, settings
from plantpulse.streaming import processor

ZERO = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)


def at(seconds):
    return ZERO + dt.timedelta(seconds=seconds)


# --- rules ---------------------------------------------------------------------------------
def brute_state(rows, site, moment):
    """field -> (display, enabled, weight) in force for a site."""
    state = {}
    for field in {r[3] for r in rows}:
        common = own = None
        for version, valid, where, name, *values in sorted(rows, key=lambda r: (r[1], r[0])):
            if name == field and valid <= moment:
                if where is None:
                    common = values
                elif where == site:
                    own = values
        if common or own:
            state[field] = [o if o is not None else c for o, c in zip(own or [None] * 3, common or [None] * 3, strict=True)]
    return state


def test_rule_states(spark):
    rng = random.Random(6)
    fields, sites = ["x", "y", "z"], ["s1", "s2", "s3"]
    rows = []
    for n in range(40):
        rows.append(
            (f"v{n:02}", at(rng.randrange(20) * 86400), rng.choice([None, *sites, "gone"]), rng.choice(fields),
             rng.choice([None, True, False]), rng.choice([None, True, False]), rng.choice([None, 1.0, 2.0, 5.0]))
        )
    factories = spark.createDataFrame([(s,) for s in sites], "factory_id string")
    states = rulebook.rule_states(rulebook.changes(spark, rows), factories)
    messages = [(s, at(rng.randrange(25 * 86400)), f"m{i}") for i, s in enumerate(sites * 60)]
    messages += [(s, r[1], "edge") for s in sites for r in rows[:5]]  # a change counts from its very moment
    df = spark.createDataFrame(messages, "factory_id string, source_timestamp timestamp, message_id string")
    for site, moment, rules in ((r.factory_id, r.source_timestamp.replace(tzinfo=dt.timezone.utc), r.rules) for r in rulebook.with_rules(df, states, 3 * 86400).collect()):
        expected = brute_state(rows, site, moment)
        weights = {f: w for f, (_, enabled, w) in expected.items() if enabled and w is not None}
        shown = sorted(f for f, (display, _, _) in expected.items() if display)
        assert (rules.rule_weights if rules else {}) == weights, (site, moment)
        assert (rules.displayed if rules else []) == shown
    assert rulebook.with_rules(df, states.where("false"), 86400).where("rules is not null").count() == 0


def test_rules_without_shuffling_messages(spark, tmp_path):
    """Messages look their rules up in the list of their site; rows without a time or site, and copies, stay."""
    rows = [("v1", at(86400), None, "x", True, True, 1.0), ("v2", at(2 * 86400), "s1", "x", None, None, 5.0)]
    factories = spark.createDataFrame([("s1",), ("s2",)], "factory_id string")
    rulebook.rule_states(rulebook.changes(spark, rows), factories).write.parquet(f"{tmp_path}/states")
    messages = [(s, t, "m") for s in ("s1", "s2", None) for t in (None, at(0), at(86400), at(3 * 86400), at(3 * 86400))]
    spark.createDataFrame(messages, "factory_id string, source_timestamp timestamp, message_id string").write.parquet(f"{tmp_path}/in")
    found = rulebook.with_rules(spark.read.parquet(f"{tmp_path}/in"), spark.read.parquet(f"{tmp_path}/states"), 86400)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Window" not in plan and plan.count("Exchange hashpartitioning") == 1
    got = sorted((r.factory_id or "", r.rules.rule_version if r.rules else "") for r in found.collect())
    assert got == sorted([("", "")] * 5 + [("s1", v) for v in ("", "", "v1", "v2", "v2")] + [("s2", v) for v in ("", "", "v1", "v1", "v1")])


def test_unknown_thresholds_fail(spark):
    with pytest.raises(ValueError):
        settings.wide_thresholds([("s", "noise", 1.0, 2.0)])


def test_score_delta(spark):
    rng = random.Random(2)
    rows = [("a" if n % 3 else "b", at(rng.randrange(20_000)), f"m{n:03}", float(rng.randrange(100))) for n in range(200)]
    schema = "factory_id string, source_timestamp timestamp, message_id string, risk_score double"
    timing = Timing(delta_window=600)
    old, new = rows[:80], rows[80:]
    found = processor.with_delta(spark.createDataFrame(new, schema), spark.createDataFrame(old, schema), 900, timing)
    for r in found.collect():
        now = r.source_timestamp.replace(tzinfo=dt.timezone.utc)
        past = [p for p in rows if p[0] == r.factory_id and 600 <= (now - p[1]).total_seconds()]
        last = max(past, key=lambda p: (p[1], p[2]), default=None)
        fresh = last is not None and (now - last[1]).total_seconds() <= 1200
        assert r.score_delta_10m == (r.risk_score - last[3] if fresh else None)


# --- look-back ------------------------------------------------------------------------------
def test_look_back(spark):
    rng = random.Random(3)
    rows = []
    for i in range(5):
        for _ in range(40):
            value = rng.choice([0.0, 1.0, 1.0, float("nan"), None]) if i == 4 else rng.choice([0.0, 1.0])
            rows.append((str(i), at(rng.randrange(6000)), value))
    df = spark.createDataFrame(rows, "i string, ts timestamp, value double").select(
        F.lit("up").alias("metric"),
        F.create_map(F.lit("cluster"), F.lit("c"), F.lit("job"), F.lit("j"), F.lit("instance"), F.col("i")).alias("labels"),
        "ts",
        "value",
    )

    def brute(moment, lookback):
        out = {}
        for i in "01234":
            seen = [r for r in rows if r[0] == i and r[1] <= moment and (moment - r[1]).total_seconds() < lookback]
            if seen:
                newest = max(t for _, t, _ in seen)
                values = [v for _, t, v in seen if t == newest]
                if not any(v is None or v != v for v in values):
                    out[i] = set(values)
        return out

    for step, lookback in ((60, 300), (300, 60), (70, 71)):
        found = {}
        for r in metrics.values_at_steps(df, step, lookback_seconds=lookback).collect():
            found.setdefault(r.step.replace(tzinfo=dt.timezone.utc), {})[r.instance] = r.value
        first = int(ZERO.timestamp()) // step * step - int(ZERO.timestamp())
        for n in range(-2, 7000 // step + 3):
            expected = brute(at(first + n * step), lookback)
            got = found.pop(at(first + n * step), {})
            assert got.keys() == expected.keys()
            assert all(got[i] in expected[i] for i in got)
        assert not found
    live = {r.instance for r in metrics.values_at(df, at(3000).strftime("%Y-%m-%d %H:%M:%S"), lookback_seconds=200).collect()}
    assert live == set(brute(at(3000), 200))


# --- distributions --------------------------------------------------------------------------
def test_percentiles_from_merged_histograms(spark, monkeypatch):
    monkeypatch.setattr(distributions, "SLICE_BINS", 7)
    rng = random.Random(5)
    rows = [(rng.choice("ab"), at(rng.randrange(90_000)), rng.choice([None, rng.randrange(-30, 200) / 10])) for _ in range(800)]
    rows += [("c", at(5), 1.5)]
    df = spark.createDataFrame(rows, "k string, ts timestamp, v double")
    hours = distributions.hourly_histogram(df, ["k"], {"s": F.col("v")}, "ts", 1)
    out = distributions.statistics(distributions.merged(hours, ["k"]), ["k"], {"p0": 0.0, "p37": 0.37, "p50": 0.5, "p100": 1.0}, {"low": (0, 5)}, 1)
    for r in out.collect():
        values = sorted(v for k, _, v in rows if k == r.k and v is not None)
        for p, got in ((0.0, r.p0), (0.37, r.p37), (0.5, r.p50), (1.0, r.p100)):
            rank = p * (len(values) - 1)
            low, high = values[int(rank)], values[min(int(rank) + 1, len(values) - 1)]
            assert got == pytest.approx(low + (high - low) * (rank - int(rank)))
        assert r.messages == len(values) and r.mean == pytest.approx(statistics.fmean(values)) and r.max == values[-1]
        assert r.low == pytest.approx(sum(0 <= v <= 5 for v in values) / len(values))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "percentile(" not in plan
    assert distributions.statistics(hours.where("false"), ["k"], {"p": 0.5}).collect() == []


# --- reconciliation -------------------------------------------------------------------------
def test_reconcile_branches(spark):
    rng = random.Random(7)
    schema = "factory_id string, source_timestamp timestamp, message_id string, v long"
    base = [(rng.choice("ab"), at(rng.randrange(10 * 86400)), f"m{n}", rng.randrange(9)) for n in range(500)]
    left, right = list(base), list(base)
    changed = {}
    for n, row in enumerate(rng.sample(base, 20)):
        kind = ("missing", "extra", "differing", "contradicting")[n % 4]
        changed[row[2]] = kind
        if kind == "missing":
            right.remove(row)
        elif kind == "extra":
            left.remove(row)
        elif kind == "differing":
            right[right.index(row)] = (*row[:3], row[3] + 1)
        else:
            right.append((*row[:3], row[3] + 1))
    left += left[:100]  # copies count once
    sides = [reconcile.prepared(spark.createDataFrame(x, schema), ["v"]) for x in (left, right)]
    assert {r.message_id: r.outcome for r in reconcile.reconcile_branches(*sides).collect()} == changed
    days = {(r.factory_id, r.day) for r in reconcile.differing(*sides, reconcile.DAY).collect()}
    assert days == {(r[0], r[1].strftime("%Y-%m-%d")) for r in base if r[2] in changed}
    assert reconcile.reconcile_branches(sides[0], sides[0]).collect() == []


# --- reading backwards ------------------------------------------------------------------------
def test_backward_reads_are_bounded(spark, sf_dir):
    asked = []

    def read(start, end):
        asked.append((start, end))
        return feed.load_factory_states(spark, sf_dir, start, end)

    oldest, newest = backward.reach(read)
    asked.clear()
    start = dt.datetime(2024, 1, 20)
    low = backward.earlier_start(read, start, 1, oldest, {"factory-a"}, dt.timedelta(minutes=10))
    before = read(low, start).where("factory_id = 'factory-a'")
    assert before.count() >= 1 and low > dt.datetime(2024, 1, 15)
    assert all(a >= low and b < start for a, b in asked[:-1])
    # A site that has no older rows ends the search at the oldest row.
    assert backward.earlier_start(read, start, 1, oldest, {"nowhere"}) == oldest
    plan = read(start, newest)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in plan and "LessThanOrEqual(ts" in plan


def test_newest_events_read_no_more_than_needed():
    windows = []

    class Events:
        def __init__(self, low, high):
            self.rows = [x for x in range(0, 1000, 7) if low <= at(x) <= high]

        def select(self, *_):
            return self

        def limit(self, n):
            self.rows = self.rows[:n]
            return self

        def collect(self):
            return self.rows

        def orderBy(self, *_):
            return self

    def between(low, high):
        windows.append((low, high))
        return Events(low, high)

    backward.newest_events(between, 10, at(0), at(1000), dt.timedelta(seconds=20))
    assert [int((high - low).total_seconds()) for low, high in windows] == [20, 80]
    windows.clear()
    backward.newest_events(between, 10**6, at(0), at(1000), dt.timedelta(seconds=20))
    assert windows[-1][0] == at(0)
