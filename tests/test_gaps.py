"""Gaps by arithmetic and points in intervals, against brute force and by plan."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from plantpulse.operators import failover, gaps, intervals

ZERO = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
ROWS = "k string, ts timestamp, v double"


def at(seconds):
    return ZERO + dt.timedelta(seconds=seconds)


@pytest.fixture(scope="module")
def samples(spark):
    rng = random.Random(4)
    rows = [("a", at(rng.randrange(200_000)), None if rng.random() < 0.1 else 1.0) for _ in range(300)]
    rows += [("b", at(10), 1.0), ("c", at(5), None), ("c", at(5000), None), ("d", at(0), None), ("d", at(400_000), 1.0)]
    rows += [(None, at(7), 1.0), (None, at(70), 1.0)]
    return rows


def brute_islands(rows, width):
    found = {}
    for k in {r[0] for r in rows}:
        mine = [(int((t - ZERO).total_seconds()) // width, v) for q, t, v in rows if q == k]
        low, high = min(n for n, _ in mine), max(n for n, _ in mine)
        held = {n for n, v in mine if v is not None}
        runs, start = [], None
        for n in range(low, high + 2):
            if n <= high and n not in held:
                start = n if start is None else start
            elif start is not None:
                runs.append((start * width, n * width))
                start = None
        found[k] = (high - low + 1, runs)
    return found


@pytest.mark.parametrize("chunk", [4096, 3])
@pytest.mark.parametrize("width", [30, 600])
def test_gaps(spark, samples, monkeypatch, width, chunk):
    monkeypatch.setattr(gaps, "CHUNK", chunk)
    df = spark.createDataFrame(samples, ROWS).repartition(3)
    expected = brute_islands(samples, width)
    second = lambda c: F.unix_seconds(c) - int(ZERO.timestamp())
    islands = gaps.gap_islands(df, ["k"], "v", width)
    rows = islands.select("k", second("gap_start"), second("gap_end"), "empty_buckets", "gap_seconds").collect()
    assert sorted(map(str, rows)) == sorted(
        str(_like(rows[0], (k, a, b, (b - a) // width, b - a)))
        for k, (_, runs) in expected.items()
        for a, b in runs
    )
    longest = {r.k: (r.buckets, r.max_empty_seconds) for r in gaps.max_empty_seconds(df, ["k"], "v", width).collect()}
    assert longest == {k: (n, max((b - a for a, b in runs), default=0)) for k, (n, runs) in expected.items()}
    missing = {r.k: (r.expected, r.missing) for r in gaps.missing_buckets(df, ["k"], "v", width).collect()}
    assert missing == {k: (n, sum(b - a for a, b in runs) // width) for k, (n, runs) in expected.items()}
    by_day = {}
    for k, (_, runs) in expected.items():
        for a, b in runs:
            for s in range(a, b, width):
                key = (k, at(s).strftime("%Y-%m-%d"))
                by_day[key] = by_day.get(key, 0) + width
    found = {(r.k, r.day): r.empty_seconds for r in gaps.empty_seconds_by_day(df, ["k"], "v", width).collect()}
    assert found == by_day


def _like(row, values):
    return type(row)(**dict(zip(row.__fields__, values, strict=True)))


def test_widths_fold_up(spark, samples):
    df = spark.createDataFrame(samples, ROWS).where("k is not null")
    bounds = df.groupBy("k").agg(F.min("ts").alias("start"), F.max("ts").alias("end"))
    occupied = gaps.distinct_buckets(df, ["k"], "v", 30)
    rows = gaps.max_empty_by_width(occupied, bounds, ["k"], 30, (30, 600, 90)).collect()
    for width in (30, 600, 90):
        expected = brute_islands([r for r in samples if r[0]], width)
        assert {r.k: r.max_empty_seconds for r in rows if r.bucket_seconds == width} == {
            k: max((b - a for a, b in runs), default=0) for k, (_, runs) in expected.items()
        }
    with pytest.raises(ValueError):
        gaps.max_empty_by_width(occupied, bounds, ["k"], 30, (45,))


def test_no_bucket_becomes_a_row(spark):
    """A month in seconds: 2.6 million empty buckets, and no operator makes as many rows."""
    df = spark.createDataFrame([("a", at(0), 1.0), ("a", at(2_600_000), 1.0), ("a", at(1_000_000), 1.0)], ROWS)
    out = gaps.max_empty_seconds(df, ["k"], "v", 1)
    assert out.collect()[0].max_empty_seconds == 1_599_999
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "sequence(" not in plan


def test_interval_join(spark):
    rng = random.Random(8)
    points = [(rng.choice("ab"), at(rng.randrange(100_000)), float(n)) for n in range(1500)]
    points += [("a", None, -1.0), (None, at(5), -2.0)]
    spans = []
    for n in range(1000):
        start, length = rng.randrange(100_000), rng.choice([0, 1, 50, 400, 5000])
        spans.append((n, rng.choice("ab"), at(start), at(start + length)))
    spans += [(2000, "a", at(10), at(5)), (2001, "a", None, at(5)), (2002, "a", at(5), None), (2003, None, at(0), at(9)), (2004, "b", at(0), at(90_000))]
    left = spark.createDataFrame(points, ROWS)
    right = spark.createDataFrame(spans, "id long, k string, start timestamp, end timestamp")
    found = intervals.interval_join(left, right, ["k"])
    expected = sorted((v, i) for k, t, v in points for i, q, a, b in spans if k and k == q and t and a and b and a <= t <= b)
    assert sorted((r.v, r.id) for r in found.collect()) == expected
    # Pairs that meet stay near pairs that are found.
    tested = intervals.binned_points(left, intervals.levels(right)).join(intervals.binned_intervals(right), ["k", "_level", "_bin"]).count()
    assert tested < 1.6 * len(expected)
    assert intervals.interval_join(left, right.where("false"), ["k"]).collect() == []
    assert intervals.interval_join(left.where("false"), right, ["k"]).collect() == []


@pytest.mark.parametrize("slice_seconds", [None, 300, 60])
def test_interval_summaries(spark, slice_seconds):
    """Count, first time and sum of every interval, with the hits never made."""
    rng = random.Random(9)
    points = [(rng.choice("ab"), at(rng.randrange(20_000) // 7 * 7), rng.choice([None, 0.5, 2.25, 7.0])) for _ in range(900)]
    points += [("a", None, -1.0), (None, at(5), -2.0)]
    spans = []
    for n in range(600):
        start, length = rng.randrange(20_000), rng.choice([0, 1, 50, 400, 5000])
        spans.append((n // 2, rng.choice("ab"), at(start), at(start + length)))
    spans += [(None, "a", at(0), at(900)), (2000, "a", at(10), at(5)), (2001, "a", None, at(5)), (2002, "a", at(5), None), (2003, None, at(0), at(9))]
    left = spark.createDataFrame(points, ROWS)
    right = spark.createDataFrame(spans, "id long, k string, start timestamp, end timestamp")
    hits = {}
    for i, q, a, b in spans:
        for k, t, v in points:
            if k and k == q and t and a and b and a <= t <= b:
                hits.setdefault(i, []).append((t, v))
    expected = {i: (len(h), min(t for t, _ in h), sum(v is not None for _, v in h), sum(v or 0 for _, v in h)) for i, h in hits.items()}
    found = intervals.interval_summaries(left, right, ["k"], ["id"], "v", "ts", slice_seconds=slice_seconds).collect()
    assert len(found) == len(expected)
    for r in found:
        first = r.first_at.replace(tzinfo=dt.timezone.utc)
        assert (r.samples, first, r["values"], round(r.total, 6)) == expected[r.id]
    assert intervals.interval_summaries(left, right.where("false"), ["k"], ["id"], "v").collect() == []
    assert intervals.interval_summaries(left.where("false"), right, ["k"], ["id"], "v").collect() == []


def test_phase_summaries_make_no_hits(spark):
    """Two thousand tests around two thousand samples: no operator hands on their four million pairs."""
    samples = spark.range(2000).selectExpr("'a' AS factory_id", "timestamp_seconds(id) AS ts", "1.5D AS v")
    tests = spark.range(2000).selectExpr("id AS test_id", "'a' AS factory_id", "timestamp_seconds(0) AS start", "timestamp_seconds(5000) AS end")
    out = failover.phase_join(samples, tests, by=["test_id"], value="v")
    assert {(r.samples, r.total) for r in out.collect()} == {(2000, 3000.0)}
    assert out.count() == 2000
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in plan.splitlines() if "Join" in line and "ts#" in line]
