"""Sliced series operators against brute force in plain Python."""

import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from plantpulse.operators import checks
from plantpulse.operators import timeseries as ts
from plantpulse.operators.sliced import Series, as_of, fill_forward, fitting_seconds, state_runs, with_previous

START = datetime(2024, 3, 1, tzinfo=timezone.utc)
SLICES = (60, 3600, 10**7)
SCHEMA = "site string, ts timestamp, id long, value double, state string"


def rows(seed, n=400):
    """One site holds most rows; there are ties in time, nulls and long holes."""
    rnd = random.Random(seed)
    out, clock = [], 0
    for i in range(n):
        clock += rnd.choice([0, 1, 5, 30, 400] + ([20000] if i % 97 == 0 else []))
        site = "hot" if rnd.random() < 0.7 else rnd.choice("bc")
        value = None if rnd.random() < 0.3 else float(rnd.randint(0, 9))
        out.append((site, START + timedelta(seconds=clock), i, value, rnd.choice("xxxy")))
    return out


def by_site(data):
    groups = {}
    for r in sorted(data, key=lambda r: (r[0], r[1], r[2])):
        groups.setdefault(r[0], []).append(r)
    return groups


@pytest.fixture(scope="module", params=[1, 2])
def case(spark, request):
    data = rows(request.param)
    return spark.createDataFrame(data, SCHEMA).repartition(4), data


def series(seconds):
    return Series(("site",), ("ts", "id"), seconds)


@pytest.mark.parametrize("seconds", SLICES)
def test_previous(case, seconds):
    df, data = case
    got = {r.id: (r.prev_id, r.prev_value) for r in with_previous(df, series(seconds), ["id", "value"]).collect()}
    want = {}
    for group in by_site(data).values():
        for before, row in zip([None, *group], group):
            want[row[2]] = (before[2], before[3]) if before else (None, None)
    assert got == want


@pytest.mark.parametrize("seconds", SLICES)
@pytest.mark.parametrize("n", [1, 3, 7])
def test_moving_mean(case, seconds, n):
    df, data = case
    got = {r.id: r.moving_mean for r in ts.moving_mean(df, series(seconds), "value", n).collect()}
    for group in by_site(data).values():
        for i, row in enumerate(group):
            seen = [r[3] for r in group[max(0, i - n + 1) : i + 1] if r[3] is not None]
            want = sum(seen) / len(seen) if seen else None
            assert got[row[2]] == pytest.approx(want)
    assert len(got) == len(data)


@pytest.mark.parametrize("seconds", SLICES)
def test_fill_forward(case, seconds):
    df, data = case
    got = {r.id: r.value for r in fill_forward(df, series(seconds), ["value"]).collect()}
    want = {}
    for group in by_site(data).values():
        last = None
        for row in group:
            last = row[3] if row[3] is not None else last
            want[row[2]] = last
    assert got == want


def brute_runs(data, use_state, max_gap):
    out = []
    for site, group in by_site(data).items():
        run = [group[0]]
        for before, row in zip(group, group[1:]):
            joined = (not use_state or before[4] == row[4]) and (
                max_gap is None or (row[1] - before[1]).total_seconds() <= max_gap
            )
            if joined:
                run.append(row)
            else:
                out.append((site, int(run[0][1].timestamp()), int(run[-1][1].timestamp()), len(run)))
                run = [row]
        out.append((site, int(run[0][1].timestamp()), int(run[-1][1].timestamp()), len(run)))
    return sorted(out)


@pytest.mark.parametrize("seconds", SLICES)
@pytest.mark.parametrize("use_state,max_gap", [(True, None), (False, 60), (True, 60)])
def test_runs(case, seconds, use_state, max_gap):
    df, data = case
    runs = state_runs(df, series(seconds), "state" if use_state else None, max_gap)
    got = runs.select("site", F.unix_seconds("run_start"), F.unix_seconds("run_end"), "row_count").collect()
    assert sorted(tuple(r) for r in got) == brute_runs(data, use_state, max_gap)


@pytest.mark.parametrize("seconds", SLICES)
def test_as_of(case, seconds):
    df, data = case
    left = df.where("state = 'x'").select("site", "ts", "id")
    right = df.where("state = 'y'").select("site", "ts", "id", F.struct(F.col("id").alias("rid")).alias("found"))
    got = {r.id: (r.found.rid if r.found else None) for r in as_of(left, right, series(seconds), "found").collect()}
    for group in by_site(data).values():
        for row in (r for r in group if r[4] == "x"):
            known = [(r[1], r[2]) for r in group if r[4] == "y" and r[1] <= row[1]]
            assert got[row[2]] == (max(known)[1] if known else None)


def test_hot_site_is_spread(spark):
    """No partition of the big shuffle holds much of a site with all the rows."""
    df = spark.range(20000).select(
        F.lit("only").alias("site"),
        F.timestamp_seconds(F.lit(1700000000) + F.col("id") * 60).alias("ts"),
        "id",
        (F.col("id") % 5).cast("double").alias("value"),
    )
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = [
            r["count"]
            for r in with_previous(df, series(3600), ["value"]).groupBy(F.spark_partition_id()).count().collect()
        ]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(sizes) == 8 and max(sizes) < 20000 * 0.3


def test_dedup_hot_id(spark):
    rnd = random.Random(3)
    data = [("hot" if rnd.random() < 0.4 else f"m{rnd.randint(0, 300)}", rnd.randint(0, 10**6), i) for i in range(3000)]
    df = spark.createDataFrame(data, "message_id string, received_at long, published_at long").repartition(6)
    got = {r.message_id: (r.received_at, r.published_at) for r in checks.dedup_messages(df).collect()}
    want = {}
    for m, r, p in data:
        want[m] = min(want.get(m, (r, p)), (r, p))
    assert got == want


def test_slice_width_follows_the_densest_minute(spark):
    rows = spark.sql("SELECT 'a' AS site, timestamp'2024-01-01' + make_dt_interval(0, 0, 0, CAST(id % 40 AS DECIMAL(18, 6))) AS ts FROM range(500)")
    rows = rows.union(spark.sql("SELECT 'b', timestamp'2024-01-01' + make_dt_interval(0, 0, CAST(id AS INT)) FROM range(50)"))
    assert fitting_seconds(rows, ["site"], "ts", rows=5000) == 600
    assert fitting_seconds(rows, ["site"], "ts", rows=10) == 60
    assert fitting_seconds(rows.where("false"), ["site"], "ts") == 7 * 86400
