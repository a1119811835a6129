"""Streams in several micro-batches give what one batch job gives."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from plantpulse.contract import Timing
from plantpulse.operators import state
from plantpulse.operators import timeseries as ts
from plantpulse.operators.sliced import Series, state_runs
from plantpulse.sources import feed, lake, latest
from plantpulse.sources.settings import load_config
from plantpulse.streaming import flows, processor

T0 = datetime(2026, 5, 14)
SCHEMA = """factory_id string, source_type string, source_timestamp timestamp, published_at timestamp,
  message_id string, received_at timestamp, risk_level string, value double"""


def make(n=240, seed=5):
    rnd = random.Random(seed)
    out, clock = [], 0
    for i in range(n):
        clock += rnd.choice([1, 2, 3, 3, 3, 90 if i % 50 == 0 else 3])
        at = T0 + timedelta(seconds=clock)
        site = "factory-a" if rnd.random() < 0.7 else "factory-b"
        out.append(
            (site, "factory_state", at, at, f"m{i:04d}", at, rnd.choice(["safe", "safe", "warning"]), float(i % 13))
        )
    return out


def drip(spark, rows, folder, parts):
    """Write the rows as consecutive files and yield after each."""
    size = (len(rows) + parts - 1) // parts
    for k in range(parts):
        chunk = rows[k * size : (k + 1) * size]
        spark.createDataFrame(chunk, SCHEMA).coalesce(1).write.mode("append").parquet(folder)
        yield k


def stream(spark, folder):
    return spark.readStream.schema(SCHEMA).parquet(folder)


def run_all(spark, rows, folder, start, parts=4):
    for _ in drip(spark, rows, folder, parts):
        start().awaitTermination()


@pytest.fixture
def home(tmp_path):
    return str(tmp_path)


def test_windowed_last_equals_batch(spark, home):
    rows = make()
    run_all(
        spark,
        rows,
        f"{home}/in",
        lambda: flows.run_to_files(
            flows.windowed_last(stream(spark, f"{home}/in"), 30), f"{home}/out", f"{home}/check"
        ),
    )
    got = {(r.factory_id, r.bucket): r.message_id for r in spark.read.parquet(f"{home}/out").collect()}
    df = spark.createDataFrame(rows, SCHEMA)
    batch = ts.downsample_last(df, ["factory_id"], "source_timestamp", state.NEWEST, 30).collect()
    closed = max(r[2] for r in rows) - timedelta(seconds=Timing().lateness)
    shift = min(r.bucket for r in batch) - min(b for _, b in got)
    want = {(r.factory_id, r.bucket): r.message_id for r in batch}
    assert shift == timedelta(0) and got
    assert all(want[k] == v for k, v in got.items())
    done = {k for k in want if spark.range(1).select(F.lit(k[1]).cast("timestamp") <= F.lit(closed)).first()[0]}
    assert done <= set(got)


def test_dedup_over_batches(spark, home):
    rows = make(120)
    repeats = [r[:5] + (r[5] + timedelta(seconds=20), *r[6:]) for r in rows if int(r[4][1:]) % 3 == 0]
    hot = [rows[100][:5] + (rows[100][5] + timedelta(seconds=k), *rows[100][6:]) for k in range(60)]
    data = sorted(rows + repeats + hot, key=lambda r: r[5])
    run_all(
        spark,
        data,
        f"{home}/in",
        lambda: flows.run_to_files(
            flows.stream_dedup(stream(spark, f"{home}/in"), Timing(lateness=600)), f"{home}/out", f"{home}/check"
        ),
    )
    got = [r.message_id for r in spark.read.parquet(f"{home}/out").collect()]
    assert sorted(got) == sorted(r[4] for r in rows)


def test_latest_over_batches_out_of_order(spark, home):
    rows = make()
    random.Random(1).shuffle(rows)
    keep = flows.latest_writer(f"{home}/latest")
    run_all(
        spark, rows, f"{home}/in", lambda: flows.run_batches(stream(spark, f"{home}/in"), keep, f"{home}/check")
    )
    got = {r.factory_id: r.message_id for r in latest.read_latest(spark, f"{home}/latest").collect()}
    want = {}
    for r in sorted(rows, key=lambda r: (r[2], r[3], r[4])):
        want[r[0]] = r[4]
    assert got == want
    assert len(latest.versions(spark, f"{home}/latest")) <= 4


def test_repeated_batch_changes_nothing(spark, home):
    df = spark.createDataFrame(make(), SCHEMA)
    root = f"{home}/latest"
    for batch_id, part in ((0, "message_id < 'm0100'"), (1, "message_id >= 'm0100'"), (1, "message_id >= 'm0100'")):
        latest.upsert_latest(df.where(part), root, batch_id)
    assert latest.versions(spark, root) == [0, 1]
    whole = state.latest_per_factory(df, ("factory_id",)).select("message_id").collect()
    assert sorted(latest.read_latest(spark, root).select("message_id").collect()) == sorted(whole)


def test_unfinished_version_is_ignored(spark, home):
    df = spark.createDataFrame(make(), SCHEMA)
    latest.upsert_latest(df, f"{home}/latest", 0)
    df.limit(1).write.parquet(f"{home}/latest/v=1")
    (tmp := __import__("pathlib").Path(f"{home}/latest/v=1/_SUCCESS")).rename(f"{home}/gone")
    assert not tmp.exists() and latest.versions(spark, f"{home}/latest") == [0]


def test_state_changes_over_batches(spark, home):
    rows = make()
    handle = flows.change_writer(f"{home}/changes", f"{home}/running", 3600)
    run_all(
        spark, rows, f"{home}/in", lambda: flows.run_batches(stream(spark, f"{home}/in"), handle, f"{home}/check")
    )
    got = sorted(
        (r.message_id, r.from_state, r.to_state, r.lasted_seconds)
        for r in spark.read.parquet(f"{home}/changes").collect()
    )
    want = []
    for site in ("factory-a", "factory-b"):
        before, since = None, None
        for r in sorted((r for r in rows if r[0] == site), key=lambda r: (r[2], r[4])):
            if before is not None and r[6] != before:
                want.append((r[4], before, r[6], (r[2] - since).total_seconds()))
            if r[6] != before:
                before, since = r[6], r[2]
    assert got == sorted(want)


def test_late_rows_are_set_apart(spark, home):
    rows = make()
    late = rows[10][:4] + ("late-1", *rows[10][5:])
    handle = flows.late_writer(f"{home}/ok", f"{home}/late", f"{home}/seen", Timing())
    data = [*rows, late]
    run_all(
        spark, data, f"{home}/in", lambda: flows.run_batches(stream(spark, f"{home}/in"), handle, f"{home}/check")
    )
    assert [r.message_id for r in spark.read.parquet(f"{home}/late").collect()] == ["late-1"]
    assert spark.read.parquet(f"{home}/ok").count() == len(rows)


def test_sessions_equal_runs(spark, home):
    rows = make()
    run_all(
        spark,
        rows,
        f"{home}/in",
        lambda: flows.run_to_files(
            flows.arrival_sessions(stream(spark, f"{home}/in"), 30), f"{home}/out", f"{home}/check"
        ),
    )
    got = {(r.factory_id, r.session_start, r.messages) for r in spark.read.parquet(f"{home}/out").collect()}
    df = spark.createDataFrame(rows, SCHEMA)
    runs = state_runs(df, Series(("factory_id",), ("source_timestamp", "message_id"), 3600), max_gap_seconds=30)
    assert got and got <= {(r.factory_id, r.run_start, r.row_count) for r in runs.collect()}


def test_silent_sites(spark):
    df = spark.createDataFrame(make(), SCHEMA)
    running = state.latest_per_factory(df, ("factory_id",))
    last = max(r[2] for r in make())
    quiet = flows.silent_sites(running, str(last + timedelta(seconds=400)), 180)
    assert {r.factory_id for r in quiet.collect()} == {"factory-a", "factory-b"}
    assert flows.silent_sites(running, str(last), 180).count() == 0


def test_raw_archive_keeps_late_rows(spark, sf_dir, home):
    from plantpulse.sources import feed

    messages = feed.load_messages(spark, sf_dir)
    lake.write_raw(messages, f"{home}/raw")
    assert lake.read_raw(spark, f"{home}/raw").count() == messages.count()


def test_versions_go_on_after_a_new_checkpoint(spark, tmp_path, monkeypatch):
    def rows(site, day):
        return spark.sql(f"SELECT '{site}' AS factory_id, timestamp'2024-01-{day:02}' AS source_timestamp, "
                         f"timestamp'2024-01-{day:02}' AS published_at, '{site}:{day}' AS message_id")  # fmt: skip

    root = str(tmp_path / "latest")
    for batch_id in range(3):
        latest.upsert_latest(rows("factory-a", batch_id + 1), root, batch_id)
    latest.upsert_latest(rows("factory-b", 2), root, 2)  # the last batch runs again with other rows
    assert {r.message_id for r in latest.read_latest(spark, root).collect()} == {"factory-a:2", "factory-b:2"}
    monkeypatch.setattr(latest, "writer_of", lambda df: "other")
    latest.upsert_latest(rows("factory-a", 30), root, 0)
    assert latest.versions(spark, root)[-1] == 3
    assert {r.message_id for r in latest.read_latest(spark, root).collect()} == {"factory-a:30", "factory-b:2"}
    latest.upsert_latest(rows("factory-a", 30), root, 0)
    assert latest.versions(spark, root)[-1] == 3


def test_rows_without_time_are_late(spark):
    rows = spark.sql("SELECT * FROM VALUES ('a', timestamp'2024-01-05', 1), ('a', timestamp'2024-01-01', 2), ('a', NULL, 3), "
                     "('b', timestamp'2024-01-01', 4) AS t(factory_id, source_timestamp, n)")  # fmt: skip
    seen = spark.sql("SELECT 'a' AS factory_id, timestamp'2024-01-04' AS source_timestamp")
    on_time, late = flows.split_late(rows, seen)
    assert {r.n for r in on_time.collect()} == {1, 4} and {r.n for r in late.collect()} == {2, 3}


def test_ranges_may_be_open(spark, tmp_path):
    from datetime import datetime

    rows = spark.sql("SELECT 'a' AS factory_id, explode(sequence(timestamp'2024-01-01', timestamp'2024-01-09', interval 1 day)) AS timestamp")
    lake.append_history(rows, str(tmp_path), "RISK")
    read = lambda **ends: lake.read_history(spark, str(tmp_path), "RISK", rows.schema, **ends).count()
    assert read() == 9
    assert read(start=datetime(2024, 1, 4)) == 6 and read(end=datetime(2024, 1, 4)) == 4
    assert read(start=datetime(2024, 1, 2), end=datetime(2024, 1, 4)) == 3


def test_one_delivery_a_batch_whatever_the_files(spark, home):
    """A table of many files comes in three micro-batches, each later than the one before; no row is late."""
    days = "timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, CAST(id AS INT))"
    events = spark.range(900).selectExpr("id AS event_id", "id AS user_id", "'view' AS event_type", '\'{"k": 1}\' AS props', f"{days} AS ts")
    # Every file spans all times.
    events.repartition(6).write.parquet(f"{home}/events.parquet")
    folder = feed.deliver(spark, home, f"{home}/events", rows_per_file=80)
    seen = []

    def note(batch, batch_id):
        seen.append(batch.agg(F.min("source_timestamp"), F.max("source_timestamp"), F.count("*")).first())

    flows.run_batches(feed.stream_messages(spark, home, folder), note, f"{home}/check").awaitTermination()
    # The cuts are approximate quantiles.
    assert len(seen) == 3 and sum(n for *_, n in seen) == 900 and all(290 < n < 310 for *_, n in seen)
    assert seen[0][1] < seen[1][0] and seen[1][1] < seen[2][0]
    rows = feed.stream_messages(spark, home, folder).select("factory_id", "source_timestamp", F.lit(1.0).alias("v"))
    flows.run_to_files(flows.windowed_mean(rows, "v", 600), f"{home}/out", f"{home}/check2").awaitTermination()
    closed = spark.read.parquet(f"{home}/out")
    assert closed.agg(F.sum("sample_count")).first()[0] >= 880


def test_deliveries_without_rows_keep_the_batches_apart(spark, home):
    """All rows but a few at one time: a delivery is empty, and the others still come one a batch."""
    ts = "CASE WHEN id < 5 THEN timestamp_ntz'2024-01-01' ELSE timestamp_ntz'2024-01-02' END"
    events = spark.range(400).selectExpr("id AS event_id", "id AS user_id", "'view' AS event_type", '\'{"k": 1}\' AS props', f"{ts} AS ts")
    events.write.parquet(f"{home}/events.parquet")
    folder = feed.deliver(spark, home, f"{home}/events", rows_per_file=50)
    counts = []
    flows.run_batches(
        feed.stream_messages(spark, home, folder), lambda b, n: counts.append(b.count()), f"{home}/check"
    ).awaitTermination()
    assert counts == [400, 0, 0]


def test_kept_in_files(spark, home):
    """A small batch is read back in few parts, and its folder goes."""
    rows = spark.range(1000).selectExpr("id", "named_struct('a', id, 'b', array(id)) AS s").repartition(8)
    with flows.kept_in_files(rows, f"{home}/work") as kept:
        assert sorted(kept.collect()) == sorted(rows.collect())
        assert len(kept.inputFiles()) == 1
        assert lake.exists(spark, f"{home}/work")
    assert not lake.exists(spark, f"{home}/work")


def test_kept_in_files_as_dealt(spark, home):
    """Rows that a shuffle has dealt stay together: no other shuffle before the files."""
    rows = spark.range(1000).selectExpr("id", "id % 40 AS hour").repartition(4, "hour")
    with flows.kept_in_files(rows, f"{home}/work", dealt=True) as kept:
        placed = kept.select("hour", F.input_file_name().alias("file")).distinct().collect()
        assert len(placed) == 40 and len({r.file for r in placed}) > 1
        assert sorted(kept.collect()) == sorted(rows.collect())


def test_hours_of_a_batch_in_one_file(spark, home):
    """Scores lie by hour once; the datasets made of them hold a file an hour, however many tasks."""
    events = spark.range(600).selectExpr(
        "id AS event_id", "id AS user_id", "'view' AS event_type", '\'{"k": 7}\' AS props',
        "timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, CAST(id AS INT)) AS ts",
    )
    events.write.parquet(f"{home}/events.parquet")
    batch = feed.load_messages(spark, home).drop("event_id")
    processor.batch_writer(home, load_config(spark), Timing().scaled(60), 8)(batch.union(batch), 0)
    for name in ("risk-score", "factory-state"):
        files = spark.read.parquet(f"{home}/processed/{name}")
        assert files.count() == 600 and len(files.inputFiles()) == 30
    assert not lake.exists(spark, f"{home}/work/scored/batch=0")
