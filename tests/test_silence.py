"""Silence by timers: no message of the silent site is needed, and a restart loses nothing."""

from datetime import datetime, timedelta, timezone

import pytest

from plantpulse.contract import Timing
from plantpulse.streaming import flows, silence

ZERO = datetime(2024, 1, 1, tzinfo=timezone.utc)
TIMING = Timing(lateness=10)


def at(seconds):
    return ZERO + timedelta(seconds=seconds)


@pytest.fixture
def rocks(spark):
    before = spark.conf.get(silence.PROVIDER_SETTING, None)
    spark.conf.set(silence.PROVIDER_SETTING, silence.PROVIDER)
    yield spark
    if before is None:
        spark.conf.unset(silence.PROVIDER_SETTING)
    else:
        spark.conf.set(silence.PROVIDER_SETTING, before)


def test_needs_a_store_with_timers(spark):
    df = spark.createDataFrame([("a", ZERO)], "factory_id string, source_timestamp timestamp")
    with pytest.raises(ValueError):
        silence.silence_events(df, 60)


def test_silence(rocks, tmp_path):
    spark = rocks
    schema = "factory_id string, source_timestamp timestamp"
    deliveries = [
        [("a", 0), ("b", 0), ("a", 20), ("b", 20), ("c", 5)],
        [("b", 50), ("b", 80), ("b", 110)],  # a and c say nothing
        [("b", 200)],
        [("a", 205), ("b", 210)],  # a is back
        [("b", 240), ("a", 240), ("b", 270), ("a", 270)],
    ]
    for rows in deliveries:
        spark.createDataFrame([(k, at(s)) for k, s in rows], schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        # Every delivery is a run of its own: state and timers come from the checkpoint.
        stream = spark.readStream.schema(schema).parquet(f"{tmp_path}/in")
        flows.run_to_files(silence.silence_events(stream, 60, TIMING), f"{tmp_path}/out", f"{tmp_path}/check").awaitTermination()
        found = [
            (r.factory_id, r.type, int((r.silent_since.replace(tzinfo=timezone.utc) - ZERO).total_seconds()), int((r.at.replace(tzinfo=timezone.utc) - ZERO).total_seconds()))
            for r in spark.read.schema(silence.EVENTS).parquet(f"{tmp_path}/out").collect()
        ]
        if rows is deliveries[2]:
            assert ("a", "silent", 20, 80) in found and ("c", "silent", 5, 65) in found
    assert sorted(found) == sorted(
        [("a", "silent", 20, 80), ("c", "silent", 5, 65), ("b", "silent", 110, 170), ("b", "back", 110, 200), ("a", "back", 20, 205)]
    )
