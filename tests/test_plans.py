"""What the physical plans must and must not contain."""

import re

import pytest

import __spark_entry__ as contract
from plantpulse.sources import lake

QUERIES = contract.queries()
# These run writers or streams when built; their reads are plain scans.
WRITERS = {"s4", "s5", "s6", "s9", "s10", "s12", "u2", "q13", "l1"}
PURE = sorted(n for n in QUERIES if n.split("_")[0] not in WRITERS and not n.startswith("x"))
# The unpartitioned order of a fleet ranks one row per site.
ONE_ROW_PER_SITE = {"w8_fleet_rank"}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def long_plans(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    yield
    spark.conf.unset("spark.sql.maxMetadataStringLength")


@pytest.mark.parametrize("name", PURE)
def test_plan_shape(spark, sf_dir, name):
    """No cross join, no Python, no window over a whole table in one task."""
    plan = plan_of(QUERIES[name](spark, sf_dir))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "FlatMapGroupsInPandas", "MapInPandas"):
        assert bad not in plan
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if name not in ONE_ROW_PER_SITE and re.search(r"\bWindow \[", line):
            assert not any("Exchange SinglePartition" in x for x in lines[i : i + 4])


def scans(plan):
    """(pushed filters, columns read) of every Parquet scan."""
    return re.findall(r"PushedFilters: \[(.*?)\], ReadSchema: struct<(.*?)>", plan)


def test_scans_are_narrow_and_filtered(spark, sf_dir, long_plans):
    for pushed, read in scans(plan_of(QUERIES["a24_ai_event_rate"](spark, sf_dir))):
        assert "event_type" in pushed and "value:" not in read
    for _, read in scans(plan_of(QUERIES["p9_store_keys"](spark, sf_dir))):
        assert sorted(c.split(":")[0] for c in read.split(",")) == ["event_id", "event_type", "ts", "user_id"]


def test_dedup_limits_before_the_shuffle(spark, sf_dir):
    plan = plan_of(QUERIES["d1_dedup_messages"](spark, sf_dir))
    exchange = plan.index("Exchange hashpartitioning(message_id")
    assert "WindowGroupLimit" in plan[exchange:]


def test_last_n_limits_before_the_shuffle(spark, sf_dir):
    plan = plan_of(QUERIES["w7_last_n_mean"](spark, sf_dir))
    exchange = plan.rindex("Exchange hashpartitioning(factory_id")
    assert "WindowGroupLimit" in plan[exchange:]


def test_top_k_is_not_a_full_sort(spark, sf_dir):
    assert "TakeOrderedAndProject" in plan_of(QUERIES["t4_timeline"](spark, sf_dir))


def test_raw_read_prunes_partitions(spark, sf_dir, tmp_path, long_plans):
    from datetime import datetime

    from plantpulse.sources import feed

    lake.write_raw(feed.load_messages(spark, sf_dir), str(tmp_path / "raw"))
    df = lake.read_raw(
        spark, str(tmp_path / "raw"), "factory-b", "factory_state", datetime(2024, 1, 10), datetime(2024, 1, 12)
    )
    filters = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", plan_of(df)).group(1)
    assert "factory_id" in filters and "source_type" in filters and "yyyy" in filters


def test_config_joins_are_broadcast_by_size(spark, sf_dir):
    df = QUERIES["j12_with_thresholds"](spark, sf_dir)
    assert "BroadcastHashJoin" in plan_of(df)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        beyond = QUERIES["j12_with_thresholds"](spark, sf_dir)
        assert "BroadcastHashJoin" not in plan_of(beyond) and "SortMergeJoin" in plan_of(beyond)
        assert beyond.count() == df.count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
