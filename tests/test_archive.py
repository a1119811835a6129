"""Reprocessing and upkeep of an archive by day."""

import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from plantpulse.sources import feed, lake, reprocess, upkeep


def messages(spark, sf_dir, start="2024-01-02", end="2024-01-06"):
    return feed.load_messages(spark, sf_dir).where(F.col("received_at").between(start, end))


def scorer(factor):
    seen = []

    def score(rows):
        seen.append(sorted(r.day for r in rows.select("day").distinct().collect()))
        return rows.select(
            "message_id", "factory_id", "day", F.col("source_timestamp").alias("event_timestamp"), (F.length("message_id") * factor).alias("score")
        )

    return score, seen


def files_of(root):
    return {p: os.stat(p).st_mtime_ns for p in map(str, Path(root).rglob("*.parquet"))}


def counts(df):
    return {r.day: r["count"] for r in df.groupBy("day").count().collect()}


def test_only_missing_and_changed_days_are_computed(spark, sf_dir, tmp_path):
    raw, root = f"{tmp_path}/raw", f"{tmp_path}/out"
    rows = messages(spark, sf_dir).cache()
    day = F.date_format("received_at", "yyyy-MM-dd")
    later = F.col("event_id") % 7 == 0
    lake.write_raw(rows.where(~later | (day != "2024-01-03")), raw)
    score, seen = scorer(1)
    first = reprocess.reprocess(spark, raw, root, "v1", score, days_at_once=1, stop_after=2)
    assert first.computed == ("2024-01-02", "2024-01-03") and seen == [["2024-01-02"], ["2024-01-03"]]
    # A run that was cut off before its manifest row is not seen.
    cut = spark.createDataFrame([("x", "factory-a", 1)], "message_id string, factory_id string, score int")
    cut.write.parquet(f"{root}/results/version=v1/day=2024-01-04/run=cut/factory_id=factory-a/yyyy=2024/mm=01/dd=04")
    assert "2024-01-04" not in counts(reprocess.read_results(spark, root, "v1"))
    second = reprocess.reprocess(spark, raw, root, "v1", score)
    assert second.skipped == first.computed and second.computed[0] == "2024-01-04"
    done = files_of(f"{root}/results")
    third = reprocess.reprocess(spark, raw, root, "v1", score)
    assert third.computed == () and files_of(f"{root}/results") == done
    lake.write_raw(rows.where(later & (day == "2024-01-03")), raw)
    score, seen = scorer(1)
    assert reprocess.reprocess(spark, raw, root, "v1", score).computed == ("2024-01-03",) and seen == [["2024-01-03"]]
    assert {p: t for p, t in files_of(f"{root}/results").items() if p in done} == done
    assert counts(reprocess.read_results(spark, root, "v1")) == counts(rows.select(day.alias("day")))
    # Another version stands beside the first, in a range of its own.
    score, _ = scorer(2)
    assert reprocess.reprocess(spark, raw, root, "v2", score, "2024-01-03", "2024-01-04").computed == ("2024-01-03", "2024-01-04")
    both = reprocess.read_results(spark, root, "v1").join(reprocess.read_results(spark, root, "v2").select("message_id", F.col("score").alias("new")), "message_id")
    assert both.where("new <> 2 * score").count() == 0 and both.count() > 0
    plan = reprocess.read_results(spark, root, "v1", ["2024-01-04"])._jdf.queryExecution().executedPlan().toString()
    assert "day=2024-01-03" not in plan


def test_a_copy_counts_on_its_first_day(spark, sf_dir, tmp_path):
    raw, root = f"{tmp_path}/raw", f"{tmp_path}/out"
    rows = messages(spark, sf_dir, "2024-01-02", "2024-01-03").cache()
    copies = rows.withColumn("received_at", F.col("received_at") + F.expr("interval 49 hours"))
    lake.write_raw(copies, raw)
    score, _ = scorer(1)
    reprocess.reprocess(spark, raw, root, "v1", score)
    assert set(counts(reprocess.read_results(spark, root, "v1"))) == {"2024-01-04", "2024-01-05"} - ({"2024-01-05"} - set(counts(copies.select(F.date_format("received_at", "yyyy-MM-dd").alias("day")))))
    lake.write_raw(rows, raw)  # the originals turn up: the days of the copies lose them
    found = reprocess.reprocess(spark, raw, root, "v1", score)
    assert found.computed[0] == "2024-01-02" and "2024-01-04" in found.computed
    assert counts(reprocess.read_results(spark, root, "v1")) == counts(rows.select(F.date_format("received_at", "yyyy-MM-dd").alias("day")))
    assert reprocess.reprocess(spark, raw, root, "v1", score).computed == ()


def test_compaction_leaves_other_days_alone(spark, sf_dir, tmp_path):
    raw, root = f"{tmp_path}/raw", f"{tmp_path}/out"
    rows = messages(spark, sf_dir).cache()
    day = F.date_format("received_at", "yyyy-MM-dd")
    late = (F.col("event_id") % 5 == 0) & (day == "2024-01-04")
    lake.write_raw(rows.where(~late), raw)
    ids = lambda df: sorted(r.message_id for r in df.select("message_id").collect())
    assert upkeep.compact_days(spark, raw, root, ["2024-01-03"]) == ["2024-01-03"]
    assert ids(upkeep.read_archive(spark, raw, root)) == ids(rows.where(~late))
    assert "2024-01-03" not in upkeep.compact_days(spark, raw, root)
    done = files_of(f"{root}/results")
    lake.write_raw(rows.where(late), raw)
    assert ids(upkeep.read_archive(spark, raw, root)) == ids(rows)  # before the next compaction
    assert upkeep.compact_days(spark, raw, root) == ["2024-01-04"]
    assert {p: t for p, t in files_of(f"{root}/results").items() if p in done} == done
    assert ids(upkeep.read_archive(spark, raw, root)) == ids(rows)
    assert set(upkeep.removable_days(spark, raw, root)) == set(counts(rows.select(day.alias("day"))))
    assert ids(upkeep.read_archive(spark, f"{tmp_path}/none", root)) == ids(rows)  # small files gone
    assert upkeep.read_archive(spark, f"{tmp_path}/none", f"{tmp_path}/empty") is None


def test_dates_are_dropped_by_name(spark, sf_dir, tmp_path):
    from datetime import datetime

    root = f"{tmp_path}/history"
    rows = messages(spark, sf_dir).select("factory_id", "source_timestamp", "message_id").cache()
    lake.write_history_batch(rows, root, "INFRA", 7)
    lake.write_history_batch(rows, root, "INFRA", 7)  # run again: replaced
    assert lake.read_history_batches(spark, root, "INFRA").count() == rows.count()
    gone = lake.drop_dates(spark, f"{root}/INFRA", datetime(2024, 1, 4, 12))
    assert [g[-10:] for g in gone] == sorted({r.d for r in rows.select(F.date_format("source_timestamp", "yyyy-MM-dd").alias("d")).collect() if r.d < "2024-01-04"})
    left = lake.read_history_batches(spark, root, "INFRA", start=datetime(2024, 1, 5))
    assert left.count() == rows.where("source_timestamp >= '2024-01-05'").count()
    plan = left._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "date" in plan.split("PartitionFilters")[1][:200]
    with pytest.raises(ValueError):
        upkeep.compact_days(spark, root, root, days_at_once=0)
