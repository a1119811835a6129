"""Failover drills: phases, durations, verdicts, gaps."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plantpulse.contract import Timing
from plantpulse.functions import clock
from plantpulse.operators import gaps
from plantpulse.operators.intervals import interval_join, interval_summaries

TEST_KEYS = ("test_id", "factory_id", "target_node", "start", "end")
PHASES = ("fault_seen_at", "not_ready_at", "on_failover_at", "ready_again_at", "on_preferred_at")


def phase_join(
    samples: DataFrame, tests: DataFrame, ts: str = "ts", by: Sequence[str] | None = None, value: str | None = None
) -> DataFrame:
    """Samples inside a test interval: equal site, time within [start, end].

    Samples meet the tests of their own time bin, so many tests of a site cost
    little more than the hits they find. With `by`, columns of the tests, the
    hits are not made: each group of tests gets its samples, first_at, values
    and the total of `value` (see `interval_summaries`).
    """
    if by is not None:
        return interval_summaries(samples, tests, ["factory_id"], by, value, ts)
    return interval_join(samples, tests, ["factory_id"], ts)


def with_nodes(df: DataFrame, nodes: DataFrame | None, preferred: str, failover: str) -> DataFrame:
    """preferred_node and failover_node of each row's site; a site without its own gets the given ones."""
    if nodes is None:
        return df.withColumns({"preferred_node": F.lit(preferred), "failover_node": F.lit(failover)})
    own = nodes.select("factory_id", F.col("preferred_node").alias("_p"), F.col("failover_node").alias("_f"))
    return df.join(own, "factory_id", "left").select(
        *df.columns,
        F.coalesce("_p", F.lit(preferred)).alias("preferred_node"),
        F.coalesce("_f", F.lit(failover)).alias("failover_node"),
    )


def _targets(observed: DataFrame) -> DataFrame:
    """One row per test, observation time and target, however often it was observed."""
    runs_on = lambda node: (F.col("pod_status") == "Running") & (F.col("pod_node") == F.col(node))
    return observed.groupBy(*TEST_KEYS, "ts", "pod").agg(
        F.bool_and("ready").alias("ready"),
        F.bool_or(runs_on("failover_node")).alias("on_failover"),
        F.bool_or(runs_on("preferred_node")).alias("on_preferred"),
    )


def _moments(observed: DataFrame) -> DataFrame:
    """One row per test and observation time: node state and where targets run."""
    return _targets(observed).groupBy(*TEST_KEYS, "ts").agg(
        F.bool_and("ready").alias("ready"),
        F.count(F.lit(1)).alias("targets"),
        F.count_if("on_failover").alias("on_failover"),
        F.count_if("on_preferred").alias("on_preferred"),
    )


def failover_timeline(
    observations: DataFrame,
    tests: DataFrame,
    preferred: str = "worker2",
    failover: str = "worker1",
    nodes: DataFrame | None = None,
) -> DataFrame:
    """When each phase of a drill was first seen, each after the one before.

    fault first seen -> node not ready -> all targets on the failover node ->
    node ready -> all targets back.  A phase never seen leaves null, and so do
    the phases after it. `nodes` has preferred_node and failover_node per site.

    Observations are folded to one row per test and moment, then "phase
    reached by now" is a chain of running maxima over one ordering: one scan
    and one sort for all phases.  A drill lasts minutes, so its moments are few.
    """
    moments = _moments(with_nodes(phase_join(observations, tests), nodes, preferred, failover))
    conditions = {
        "fault_seen_at": ~F.col("ready") | (F.col("on_preferred") < F.col("targets")),
        "not_ready_at": ~F.col("ready"),
        "on_failover_at": F.col("on_failover") == F.col("targets"),
        "ready_again_at": F.col("ready"),
        "on_preferred_at": F.col("on_preferred") == F.col("targets"),
    }
    so_far = Window.partitionBy("test_id").orderBy("ts").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    reached, steps = F.lit(True), moments
    for phase in PHASES:
        steps = steps.withColumn(phase, F.max(conditions[phase] & reached).over(so_far))
        reached = F.col(phase)
    first = steps.groupBy("test_id").agg(*[F.min(F.when(F.col(p), F.col("ts"))).alias(p) for p in PHASES])
    return tests.join(first, "test_id", "left")


def phase_durations(timeline: DataFrame) -> DataFrame:
    """Seconds between the phases of each drill."""
    between = lambda a, b: clock.age_seconds(F.col(b), F.col(a))
    return timeline.select(
        "test_id",
        "factory_id",
        between("fault_seen_at", "not_ready_at").alias("detect_seconds"),
        between("not_ready_at", "on_failover_at").alias("failover_seconds"),
        between("fault_seen_at", "on_failover_at").alias("outage_seconds"),
        between("ready_again_at", "on_preferred_at").alias("failback_seconds"),
        between("fault_seen_at", "on_preferred_at").alias("total_seconds"),
    )


def holdoff_filter(samples_in_tests: DataFrame, timing: Timing = Timing(), ts: str = "ts") -> DataFrame:
    """Drop what was seen in the first five minutes of a drill."""
    return samples_in_tests.where(clock.age_seconds(F.col(ts), F.col("start")) >= timing.holdoff)


def failover_verdict(
    observations: DataFrame,
    tests: DataFrame,
    expected_node: str = "worker1",
    timing: Timing = Timing(),
    nodes: DataFrame | None = None,
) -> DataFrame:
    """Success if, after the hold-off, all targets of the site ran on its expected node at once.

    The targets of a drill are the distinct ones observed in it; the expected
    node is the failover node of the site in `nodes`, else `expected_node`.
    """
    inside = with_nodes(phase_join(observations, tests), nodes, expected_node, expected_node)
    known = inside.select("test_id", "pod").distinct().groupBy("test_id").agg(F.count(F.lit(1)).alias("targets"))
    moments = _targets(holdoff_filter(inside, timing)).groupBy("test_id", "ts").agg(F.count_if("on_failover").alias("placed"))
    good = moments.join(known, "test_id").groupBy("test_id").agg(
        F.count(F.lit(1)).alias("moments"), F.count_if(F.col("placed") == F.col("targets")).alias("good_moments")
    )
    return tests.select("test_id", "factory_id", "test_type").join(good, "test_id", "left").select(
        "test_id",
        "factory_id",
        "test_type",
        F.coalesce("moments", F.lit(0)).alias("moments"),
        F.coalesce("good_moments", F.lit(0)).alias("good_moments"),
        (F.coalesce("good_moments", F.lit(0)) > 0).alias("success"),
    )


def first_data_after(samples: DataFrame, timeline: DataFrame, phase: str, measurement: str) -> DataFrame:
    """First sample of a measurement at or after a phase of each drill."""
    asked = timeline.select("test_id", "factory_id", F.col(phase).alias("phase_at"), "end").where(
        F.col("phase_at").isNotNull()
    )
    hits = interval_join(samples, asked, ["factory_id"], start="phase_at")
    return hits.groupBy("test_id", "phase_at").agg(F.min("ts").alias("first_data_at")).select(
        "test_id",
        F.lit(measurement).alias("measurement"),
        "phase_at",
        "first_data_at",
        clock.age_seconds("first_data_at", "phase_at").alias("wait_seconds"),
    )


def gap_report(
    measurements: dict[str, tuple[DataFrame, str]], tests: DataFrame, intervals: Sequence[int]
) -> DataFrame:
    """Longest empty run per drill, measurement and bucket width.

    One join and one pass over the samples find the occupied buckets of the
    finest common width; all asked widths are folded up from those.
    """
    unit = math.gcd(*intervals)
    names = list(measurements)
    samples = [
        df.select("factory_id", "ts", F.lit(name).alias("measurement"), F.col(value).cast("double").alias("value"))
        for name, (df, value) in measurements.items()
    ]
    union = samples[0]
    for more in samples[1:]:
        union = union.unionByName(more)
    keys = ["test_id", "measurement"]
    occupied = gaps.distinct_buckets(phase_join(union, tests), keys, "value", unit)
    bounds = tests.select(
        "test_id", F.explode(F.array(*[F.lit(n) for n in names])).alias("measurement"), "start", "end"
    )
    return gaps.max_empty_by_width(occupied, bounds, keys, unit, intervals)


def failover_sla(durations: DataFrame, timing: Timing = Timing()) -> DataFrame:
    """Resumed in time, and detected within the expected span."""
    def met(value: Column, low: int, high: int) -> Column:
        return F.coalesce(value.between(low, high), F.lit(False))

    return durations.select(
        "test_id",
        "factory_id",
        "outage_seconds",
        "detect_seconds",
        met(F.col("outage_seconds"), 0, timing.failover_within).alias("resumed_in_time"),
        met(F.col("detect_seconds"), timing.detect_from, timing.detect_to).alias("detected_in_span"),
        met(F.col("detect_seconds"), 0, timing.detect_to).alias("detected_in_time"),
    )

