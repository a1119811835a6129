"""Volume, rate, completeness, latency and reconciliation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantpulse.contract import Timing
from plantpulse.functions import clock
from plantpulse.operators import distributions

# Scores that differ by less are equal.
SCORE_NOISE = 1e-9


def payload_stats(df: DataFrame, body: str = "body", ts: str = "source_timestamp") -> DataFrame:
    """Message sizes and throughput per site and source type."""
    size = F.octet_length(body)
    elapsed = F.greatest(
        (F.unix_micros(F.max(ts)) - F.unix_micros(F.min(ts))) / F.lit(1000000), F.lit(1.0)
    )
    total = F.sum(size)
    return df.groupBy("factory_id", "source_type").agg(
        F.count(F.lit(1)).alias("messages"),
        total.alias("total_bytes"),
        F.avg(size).alias("mean_bytes"),
        F.max(size).cast("bigint").alias("max_bytes"),
        (total / F.lit(1000) / elapsed).alias("kb_per_second"),
        (total / F.lit(1000000) / elapsed * 86400).alias("mb_per_day"),
    )


def message_rate(df: DataFrame, window_seconds: int, ts: str = "received_at") -> DataFrame:
    """Messages per window, site and source type."""
    n = F.count(F.lit(1))
    return df.groupBy(
        "factory_id", "source_type", clock.bucket_start(ts, window_seconds).alias("window_start")
    ).agg(n.alias("messages"), (n / window_seconds).alias("per_second"))


def receive_success_rate(
    df: DataFrame, timing: Timing = Timing(), minimum_seconds: int = 600, ts: str = "source_timestamp"
) -> DataFrame:
    """Distinct messages received over those expected from the period.

    Copies are removed per (site, source type, message_id) first, so distinct
    ids of a busy site are spread over all tasks.
    """
    unique = df.groupBy("factory_id", "source_type", "message_id").agg(F.min(ts).alias("ts"))
    period = F.when(F.col("source_type") == "infra_state", timing.infra_period).otherwise(timing.factory_period)
    return (
        unique.groupBy("factory_id", "source_type")
        .agg(
            F.count(F.lit(1)).alias("received"),
            ((F.unix_micros(F.max("ts")) - F.unix_micros(F.min("ts"))) / F.lit(1000000)).alias("elapsed_seconds"),
        )
        .where(F.col("elapsed_seconds") >= minimum_seconds)
        .withColumn("expected", F.floor(F.col("elapsed_seconds") / period) + 1)
        .withColumn("success_rate", F.col("received") / F.col("expected"))
    )


def stage_delays(df: DataFrame, processed_at: str | None = None) -> dict[str, Column]:
    """Seconds spent in each stage of a message's way."""
    micros = lambda a, b: clock.age_seconds(F.col(b), F.col(a))
    out = {
        "source_to_publish": micros("source_timestamp", "published_at"),
        "publish_to_receive": micros("published_at", "received_at"),
        "source_to_receive": micros("source_timestamp", "received_at"),
    }
    if processed_at:
        out["source_to_processed"] = micros("source_timestamp", processed_at)
    return out


def latency_stats(
    df: DataFrame,
    keys: Sequence[str] = ("factory_id",),
    processed_at: str | None = None,
    timing: Timing = Timing(),
    resolution: int = 3,
) -> DataFrame:
    """avg, p50, p95, max per stage, and the shares inside the two targets.

    Delays become a histogram (to `resolution` decimals) before anything is
    gathered per key, and percentiles come from running counts over its bins.
    """
    counts = distributions.histogram(df, keys, stage_delays(df, processed_at), resolution)
    return delay_statistics(counts, keys, timing, resolution)


def delay_statistics(counts: DataFrame, keys: Sequence[str], timing: Timing = Timing(), resolution: int = 3) -> DataFrame:
    """The same from histograms, for instance from stored hours (`distributions.merged`)."""
    found = distributions.statistics(
        counts,
        keys,
        {"p50": 0.5, "p95": 0.95},
        {
            "share_normal_target": (timing.display_delay_from, timing.display_delay_to),
            "share_fault_target": (timing.detect_from, timing.detect_to),
        },
        resolution,
    )
    return found.withColumnsRenamed({"mean": "mean_delay", "max": "max_delay"})


def except_messages(a: DataFrame, b: DataFrame) -> DataFrame:
    """Ids in `a` that are not in `b`; copies fold before the shuffle."""
    return a.select("message_id").distinct().join(b.select("message_id").distinct(), "message_id", "left_anti")


def one_per_id(df: DataFrame, fields: Sequence[str], out: str) -> DataFrame:
    """One row per message_id, so that copies cannot multiply in a join.

    Copies fold in the map tasks, and the join that follows reuses the
    partitioning by message_id.
    """
    return df.groupBy("message_id").agg(F.min(F.struct(*fields)).alias(out))


def reconcile(raw: DataFrame, processed: DataFrame, compare: Sequence[str]) -> DataFrame:
    """Per message: missing, extra, differing or equal, over a full outer join."""
    left = one_per_id(raw, compare, "raw_values")
    right = one_per_id(processed, compare, "processed_values")
    same = F.col("raw_values").eqNullSafe(F.col("processed_values"))
    return left.join(right, "message_id", "full_outer").select(
        "message_id",
        F.when(F.col("processed_values").isNull(), "missing")
        .when(F.col("raw_values").isNull(), "extra")
        .when(~same, "differing")
        .otherwise("equal")
        .alias("outcome"),
    )


def compare_versions(a: DataFrame, b: DataFrame) -> DataFrame:
    """Two calculations of the same messages, side by side per site."""
    left = one_per_id(a, ("factory_id", "risk_score", "risk_level"), "a")
    right = one_per_id(b, ("risk_score", "risk_level"), "b")
    delta = F.col("b.risk_score") - F.col("a.risk_score")
    return (
        left.join(right, "message_id")
        .groupBy(F.col("a.factory_id").alias("factory_id"))
        .agg(
            F.count(F.lit(1)).alias("messages"),
            F.count_if(F.abs(delta) > SCORE_NOISE).alias("changed"),
            F.count_if(F.col("a.risk_level") != F.col("b.risk_level")).alias("level_changed"),
            F.avg(delta).alias("mean_delta"),
            F.max(F.abs(delta)).alias("max_abs_delta"),
        )
    )
