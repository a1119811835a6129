"""Metric samples (`up` series) and node resource use."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantpulse import contract as C
from plantpulse.functions import clock, rules

LABELS = ("cluster", "job", "instance")


def _labelled(samples: DataFrame, metric: str, cluster: str | None) -> DataFrame:
    rows = samples.where(F.col("metric") == metric).select(
        *[F.col("labels")[n].alias(n) for n in LABELS], "ts", "value"
    )
    return rows if cluster is None else rows.where(F.col("cluster") == cluster)


# An instant query sees no sample older than this.
LOOKBACK_SECONDS = 300


def ended(value: Column) -> Column:
    """The end-of-series marker: a sample without a number."""
    return value.isNull() | F.isnan(value)


def values_at(
    samples: DataFrame, as_of_time, cluster: str | None = None, metric: str = "up", lookback_seconds: int = LOOKBACK_SECONDS
) -> DataFrame:
    """The value of every live series at one moment: its newest sample within the look-back.

    A series whose newest sample is older, or is an end-of-series marker, is gone.
    """
    now = clock.as_timestamp(as_of_time)
    seen = _labelled(samples, metric, cluster).where(
        (F.col("ts") <= now) & (F.col("ts") > clock.plus_seconds(now, -lookback_seconds))
    )
    newest = seen.groupBy(*LABELS).agg(F.max_by("value", F.struct("ts", ended(F.col("value")))).alias("value"))
    return newest.where(~ended(F.col("value")))


def values_at_steps(
    samples: DataFrame, step_seconds: int, cluster: str | None = None, metric: str = "up", lookback_seconds: int = LOOKBACK_SECONDS
) -> DataFrame:
    """What an instant query would see at every step, per label set.

    A sample answers the steps from its own time until the look-back has passed,
    unless a newer one does. The newest sample between two steps stands for all
    others there, so it alone is listed on the few steps it can answer; then the
    newest per step wins. Both reductions combine in the map tasks, and no grid
    of all steps is made.
    """
    step, reach = step_seconds * 1000000, lookback_seconds * 1000000
    micros = F.unix_micros("ts")
    newest = F.struct(F.col("ts"), ended(F.col("value")))
    first = F.ceil(micros / step).cast("long")
    per_step = (
        _labelled(samples, metric, cluster)
        .withColumn("_first", first)
        .groupBy(*LABELS, "_first")
        .agg(F.max_by(F.struct("ts", "value"), newest).alias("_s"))
    )
    # Strictly younger than the look-back at the last step.
    last = F.ceil((F.unix_micros("_s.ts") + reach) / step).cast("long") - 1
    listed = per_step.where(last >= F.col("_first")).select(
        *LABELS, F.explode(F.sequence("_first", last)).alias("_n"), F.col("_s.ts").alias("ts"), F.col("_s.value").alias("value")
    )
    return (
        listed.groupBy(*LABELS, "_n")
        .agg(F.max_by("value", newest).alias("value"))
        .where(~ended(F.col("value")))
        .select(*LABELS, F.timestamp_micros(F.col("_n") * step).alias("step"), "value")
    )


def up_target_count(
    samples: DataFrame, as_of_time, cluster: str | None = None, metric: str = "up", lookback_seconds: int = LOOKBACK_SECONDS
) -> DataFrame:
    """Live targets at `as_of_time` and those whose sample is 1, per cluster."""
    newest = values_at(samples, as_of_time, cluster, metric, lookback_seconds)
    return newest.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("targets"), F.count_if(F.col("value") == 1).alias("up_targets")
    )


def up_series(samples: DataFrame, step_seconds: int, cluster: str | None = None, metric: str = "up") -> DataFrame:
    """Last sample per step and label set."""
    return (
        _labelled(samples, metric, cluster)
        .groupBy(*LABELS, clock.bucket_start("ts", step_seconds).alias("step"))
        .agg(F.max_by("value", "ts").alias("value"))
    )


def node_rows(infra: DataFrame) -> DataFrame:
    """One row per node and infra message."""
    return infra.select("factory_id", F.col("source_timestamp").alias("ts"), "event_id", F.inline("nodes"))


def resource_usage_stats(nodes: DataFrame, limit: float = C.RESOURCE_WARNING_FROM) -> DataFrame:
    """Mean and peak use per node, and how often a limit was reached."""
    metrics = ("cpu", "memory", "disk")
    aggs = [F.count(F.lit(1)).alias("samples")]
    for m in metrics:
        value = F.col(f"{m}_usage_percent")
        aggs += [F.avg(value).alias(f"{m}_mean"), F.max(value).alias(f"{m}_peak")]
    over = F.greatest(*[F.col(f"{m}_usage_percent") for m in metrics]) >= limit
    return nodes.groupBy("factory_id", "node_id").agg(*aggs, F.count_if(over).alias("over_limit"))


def with_resource_bands(nodes: DataFrame) -> DataFrame:
    for m in ("cpu", "memory", "disk"):
        nodes = nodes.withColumn(f"{m}_band", rules.resource_band(F.col(f"{m}_usage_percent")))
    return nodes
