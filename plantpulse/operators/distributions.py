"""Distributions that are kept as data, merged, and asked for exact percentiles.

A distribution is a table of (keys, stage, bin, n): how many measurements fell
on a value rounded to a fixed number of decimals. Such tables add up: hours make
days, days make months, and late hours can be added at any time. Percentiles
come from running counts over the bins in order. The bins of a key are cut into
slices; the totals of slices before give each slice its offset, so neither a map
of values nor an ordered list of one key is held by one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plantpulse.functions import clock

#: Bins that one slice spans.
SLICE_BINS = 4096


def histogram(df: DataFrame, keys: Sequence[str], stages: Mapping[str, Column], resolution: int = 3) -> DataFrame:
    """keys, stage, bin, n: measurements counted by value times 10 ** resolution; null is not counted."""
    scale = 10**resolution
    found = F.array(*[F.struct(F.lit(s).alias("stage"), F.round(c * scale).cast("long").alias("bin")) for s, c in stages.items()])
    rows = df.select(*keys, F.inline(found)).where("bin is not null")
    return rows.groupBy(*keys, "stage", "bin").agg(F.count(F.lit(1)).alias("n"))


def hourly_histogram(
    df: DataFrame, keys: Sequence[str], stages: Mapping[str, Column], ts: str, resolution: int = 3
) -> DataFrame:
    """A histogram per hour, with its `date` and `hour` to store it by."""
    hour = clock.bucket_start(ts, 3600)
    made = histogram(df.withColumn("hour", hour), [*keys, "hour"], stages, resolution)
    return made.withColumn("date", F.date_format("hour", "yyyy-MM-dd"))


def merged(histograms: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Any number of histograms as one."""
    return histograms.groupBy(*keys, "stage", "bin").agg(F.sum("n").alias("n"))


def _counted(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Bins with `_before` and `_upto`, the measurements below and up to them, and `_all`, those of the key."""
    own = [*keys, "stage"]
    sliced = counts.withColumn("_slice", F.floor(F.col("bin") / SLICE_BINS))
    totals = sliced.groupBy(*own, "_slice").agg(F.sum("n").alias("_own"))
    along = Window.partitionBy(*own).orderBy("_slice")
    offsets = totals.select(
        *own,
        "_slice",
        F.coalesce(F.sum("_own").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_offset"),
        F.sum("_own").over(Window.partitionBy(*own)).alias("_all"),
    )
    inside = Window.partitionBy(*own, "_slice").orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    joined = sliced.join(offsets, [*own, "_slice"])
    upto = F.col("_offset") + F.sum("n").over(inside)
    return joined.withColumn("_upto", upto).withColumn("_before", F.col("_upto") - F.col("n"))


def statistics(
    counts: DataFrame,
    keys: Sequence[str],
    percentiles: Mapping[str, float],
    shares: Mapping[str, tuple[float, float]] | None = None,
    resolution: int = 3,
) -> DataFrame:
    """Per keys and stage: messages, mean, max, exact percentiles, shares within closed ranges.

    `counts` has one row per bin (see `merged`). A percentile between two
    measurements is interpolated between them.
    """
    scale = float(10**resolution)
    value, n = F.col("bin") / F.lit(scale), F.col("n")
    total = F.sum("n")
    columns = []
    for name, p in percentiles.items():
        rank = F.lit(float(p)) * (F.col("_all") - 1)
        at = lambda k: (F.col("_before") <= k) & (k < F.col("_upto"))
        low, high = F.floor(rank), F.ceil(rank)
        # The lower neighbour's share and the upper one's; both are the same bin where the rank is whole.
        weight = F.when(at(low), low + 1 - rank).otherwise(0.0) + F.when(at(high) & (high > low), rank - low).otherwise(0.0)
        columns.append(F.sum(value * weight).alias(name))
    for name, (low, high) in (shares or {}).items():
        columns.append((F.sum(F.when(value.between(low, high), n).otherwise(0)) / total).alias(name))
    return _counted(counts, keys).groupBy(*keys, "stage").agg(
        total.alias("messages"), (F.sum(F.col("bin") * n) / total / scale).alias("mean"), F.max(value).alias("max"), *columns
    )
