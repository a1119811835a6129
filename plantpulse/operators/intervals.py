"""Points in intervals as a hash join.

A condition `ts between start and end` alone tests every point of a key against
every interval of the key. Here time is cut into bins, an interval is listed in
the bins it touches, and points meet intervals of their own bin only. A point has
one bin per width, so no hit is found twice. The width follows the length of the
interval: intervals of about the same length form a level, whose bins are an
eighth to a quarter of that length, so an interval touches few bins and most
points of these bins lie inside it. Levels are few: their number is the logarithm
of longest to shortest length.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plantpulse.operators.sliced import fitting_seconds

# Rows of the densest key in one slice of `interval_summaries`.
SUMMARY_ROWS = 200_000
# An interval is cut into about this many bins.
PARTS = 4
SHORTEST_MICROS = 1000


def _level(start: Column, end: Column) -> Column:
    """Exponent of the bin width in microseconds (a power of two)."""
    length = F.greatest(end - start, F.lit(SHORTEST_MICROS * PARTS))
    return F.floor(F.log2(length.cast("double") / PARTS)).cast("int")


def _bin(micros: Column, level: Column) -> Column:
    return F.floor(micros / F.pow(F.lit(2.0), level)).cast("long")


def levels(intervals: DataFrame, start: str = "start", end: str = "end") -> list[int]:
    """Levels that occur: at most some forty small numbers reach the driver."""
    rows = intervals.select(_level(F.unix_micros(start), F.unix_micros(end)).alias("level"))
    return sorted(r.level for r in rows.where("level is not null").distinct().collect())


def binned_intervals(intervals: DataFrame, start: str = "start", end: str = "end") -> DataFrame:
    """Every interval once per bin it touches, with `_level` and `_bin`.

    Intervals without start or end, or that end before they start, touch none.
    """
    low, high = F.unix_micros(start), F.unix_micros(end)
    return (
        intervals.where(F.col(start) <= F.col(end))
        .withColumn("_level", _level(low, high))
        .withColumn("_bin", F.explode(F.sequence(_bin(low, F.col("_level")), _bin(high, F.col("_level")))))
    )


def binned_points(points: DataFrame, found: Sequence[int], ts: str = "ts") -> DataFrame:
    """Every point once per level."""
    level = F.explode(F.array(*[F.lit(x) for x in found])) if found else F.explode(F.array().cast("array<int>"))
    return points.withColumn("_level", level).withColumn("_bin", _bin(F.unix_micros(ts), F.col("_level")))


def interval_join(
    points: DataFrame, intervals: DataFrame, keys: Sequence[str], ts: str = "ts", start: str = "start", end: str = "end"
) -> DataFrame:
    """Points with the columns of every interval of equal keys that holds them, both ends included.

    Apart from the keys the two sides must not share column names.
    """
    right = binned_intervals(intervals, start, end)
    left = binned_points(points, levels(intervals, start, end), ts)
    on = [*keys, "_level", "_bin"]
    return left.join(right, on).where(F.col(ts).between(F.col(start), F.col(end))).drop("_level", "_bin")


def interval_summaries(
    points: DataFrame,
    intervals: DataFrame,
    keys: Sequence[str],
    by: Sequence[str],
    value: str,
    ts: str = "ts",
    start: str = "start",
    end: str = "end",
    slice_seconds: int | None = None,
) -> DataFrame:
    """What `interval_join` grouped by the interval columns `by` gives, without making its rows.

    -> by, `samples` (rows), `first_at`, `values` (values that are not null),
    `total` (their sum; values are finite). Hits grow with points times
    intervals; here both ends of an interval ask a running count and sum of the
    points, so the work grows with points plus intervals. Counts run inside
    time slices and along the slices, so no key is one task's; sums of slices
    that an interval only touches are not taken from the sum of all before,
    which would cost digits.
    """
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    whole = F.lit(True)
    for k in keys:
        whole &= F.col(k).isNotNull()
    points = points.where(whole & F.col(ts).isNotNull())
    intervals = intervals.where(whole & (F.col(start) <= F.col(end)))
    if slice_seconds is None:
        moments = points.select(*keys, F.col(ts).cast("timestamp").alias("_ts"))
        for c in (start, end):
            moments = moments.unionByName(intervals.select(*keys, F.col(c).cast("timestamp").alias("_ts")))
        slice_seconds = fitting_seconds(moments, keys, "_ts", SUMMARY_ROWS)
    in_slice = lambda c: F.floor(F.col(c) / F.lit(slice_seconds * 1_000_000))
    # At one time starts come before points and ends after them.
    at = (
        points.select(*keys, micros(ts).alias("_at"), F.col(value).cast("double").alias("_v"))
        .groupBy(*keys, "_at")
        .agg(F.count(F.lit(1)).alias("_n"), F.count("_v").alias("_c"), F.sum("_v").alias("_s"))
        .withColumn("_side", F.lit(1))
    )
    named = list(dict.fromkeys([*keys, *by]))
    ends = intervals.select(*named, micros(start).alias("_low"), micros(end).alias("_high")).select(
        *named, "_low", "_high", F.inline(F.array(*[F.struct(F.col(c).alias("_at"), F.lit(side).alias("_side")) for c, side in (("_low", 0), ("_high", 2))]))
    )
    both = at.unionByName(ends, allowMissingColumns=True).withColumn("_slice", in_slice("_at"))
    point_at = F.when(F.col("_side") == 1, F.col("_at"))
    slices = both.groupBy(*keys, "_slice").agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(f"{c}_all") for c in ("_n", "_c", "_s")], F.min(point_at).alias("_first")
    )
    along = Window.partitionBy(*keys).orderBy("_slice")
    before, through = (along.rowsBetween(Window.unboundedPreceding, n) for n in (-1, 0))
    later = Window.partitionBy(*keys).orderBy(F.desc("_slice")).rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.select(
        *keys,
        "_slice",
        "_s_all",
        *[F.coalesce(F.sum(f"{c}_all").over(before), F.lit(0)).alias(f"{c}_before") for c in ("_n", "_c", "_s")],
        F.sum("_s_all").over(through).alias("_s_through"),
        F.min("_first").over(later).alias("_later"),
    )
    inside = Window.partitionBy(*keys, "_slice")
    upwards, downwards = inside.orderBy("_at", "_side"), inside.orderBy(F.desc("_at"), F.desc("_side"))
    running = lambda w: w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    asked = (
        both.select(
            "*",
            *[F.coalesce(F.sum(c).over(running(upwards)), F.lit(0)).alias(f"{c}_run") for c in ("_n", "_c", "_s")],
            F.min(point_at).over(running(downwards)).alias("_next"),
        )
        .where("_side <> 1")
        .join(slices, [*keys, "_slice"])
    )
    is_start = F.col("_side") == 0
    one_slice = F.col("_slice") == in_slice("_high")
    signed = lambda c: F.when(is_start, -c).otherwise(c)
    near = F.when(is_start & ~one_slice, F.col("_s_all") - F.col("_s_run")).otherwise(signed(F.col("_s_run")))
    far = F.when(is_start & ~one_slice, -F.col("_s_through")).otherwise(signed(F.col("_s_before")))
    first = F.coalesce("_next", "_later")
    found = asked.groupBy(*by).agg(
        F.sum(signed(F.col("_n_before") + F.col("_n_run"))).alias("samples"),
        F.min(F.when(is_start & (first <= F.col("_high")), F.timestamp_micros(first))).alias("first_at"),
        F.sum(signed(F.col("_c_before") + F.col("_c_run"))).alias("values"),
        (F.sum(near) + F.sum(far)).alias("total"),
    )
    return found.where("samples > 0")
