"""Empty buckets by arithmetic between neighbouring occupied ones.

No empty bucket is ever made into a row. A series is cut into slices of CHUNK
buckets; each slice becomes one row with its occupied bucket numbers (at most
CHUNK of them, gathered with map-side combine). Gaps inside a slice follow from
that array, gaps between slices from the last number of one and the first of
the next. Two numbers stand just outside the range of a series, so that empty
time before its first and after its last occupied bucket counts as well. The
cost is one row per slice that holds data, however long or fine the range is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plantpulse.functions import clock

# Occupied buckets that one array may hold.
CHUNK = 4096


def bucket_number(ts, interval_seconds: int | Column) -> Column:
    """Number of the epoch-aligned bucket that a time lies in."""
    step = interval_seconds if isinstance(interval_seconds, Column) else F.lit(interval_seconds)
    return F.floor(F.unix_micros(ts) / (step * F.lit(1000000))).cast("long")


def number_range(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """lo and hi of the bucket numbers `n` of every series."""
    return df.groupBy(*keys).agg(F.min("n").alias("lo"), F.max("n").alias("hi"))


def slices(occupied: DataFrame, ranges: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per series and slice the ordered numbers `n`, and whether `found` holds more than the range's ends.

    `occupied` has keys and n; `ranges` has keys, lo and hi, all inclusive.
    """
    ends = ranges.select(*keys, F.explode(F.array(F.col("lo") - 1, F.col("hi") + 1)).alias("n"))
    both = occupied.select(*keys, "n").unionByName(ends)
    return (
        both.groupBy(*keys, F.floor(F.col("n") / CHUNK).alias("_slice"))
        .agg(F.sort_array(F.collect_set("n")).alias("_numbers"))
    )


def gaps(occupied: DataFrame, ranges: DataFrame, keys: Sequence[str]) -> DataFrame:
    """keys, after, before: neighbouring numbers with empty buckets between them."""
    along = Window.partitionBy(*keys).orderBy("_slice")
    last = F.element_at("_numbers", -1)
    linked = slices(occupied, ranges, keys).withColumn("_last", F.lag(last).over(along))
    numbers = F.when(F.col("_last").isNull(), F.col("_numbers")).otherwise(
        F.concat(F.array("_last"), F.col("_numbers"))
    )
    left = F.slice(numbers, F.lit(1), F.size(numbers) - 1)
    right = F.slice(numbers, F.lit(2), F.size(numbers) - 1)
    pairs = F.zip_with(left, right, lambda a, b: F.struct(a.alias("after"), b.alias("before")))
    return linked.select(*keys, F.inline(F.filter(pairs, lambda p: p.before - p.after > 1)))


def _numbered(df: DataFrame, keys: Sequence[str], value: str, interval_seconds: int, bounds, ts: str):
    """(occupied, ranges) of a table of samples."""
    rows = df.select(*keys, bucket_number(ts, interval_seconds).alias("n"), F.col(value).isNotNull().alias("_filled"))
    if bounds is None:
        ranges = number_range(rows, keys)
    else:
        ranges = bounds.select(
            *keys,
            bucket_number("start", interval_seconds).alias("lo"),
            bucket_number("end", interval_seconds).alias("hi"),
        )
    return rows.where("_filled"), ranges


def gap_islands(
    df: DataFrame, keys: Sequence[str], value: str, interval_seconds: int, bounds: DataFrame | None = None, ts: str = "ts"
) -> DataFrame:
    """Runs of buckets without a value: start, end (exclusive), count, seconds.

    The range of a series is that of its rows, with or without value, or `start`
    and `end` of `bounds`.
    """
    at = lambda n: F.timestamp_seconds(n * interval_seconds)
    empty = F.col("before") - F.col("after") - 1
    return gaps(*_numbered(df, keys, value, interval_seconds, bounds, ts), keys).select(
        *keys,
        at(F.col("after") + 1).alias("gap_start"),
        at(F.col("before")).alias("gap_end"),
        empty.alias("empty_buckets"),
        (empty * interval_seconds).alias("gap_seconds"),
    )


def gap_totals(occupied: DataFrame, ranges: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per series: buckets in its range, empty ones, longest run of empty ones.

    One row per slice carries its own sums; what follows the one shuffle of the
    samples is small.
    """
    along = Window.partitionBy(*keys).orderBy("_slice")
    numbers, last = F.col("_numbers"), F.element_at("_numbers", -1)
    left = F.slice(numbers, F.lit(1), F.size(numbers) - 1)
    right = F.slice(numbers, F.lit(2), F.size(numbers) - 1)
    between = F.col("_first") - F.lag("_final").over(along) - 1
    per_slice = slices(occupied, ranges, keys).select(
        *keys,
        "_slice",
        F.element_at("_numbers", 1).alias("_first"),
        last.alias("_final"),
        F.size(numbers).cast("long").alias("_held"),
        F.coalesce(F.array_max(F.zip_with(left, right, lambda a, b: b - a - 1)), F.lit(0)).alias("_inside"),
    )
    return (
        per_slice.withColumn("_gap", F.greatest("_inside", F.coalesce(between, F.lit(0))))
        .groupBy(*keys)
        .agg(
            (F.max("_final") - F.min("_first") - 1).alias("buckets"),
            (F.max("_final") - F.min("_first") + 1 - F.sum("_held")).alias("empty"),
            F.max("_gap").alias("longest"),
        )
    )


def max_empty_seconds(
    df: DataFrame, keys: Sequence[str], value: str, interval_seconds: int, bounds: DataFrame | None = None, ts: str = "ts"
) -> DataFrame:
    """Buckets and longest empty run per series, 0 if there is none."""
    totals = gap_totals(*_numbered(df, keys, value, interval_seconds, bounds, ts), keys)
    return totals.select(*keys, "buckets", (F.col("longest") * interval_seconds).alias("max_empty_seconds"))


def missing_buckets(
    df: DataFrame, keys: Sequence[str], value: str, interval_seconds: int, bounds: DataFrame | None = None, ts: str = "ts"
) -> DataFrame:
    """Expected and missing buckets per series."""
    totals = gap_totals(*_numbered(df, keys, value, interval_seconds, bounds, ts), keys)
    return totals.select(*keys, F.col("buckets").alias("expected"), F.col("empty").alias("missing"))


def empty_seconds_by_day(df: DataFrame, keys: Sequence[str], value: str, interval_seconds: int, ts: str = "ts") -> DataFrame:
    """Empty time per series and day, days without any left out: gaps are cut at midnight.

    `day` is the day that a bucket starts in.
    """
    found = gaps(*_numbered(df, keys, value, interval_seconds, None, ts), keys)
    first, end = (F.col("after") + 1) * interval_seconds, F.col("before") * interval_seconds
    day = 86400
    days = F.sequence(F.floor(first / day), F.floor((end - interval_seconds) / day))
    # Buckets that start inside [a, b): their number is a difference of ceilings.
    inside = F.ceil(F.least(F.col("_end"), (F.col("_day") + 1) * day) / interval_seconds) - F.ceil(
        F.greatest(F.col("_first"), F.col("_day") * day) / interval_seconds
    )
    return (
        found.select(*keys, first.alias("_first"), end.alias("_end"), F.explode(days).alias("_day"))
        .groupBy(*keys, F.date_format(F.timestamp_seconds(F.col("_day") * day), "yyyy-MM-dd").alias("day"))
        .agg((F.sum(inside) * interval_seconds).alias("empty_seconds"))
    )


def max_empty_by_width(
    occupied: DataFrame, bounds: DataFrame, keys: Sequence[str], unit_seconds: int, intervals: Sequence[int]
) -> DataFrame:
    """Longest empty run for several bucket widths, folded up from one pass.

    `occupied` has keys and the occupied bucket numbers `n` of width
    `unit_seconds`, which divides every interval; `bounds` has keys, start, end.
    A coarser bucket is occupied if one of its parts is.
    """
    bad = [i for i in intervals if i % unit_seconds]
    if bad:
        raise ValueError(f"not multiples of {unit_seconds}: {bad}")
    width = F.explode(F.array(*[F.lit(i) for i in intervals])).alias("bucket_seconds")
    wide = [*keys, "bucket_seconds"]
    coarse = occupied.select(*keys, "n", width).select(
        *wide, F.floor(F.col("n") * unit_seconds / F.col("bucket_seconds")).alias("n")
    )
    ranges = bounds.select(*keys, "start", "end", width).select(
        *wide,
        bucket_number("start", F.col("bucket_seconds")).alias("lo"),
        bucket_number("end", F.col("bucket_seconds")).alias("hi"),
    )
    return gap_totals(coarse, ranges, wide).select(
        *wide, "buckets", (F.col("longest") * F.col("bucket_seconds")).alias("max_empty_seconds")
    )


def distinct_buckets(df: DataFrame, keys: Sequence[str], value: str, interval_seconds: int, ts: str = "ts") -> DataFrame:
    """keys and the numbers of the buckets that hold a value, once each."""
    rows = df.where(F.col(value).isNotNull())
    return rows.select(*keys, bucket_number(ts, interval_seconds).alias("n")).distinct()


__all__ = [
    "bucket_number",
    "distinct_buckets",
    "empty_seconds_by_day",
    "gap_islands",
    "gap_totals",
    "gaps",
    "max_empty_by_width",
    "max_empty_seconds",
    "missing_buckets",
]
