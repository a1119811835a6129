"""Ordered-series primitives that never put a whole series into one task.

One site may hold a third of all rows, so a window partitioned by site alone
would run that third in a single task.  A series is therefore cut into time
slices, and windows are partitioned by (keys, slice).  What a slice needs from
before its start is carried over in a small context relation: the last rows
(or last known values) of each slice, a few rows per slice, taken with map-side
pre-selection.  The context rows are unioned with the data before the one
shuffle on (keys, slice), so no join and no second shuffle of the data is
needed.  `fitting_seconds` takes the width from the data, so that one slice of
the busiest series fits a task; the result does not depend on it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

SLICE = "_slice"
CONTEXT = "_context"


@dataclass(frozen=True)
class Series:
    """Rows with equal `keys`, ordered by `order` (first column: a timestamp)."""

    keys: tuple[str, ...]
    order: tuple[str, ...]
    slice_seconds: int = 3600

    @property
    def ts(self) -> str:
        return self.order[0]

    def slice_column(self) -> Column:
        return F.floor(F.unix_seconds(self.ts) / self.slice_seconds)

    def window(self) -> WindowSpec:
        """Within one slice, context rows first."""
        return Window.partitionBy(*self.keys, SLICE).orderBy(F.col(CONTEXT).desc(), *self.order)


def fitting_seconds(df: DataFrame, keys: Sequence[str], ts: str, rows: int = 2_000_000) -> int:
    """Slice width at which the densest minute of any series gives about `rows` rows a slice.

    Between a minute and a week.  One count per series and minute, with map-side
    combine; a single number reaches the driver.
    """
    minutes = df.groupBy(*keys, F.floor(F.unix_seconds(ts) / 60).alias("_minute")).count()
    densest = minutes.agg(F.max("count")).first()[0] or 1
    return max(60, min(7 * 86400, 60 * rows // densest))


def _with_slice(df: DataFrame, series: Series) -> DataFrame:
    return df.withColumn(SLICE, series.slice_column())


def with_lookback(df: DataFrame, series: Series, columns: Sequence[str], rows: int = 1) -> DataFrame:
    """Add to every slice the `rows` rows that precede it in its series.

    Added rows carry keys, order and `columns`; CONTEXT marks them.
    """
    carried = [*series.order, *[c for c in columns if c not in series.order and c not in series.keys]]
    sliced = _with_slice(df, series)
    newest_first = Window.partitionBy(*series.keys, SLICE).orderBy(*[F.col(c).desc() for c in series.order])
    tails = (
        sliced.select(*series.keys, SLICE, *carried)
        .withColumn("_back", F.row_number().over(newest_first))
        .where(F.col("_back") <= rows)
    )
    across = Window.partitionBy(*series.keys).orderBy(*series.order)
    context = (
        tails.select(
            *series.keys,
            SLICE,
            F.collect_list(F.struct(*carried)).over(across.rowsBetween(-rows, -1)).alias("_rows"),
            F.lag(SLICE).over(across).alias("_slice_before"),
        )
        .where(~F.col(SLICE).eqNullSafe(F.col("_slice_before")))
        .select(*series.keys, SLICE, F.inline("_rows"), F.lit(True).alias(CONTEXT))
    )
    return sliced.withColumn(CONTEXT, F.lit(False)).unionByName(context, allowMissingColumns=True)


def over_rows(
    df: DataFrame,
    series: Series,
    columns: Sequence[str],
    make: Callable[[WindowSpec], dict[str, Column]],
    rows: int = 1,
) -> DataFrame:
    """Evaluate row-frame window expressions that look back at most `rows`."""
    exprs = make(series.window())
    return (
        with_lookback(df, series, columns, rows)
        .select("*", *[e.alias(n) for n, e in exprs.items()])
        .where(~F.col(CONTEXT))
        .drop(CONTEXT, SLICE)
    )


def with_previous(df: DataFrame, series: Series, columns: Sequence[str], prefix: str = "prev_") -> DataFrame:
    """The same columns of the previous row of the series (null on the first)."""
    return over_rows(df, series, columns, lambda w: {f"{prefix}{c}": F.lag(c).over(w) for c in columns})


def fill_forward(df: DataFrame, series: Series, columns: Sequence[str]) -> DataFrame:
    """Replace nulls by the last non-null value at or before the row."""
    sliced = _with_slice(df, series)
    position = F.struct(*series.order)
    tails = sliced.groupBy(*series.keys, SLICE).agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), position)).alias(c) for c in columns]
    )
    before = Window.partitionBy(*series.keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    context = tails.select(
        *series.keys,
        SLICE,
        *[F.last(c, ignorenulls=True).over(before).alias(c) for c in columns],
        F.lit(True).alias(CONTEXT),
    )
    w = series.window().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    filled = {c: F.last(c, ignorenulls=True).over(w) for c in columns}
    return (
        sliced.withColumn(CONTEXT, F.lit(False))
        .unionByName(context, allowMissingColumns=True)
        .select(*[filled[c].alias(c) if c in filled else F.col(c) for c in df.columns], CONTEXT)
        .where(~F.col(CONTEXT))
        .drop(CONTEXT)
    )


def state_runs(
    df: DataFrame, series: Series, state: str | None = None, max_gap_seconds: float | None = None
) -> DataFrame:
    """Maximal runs of consecutive rows with equal `state`, no gap above the limit.

    -> keys, [state], run_start, run_end, row_count.  Runs are found inside
    each slice; only the first and last run of a slice can continue elsewhere,
    so just those (two rows per slice) are stitched along the series.
    """
    keys, tags = list(series.keys), [state] if state else []

    def continues(w: WindowSpec, start: str, end: str) -> Column:
        same = F.lag(F.lit(1)).over(w).isNotNull()
        if state:
            same &= F.col(state).eqNullSafe(F.lag(state).over(w))
        if max_gap_seconds is not None:
            gap = F.unix_micros(start) - F.unix_micros(F.lag(end).over(w))
            same &= F.coalesce(gap <= int(max_gap_seconds * 1000000), F.lit(False))
        return same

    w = Window.partitionBy(*keys, SLICE).orderBy(*series.order)
    pieces = (
        _with_slice(df.select(*keys, *series.order, *tags), series)
        .withColumn("_step", F.when(continues(w, series.ts, series.ts), 0).otherwise(1))
        .withColumn("_run", F.sum("_step").over(w))
        .groupBy(*keys, SLICE, "_run", *tags)
        .agg(
            F.min(series.ts).alias("run_start"),
            F.max(series.ts).alias("run_end"),
            F.count(F.lit(1)).alias("row_count"),
        )
        .withColumn("_runs", F.max("_run").over(Window.partitionBy(*keys, SLICE)))
    )
    edge = (F.col("_run") == 1) | (F.col("_run") == F.col("_runs"))
    out = [*keys, *tags, "run_start", "run_end", "row_count"]
    inner = pieces.where(~edge).select(*out)
    along = Window.partitionBy(*keys).orderBy(SLICE, "_run")
    joins = continues(along, "run_start", "run_end") & (F.lag(SLICE).over(along) < F.col(SLICE))
    stitched = (
        pieces.where(edge)
        .withColumn("_new", F.when(joins, 0).otherwise(1))
        .withColumn("_chain", F.sum("_new").over(along))
        .groupBy(*keys, "_chain", *tags)
        .agg(
            F.min("run_start").alias("run_start"),
            F.max("run_end").alias("run_end"),
            F.sum("row_count").alias("row_count"),
        )
        .select(*out)
    )
    return inner.unionByName(stitched)


def as_of(
    left: DataFrame,
    right: DataFrame,
    series: Series,
    value: str,
    *,
    left_time: Column | None = None,
) -> DataFrame:
    """Give every left row the newest `right` value at or before its time.

    `right` has the series columns and the struct column `value`.  One union
    and one sliced fill replace a non-equi join.  At equal time the right row
    comes first.  `left_time` shifts the moment a left row asks about.
    """
    ts, rest = series.ts, series.order[1:]
    questions = left.withColumn("_side", F.lit(1))
    if left_time is not None:
        questions = questions.withColumn("_own_time", F.col(ts)).withColumn(ts, left_time)
    answers = right.select(*series.keys, ts, *rest, F.lit(0).alias("_side"), value)
    # Left columns stay at top level, so that unused ones are pruned.
    both = questions.unionByName(answers, allowMissingColumns=True)
    sided = Series(series.keys, (ts, "_side", *rest), series.slice_seconds)
    out = fill_forward(both, sided, [value]).where(F.col("_side") == 1)
    if left_time is not None:
        out = out.withColumn(ts, F.col("_own_time"))
    return out.select(*left.columns, value)
