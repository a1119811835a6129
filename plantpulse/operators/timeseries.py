"""Windows, buckets, gaps and runs over time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plantpulse.functions import clock
from plantpulse.operators.sliced import Series, over_rows, state_runs, with_previous

# Bucket numbers are made in chunks, so no row ever holds a long array.
SPINE_CHUNK = 4096


# --- tumbling aggregates ------------------------------------------------------------
def sensor_window_avg(environment: DataFrame, window_seconds: int = 3) -> DataFrame:
    """Mean temperature, humidity and pressure per site and window."""
    return environment.groupBy(
        "factory_id", clock.bucket_start("ts", window_seconds).alias("window_start")
    ).agg(
        F.count(F.lit(1)).alias("sample_count"),
        F.avg("temperature").alias("temperature_celsius_avg"),
        F.avg("humidity").alias("humidity_percent_avg"),
        F.avg("pressure").alias("pressure_hpa_avg"),
    )


def ai_window_score(detections: DataFrame, window_seconds: int = 3) -> DataFrame:
    """Mean of 0/1 detections per window, to four decimals."""
    score = lambda c: F.round(F.avg(c), 4)
    return detections.groupBy(
        "factory_id", clock.bucket_start("ts", window_seconds).alias("window_start")
    ).agg(
        F.count(F.lit(1)).alias("sample_count"),
        score("fire_detected").alias("fire_score"),
        score("fallen_detected").alias("fall_score"),
        score("bending_detected").alias("bend_score"),
    )


def representative_sound(sounds: DataFrame, window_seconds: int = 3) -> DataFrame:
    """Most frequent non-empty label per window; ties: latest, then first by name.

    Counting per label first keeps the second step at one row per label.
    """
    per_label = sounds.groupBy(
        "factory_id", clock.bucket_start("ts", window_seconds).alias("window_start"), "label"
    ).agg(F.count(F.lit(1)).alias("n"), F.max("ts").alias("last_ts"))
    heard = F.col("label") != ""
    # min_by with negated counts makes "first by name" the natural last tie-break
    rank = F.when(heard, F.struct(-F.col("n"), -F.unix_micros("last_ts"), F.col("label")))
    return per_label.groupBy("factory_id", "window_start").agg(
        F.coalesce(F.min_by("label", rank), F.lit("")).alias("abnormal_sound"),
        F.sum(F.when(heard, F.col("n")).otherwise(0)).alias("danger_count"),
    )


def merge_measurement_windows(
    environment: DataFrame, detections: DataFrame, sounds: DataFrame, window_seconds: int = 3
) -> DataFrame:
    """Sensor, AI and sound of one window in one row, a window may lack any.

    The three aggregates are unioned and folded by one group-by, so each
    measurement is pre-aggregated on its own before the common shuffle.
    """
    parts = (
        sensor_window_avg(environment, window_seconds).withColumnRenamed("sample_count", "sensor_count"),
        ai_window_score(detections, window_seconds).withColumnRenamed("sample_count", "ai_count"),
        representative_sound(sounds, window_seconds).drop("danger_count"),
    )
    union = parts[0].unionByName(parts[1], allowMissingColumns=True).unionByName(parts[2], allowMissingColumns=True)
    values = [c for c in union.columns if c not in ("factory_id", "window_start")]
    folded = union.groupBy("factory_id", "window_start").agg(*[F.max(c).alias(c) for c in values])
    return folded.select(
        "factory_id",
        "window_start",
        F.coalesce("sensor_count", F.lit(0)).alias("sensor_count"),
        "temperature_celsius_avg",
        "humidity_percent_avg",
        "pressure_hpa_avg",
        F.coalesce("ai_count", F.lit(0)).alias("ai_count"),
        "fire_score",
        "fall_score",
        "bend_score",
        F.coalesce("abnormal_sound", F.lit("")).alias("abnormal_sound"),
    )


# --- buckets with filling ------------------------------------------------------------
def bucket_spine(bounds: DataFrame, keys: Sequence[str], interval_seconds: int) -> DataFrame:
    """Every epoch-aligned bucket between `start` and `end` (both inclusive)."""
    step = interval_seconds
    chunk = step * SPINE_CHUNK
    first = F.unix_seconds("start") - F.pmod(F.unix_seconds("start"), F.lit(step))
    last = F.unix_seconds("end") - F.pmod(F.unix_seconds("end"), F.lit(step))
    chunks = bounds.select(
        *keys, last.alias("_last"), F.explode(F.sequence(first, last, F.lit(chunk))).alias("_from")
    )
    # The bounds of a long series lie in one task; its chunks are spread before they grow.
    tasks = int(bounds.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chunks = chunks.repartition(tasks, *keys, "_from")
    numbers = F.sequence(
        F.col("_from"), F.least(F.col("_from") + F.lit(chunk - step), F.col("_last")), F.lit(step)
    )
    return chunks.select(*keys, F.explode(numbers).alias("_n")).select(
        *keys, F.timestamp_seconds("_n").alias("bucket")
    )


def series_bounds(df: DataFrame, keys: Sequence[str], ts: str = "ts") -> DataFrame:
    return df.groupBy(*keys).agg(F.min(ts).alias("start"), F.max(ts).alias("end"))


def fill_buckets(
    counts: DataFrame, spine: DataFrame, keys: Sequence[str], fill: dict[str, object] | None = None
) -> DataFrame:
    """Left join of the spine with bucket results; `fill` replaces nulls."""
    joined = spine.join(counts, [*keys, "bucket"], "left")
    return joined.fillna(fill) if fill else joined


def bucket_series(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    interval_seconds: int,
    bounds: DataFrame | None = None,
    ts: str = "ts",
) -> DataFrame:
    """count and mean of `value` per bucket, empty buckets included.

    The spine enters as rows without a value, so counting, averaging and
    filling are one aggregation with map-side combine: count 0 and mean null.
    """
    bounds = series_bounds(df, keys, ts) if bounds is None else bounds
    spine = bucket_spine(bounds, keys, interval_seconds)
    rows = df.select(*keys, clock.bucket_start(ts, interval_seconds).alias("bucket"), F.col(value).alias("_v"))
    both = rows.unionByName(spine, allowMissingColumns=True)
    return both.groupBy(*keys, "bucket").agg(
        F.count("_v").alias("sample_count"), F.avg("_v").alias("mean_value")
    )


def bucket_mean(df, keys, value, interval_seconds, bounds=None, ts="ts") -> DataFrame:
    """Mean per bucket, null where the bucket is empty."""
    return bucket_series(df, keys, value, interval_seconds, bounds, ts).drop("sample_count")


def bucket_count(df, keys, value, interval_seconds, bounds=None, ts="ts") -> DataFrame:
    """Count per bucket, 0 where the bucket is empty."""
    return bucket_series(df, keys, value, interval_seconds, bounds, ts).drop("mean_value")


def downsample_last(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    order: Sequence[str],
    interval_seconds: int = 30,
) -> DataFrame:
    """Last row of every bucket; `bucket` is the bucket's end."""
    rest = [c for c in df.columns if c not in keys]
    return (
        df.groupBy(*keys, clock.bucket_label(ts, interval_seconds).alias("bucket"))
        .agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_row"))
        .select(*keys, "bucket", "_row.*")
    )


# --- runs and steps --------------------------------------------------------------------
def run_durations(df: DataFrame, series: Series, state: str) -> DataFrame:
    """Runs of equal state with their duration in seconds (first to last row)."""
    return state_runs(df, series, state).withColumn("duration_seconds", clock.age_seconds("run_end", "run_start"))


def last_n_mean(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, n: int = 10) -> DataFrame:
    """Mean over the newest `n` rows of each series.

    The rank filter lets Spark keep `n` rows per series and map task before
    the shuffle.
    """
    newest = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    return (
        df.select(*keys, *order, value)
        .withColumn("_back", F.row_number().over(newest))
        .where(F.col("_back") <= n)
        .groupBy(*keys)
        .agg(F.count(value).alias("sample_count"), F.avg(value).alias("mean_value"))
    )


def moving_mean(df: DataFrame, series: Series, value: str, n: int = 10) -> DataFrame:
    """Mean over the row and the n - 1 rows before it."""
    return over_rows(
        df,
        series,
        [value],
        lambda w: {"moving_mean": F.avg(value).over(w.rowsBetween(-(n - 1), 0))},
        rows=n - 1,
    )


def inter_arrival(df: DataFrame, series: Series) -> DataFrame:
    """Seconds since the previous row of the series (null on the first)."""
    out = with_previous(df, series, [series.ts])
    return out.withColumn("gap_seconds", clock.age_seconds(series.ts, f"prev_{series.ts}"))


def sequence_gaps(df: DataFrame, series: Series, number: str) -> DataFrame:
    """Missing numbers between a row and the one before it."""
    out = with_previous(df, series, [number])
    missing: Column = F.col(number) - F.col(f"prev_{number}") - 1
    return out.withColumn("missing", missing).where(F.col("missing") > 0)
