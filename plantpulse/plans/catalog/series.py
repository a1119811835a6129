"""Time series: windows, buckets, runs, gaps (A1-A6, A19, W, J4, J8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from plantpulse.functions import clock
from plantpulse.operators import gaps, risk, sliced, state
from plantpulse.operators import timeseries as ts
from plantpulse.plans import views
from plantpulse.plans.catalog.ingest import scored
from plantpulse.plans.catalog.registry import (
    ENV,
    FS,
    INF,
    MSG,
    SCORED,
    TIMING,
    age_sql,
    bucket_sql,
    detections,
    environment,
    factory,
    gap_sql,
    infra,
    iso,
    iso_sql,
    message_series,
    messages,
    query,
    r6,
    sample_series,
    slice_seconds,
    sounds,
)

WINDOW = TIMING.factory_period
KEY = ["factory_id"]


@query(
    "a1_sensor_window_avg",
    f"""WITH {ENV} SELECT factory_id, {iso_sql(bucket_sql('ts', WINDOW))} AS window_start, count(*) AS sample_count,
    round(avg(temperature), 6) AS temperature_celsius_avg, round(avg(humidity), 6) AS humidity_percent_avg,
    round(avg(pressure), 6) AS pressure_hpa_avg FROM env GROUP BY ALL""",
)
def a1(spark, d):
    out = ts.sensor_window_avg(environment(spark, d), WINDOW)
    return out.select(
        "factory_id",
        iso("window_start").alias("window_start"),
        "sample_count",
        *[r6(c).alias(c) for c in ("temperature_celsius_avg", "humidity_percent_avg", "pressure_hpa_avg")],
    )


_AI_WINDOW = 3600


@query(
    "a2_ai_window_score",
    f"""WITH {ENV} SELECT factory_id, {iso_sql(bucket_sql('ts', _AI_WINDOW))} AS window_start, count(*) AS sample_count,
    round(avg(fire_detected), 4) AS fire_score, round(avg(fallen_detected), 4) AS fall_score,
    round(avg(bending_detected), 4) AS bend_score FROM ai GROUP BY ALL""",
)
def a2(spark, d):
    out = ts.ai_window_score(detections(spark, d), _AI_WINDOW)
    return out.withColumn("window_start", iso("window_start"))


# More than one sound is needed for the choice to mean anything.
_LABELS = "CASE WHEN label = '' THEN '' WHEN event_id % 3 = 0 THEN 'alarm' ELSE label END"


@query(
    "a3_representative_sound",
    f"""WITH {ENV}, l AS (SELECT factory_id, {bucket_sql('ts', 21600)} AS w, {_LABELS} AS label, count(*) AS n, max(ts) AS last_ts
      FROM snd GROUP BY ALL),
    r AS (SELECT *, row_number() OVER (PARTITION BY factory_id, w ORDER BY label = '', n DESC, last_ts DESC, label) AS rn FROM l)
    SELECT factory_id, {iso_sql('w')} AS window_start, max(label) FILTER (rn = 1) AS abnormal_sound,
    CAST(sum(CASE WHEN label <> '' THEN n ELSE 0 END) AS BIGINT) AS danger_count FROM r GROUP BY ALL""",
)
def a3(spark, d):
    label = F.when(F.col("label") == "", "").when(F.col("event_id") % 3 == 0, "alarm").otherwise(F.col("label"))
    out = ts.representative_sound(sounds(spark, d).withColumn("label", label), 21600)
    return out.withColumn("window_start", iso("window_start"))


@query(
    "j8_merge_measurement_windows",
    f"""WITH {ENV}, e AS (SELECT factory_id, {bucket_sql('ts', WINDOW)} AS w, count(*) AS sensor_count, avg(temperature) AS t
      FROM env GROUP BY ALL),
    a AS (SELECT factory_id, {bucket_sql('ts', WINDOW)} AS w, count(*) AS ai_count, round(avg(fallen_detected), 4) AS fall FROM ai GROUP BY ALL),
    s AS (SELECT factory_id, {bucket_sql('ts', WINDOW)} AS w, max(label) AS sound FROM snd GROUP BY ALL)
    SELECT factory_id, {iso_sql('w')} AS window_start, coalesce(sensor_count, 0) AS sensor_count,
    round(t, 6) AS temperature_celsius_avg, coalesce(ai_count, 0) AS ai_count, fall AS fall_score,
    coalesce(sound, '') AS abnormal_sound FROM e FULL JOIN a USING (factory_id, w) FULL JOIN s USING (factory_id, w)""",
)
def j8(spark, d):
    out = ts.merge_measurement_windows(environment(spark, d), detections(spark, d), sounds(spark, d), WINDOW)
    return out.select(
        "factory_id",
        iso("window_start").alias("window_start"),
        "sensor_count",
        r6("temperature_celsius_avg").alias("temperature_celsius_avg"),
        "ai_count",
        "fall_score",
        "abnormal_sound",
    )


@query(
    "a4_bucket_mean",
    f"""WITH {ENV}, {gap_sql('env', 'temperature', 600)} SELECT factory_id, {iso_sql('bucket')} AS bucket,
    round(mean_value, 6) AS mean_value FROM buckets""",
)
def a4(spark, d):
    out = ts.bucket_mean(environment(spark, d), KEY, "temperature", 600)
    return out.select("factory_id", iso("bucket").alias("bucket"), r6("mean_value").alias("mean_value"))


@query(
    "a5_bucket_count",
    f"""WITH {ENV}, {gap_sql('ai', 'fire_detected', 600)} SELECT factory_id, {iso_sql('bucket')} AS bucket,
    n AS sample_count FROM buckets""",
)
def a5(spark, d):
    out = ts.bucket_count(detections(spark, d), KEY, "fire_detected", 600)
    return out.select("factory_id", iso("bucket").alias("bucket"), "sample_count")


@query(
    "j4_fill_buckets",
    f"""WITH {ENV}, {gap_sql('snd', 'is_danger', 1800)}, danger AS (SELECT factory_id, epoch_us(ts) // 1800000000 AS b,
      CAST(sum(is_danger) AS BIGINT) AS dangers FROM snd GROUP BY ALL)
    SELECT factory_id, {iso_sql('bucket')} AS bucket, coalesce(dangers, 0) AS dangers FROM buckets LEFT JOIN danger USING (factory_id, b)""",
)
def j4(spark, d):
    rows = sounds(spark, d)
    spine = ts.bucket_spine(ts.series_bounds(rows, KEY), KEY, 1800)
    counts = rows.groupBy("factory_id", clock.bucket_start("ts", 1800).alias("bucket")).agg(
        F.sum("is_danger").alias("dangers")
    )
    out = ts.fill_buckets(counts, spine, KEY, {"dangers": 0})
    return out.select("factory_id", iso("bucket").alias("bucket"), "dangers")


@query(
    "a6_downsample_last",
    f"""WITH {FS} SELECT factory_id, {iso_sql(bucket_sql('source_timestamp', 1800) + ' + to_seconds(1800)')} AS bucket,
    arg_max(message_id, source_timestamp) AS message_id, arg_max(fall, source_timestamp) AS fall_score FROM fs GROUP BY 1, 2""",
)
def a6(spark, d):
    rows = factory(spark, d).select(
        "factory_id", *state.NEWEST, F.col("ai_result.fall_score").alias("fall_score")
    )
    out = ts.downsample_last(rows, KEY, "source_timestamp", state.NEWEST, TIMING.history_bucket)
    return out.select("factory_id", iso("bucket").alias("bucket"), "message_id", "fall_score")


@query(
    "a19_max_empty_bucket_seconds",
    f"""WITH {ENV}, {gap_sql('env', 'temperature', 600)} SELECT factory_id, count(*) AS buckets,
    coalesce((SELECT max(len) FROM islands i WHERE i.factory_id = b.factory_id), 0) * 600 AS max_empty_seconds
    FROM buckets b GROUP BY factory_id""",
)
def a19(spark, d):
    return gaps.max_empty_seconds(environment(spark, d), KEY, "temperature", 600)


@query(
    "w6_gap_islands",
    f"""WITH {ENV}, {gap_sql('env', 'temperature', 600)} SELECT factory_id, {iso_sql('make_timestamp(first_b * 600000000)')} AS gap_start,
    {iso_sql('make_timestamp((first_b + len) * 600000000)')} AS gap_end, len AS empty_buckets, len * 600 AS gap_seconds FROM islands""",
)
def w6(spark, d):
    out = gaps.gap_islands(environment(spark, d), KEY, "temperature", 600)
    return out.select(
        "factory_id", iso("gap_start").alias("gap_start"), iso("gap_end").alias("gap_end"), "empty_buckets", "gap_seconds"
    )


@query(
    "w1_with_previous",
    f"""WITH {FS} SELECT event_id, lag(message_id) OVER w AS prev_message_id, round(lag(temperature) OVER w, 6) AS prev_temperature
    FROM fs WINDOW w AS (PARTITION BY factory_id ORDER BY source_timestamp)""",
)
def w1(spark, d):
    rows = factory(spark, d).select(
        "factory_id", "source_timestamp", "event_id", "message_id", F.col("sensor.temperature_celsius_avg").alias("temperature")
    )
    out = sliced.with_previous(rows, message_series(spark, d), ["message_id", "temperature"])
    return out.select("event_id", "prev_message_id", r6("prev_temperature").alias("prev_temperature"))


_DELTA = f"""WITH {SCORED}, dl AS (SELECT l.event_id, l.factory_id, l.risk_score, l.risk_score - p.risk_score AS delta
  FROM leveled l ASOF LEFT JOIN leveled p ON l.factory_id = p.factory_id
    AND p.source_timestamp <= l.source_timestamp - to_seconds({TIMING.delta_window}))"""


@query("w2_score_delta", f"{_DELTA} SELECT event_id, round(risk_score, 6) AS risk_score, round(delta, 6) + 0 AS score_delta FROM dl")
def w2(spark, d):
    rows = scored(spark, d).select("factory_id", "source_timestamp", "message_id", "event_id", "risk_score")
    out = risk.score_delta(rows, slice_seconds(spark, d), TIMING.delta_window)
    return out.select("event_id", r6("risk_score").alias("risk_score"), r6("score_delta").alias("score_delta"))


@query(
    "w3_trend_direction",
    f"""{_DELTA} SELECT factory_id, CASE WHEN round(delta, 6) > 0 THEN 'up' WHEN round(delta, 6) < 0 THEN 'down' ELSE 'flat' END AS trend,
    count(*) AS messages FROM dl GROUP BY ALL""",
)
def w3(spark, d):
    rows = scored(spark, d).select("factory_id", "source_timestamp", "message_id", "risk_score")
    trend = risk.trend_direction(F.round("score_delta", 6))
    return (
        risk.score_delta(rows, slice_seconds(spark, d), TIMING.delta_window)
        .groupBy("factory_id", trend.alias("trend"))
        .agg(F.count(F.lit(1)).alias("messages"))
    )


@query(
    "w5_state_runs",
    f"""WITH {SCORED}, c AS (SELECT *, CASE WHEN risk_level IS NOT DISTINCT FROM lag(risk_level) OVER w THEN 0 ELSE 1 END AS step
      FROM leveled WINDOW w AS (PARTITION BY factory_id ORDER BY source_timestamp)),
    r AS (SELECT *, sum(step) OVER (PARTITION BY factory_id ORDER BY source_timestamp) AS run FROM c)
    SELECT factory_id, risk_level, {iso_sql('min(source_timestamp)')} AS run_start, {iso_sql('max(source_timestamp)')} AS run_end,
    count(*) AS row_count, round({age_sql('max(source_timestamp)', 'min(source_timestamp)')}, 6) AS duration_seconds
    FROM r GROUP BY factory_id, run, risk_level""",
)
def w5(spark, d):
    out = views.level_minutes(scored(spark, d), slice_seconds(spark, d))
    return out.select(
        "factory_id",
        "risk_level",
        iso("run_start").alias("run_start"),
        iso("run_end").alias("run_end"),
        "row_count",
        r6("duration_seconds").alias("duration_seconds"),
    )


@query(
    "w6_gap_islands_by_node",
    f"""WITH {ENV}, src AS (SELECT factory_id || '/' || node_id AS factory_id, ts, temperature FROM env),
    {gap_sql('src', 'temperature', 7)} SELECT split_part(factory_id, '/', 1) AS factory_id, split_part(factory_id, '/', 2) AS node_id,
    {iso_sql('make_timestamp(first_b * 7000000)')} AS gap_start, len AS empty_buckets FROM islands""",
)
def w6_by_node(spark, d):
    # Buckets of seven seconds over a month: nearly all are empty, none becomes a row.
    out = gaps.gap_islands(environment(spark, d), ["factory_id", "node_id"], "temperature", 7)
    return out.select("factory_id", "node_id", iso("gap_start").alias("gap_start"), "empty_buckets")


@query(
    "w7_last_n_mean",
    f"""WITH {ENV}, r AS (SELECT *, row_number() OVER (PARTITION BY factory_id ORDER BY ts DESC) AS rn FROM ai)
    SELECT factory_id, count(*) AS sample_count, round(avg(fallen_detected), 6) AS mean_value FROM r WHERE rn <= 10 GROUP BY 1""",
)
def w7(spark, d):
    out = ts.last_n_mean(detections(spark, d), KEY, ("ts", "event_id"), "fallen_detected", 10)
    return out.withColumn("mean_value", r6("mean_value"))


@query(
    "w7_moving_mean",
    f"""WITH {ENV} SELECT event_id, round(avg(temperature) OVER (PARTITION BY factory_id ORDER BY ts ROWS 9 PRECEDING), 6) AS moving_mean FROM env""",
)
def w7_moving(spark, d):
    rows = environment(spark, d).select("factory_id", "ts", "event_id", "temperature")
    return ts.moving_mean(rows, sample_series(spark, d), "temperature", 10).select("event_id", r6("moving_mean").alias("moving_mean"))


@query(
    "w9_sequence_gaps",
    f"""WITH {INF}, s AS (SELECT factory_id, event_id, event_id - lag(event_id) OVER (PARTITION BY factory_id ORDER BY source_timestamp) - 1 AS missing
      FROM inf) SELECT factory_id, event_id, missing FROM s WHERE missing > 0""",
)
def w9(spark, d):
    rows = infra(spark, d).select(
        "factory_id", "source_timestamp", "event_id", F.col("heartbeat.publish_sequence").alias("publish_sequence")
    )
    return ts.sequence_gaps(rows, message_series(spark, d), "publish_sequence").select("factory_id", "event_id", "missing")


@query(
    "w10_inter_arrival",
    f"""WITH {MSG} SELECT event_id, source_type, round({age_sql('source_timestamp', 'lag(source_timestamp) OVER w')}, 6) AS gap_seconds
    FROM msg WINDOW w AS (PARTITION BY factory_id, source_type ORDER BY source_timestamp)""",
)
def w10(spark, d):
    rows = messages(spark, d).select("factory_id", "source_type", "source_timestamp", "event_id")
    out = ts.inter_arrival(rows, message_series(spark, d, ("factory_id", "source_type")))
    return out.select("event_id", "source_type", r6("gap_seconds").alias("gap_seconds"))


@query(
    "w11_last_known_fill",
    f"""WITH {FS}, s AS (SELECT m.event_id, m.factory_id, m.source_timestamp, fs.temperature,
      CASE WHEN m.source_type = 'infra_state' THEN m.event_id END AS seq FROM msg m LEFT JOIN fs ON m.event_id = fs.event_id)
    SELECT event_id, round(last_value(temperature IGNORE NULLS) OVER w, 6) AS temperature,
    last_value(seq IGNORE NULLS) OVER w AS publish_sequence FROM s WINDOW w AS (PARTITION BY factory_id ORDER BY source_timestamp)""",
)
def w11(spark, d):
    rows = messages(spark, d).select(
        "factory_id",
        "source_timestamp",
        "event_id",
        F.col("payload.sensor.temperature_celsius_avg").alias("temperature"),
        F.col("payload.heartbeat.publish_sequence").alias("publish_sequence"),
    )
    out = state.last_known(rows, message_series(spark, d), ["temperature", "publish_sequence"])
    return out.select("event_id", r6("temperature").alias("temperature"), "publish_sequence")


@query(
    "t2_latest_n",
    f"WITH {ENV} SELECT factory_id, {iso_sql('ts')} AS ts, round(temperature, 6) AS temperature FROM env ORDER BY env.ts DESC LIMIT 10",
)
def t2(spark, d):
    rows = views.latest_n(environment(spark, d), 10, ties=("event_id",))
    return rows.select("factory_id", iso("ts").alias("ts"), r6("temperature").alias("temperature"))


@query(
    "t2_latest_n_per_factory",
    f"""WITH {ENV} SELECT factory_id, {iso_sql('ts')} AS ts, is_danger, row_number() OVER (PARTITION BY factory_id ORDER BY snd.ts DESC) AS recency
    FROM snd QUALIFY recency <= 5""",
)
def t2_factory(spark, d):
    rows = views.latest_n_per_factory(sounds(spark, d), 5, ties=("event_id",))
    return rows.select("factory_id", iso("ts").alias("ts"), "is_danger", "recency")
