"""Streaming flows over the whole event table, run until the input is used up (X).

The events arrive in three deliveries, cut by time and read one a batch, so
state is carried from batch to batch.  Results are read back from the sink.
Windows still open at the end are not emitted in append mode, so the twins
compare closed windows.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from plantpulse.operators import checks, risk, rulebook, state
from plantpulse.plans.catalog.registry import (
    AS_OF,
    FS,
    INF,
    MSG,
    SCORED,
    TIMING,
    age_sql,
    bucket_sql,
    config,
    factory,
    iso,
    iso_sql,
    messages,
    query,
    r6,
    scratch,
    slice_seconds,
)
from plantpulse.plans.catalog.risk import RULED, rule_changes
from plantpulse.sources import feed, lake, latest
from plantpulse.streaming import flows, processor, silence

_MICROS = 1000000
_NOW = f"TIMESTAMP '{AS_OF}'"
SILENT_AFTER = 6 * TIMING.infra_period


def _closed(end: str, table: str, lateness: int = TIMING.lateness) -> str:
    return f"epoch_us({end}) <= (SELECT max(epoch_us(source_timestamp)) FROM {table}) - {lateness * _MICROS}"


def _finish(spark, query_, path):
    query_.awaitTermination()
    return spark.read.parquet(path)


@query(
    "x1_event_time_mean",
    f"""WITH {FS}, b AS (SELECT factory_id, {bucket_sql('source_timestamp', TIMING.infra_period)} AS w, count(temperature) AS sample_count,
      avg(temperature) AS mean_value FROM fs GROUP BY ALL)
    SELECT factory_id, {iso_sql('w')} AS window_start, sample_count, round(mean_value, 6) AS mean_value FROM b
    WHERE {_closed(f'w + to_seconds({TIMING.infra_period})', 'fs')}""",
)
def x1(spark, d):
    root = scratch(spark)
    rows = feed.stream_factory_states(spark, d, feed.deliver(spark, d, f"{root}/events")).select(
        "factory_id", "source_timestamp", F.col("sensor.temperature_celsius_avg").alias("temperature")
    )
    out = flows.windowed_mean(rows, "temperature", TIMING.infra_period, TIMING)
    done = _finish(spark, flows.run_to_files(out, f"{root}/out", f"{root}/check"), f"{root}/out")
    return done.select(
        "factory_id", iso("window_start").alias("window_start"), "sample_count", r6("mean_value").alias("mean_value")
    )


@query(
    "x2_windowed_last",
    f"""WITH {FS}, b AS (SELECT factory_id, {bucket_sql('source_timestamp', TIMING.history_bucket)} + to_seconds({TIMING.history_bucket}) AS bucket,
      arg_max(message_id, source_timestamp) AS message_id, arg_max(fall, source_timestamp) AS fall_score FROM fs GROUP BY 1, 2)
    SELECT factory_id, {iso_sql('bucket')} AS bucket, message_id, fall_score FROM b WHERE {_closed('bucket', 'fs')}""",
)
def x2(spark, d):
    root = scratch(spark)
    rows = feed.stream_factory_states(spark, d, feed.deliver(spark, d, f"{root}/events")).select(
        "factory_id", *state.NEWEST, F.col("ai_result.fall_score").alias("fall_score")
    )
    out = flows.windowed_last(rows, TIMING.history_bucket, TIMING)
    done = _finish(spark, flows.run_to_files(out, f"{root}/out", f"{root}/check"), f"{root}/out")
    return done.select("factory_id", iso("bucket").alias("bucket"), "message_id", "fall_score")


@query(
    "x3_stream_dedup",
    f"WITH {MSG} SELECT message_id, factory_id, {iso_sql('source_timestamp')} AS source_time FROM msg",
)
def x3(spark, d):
    root = scratch(spark)
    rows = feed.with_repeats(feed.stream_messages(spark, d, feed.deliver(spark, d, f"{root}/events"))).select(
        "message_id", "factory_id", "source_timestamp", "published_at", "received_at"
    )
    out = flows.stream_dedup(rows, TIMING)
    done = _finish(spark, flows.run_to_files(out, f"{root}/out", f"{root}/check"), f"{root}/out")
    return done.select("message_id", "factory_id", iso("source_timestamp").alias("source_time"))


@query(
    "x4_keyed_latest",
    f"""WITH {MSG} SELECT factory_id, source_type, message_id FROM msg
    QUALIFY row_number() OVER (PARTITION BY factory_id, source_type ORDER BY source_timestamp DESC) = 1""",
)
def x4(spark, d):
    root = scratch(spark)
    rows = feed.stream_messages(spark, d, feed.deliver(spark, d, f"{root}/events")).select("factory_id", "source_type", *state.NEWEST)
    keep = flows.latest_writer(f"{root}/latest", ("factory_id", "source_type"))
    flows.run_batches(rows, keep, f"{root}/check").awaitTermination()
    return latest.read_latest(spark, f"{root}/latest").select("factory_id", "source_type", "message_id")


@query(
    "x5_state_changes",
    f"""WITH {SCORED}, p AS (SELECT *, lag(risk_level) OVER w AS was FROM leveled WINDOW w AS (PARTITION BY factory_id ORDER BY source_timestamp)),
    s AS (SELECT * FROM p WHERE was IS NULL OR was <> risk_level),
    c AS (SELECT *, {age_sql('source_timestamp', 'lag(source_timestamp) OVER w')} AS lasted FROM s WINDOW w AS (PARTITION BY factory_id ORDER BY source_timestamp))
    SELECT message_id, was AS from_state, risk_level AS to_state, round(lasted, 6) AS lasted_seconds FROM c WHERE was IS NOT NULL""",
)
def x5(spark, d):
    root = scratch(spark)
    scored = risk.score_messages(feed.stream_factory_states(spark, d, feed.deliver(spark, d, f"{root}/events")), config(spark).thresholds)
    rows = scored.select("factory_id", *state.NEWEST, "risk_level")
    handle = flows.change_writer(f"{root}/changes", f"{root}/running", slice_seconds(spark, d))
    flows.run_batches(rows, handle, f"{root}/check").awaitTermination()
    done = spark.read.parquet(f"{root}/changes")
    return done.select("message_id", "from_state", "to_state", r6("lasted_seconds").alias("lasted_seconds"))


@query(
    "x5_silent_sites",
    f"""WITH {MSG}, l AS (SELECT factory_id, source_type, max(source_timestamp) AS at FROM msg GROUP BY ALL)
    SELECT factory_id, {iso_sql('l.at')} AS silent_since, round({age_sql("TIMESTAMP '2024-02-01'", 'l.at')}, 6) AS silent_seconds
    FROM l WHERE source_type = 'factory_state' AND {age_sql("TIMESTAMP '2024-02-01'", 'l.at')} > {TIMING.risk_sensor_after}""",
)
def x5_silent(spark, d):
    root = scratch(spark)
    rows = feed.stream_factory_states(spark, d, feed.deliver(spark, d, f"{root}/events")).select("factory_id", *state.NEWEST)
    flows.run_batches(rows, flows.latest_writer(f"{root}/latest"), f"{root}/check").awaitTermination()
    running = latest.read_latest(spark, f"{root}/latest")
    out = flows.silent_sites(running, "2024-02-01 00:00:00", TIMING.risk_sensor_after)
    return out.select("factory_id", iso("silent_since").alias("silent_since"), r6("silent_seconds").alias("silent_seconds"))


@query(
    "x5_silence_by_timer",
    f"""WITH {MSG}, g AS (SELECT factory_id, source_timestamp AS seen, lag(source_timestamp) OVER (PARTITION BY factory_id ORDER BY source_timestamp) AS before
      FROM msg WHERE source_type = 'infra_state'),
    q AS (SELECT * FROM g WHERE {age_sql('seen', 'before')} > {SILENT_AFTER})
    SELECT factory_id, 'silent' AS type, {iso_sql('before')} AS silent_since, {iso_sql(f'before + to_seconds({SILENT_AFTER})')} AS at FROM q
    UNION ALL SELECT factory_id, 'back', {iso_sql('before')}, {iso_sql('seen')} FROM q
    UNION ALL SELECT factory_id, 'silent', {iso_sql('last')}, {iso_sql(f'last + to_seconds({SILENT_AFTER})')} FROM (
      SELECT factory_id, max(seen) AS last FROM g GROUP BY 1)
      WHERE epoch_us(last) + {SILENT_AFTER * _MICROS} < (SELECT max(epoch_us(seen)) FROM g) - {TIMING.lateness * _MICROS}""",
)
def x5_timer(spark, d):
    # Three deliveries cut by time; silences within one and across two are reported alike.
    root = scratch(spark)
    before = spark.conf.get(silence.PROVIDER_SETTING, None)
    spark.conf.set(silence.PROVIDER_SETTING, silence.PROVIDER)
    try:
        m = feed.stream_messages(spark, d, feed.deliver(spark, d, f"{root}/events")).where("source_type = 'infra_state'")
        found = _finish(spark, flows.run_to_files(silence.silence_events(m, SILENT_AFTER, TIMING), f"{root}/out", f"{root}/check"), f"{root}/out")
    finally:
        if before is None:
            spark.conf.unset(silence.PROVIDER_SETTING)
        else:
            spark.conf.set(silence.PROVIDER_SETTING, before)
    return found.select("factory_id", "type", iso("silent_since").alias("silent_since"), iso("at").alias("at"))


@query(
    "x6_last_known_infra",
    f"""WITH {INF}, f AS (SELECT * FROM msg WHERE source_type = 'factory_state')
    SELECT f.message_id, {iso_sql('inf.source_timestamp')} AS infra_at, inf.ready FROM f
    ASOF LEFT JOIN inf ON f.factory_id = inf.factory_id AND inf.source_timestamp <= f.source_timestamp""",
)
def x6(spark, d):
    root = scratch(spark)
    rows = feed.stream_messages(spark, d, feed.deliver(spark, d, f"{root}/events")).select(
        "factory_id",
        "source_type",
        *state.NEWEST,
        *[F.col(f"payload.{c}").alias(c) for c in ("heartbeat", "nodes", "workloads", "devices")],
    )
    handle = flows.asof_writer(f"{root}/out", f"{root}/infra", slice_seconds(spark, d))
    flows.run_batches(rows, handle, f"{root}/check").awaitTermination()
    return spark.read.parquet(f"{root}/out").select(
        "message_id",
        iso("infra.at").alias("infra_at"),
        F.when(F.col("infra").isNotNull(), state.node_summary(F.col("infra.nodes"))["ready"]).alias("ready"),
    )


_GAP = TIMING.infra_period


@query(
    "x7_arrival_sessions",
    f"""WITH {MSG}, g AS (SELECT *, coalesce({age_sql('source_timestamp', 'lag(source_timestamp) OVER w')} > {_GAP}, true) AS brk FROM msg
      WINDOW w AS (PARTITION BY factory_id ORDER BY source_timestamp)),
    r AS (SELECT *, sum(brk::INT) OVER (PARTITION BY factory_id ORDER BY source_timestamp) AS run FROM g),
    s AS (SELECT factory_id, min(source_timestamp) AS a, max(source_timestamp) AS z, count(*) AS messages FROM r GROUP BY factory_id, run)
    SELECT factory_id, {iso_sql('a')} AS session_start, {iso_sql('z')} AS last_arrival, messages FROM s WHERE {_closed(f'z + to_seconds({_GAP})', 'msg')}""",
)
def x7(spark, d):
    root = scratch(spark)
    rows = feed.stream_messages(spark, d, feed.deliver(spark, d, f"{root}/events")).select("factory_id", "source_timestamp")
    out = flows.arrival_sessions(rows, _GAP, TIMING)
    done = _finish(spark, flows.run_to_files(out, f"{root}/out", f"{root}/check"), f"{root}/out")
    return done.select(
        "factory_id", iso("session_start").alias("session_start"), iso("last_arrival").alias("last_arrival"), "messages"
    )


@query(
    "x8_late_rows",
    f"""WITH {MSG}, seen AS (SELECT factory_id, max(source_timestamp) AS at FROM msg WHERE event_id % 5 <> 0 GROUP BY 1)
    SELECT message_id, CASE WHEN event_id % 5 = 0 AND source_timestamp < seen.at - to_seconds({TIMING.lateness})
      THEN 'late' ELSE 'on_time' END AS outcome FROM msg LEFT JOIN seen USING (factory_id)""",
)
def x8(spark, d):
    # A fifth of the messages arrives in a second delivery, long after its time.
    root = scratch(spark)
    rows = messages(spark, d)
    handle = flows.late_writer(f"{root}/on_time", f"{root}/late", f"{root}/seen", TIMING)
    for part in (F.col("event_id") % 5 != 0, F.col("event_id") % 5 == 0):
        lake.raw_rows(rows.where(part)).write.mode("append").parquet(f"{root}/raw")
        source = flows.read_raw_stream(spark, f"{root}/raw", "parquet")
        flows.run_batches(source, handle, f"{root}/check").awaitTermination()
    late = spark.read.parquet(f"{root}/late").select("message_id", F.lit("late").alias("outcome"))
    return late.unionByName(spark.read.parquet(f"{root}/on_time").select("message_id", F.lit("on_time").alias("outcome")))


@query(
    "x9_two_sinks",
    f"""WITH {MSG} SELECT 'raw' AS sink, factory_id, count(*) AS messages FROM msg GROUP BY ALL UNION ALL
    SELECT 'latest', factory_id, count(DISTINCT source_type) FROM msg GROUP BY ALL""",
)
def x9(spark, d):
    root = scratch(spark)
    keep = flows.latest_writer(f"{root}/latest", ("factory_id", "source_type"))

    def handle(batch, batch_id):
        keep(batch.select("factory_id", "source_type", *state.NEWEST), batch_id)

    for q in flows.both_sinks(feed.stream_messages(spark, d, feed.deliver(spark, d, f"{root}/events")), f"{root}/raw", handle, f"{root}/check"):
        q.awaitTermination()
    raw = lake.read_raw(spark, f"{root}/raw", fmt="parquet").select("factory_id", F.lit("raw").alias("sink"))
    now = latest.read_latest(spark, f"{root}/latest").select("factory_id", F.lit("latest").alias("sink"))
    return raw.unionByName(now).groupBy("sink", "factory_id").agg(F.count(F.lit(1)).alias("messages"))


@query(
    "x10_replay",
    f"WITH {SCORED} SELECT message_id, round(risk_score, 6) AS risk_score, risk_level, 'risk-v0.2.0' AS calculation_version FROM leveled",
)
def x10(spark, d):
    # The archive is replayed as a stream through the same scoring function.
    root = scratch(spark)
    lake.write_raw(messages(spark, d), f"{root}/raw")
    source = flows.read_raw_stream(spark, f"{root}/raw").withColumn("received_at", F.timestamp_millis("received_at"))
    scored = risk.score_messages(
        checks.factory_rows(source), config(spark).thresholds, calculation_version="risk-v0.2.0"
    ).select("message_id", "risk_score", "risk_level", "calculation_version")
    done = _finish(spark, flows.run_to_files(scored, f"{root}/out", f"{root}/check"), f"{root}/out")
    return done.withColumn("risk_score", r6("risk_score"))


@query(
    "x9_data_processor",
    f"""WITH {SCORED}, lf AS (SELECT factory_id, arg_max(message_id, source_timestamp) AS factory_message_id, round(arg_max(risk_score, source_timestamp), 6) AS risk_score,
      count(DISTINCT epoch_us(source_timestamp) // {TIMING.history_bucket * _MICROS}) AS history_points FROM leveled GROUP BY 1),
    li AS (SELECT factory_id, arg_max(message_id, source_timestamp) AS infra_message_id FROM msg WHERE source_type = 'infra_state' GROUP BY 1),
    rj AS (SELECT factory_id, count(*) AS rejected FROM msg WHERE event_id % 53 = 0 GROUP BY 1)
    SELECT 'valid' AS part, factory_id, factory_message_id, infra_message_id, risk_score, history_points FROM lf JOIN li USING (factory_id)
    UNION ALL SELECT 'rejected', factory_id, NULL, NULL, NULL, rejected FROM rj""",
)
def x9_processor(spark, d):
    # Every message arrives well-formed; one in 53 arrives once more, damaged.
    root = scratch(spark)
    m = feed.stream_messages(spark, d, feed.deliver(spark, d, f"{root}/events"))
    damaged = F.when(F.col("copy") == 1, "unknown").otherwise(F.col("environment_type"))
    copies = F.when(F.col("event_id") % 53 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    arrivals = m.withColumn("copy", F.explode(copies)).withColumn("environment_type", damaged).drop("copy", "event_id")
    for q in processor.run(
        arrivals, root, config(spark), f"{root}/check", TIMING, lake.backfill_tasks(spark)
    ):
        q.awaitTermination()
    points = processor.history(spark, root, "RISK", TIMING).groupBy("factory_id").agg(F.count(F.lit(1)).alias("history_points"))
    now = processor.current_state(spark, root).join(points, "factory_id")
    none = F.lit(None)
    rejects = spark.read.parquet(f"{root}/rejects").groupBy("factory_id").agg(F.count(F.lit(1)).alias("history_points"))
    return now.select(
        F.lit("valid").alias("part"),
        "factory_id",
        "factory_message_id",
        "infra_message_id",
        r6("risk_score").alias("risk_score"),
        "history_points",
    ).unionByName(
        rejects.select(
            F.lit("rejected").alias("part"),
            "factory_id",
            none.cast("string").alias("factory_message_id"),
            none.cast("string").alias("infra_message_id"),
            none.cast("double").alias("risk_score"),
            "history_points",
        )
    )


@query(
    "x9_processor_late",
    f"""WITH {MSG}, t AS (SELECT *, event_id % 5 = 0 AS second FROM msg),
    seen AS (SELECT factory_id, max(source_timestamp) AS at FROM t WHERE NOT second GROUP BY 1),
    o AS (SELECT factory_id, second AND source_timestamp < seen.at - to_seconds({TIMING.lateness}) AS late, source_type, event_id
      FROM t LEFT JOIN seen USING (factory_id))
    SELECT 'processed ' || source_type AS part, factory_id, count(*) AS messages FROM o GROUP BY ALL
    UNION ALL SELECT 'late', factory_id, count(*) FROM o WHERE late GROUP BY ALL
    UNION ALL SELECT 'rejected', factory_id, count(*) FROM o WHERE event_id % 53 = 0 GROUP BY ALL
    UNION ALL SELECT 'infra history', factory_id, count(*) FROM o WHERE source_type = 'infra_state' GROUP BY ALL""",
)
def x9_late(spark, d):
    # Two deliveries: the second holds a fifth of the messages, long after their
    # time, and once more every seventh message of the first.
    root = scratch(spark)
    rows = messages(spark, d)
    damaged = F.when(F.col("copy") == 1, "unknown").otherwise(F.col("environment_type"))
    copies = F.when(F.col("event_id") % 53 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    second = F.col("event_id") % 5 == 0
    again = (F.col("event_id") % 7 == 0) & (F.col("event_id") % 53 != 0)
    for part in (~second, second | again):
        sent = rows.where(part).withColumn("copy", F.explode(copies)).withColumn("environment_type", damaged)
        sent = sent.where((F.col("copy") == 0) | ~again).drop("copy", "event_id")
        sent.write.mode("append").parquet(f"{root}/in")
        source = spark.readStream.schema(sent.schema).parquet(f"{root}/in")
        for q in processor.run(source, root, config(spark), f"{root}/check", TIMING, lake.backfill_tasks(spark)):
            q.awaitTermination()

    def counted(path, part):
        return spark.read.parquet(f"{root}/{path}").groupBy("factory_id").agg(F.count(F.lit(1)).alias("messages")).withColumn("part", F.lit(part))

    found = [
        counted("processed/factory-state", "processed factory_state"),
        counted("processed/infra-state", "processed infra_state"),
        counted("late", "late"),
        counted("rejects", "rejected"),
        processor.history(spark, root, "INFRA", TIMING).groupBy("factory_id").agg(F.count(F.lit(1)).alias("messages")).withColumn("part", F.lit("infra history")),
    ]
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out.select("part", "factory_id", "messages")


# --- the processor under rules that change in mid-stream ---------------------------------------------
_RUNS: dict[tuple[str, str], str] = {}


def ruled_run(spark, d) -> str:
    """Folder of one processor run over two deliveries.

    The second holds a fifth of the messages of three days, long after their
    time; the rules change in the middle of these days.
    """
    key = (spark.sparkContext.applicationId, d)
    if key not in _RUNS:
        root = scratch(spark)
        rows = messages(spark, d)
        late = (F.col("event_id") % 5 == 0) & F.col("source_timestamp").between("2024-01-09", "2024-01-12")
        for part in (~late, late):
            sent = rows.where(part).drop("event_id")
            sent.write.mode("append").parquet(f"{root}/in")
            source = spark.readStream.schema(sent.schema).parquet(f"{root}/in")
            for q in processor.run(
                source,
                root,
                config(spark),
                f"{root}/check",
                TIMING,
                lake.backfill_tasks(spark),
                # Asked for at every batch: a change needs no restart.
                lambda s: rulebook.rule_states(rule_changes(s), config(s).factories),
                slice_seconds(spark, d),
            ):
                q.awaitTermination()
        _RUNS[key] = root
    return _RUNS[key]


@query(
    "x9_processor_rules",
    f"WITH {RULED} SELECT message_id, rule_version, round(ruled_score, 6) AS risk_score, bend_shown FROM rs",
)
def x9_rules(spark, d):
    found = spark.read.parquet(f"{ruled_run(spark, d)}/processed/risk-score")
    return found.select(
        "message_id",
        F.col("calculation_version").alias("rule_version"),
        r6("risk_score").alias("risk_score"),
        F.array_contains("displayed", "bend_score").alias("bend_shown"),
    )


@query(
    "x9_processor_latest",
    f"""WITH {RULED}, lf AS (SELECT * FROM rs QUALIFY row_number() OVER (PARTITION BY factory_id ORDER BY source_timestamp DESC) = 1),
    tc AS (SELECT factory_id, string_agg(name, ', ' ORDER BY contribution DESC, pos) AS causes FROM (
      SELECT factory_id, unnest([1, 2, 4, 5, 6, 7]) AS pos, unnest([c1, c2, fire_part, fall_part, CASE WHEN bend_counts THEN c6 ELSE 0 END, c7]) AS contribution,
        unnest(['temperature_celsius_avg', 'humidity_percent_avg', 'fire_score', 'fall_score', 'bend_score', 'abnormal_sound']) AS name FROM lf)
      WHERE contribution > 0 GROUP BY 1),
    tr AS (SELECT factory_id, max(received_at) AS ra, max(received_at) FILTER (source_type = 'infra_state') AS ia,
      max(source_timestamp) AS ua FROM msg GROUP BY 1),
    x AS (SELECT *, CASE WHEN ruled_score < 40 THEN '안전' WHEN ruled_score < 70 THEN '주의' ELSE '위험' END AS label FROM lf)
    SELECT x.factory_id, rule_version, CASE WHEN {age_sql(_NOW, 'ia')} > {TIMING.status_critical_after} THEN 'critical'
      WHEN {age_sql(_NOW, 'ia')} > {TIMING.status_warning_after} THEN 'warning' ELSE 'normal' END AS status,
    round({age_sql(_NOW, 'ia')}, 6) AS infra_age, round({age_sql(_NOW, 'ra')}, 6) AS raw_age, label AS display_status,
    CASE WHEN causes IS NULL THEN '' ELSE array_to_string(string_split(causes, ', ')[1:3], ', ') || ' → ' END || label AS summary,
    {iso_sql('ua')} AS updated_at, round(fall, 6) AS shown_fall, CASE WHEN bend_shown THEN round(bend, 6) END AS shown_bend
    FROM x JOIN tr USING (factory_id) LEFT JOIN tc USING (factory_id)""",
)
def x9_latest(spark, d):
    out = processor.latest_state(spark, ruled_run(spark, d), AS_OF, TIMING)
    return out.select(
        "factory_id",
        F.col("calculation_version").alias("rule_version"),
        "pipeline_status.status",
        r6("pipeline_status.latest_infra_state_age_seconds").alias("infra_age"),
        r6("pipeline_status.latest_s3_raw_age_seconds").alias("raw_age"),
        "dashboard.display_status",
        "dashboard.summary",
        iso("dashboard.updated_at").alias("updated_at"),
        r6("shown.fall_score").alias("shown_fall"),
        r6("shown.bend_score").alias("shown_bend"),
    )


@query(
    "a23_running_days",
    f"""WITH {RULED}, x AS (SELECT *, strftime(source_timestamp, '%Y-%m-%d') AS date, CASE WHEN ruled_score < 40 THEN 'safe' WHEN ruled_score < 70 THEN 'warning'
      ELSE 'danger' END AS level, greatest(fire, fall, bend) AS ai, list_sort(list_transform(list_filter(list_zip([c1, c2, fire_part, fall_part,
      CASE WHEN bend_counts THEN c6 ELSE 0 END, c7], [1, 2, 4, 5, 6, 7], ['temperature_celsius_avg', 'humidity_percent_avg', 'fire_score', 'fall_score',
      'bend_score', 'abnormal_sound']), lambda p: p[1] > 0), lambda p: {{'a': -p[1], 'i': p[2], 'name': p[3]}}))[1].name AS cause FROM rs),
    mc AS (SELECT factory_id, date, cause FROM x WHERE cause IS NOT NULL GROUP BY factory_id, date, cause
      QUALIFY row_number() OVER (PARTITION BY factory_id, date ORDER BY count(*) DESC, cause) = 1)
    SELECT x.factory_id, x.date, count(*) AS messages, round(min(ruled_score), 6) AS min_score, round(avg(ruled_score), 6) AS mean_score,
    round(max(ruled_score), 6) AS max_score, round(count(*) FILTER (level = 'warning') * 3, 6) AS warning_minutes,
    round(count(*) FILTER (level = 'danger') * 3, 6) AS danger_minutes, count(*) FILTER (ai >= 0.25 AND ai < 0.75) AS uncertain_rows,
    any_value(mc.cause) AS main_cause FROM x LEFT JOIN mc ON mc.factory_id = x.factory_id AND mc.date = x.date GROUP BY ALL""",
)
def a23_running(spark, d):
    # What came in a second batch added to days long past.
    out = processor.day_summaries(spark, ruled_run(spark, d), TIMING)
    scores = ("min_score", "mean_score", "max_score", "warning_minutes", "danger_minutes")
    return out.select("factory_id", "date", "messages", *[r6(c).alias(c) for c in scores], "uncertain_rows", "main_cause")


@query(
    "q5_stored_infra_history",
    f"""WITH {INF}, ih AS (SELECT inf.*, {age_sql('source_timestamp', 'lag(source_timestamp) OVER (PARTITION BY factory_id ORDER BY source_timestamp)')} AS age FROM inf)
    SELECT factory_id, {iso_sql('source_timestamp')} AS timestamp, ready, round(age, 6) AS age_seconds FROM ih
    WHERE factory_id = 'factory-b' AND source_timestamp BETWEEN TIMESTAMP '2024-01-10' AND TIMESTAMP '2024-01-12'""",
)
def q5_stored(spark, d):
    # Only the dates asked for are opened, and the one that holds the message before them.
    out = processor.history(
        spark, ruled_run(spark, d), "INFRA", TIMING, "factory-b", datetime(2024, 1, 10), datetime(2024, 1, 12)
    )
    return out.select(
        "factory_id",
        iso("timestamp").alias("timestamp"),
        F.col("node_summary.ready").alias("ready"),
        r6("pipeline_status.latest_infra_state_age_seconds").alias("age_seconds"),
    )


@query(
    "l1_drop_dates",
    f"WITH {MSG} SELECT factory_id, count(*) AS messages FROM msg WHERE source_type = 'infra_state' AND source_timestamp >= TIMESTAMP '2024-01-15' GROUP BY 1",
)
def l1_drop(spark, d):
    # Whole dates go by their name; what is left of a copy is counted.
    kept_root = scratch(spark)
    stored = lake.read_history_batches(spark, f"{ruled_run(spark, d)}/history", "INFRA")
    lake.write_history_batch(stored.drop("batch", "date"), f"{kept_root}/history", "INFRA", 0)
    processor.expire_history(spark, kept_root, datetime(2024, 1, 16, 12), 86400)
    left = lake.read_history_batches(spark, f"{kept_root}/history", "INFRA")
    return left.groupBy("factory_id").agg(F.count(F.lit(1)).alias("messages"))


@query(
    "w2_score_delta_10m",
    f"""WITH {SCORED}, p AS (SELECT l.event_id, l.risk_score, e.risk_score AS was, e.source_timestamp AS was_at, l.source_timestamp
      FROM leveled l ASOF LEFT JOIN leveled e ON l.factory_id = e.factory_id AND l.source_timestamp - to_seconds({TIMING.delta_window}) >= e.source_timestamp)
    SELECT event_id, CASE WHEN {age_sql('source_timestamp', 'was_at')} <= {2 * TIMING.delta_window} THEN round(risk_score - was, 6) END AS score_delta_10m FROM p""",
)
def w2_bounded(spark, d):
    rows = risk.score_messages(factory(spark, d), config(spark).thresholds)
    out = processor.with_delta(rows, None, slice_seconds(spark, d), TIMING)
    return out.select("event_id", r6("score_delta_10m").alias("score_delta_10m"))
