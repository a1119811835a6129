"""Contract checks (P1-P6, P10-P15), deduplication and quality (D, A15-A18)."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime

from pyspark.sql import functions as F

from plantpulse import contract as C
from plantpulse.functions import clock
from plantpulse.operators import checks, directory, distributions, quality, reconcile, risk
from plantpulse.operators import timeseries as ts
from plantpulse.plans import views
from plantpulse.plans.catalog.ingest import bodies, scored
from plantpulse.plans.catalog.registry import (
    ENV,
    FS,
    MSG,
    SCORED,
    TIMING,
    age_sql,
    bucket_sql,
    config,
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
    scratch,
    INF,
)
from plantpulse.sources import feed, lake, reprocess, settings


@query(
    "p1_normalize_readings",
    f"""WITH {FS} SELECT event_id, CASE WHEN event_id % 4 = 3 THEN NULL ELSE round(temperature, 6) END AS temperature_celsius_avg,
    humidity AS humidity_percent_avg FROM fs""",
)
def p1(spark, d):
    # Readings arrive under different names and as text; some text is no number.
    t = F.col("sensor.temperature_celsius_avg")
    kind = F.col("event_id") % 4
    rows = factory(spark, d).select(
        "event_id",
        F.when(kind == 0, t).alias("temperature_celsius_avg"),
        F.when(kind == 1, t.cast("string")).when(kind == 3, F.lit("n/a")).alias("temperature_c"),
        F.when(kind == 2, t).alias("temperature"),
        F.col("sensor.humidity_percent_avg").cast("string").alias("humidity_percent"),
    )
    out = checks.normalize_readings(rows)
    return out.select("event_id", r6("temperature_celsius_avg").alias("temperature_celsius_avg"), "humidity_percent_avg")


def damaged(m):
    """Messages with missing fields and values outside their domain."""
    eid = F.col("event_id")
    return (
        m.withColumn("factory_id", F.when(eid % 41 != 0, F.col("factory_id")))
        .withColumn("agent_instance_id", F.when(eid % 43 != 0, F.col("agent_instance_id")))
        .withColumn("source_type", F.when(eid % 47 == 0, "event").otherwise(F.col("source_type")))
        .withColumn("environment_type", F.when(eid % 53 == 0, "unknown").otherwise(F.col("environment_type")))
        .withColumn("node_id", F.when(eid % 59 == 0, "worker9").otherwise(F.col("node_id")))
    )


_MISSING = """concat_ws(',', CASE WHEN event_id % 41 = 0 THEN 'missing:factory_id' END,
  CASE WHEN event_id % 43 = 0 THEN 'missing:agent_instance_id' END)"""
_DOMAIN = """concat_ws(',', CASE WHEN event_id % 53 = 0 THEN 'domain:environment_type' END,
  CASE WHEN event_id % 47 = 0 THEN 'domain:source_type' END, CASE WHEN event_id % 59 = 0 THEN 'domain:node_id' END)"""


@query("p2_validate_required", f"WITH {MSG} SELECT event_id, {_MISSING} AS errors FROM msg")
def p2(spark, d):
    return damaged(messages(spark, d)).select("event_id", F.concat_ws(",", checks.required_errors()).alias("errors"))


@query("p3_validate_domains", f"WITH {MSG} SELECT event_id, {_DOMAIN} AS errors FROM msg")
def p3(spark, d):
    return damaged(messages(spark, d)).select("event_id", F.concat_ws(",", checks.domain_errors()).alias("errors"))


@query(
    "p3_configured_nodes",
    f"""WITH {MSG} SELECT event_id, CASE WHEN event_id % 3 = 0 AND factory_id <> 'factory-b' THEN 'domain:node_id' ELSE '' END AS errors
    FROM msg""",
)
def p3_nodes(spark, d):
    # A third of the messages names its node as the configuration does for factory-b.
    named = F.when(F.col("event_id") % 3 == 0, "factory-b").otherwise(F.col("node_id"))
    rows = checks.with_errors(messages(spark, d).withColumn("node_id", named), config(spark).factories)
    return rows.select("event_id", F.concat_ws(",", "errors").alias("errors"))


@query(
    "p4_apply_null_policy",
    f"""WITH {FS} SELECT event_id, sensor_count, round(temperature, 6) AS temperature, fire AS fire_score, sound AS abnormal_sound FROM fs""",
)
def p4(spark, d):
    # The policy must clear a stale value that came with a zero count.
    sensor = F.struct(
        F.col("sensor.sample_count").alias("sample_count"),
        F.coalesce("sensor.temperature_celsius_avg", F.lit(-99.0)).alias("temperature_celsius_avg"),
        F.col("sensor.humidity_percent_avg").alias("humidity_percent_avg"),
        F.col("sensor.pressure_hpa_avg").alias("pressure_hpa_avg"),
    )
    ai = F.col("ai_result").withField("abnormal_sound", F.nullif(F.col("ai_result.abnormal_sound"), F.lit("")))
    out = checks.apply_null_policy(factory(spark, d).withColumn("sensor", sensor).withColumn("ai_result", ai))
    return out.select(
        "event_id",
        F.col("sensor.sample_count").alias("sensor_count"),
        r6("sensor.temperature_celsius_avg").alias("temperature"),
        F.col("ai_result.fire_score").alias("fire_score"),
        F.col("ai_result.abnormal_sound").alias("abnormal_sound"),
    )


@query(
    "p4_device_policy",
    f"""WITH {INF} SELECT event_id, CASE WHEN event_id % 3 = 0 THEN false ELSE camera END AS camera_available,
    CASE WHEN event_id % 3 <> 0 THEN {iso_sql('source_timestamp')} END AS camera_seen_at FROM inf""",
)
def p4_device(spark, d):
    gone = F.map_filter("devices", lambda k, v: (k != "camera") | (F.col("event_id") % 3 != 0))
    out = checks.device_policy(infra(spark, d).withColumn("devices", gone))
    return out.select(
        "event_id",
        F.col("devices")["camera"]["available"].alias("camera_available"),
        iso(F.col("devices")["camera"]["last_seen_at"]).alias("camera_seen_at"),
    )


@query(
    "p5_quarantine_split",
    f"""WITH {MSG}, e AS (SELECT event_id, concat_ws(',', nullif({_MISSING}, ''), nullif({_DOMAIN}, '')) AS reason FROM msg)
    SELECT event_id, reason FROM e WHERE reason <> '' UNION ALL
    SELECT -count(*), 'accepted' FROM e WHERE reason = ''""",
)
def p5(spark, d):
    good, bad = checks.quarantine_split(damaged(messages(spark, d)))
    accepted = good.agg((-F.count(F.lit(1))).alias("event_id")).withColumn("reason", F.lit("accepted"))
    return bad.select("event_id", "reason").unionByName(accepted)


@query(
    "p5_quarantine_corrupt",
    f"""WITH {MSG} SELECT event_id % 97 = 0 AS rejected, count(*) AS messages FROM msg GROUP BY 1""",
)
def p5_corrupt(spark, d):
    checked = checks.with_errors(checks.parse_messages(bodies(messages(spark, d))))
    return checked.groupBy((F.size("errors") > 0).alias("rejected")).agg(F.count(F.lit(1)).alias("messages"))


@query(
    "p6_route_by_source_type",
    f"""WITH {MSG} SELECT source_type, factory_id, count(*) AS messages, {iso_sql('max(source_timestamp)')} AS newest
    FROM msg GROUP BY ALL""",
)
def p6(spark, d):
    parts = [
        rows.groupBy("source_type", "factory_id").agg(
            F.count(F.lit(1)).alias("messages"), iso(F.max("source_timestamp")).alias("newest")
        )
        for rows in checks.route_by_source_type(messages(spark, d)).values()
    ]
    return parts[0].unionByName(parts[1])


@query(
    "p10_visible_fields",
    f"""WITH {FS} SELECT event_id, 'temperature' AS field, round(temperature, 6) AS value FROM fs UNION ALL
    SELECT event_id, 'humidity', CASE WHEN factory_id <> 'factory-b' THEN humidity END FROM fs""",
)
def p10(spark, d):
    cfg = settings.load_config(spark, overrides=[("factory-b", "humidity", False, None, None)])
    pairs = F.array(
        F.struct(F.lit("temperature").alias("field"), F.col("sensor.temperature_celsius_avg").alias("value")),
        F.struct(F.lit("humidity").alias("field"), F.col("sensor.humidity_percent_avg").alias("value")),
    )
    rows = factory(spark, d).select("factory_id", "event_id", F.inline(pairs))
    out = directory.visible_fields(rows, directory.effective_rules(cfg))
    return out.select("event_id", "field", r6("value").alias("value"))


@query(
    "p11_risk_enabled_filter",
    f"""WITH {FS} SELECT factory_id, field, count(*) AS messages FROM fs, (VALUES ('temperature'), ('humidity'),
    ('node_status'), ('pod_health'), ('data_freshness'), ('ai_event_rate'), ('storage_pressure'), ('network_reachability')) AS t(field)
    GROUP BY ALL""",
)
def p11(spark, d):
    rules = directory.risk_enabled_filter(directory.effective_rules(config(spark)))
    per_site = factory(spark, d).groupBy("factory_id").agg(F.count(F.lit(1)).alias("messages"))
    return rules.join(per_site, "factory_id").select("factory_id", "field", "messages")


NOW = datetime(2024, 1, 20, 12)


@query(
    "p12_resolve_window",
    f"""WITH {MSG} SELECT message_id, {iso_sql('source_timestamp')} AS source_time FROM msg
    WHERE source_timestamp BETWEEN TIMESTAMP '2024-01-19 12:00:00' AND TIMESTAMP '2024-01-20 12:00:00'""",
)
def p12(spark, d):
    start, end = views.resolve_window("24h", now=NOW)
    rows = views.time_range(messages(spark, d), start, end, "source_timestamp")
    return rows.select("message_id", iso("source_timestamp").alias("source_time"))


@query(
    "p12_from_only",
    f"""WITH {MSG} SELECT message_id, {iso_sql('source_timestamp')} AS source_time FROM msg
    WHERE source_timestamp BETWEEN TIMESTAMP '2024-01-18' AND TIMESTAMP '2024-01-20 12:00:00'""",
)
def p12_from(spark, d):
    start, end = views.resolve_window(start=datetime(2024, 1, 18), now=NOW)
    rows = views.time_range(messages(spark, d), start, end, "source_timestamp")
    return rows.select("message_id", iso("source_timestamp").alias("source_time"))


@query(
    "p15_time_range_filter",
    f"""WITH {ENV} SELECT factory_id, {iso_sql('ts')} AS ts, humidity FROM env
    WHERE ts >= TIMESTAMP '2024-01-05 06:00:00' AND ts <= TIMESTAMP '2024-01-06 18:00:00'""",
)
def p15(spark, d):
    rows = views.time_range(environment(spark, d), datetime(2024, 1, 5, 6), datetime(2024, 1, 6, 18), "ts")
    return rows.select("factory_id", iso("ts").alias("ts"), "humidity")


# --- deduplication -------------------------------------------------------------------------
@query(
    "d1_dedup_messages",
    f"""WITH {MSG} SELECT message_id, {iso_sql('received_at')} AS received_at FROM msg""",
)
def d1(spark, d):
    rows = feed.with_repeats(messages(spark, d)).select("message_id", "received_at", "published_at", "delivery")
    return checks.dedup_messages(rows).select("message_id", iso("received_at").alias("received_at"))


@query(
    "d2_exact_duplicates",
    f"WITH {MSG} SELECT message_id, 2 AS copies, 1 AS writers FROM msg WHERE event_id % 10 = 0",
)
def d2_exact(spark, d):
    return checks.exact_duplicates(feed.with_repeats(messages(spark, d)))


@query(
    "d2_duplicate_write_candidates",
    f"""WITH {ENV}, {gap_sql('env', 'temperature', 3600)},
    med AS (SELECT factory_id, median(n) AS median_count FROM buckets WHERE n > 0 GROUP BY 1)
    SELECT factory_id, {iso_sql('bucket')} AS bucket, n AS sample_count, CAST(median_count AS DOUBLE) AS median_count
    FROM buckets JOIN med USING (factory_id) WHERE n > median_count * 2""",
)
def d2(spark, d):
    buckets = ts.bucket_count(environment(spark, d), ["factory_id"], "temperature", 3600)
    out = checks.duplicate_write_candidates(buckets, ["factory_id"])
    return out.select("factory_id", iso("bucket").alias("bucket"), "sample_count", "median_count")


@query(
    "d3_missing_samples",
    f"""WITH {ENV}, {gap_sql('env', 'temperature', 600)} SELECT factory_id, count(*) AS expected,
    count(*) FILTER (n = 0) AS missing FROM buckets GROUP BY 1""",
)
def d3(spark, d):
    return checks.missing_samples(environment(spark, d), ["factory_id"], "temperature", 600)


@query(
    "d4_field_null_report",
    f"""WITH {FS} SELECT factory_id, count(*) AS row_count, 'temperature' AS field,
      round(avg((temperature IS NULL)::INT), 6) AS null_share FROM fs GROUP BY 1
    UNION ALL SELECT factory_id, count(*), 'abnormal_sound', round(avg((sound = '')::INT), 6) FROM fs GROUP BY 1""",
)
def d4(spark, d):
    fields = {
        "temperature": F.col("sensor.temperature_celsius_avg"),
        "abnormal_sound": F.nullif(F.col("ai_result.abnormal_sound"), F.lit("")),
    }
    out = checks.field_null_report(factory(spark, d), ["factory_id"], fields)
    return out.select("factory_id", "row_count", "field", r6("null_share").alias("null_share"))


@query(
    "d5_continuity_check",
    f"""WITH {MSG}, g AS (SELECT factory_id, source_timestamp, coalesce({age_sql('source_timestamp',
      'lag(source_timestamp) OVER w')} > 1200, true) AS brk FROM msg WINDOW w AS (PARTITION BY factory_id ORDER BY source_timestamp)),
    r AS (SELECT *, sum(brk::INT) OVER (PARTITION BY factory_id ORDER BY source_timestamp) AS run FROM g),
    s AS (SELECT factory_id, run, {age_sql('max(source_timestamp)', 'min(source_timestamp)')} AS secs FROM r GROUP BY 1, 2)
    SELECT factory_id, round(max(secs), 6) AS longest_seconds, max(secs) >= 36000 AS continuous FROM s GROUP BY 1""",
)
def d5(spark, d):
    rows = messages(spark, d).select("factory_id", "source_timestamp", "event_id")
    out = checks.continuity_check(rows, message_series(spark, d), TIMING.infra_period, TIMING.continuity_window)
    return out.select("factory_id", r6("longest_seconds").alias("longest_seconds"), "continuous")


# --- volume, rate, completeness, latency -----------------------------------------------------
@query(
    "a15_payload_stats",
    f"""WITH {MSG}, b AS (SELECT *, octet_length(encode(message_id || '|' || CAST(event_id AS VARCHAR))) AS size FROM msg)
    SELECT factory_id, source_type, count(*) AS messages, CAST(sum(size) AS BIGINT) AS total_bytes, round(avg(size), 6) AS mean_bytes,
    max(size) AS max_bytes, round(sum(size) / 1000 / {age_sql('max(source_timestamp)', 'min(source_timestamp)')}, 6) AS kb_per_second,
    round(sum(size) / 1000000 / {age_sql('max(source_timestamp)', 'min(source_timestamp)')} * 86400, 6) AS mb_per_day
    FROM b GROUP BY ALL""",
)
def a15(spark, d):
    # Both engines must see the same text, so the body is a short one here.
    body = F.concat_ws("|", "message_id", F.col("event_id").cast("string"))
    out = quality.payload_stats(messages(spark, d).withColumn("body", body))
    return out.select(
        "factory_id",
        "source_type",
        "messages",
        "total_bytes",
        r6("mean_bytes").alias("mean_bytes"),
        "max_bytes",
        r6("kb_per_second").alias("kb_per_second"),
        r6("mb_per_day").alias("mb_per_day"),
    )


@query(
    "a16_message_rate",
    f"""WITH {MSG} SELECT factory_id, source_type, {iso_sql(bucket_sql('received_at', 3600))} AS window_start,
    count(*) AS messages, round(count(*) / 3600, 6) AS per_second FROM msg GROUP BY ALL""",
)
def a16(spark, d):
    out = quality.message_rate(messages(spark, d), 3600)
    return out.select(
        "factory_id", "source_type", iso("window_start").alias("window_start"), "messages", r6("per_second").alias("per_second")
    )


@query(
    "a17_receive_success_rate",
    f"""WITH {MSG}, s AS (SELECT factory_id, source_type, count(DISTINCT message_id) AS received,
      {age_sql('max(source_timestamp)', 'min(source_timestamp)')} AS elapsed FROM msg GROUP BY 1, 2)
    SELECT factory_id, source_type, received, round(elapsed, 6) AS elapsed_seconds,
    CAST(floor(elapsed / CASE WHEN source_type = 'infra_state' THEN 1200 ELSE 180 END) + 1 AS BIGINT) AS expected,
    round(received / (floor(elapsed / CASE WHEN source_type = 'infra_state' THEN 1200 ELSE 180 END) + 1), 6) AS success_rate
    FROM s WHERE elapsed >= 36000""",
)
def a17(spark, d):
    rows = feed.with_repeats(messages(spark, d))
    out = quality.receive_success_rate(rows, TIMING, TIMING.continuity_window)
    return out.select(
        "factory_id",
        "source_type",
        "received",
        r6("elapsed_seconds").alias("elapsed_seconds"),
        "expected",
        r6("success_rate").alias("success_rate"),
    )


@query(
    "a18_latency_stats",
    f"""WITH {MSG}, d AS (SELECT factory_id, unnest(['source_to_publish', 'publish_to_receive', 'source_to_receive']) AS stage,
      unnest([{age_sql('published_at', 'source_timestamp')}, {age_sql('received_at', 'published_at')},
              {age_sql('received_at', 'source_timestamp')}]) AS delay FROM msg)
    SELECT factory_id, stage, count(*) AS messages, round(avg(delay), 6) AS mean_delay, quantile_cont(delay, 0.5) AS p50,
    round(quantile_cont(delay, 0.95), 6) AS p95, max(delay) AS max_delay,
    round(count(*) FILTER (delay BETWEEN 3 AND 5) / count(*), 6) AS share_normal_target,
    round(count(*) FILTER (delay BETWEEN 4 AND 6) / count(*), 6) AS share_fault_target FROM d GROUP BY ALL""",
)
def a18(spark, d):
    targets = replace(TIMING, display_delay_from=3, display_delay_to=5, detect_from=4, detect_to=6)
    out = quality.latency_stats(messages(spark, d), timing=targets)
    return out.select(
        "factory_id",
        "stage",
        "messages",
        r6("mean_delay").alias("mean_delay"),
        "p50",
        r6("p95").alias("p95"),
        "max_delay",
        r6("share_normal_target").alias("share_normal_target"),
        r6("share_fault_target").alias("share_fault_target"),
    )


_STAGES = ("source_to_publish", "publish_to_receive", "source_to_receive", "source_to_processed")


@query(
    "a18_stored_hours",
    f"""WITH {MSG}, d AS (SELECT factory_id, unnest({list(_STAGES)}) AS stage,
      unnest([{age_sql('published_at', 'source_timestamp')}, {age_sql('received_at', 'published_at')}, {age_sql('received_at', 'source_timestamp')},
        {age_sql('received_at', 'source_timestamp')} + event_id % 1009 / 8]) AS delay FROM msg
      WHERE source_timestamp >= TIMESTAMP '2024-01-08' AND source_timestamp < TIMESTAMP '2024-01-22')
    SELECT factory_id, stage, count(*) AS messages, round(avg(delay), 6) AS mean_delay, round(quantile_cont(delay, 0.5), 6) AS p50,
    round(quantile_cont(delay, 0.95), 6) AS p95, round(quantile_cont(delay, 0.99), 6) AS p99, max(delay) AS max_delay FROM d GROUP BY ALL""",
)
def a18_stored(spark, d):
    # Hours are stored once; two weeks of percentiles come from them, not from messages.
    root = scratch(spark)
    took = F.make_dt_interval(secs=(F.col("event_id") % 1009 / 8).cast("decimal(18,6)"))
    rows = messages(spark, d).withColumn("processed_at", F.col("received_at") + took)
    hours = distributions.hourly_histogram(rows, ["factory_id"], quality.stage_delays(rows, "processed_at"), "source_timestamp")
    hours.hint("rebalance", "date").write.partitionBy("date").parquet(root)
    weeks = spark.read.schema(hours.schema).parquet(root).where("date >= '2024-01-08' AND date < '2024-01-22'")
    out = distributions.statistics(
        distributions.merged(weeks, ["factory_id"]), ["factory_id"], {"p50": 0.5, "p95": 0.95, "p99": 0.99}
    )
    return out.select(
        "factory_id",
        "stage",
        "messages",
        r6("mean").alias("mean_delay"),
        *[r6(p).alias(p) for p in ("p50", "p95", "p99")],
        F.col("max").alias("max_delay"),
    )


@query(
    "u3_except_messages",
    f"WITH {MSG} SELECT message_id FROM msg WHERE source_type = 'infra_state'",
)
def u3(spark, d):
    # What is archived (with repeats) but was never scored.
    archived = feed.with_repeats(messages(spark, d))
    return quality.except_messages(archived, scored(spark, d))


_REWEIGHTED = f"""{SCORED}, v AS (SELECT *, least(greatest(c1 + c2 + c4 + c5 / 35 * 20 + c6 + c7, 0), 100) AS s2 FROM leveled)"""


@query(
    "j5_reconcile_raw_processed",
    f"""WITH {_REWEIGHTED}, o AS (SELECT CASE WHEN round(s2, 6) = round(risk_score, 6) THEN 'equal' ELSE 'differing' END AS outcome FROM v)
    SELECT direction, outcome, count(*) AS messages FROM (
      SELECT 'archive' AS direction, outcome FROM o UNION ALL SELECT 'archive', 'missing' FROM msg WHERE source_type = 'infra_state' UNION ALL
      SELECT 'processed', outcome FROM o UNION ALL SELECT 'processed', 'extra' FROM msg WHERE source_type = 'infra_state') GROUP BY ALL""",
)
def j5(spark, d):
    # The archive holds both source types, repeats and the old scores; the
    # processed side holds factory messages under new weights.
    score = F.round("risk_score", 6).alias("risk_score")
    old = scored(spark, d).select("message_id", score)
    archived = feed.with_repeats(messages(spark, d)).select("message_id").join(old, "message_id", "left")
    new = risk.score_messages(factory(spark, d), config(spark).thresholds, NEW_WEIGHTS).select("message_id", score)
    parts = [
        quality.reconcile(a, b, ["risk_score"]).withColumn("direction", F.lit(name))
        for name, a, b in (("archive", archived, new), ("processed", new, archived))
    ]
    return parts[0].unionByName(parts[1]).groupBy("direction", "outcome").agg(F.count(F.lit(1)).alias("messages"))


@query(
    "j5_reconcile_branches",
    f"""WITH {SCORED}, x AS (SELECT message_id, event_id, source_type, source_timestamp AS t FROM msg)
    SELECT message_id, CASE WHEN event_id % 13 = 0 THEN 'contradicting' WHEN event_id % 7 = 0 THEN 'missing'
      WHEN event_id % 11 = 0 THEN 'extra' ELSE 'differing' END AS outcome FROM x
    WHERE source_type = 'factory_state' AND t >= TIMESTAMP '2024-01-12' AND t < TIMESTAMP '2024-01-14'
      AND (event_id % 13 = 0 OR event_id % 7 = 0 OR event_id % 11 = 0 OR event_id % 5 = 0)""",
)
def j5_branches(spark, d):
    # The second archive went wrong on two days: lost, added, changed and contradicting messages.
    rows = scored(spark, d).select("factory_id", "source_timestamp", "message_id", "event_id", F.round("risk_score", 6).alias("risk_score"))
    bad = F.col("source_timestamp").between("2024-01-12", "2024-01-13 23:59:59.999999")
    every = lambda n: bad & (F.col("event_id") % n == 0)
    twice = F.when(every(13), F.array(F.lit(0.0), F.lit(1.0))).otherwise(F.array(F.lit(0.0)))
    first = rows.where(~every(11) | every(13) | every(7))
    second = (
        rows.where(~every(7) | every(13))
        .withColumn("_more", F.explode(twice))
        .withColumn("risk_score", F.col("risk_score") + F.col("_more") + F.when(every(5) & ~every(13), 1.0).otherwise(0.0))
    )
    repeated = first.unionByName(first.where("event_id % 10 = 0"))
    return reconcile.reconcile_branches(
        reconcile.prepared(repeated, ["risk_score"]), reconcile.prepared(second, ["risk_score"])
    )


NEW_WEIGHTS = {**dict(C.MESSAGE_WEIGHTS), "fall_score": 20.0}


@query(
    "r15_compare_versions",
    f"""WITH {SCORED}, v AS (SELECT *, least(greatest(c1 + c2 + c4 + c5 / 35 * 20 + c6 + c7, 0), 100) AS s2 FROM leveled),
    w AS (SELECT *, CASE WHEN s2 < 40 THEN 'safe' WHEN s2 < 70 THEN 'warning' ELSE 'danger' END AS l2 FROM v)
    SELECT factory_id, count(*) AS messages, count(*) FILTER (abs(s2 - risk_score) > 1e-9) AS changed,
    count(*) FILTER (l2 <> risk_level) AS level_changed, round(avg(s2 - risk_score), 6) AS mean_delta,
    round(max(abs(s2 - risk_score)), 6) AS max_abs_delta FROM w GROUP BY 1""",
)
def r15(spark, d):
    # The archive is scored again under new weights and compared.
    again = risk.score_messages(factory(spark, d), config(spark).thresholds, NEW_WEIGHTS, "risk-v0.2.0")
    out = quality.compare_versions(scored(spark, d), again)
    return out.select(
        "factory_id",
        "messages",
        "changed",
        "level_changed",
        r6("mean_delta").alias("mean_delta"),
        r6("max_abs_delta").alias("max_abs_delta"),
    )




def _scorer(spark, version, weights):
    """Archived messages to results under the given weights."""
    columns = ("message_id", "factory_id", "event_timestamp", "day", "risk_score", "risk_level")

    def score(rows):
        ready = checks.factory_rows(rows.withColumn("received_at", F.timestamp_millis("received_at")))
        return risk.score_messages(ready, config(spark).thresholds, weights, version).select(*columns)

    return score


@query(
    "r15_reprocess",
    f"""WITH {_REWEIGHTED}, w AS (SELECT *, strftime(received_at, '%Y-%m-%d') AS day FROM v),
    d AS (SELECT 'risk-v0.1.0' AS version, day, count(*) AS messages, round(sum(risk_score), 4) AS total FROM w GROUP BY day
      UNION ALL SELECT 'risk-v0.2.0', day, count(*), round(sum(s2), 4) FROM w GROUP BY day)
    SELECT *, 0 AS computed_again FROM d""",
)
def r15_reprocess(spark, d):
    # First delivery: no original of every eleventh message, but a copy a day
    # later. Its results are cut off after one job and gone on with. The second
    # delivery brings the originals and copies of other messages: the days it
    # touches, and those that had counted the copies, are computed anew.
    root = scratch(spark)
    m = messages(spark, d)
    day_later = m.withColumn("received_at", clock.plus_seconds("received_at", 26 * 3600))
    eleventh, tenth = F.col("event_id") % 11 == 0, F.col("event_id") % 10 == 0
    old = _scorer(spark, "risk-v0.1.0", C.MESSAGE_WEIGHTS)
    new = _scorer(spark, "risk-v0.2.0", NEW_WEIGHTS)
    lake.write_raw(m.where(~eleventh).unionByName(day_later.where(eleventh)), f"{root}/raw")
    reprocess.reprocess(spark, f"{root}/raw", root, "risk-v0.1.0", old, days_at_once=9, stop_after=1)
    reprocess.reprocess(spark, f"{root}/raw", root, "risk-v0.1.0", old)
    lake.write_raw(m.where(eleventh).unionByName(day_later.where(tenth & ~eleventh)), f"{root}/raw")
    again = 0
    for version, score in (("risk-v0.1.0", old), ("risk-v0.2.0", new)):
        reprocess.reprocess(spark, f"{root}/raw", root, version, score)
        again += len(reprocess.reprocess(spark, f"{root}/raw", root, version, score).computed)
    found = [reprocess.read_results(spark, root, version) for version in ("risk-v0.1.0", "risk-v0.2.0")]
    return (
        found[0].unionByName(found[1])
        .groupBy("version", "day")
        .agg(F.count(F.lit(1)).alias("messages"), F.round(F.sum("risk_score"), 4).alias("total"))
        .withColumn("computed_again", F.lit(again))
    )
