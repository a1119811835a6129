"""Sources, sinks, topic rule, parsing, stores (S), identifiers and keys (P7-P9)."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from plantpulse.functions import clock, text
from plantpulse.operators import checks, directory, risk, state
from plantpulse.plans.catalog.registry import (
    AS_OF,
    MSG,
    FS,
    ENV,
    SCORED,
    TIMING,
    TOPIC_ROOT,
    bucket_sql,
    config,
    detections,
    environment,
    factory,
    infra,
    iso,
    iso_sql,
    messages,
    query,
    r6,
    scratch,
    sounds,
)
from plantpulse.sources import lake, latest, upkeep

DAY_FROM, DAY_TO = datetime(2024, 1, 10), datetime(2024, 1, 12)


def topics(m):
    """Messages with the topic they came on; some topics do not fit the rule."""
    good = text.topic(TOPIC_ROOT, F.col("factory_id"), F.col("source_type"))
    return m.withColumn(
        "topic",
        F.when(F.col("event_id") % 13 == 0, F.concat(good, F.lit("/extra")))
        .when(F.col("event_id") % 17 == 0, F.concat(F.lit("other/"), F.col("factory_id"), F.lit("/x")))
        .otherwise(good),
    )


_TOPICS = MSG + """,
tp AS (SELECT *, CASE WHEN event_id % 13 = 0 THEN 'fleet/' || factory_id || '/' || source_type || '/extra'
  WHEN event_id % 17 = 0 THEN 'other/' || factory_id || '/x'
  ELSE 'fleet/' || factory_id || '/' || source_type END AS topic FROM msg)"""


@query(
    "s1_filter_topic",
    f"WITH {_TOPICS} SELECT event_id, topic FROM tp WHERE topic LIKE 'fleet/%/%' AND topic NOT LIKE 'fleet/%/%/%'",
)
def s1(spark, d):
    return checks.filter_topic(topics(messages(spark, d)), TOPIC_ROOT).select("event_id", "topic")


@query(
    "s2_ingest_projection",
    f"""WITH {_TOPICS} SELECT event_id, split_part(topic, '/', 3) AS source_type,
    (epoch_us(received_at) // 1000) AS received_at FROM tp
    WHERE topic LIKE 'fleet/%/%' AND topic NOT LIKE 'fleet/%/%/%'""",
)
def s2(spark, d):
    kept = checks.filter_topic(topics(messages(spark, d)), TOPIC_ROOT).drop("source_type")
    return checks.ingest_projection(kept, F.col("received_at")).select("event_id", "source_type", "received_at")


@query(
    "s3_assign_message_id",
    f"""WITH {MSG} SELECT event_id, CASE WHEN event_id % 19 <> 0 THEN message_id ELSE
    sha256('{{"factory_id":"' || factory_id || '","source_type":"' || source_type || '","event_id":' || event_id || '}}')
    END AS message_id FROM msg""",
)
def s3(spark, d):
    rows = messages(spark, d).select(
        F.when(F.col("event_id") % 19 != 0, F.col("message_id")).alias("message_id"),
        "factory_id",
        "source_type",
        "event_id",
    )
    return checks.assign_message_id(rows).select("event_id", "message_id")


@query(
    "s4_write_raw",
    f"""WITH {MSG} SELECT message_id, factory_id, source_type, strftime(received_at, '%Y') AS yyyy,
    strftime(received_at, '%m') AS mm, strftime(received_at, '%d') AS dd, (epoch_us(received_at) // 1000) AS received_at FROM msg""",
)
def s4(spark, d):
    root = scratch(spark)
    lake.write_raw(messages(spark, d), root)
    return lake.read_raw(spark, root).select(
        "message_id", "factory_id", "source_type", "yyyy", "mm", "dd", "received_at"
    )


@query(
    "s5_read_raw",
    f"""WITH {FS} SELECT message_id, {iso_sql('source_timestamp')} AS source_time, round(temperature, 6) AS temperature
    FROM fs WHERE factory_id = 'factory-b' AND source_timestamp BETWEEN TIMESTAMP '2024-01-10' AND TIMESTAMP '2024-01-12'""",
)
def s5(spark, d):
    root = scratch(spark)
    lake.write_raw(messages(spark, d), root)
    rows = lake.read_raw(spark, root, "factory-b", "factory_state", DAY_FROM, DAY_TO)
    return rows.select(
        "message_id",
        iso("source_timestamp").alias("source_time"),
        r6("payload.sensor.temperature_celsius_avg").alias("temperature"),
    )


@query(
    "s5_read_raw_late",
    f"""WITH {MSG} SELECT message_id, {iso_sql('source_timestamp')} AS source_time FROM msg
    WHERE factory_id = 'factory-b' AND source_timestamp >= TIMESTAMP '2024-01-10'""",
)
def s5_late(spark, d):
    # A tenth of the messages comes out of a spool three days late; the range has no end.
    root = scratch(spark)
    wait = F.when(F.col("event_id") % 10 == 0, F.expr("interval 3 days")).otherwise(F.expr("interval 0 days"))
    lake.write_raw(messages(spark, d).withColumn("received_at", F.col("received_at") + wait), root)
    rows = lake.read_raw(spark, root, "factory-b", start=DAY_FROM)
    return rows.select("message_id", iso("source_timestamp").alias("source_time"))


def scored(spark, d):
    return risk.score_messages(factory(spark, d), config(spark).thresholds)


def risk_history(spark, d, ttl_seconds=86400):
    last = state.last_per_bucket(factory(spark, d), TIMING)
    return state.risk_history(risk.score_messages(last, config(spark).thresholds), TIMING, ttl_seconds)


@query(
    "s5_read_raw_ahead",
    f"""WITH {MSG} SELECT message_id FROM msg WHERE source_timestamp BETWEEN TIMESTAMP '2024-01-10' AND TIMESTAMP '2024-01-12'""",
)
def s5_ahead(spark, d):
    # The source clocks run 50 minutes ahead: messages of the first hour lie in the day before.
    root = scratch(spark)
    behind = F.expr("interval 50 minutes")
    lake.write_raw(messages(spark, d).withColumn("received_at", F.col("source_timestamp") - behind), root)
    return lake.read_raw(spark, root, start=DAY_FROM, end=DAY_TO).select("message_id")


@query(
    "s6_write_processed",
    f"""WITH {SCORED} SELECT message_id, factory_id, strftime(source_timestamp, '%Y-%m-%d %H') AS hour,
    round(risk_score, 6) AS risk_score, risk_level FROM leveled""",
)
def s6(spark, d):
    root = scratch(spark)
    rows = scored(spark, d).select("factory_id", "message_id", "event_timestamp", "risk_score", "risk_level")
    lake.write_processed(rows, root, "risk-score", tasks=lake.backfill_tasks(spark))
    out = lake.read_processed(spark, root, "risk-score", rows.schema)
    return out.select(
        "message_id",
        "factory_id",
        F.concat(F.concat_ws("-", "yyyy", "mm", "dd"), F.lit(" "), F.col("hh")).alias("hour"),
        r6("risk_score").alias("risk_score"),
        "risk_level",
    )


def bodies(m):
    """JSON text of the messages; one in 97 is cut off."""
    body = checks.to_body(m)
    cut = F.expr("substring(body, 1, cast(length(body) / 2 as int))")
    return m.select("event_id", body.alias("body")).withColumn(
        "body", F.when(F.col("event_id") % 97 == 0, cut).otherwise(F.col("body"))
    )


@query(
    "s7_parse_messages",
    f"""WITH {FS} SELECT m.event_id, m.event_id % 97 = 0 AS corrupt,
    CASE WHEN m.event_id % 97 <> 0 THEN m.message_id END AS message_id,
    CASE WHEN m.event_id % 97 <> 0 THEN {iso_sql('m.published_at')} END AS published_at,
    CASE WHEN m.event_id % 97 <> 0 THEN round(fs.temperature, 6) END AS temperature,
    CASE WHEN m.event_id % 97 <> 0 AND m.source_type = 'infra_state' THEN m.event_id END AS publish_sequence
    FROM msg m LEFT JOIN fs ON m.event_id = fs.event_id""",
)
def s7(spark, d):
    # A cut text may still yield its leading fields, so they are masked here.
    parsed = checks.parse_messages(bodies(messages(spark, d)))
    ok = F.col(checks.CORRUPT).isNull()
    return parsed.select(
        "event_id",
        (~ok).alias("corrupt"),
        F.when(ok, F.col("message_id")).alias("message_id"),
        F.when(ok, iso("published_at")).alias("published_at"),
        F.when(ok, r6("payload.sensor.temperature_celsius_avg")).alias("temperature"),
        F.when(ok, F.col("payload.heartbeat.publish_sequence")).alias("publish_sequence"),
    )


@query(
    "s8_environment_data",
    f"""WITH {ENV} SELECT factory_id, node_id, {iso_sql('ts')} AS ts, round(temperature, 6) AS temperature,
    humidity, pressure FROM env""",
)
def s8_env(spark, d):
    return environment(spark, d).select(
        "factory_id", "node_id", iso("ts").alias("ts"), r6("temperature").alias("temperature"), "humidity", "pressure"
    )


@query(
    "s8_ai_detection",
    f"""WITH {ENV} SELECT factory_id, node_id, {iso_sql('ts')} AS ts, fire_detected, fallen_detected,
    bending_detected FROM ai""",
)
def s8_ai(spark, d):
    return detections(spark, d).select(
        "factory_id", "node_id", iso("ts").alias("ts"), "fire_detected", "fallen_detected", "bending_detected"
    )


@query(
    "s8_acoustic_detection",
    f"WITH {ENV} SELECT factory_id, node_id, {iso_sql('ts')} AS ts, is_danger, label FROM snd",
)
def s8_sound(spark, d):
    return sounds(spark, d).select("factory_id", "node_id", iso("ts").alias("ts"), "is_danger", "label")


@query(
    "s9_upsert_latest",
    f"""WITH {FS} SELECT factory_id, message_id, {iso_sql('source_timestamp')} AS source_time,
    round(temperature, 6) AS temperature FROM fs
    QUALIFY row_number() OVER (PARTITION BY factory_id ORDER BY source_timestamp DESC) = 1""",
)
def s9(spark, d):
    # Three batches whose rows interleave in time: arrival order must not matter.
    root = scratch(spark)
    rows = factory(spark, d).select(
        "factory_id", "message_id", "source_timestamp", "published_at", "sensor", "event_id"
    )
    for batch in (2, 0, 1):
        latest.upsert_latest(rows.where(F.col("event_id") % 3 == batch).drop("event_id"), root, (2, 0, 1).index(batch))
    return latest.read_latest(spark, root).select(
        "factory_id",
        "message_id",
        iso("source_timestamp").alias("source_time"),
        r6("sensor.temperature_celsius_avg").alias("temperature"),
    )


_RISK_HISTORY = f"""
rh AS (SELECT *, {bucket_sql('source_timestamp', TIMING.history_bucket)} + to_seconds({TIMING.history_bucket}) AS bucket FROM leveled
  QUALIFY row_number() OVER (PARTITION BY factory_id, bucket ORDER BY source_timestamp DESC) = 1)"""


@query(
    "s10_append_history",
    f"""WITH {SCORED}, {_RISK_HISTORY} SELECT 'FACTORY#' || factory_id AS pk,
    'HISTORY#RISK#' || strftime(bucket, '%Y-%m-%dT%H:%M:%SZ') AS sk, round(risk_score, 6) AS risk_score, risk_level,
    CAST(epoch(bucket) AS BIGINT) + 86400 AS ttl FROM rh
    WHERE bucket BETWEEN TIMESTAMP '2024-01-10' AND TIMESTAMP '2024-01-12'""",
)
def s10(spark, d):
    root = scratch(spark)
    history = risk_history(spark, d)
    lake.append_history(history, root, "RISK")
    rows = lake.read_history(spark, root, "RISK", history.schema, start=DAY_FROM, end=DAY_TO)
    return rows.select("pk", "sk", r6("risk_score").alias("risk_score"), "risk_level", "ttl")


@query(
    "s11_load_config",
    f"""WITH {MSG}, rule AS (SELECT * FROM (VALUES ('temperature', 15.0::DOUBLE, true), ('humidity', 10, true),
     ('node_status', 20, true), ('pod_health', 15, true), ('data_freshness', 15, true), ('ai_event_rate', 10, true),
     ('storage_pressure', 10, true), ('network_reachability', 5, true), ('camera_snapshot', 0, false),
     ('audio_level', 0, false)) AS t(field, weight, risk_enabled))
    SELECT factory_id, field, CASE WHEN factory_id = 'factory-c' AND field = 'network_reachability' THEN 10
      WHEN factory_id = 'factory-c' AND field = 'storage_pressure' THEN 5 ELSE weight END AS weight, risk_enabled,
      count(*) AS messages FROM msg, rule GROUP BY ALL""",
)
def s11(spark, d):
    per_site = messages(spark, d).groupBy("factory_id").agg(F.count(F.lit(1)).alias("messages"))
    return directory.effective_rules(config(spark)).join(per_site, "factory_id").select(
        "factory_id", "field", "weight", "risk_enabled", "messages"
    )


@query(
    "s12_compact_raw",
    f"""WITH {MSG} SELECT factory_id, source_type, strftime(received_at, '%Y-%m-%d') AS day, count(*) AS messages,
    count(DISTINCT message_id) AS ids, CAST(sum((epoch_us(received_at) // 1000) % 100000) AS BIGINT) AS checksum FROM msg GROUP BY ALL""",
)
def s12(spark, d):
    root = scratch(spark)
    lake.write_raw(messages(spark, d), f"{root}/raw")
    lake.compact_raw(spark, f"{root}/raw", f"{root}/compact")
    rows = lake.read_raw(spark, f"{root}/compact", fmt="parquet")
    return rows.groupBy("factory_id", "source_type", F.concat_ws("-", "yyyy", "mm", "dd").alias("day")).agg(
        F.count(F.lit(1)).alias("messages"),
        F.count_distinct("message_id").alias("ids"),
        F.sum(F.col("received_at") % 100000).alias("checksum"),
    )


@query(
    "s12_compact_days",
    f"""WITH {MSG} SELECT strftime(received_at, '%Y-%m-%d') AS day, count(*) AS messages,
    CASE WHEN strftime(received_at, '%Y-%m-%d') IN ('2024-01-10', '2024-01-20') THEN 1 ELSE 0 END AS compacted_again FROM msg GROUP BY 1""",
)
def s12_days(spark, d):
    # All days are compacted; then two of them get messages that had been held back.
    root = scratch(spark)
    m = messages(spark, d)
    held = F.date_format("received_at", "yyyy-MM-dd").isin("2024-01-10", "2024-01-20") & (F.col("event_id") % 3 == 0)
    lake.write_raw(m.where(~held), f"{root}/raw")
    upkeep.compact_days(spark, f"{root}/raw", root)
    lake.write_raw(m.where(held), f"{root}/raw")
    again = upkeep.compact_days(spark, f"{root}/raw", root)
    rows = upkeep.read_archive(spark, f"{root}/raw", root)
    day = F.date_format(F.timestamp_millis("received_at"), "yyyy-MM-dd").alias("day")
    return rows.groupBy(day).agg(F.count(F.lit(1)).alias("messages")).withColumn(
        "compacted_again", F.col("day").isin(again).cast("int")
    )


@query(
    "s13_read_long_history",
    f"""WITH {SCORED}, {_RISK_HISTORY} SELECT factory_id, {iso_sql('bucket')} AS ts, round(risk_score, 6) AS risk_score,
      'history' AS origin FROM rh WHERE bucket > TIMESTAMP '2024-01-30'
    UNION ALL SELECT factory_id, {iso_sql('source_timestamp')}, round(risk_score, 6), 'processed' FROM leveled
      WHERE source_timestamp <= TIMESTAMP '2024-01-30'""",
)
def s13(spark, d):
    history = risk_history(spark, d)
    processed = scored(spark, d).withColumn("timestamp", F.col("event_timestamp"))
    out = lake.long_history(history, processed, AS_OF)
    return out.select("factory_id", iso("timestamp").alias("ts"), r6("risk_score").alias("risk_score"), "origin")


@query(
    "u2_union_factories",
    f"WITH {MSG} SELECT factory_id, source_type, count(*) AS messages FROM msg GROUP BY ALL",
)
def u2(spark, d):
    # One partitioned table serves the fleet; the union of its sites is one scan.
    root = scratch(spark)
    lake.write_raw(messages(spark, d), root, fmt="parquet")
    rows = lake.read_raw(spark, root, fmt="parquet")
    return rows.groupBy("factory_id", "source_type").agg(F.count(F.lit(1)).alias("messages"))


@query(
    "q13_processed_detail",
    f"""WITH {SCORED} SELECT message_id, round(risk_score, 6) AS risk_score, risk_level FROM leveled
    WHERE message_id = (SELECT max(message_id) FROM leveled)""",
)
def q13(spark, d):
    root = scratch(spark)
    rows = scored(spark, d).select("factory_id", "message_id", "event_timestamp", "risk_score", "risk_level")
    lake.write_processed(rows, root, "risk-score", tasks=lake.backfill_tasks(spark))
    wanted = rows.agg(F.max("message_id")).first()[0]
    out = lake.processed_detail(lake.read_processed(spark, root, "risk-score", rows.schema), wanted)
    return out.select("message_id", r6("risk_score").alias("risk_score"), "risk_level")


@query(
    "p7_message_id_parts",
    f"""WITH {MSG} SELECT event_id, factory_id AS id_factory, source_type AS id_source_type, node_id AS id_node,
    {iso_sql('source_timestamp')} AS id_timestamp FROM msg""",
)
def p7(spark, d):
    return checks.with_id_parts(messages(spark, d)).select(
        "event_id", "id_factory", "id_source_type", "id_node", "id_timestamp"
    )


@query(
    "p8_topic_and_object_key",
    f"""WITH {MSG} SELECT event_id, 'fleet/' || factory_id || '/' || source_type AS topic,
    'raw/' || factory_id || '/' || source_type || strftime(received_at, '/yyyy=%Y/mm=%m/dd=%d/') || message_id || '.json' AS raw_key,
    'processed/infra-state/' || factory_id || strftime(source_timestamp, '/yyyy=%Y/mm=%m/dd=%d/hh=%H/') || message_id || '.json' AS processed_key
    FROM msg""",
)
def p8(spark, d):
    c = F.col
    return messages(spark, d).select(
        "event_id",
        text.topic(TOPIC_ROOT, c("factory_id"), c("source_type")).alias("topic"),
        text.object_key("raw", [c("factory_id"), c("source_type")], c("received_at"), c("message_id")).alias("raw_key"),
        text.object_key(
            "processed", [F.lit("infra-state"), c("factory_id")], c("source_timestamp"), c("message_id"), hours=True
        ).alias("processed_key"),
    )


@query(
    "p9_store_keys",
    f"""WITH {MSG} SELECT event_id, 'FACTORY#' || factory_id AS pk,
    'HISTORY#INFRA#' || strftime(source_timestamp, '%Y-%m-%dT%H:%M:%SZ') AS sk,
    CAST(epoch_us(source_timestamp) // 1000000 AS BIGINT) + 86400 AS ttl FROM msg WHERE source_type = 'infra_state'""",
)
def p9(spark, d):
    rows = checks.with_store_keys(infra(spark, d), "INFRA", "source_timestamp")
    return rows.select("event_id", "pk", "sk", clock.ttl("source_timestamp", 86400).alias("ttl"))
