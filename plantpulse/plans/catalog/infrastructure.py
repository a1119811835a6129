"""Current state, infrastructure sections, metrics and configuration joins."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from plantpulse import contract as C
from plantpulse.functions import clock, rules
from plantpulse.operators import directory, metrics, risk, state
from plantpulse.plans import views
from plantpulse.plans.catalog.registry import (
    AS_OF,
    FS,
    INF,
    MSG,
    TIMING,
    age_sql,
    bucket_sql,
    config,
    factory,
    infra,
    iso,
    iso_sql,
    messages,
    query,
    r6,
    slice_seconds,
)

_AS_OF = f"TIMESTAMP '{AS_OF}'"


@query(
    "a7_latest_per_factory",
    f"""WITH {MSG} SELECT factory_id, source_type, message_id, {iso_sql('source_timestamp')} AS source_time, event_id FROM msg
    QUALIFY row_number() OVER (PARTITION BY factory_id, source_type ORDER BY source_timestamp DESC) = 1""",
)
def a7(spark, d):
    rows = messages(spark, d).select("factory_id", "source_type", *state.NEWEST, "event_id")
    out = state.latest_per_factory(rows)
    return out.select("factory_id", "source_type", "message_id", iso("source_timestamp").alias("source_time"), "event_id")


@query("a8_node_summary", f"WITH {INF} SELECT event_id, 3 AS total, ready, 3 - ready AS not_ready FROM inf")
def a8(spark, d):
    return infra(spark, d).select("event_id", state.node_summary(F.col("nodes")).alias("s")).select("event_id", "s.*")


@query(
    "a9_workload_summary",
    f"""WITH {INF} SELECT event_id, 3 AS total, running, 3 - running AS unhealthy, 3 * (event_id % 3) AS restart_count_total FROM inf""",
)
def a9(spark, d):
    return infra(spark, d).select("event_id", state.workload_summary(F.col("workloads")).alias("s")).select(
        "event_id", "s.*"
    )


@query(
    "a10_device_summary",
    f"""WITH {INF} SELECT event_id, bme280 AS bme280_available, camera AS camera_available, microphone AS microphone_available FROM inf""",
)
def a10(spark, d):
    return infra(spark, d).select("event_id", state.device_summary(F.col("devices")).alias("s")).select("event_id", "s.*")


@query(
    "a20_resource_usage_stats",
    f"""WITH {INF} SELECT factory_id, node_id, count(*) AS samples, round(avg(cpu), 6) AS cpu_mean, max(cpu) AS cpu_peak,
    round(avg(memory), 6) AS memory_mean, max(memory) AS memory_peak, round(avg(disk), 6) AS disk_mean, max(disk) AS disk_peak,
    count(*) FILTER (greatest(cpu, memory, disk) >= 80) AS over_limit FROM node GROUP BY ALL""",
)
def a20(spark, d):
    out = metrics.resource_usage_stats(metrics.node_rows(infra(spark, d)))
    means = ("cpu_mean", "memory_mean", "disk_mean")
    return out.select(*[r6(c).alias(c) if c in means else c for c in out.columns])


LOOKBACK = 60 * metrics.LOOKBACK_SECONDS


def up_samples(spark, d):
    """`up` samples of the agents: 1 while the node is ready."""
    nodes = metrics.node_rows(infra(spark, d))
    return nodes.select(
        F.lit("up").alias("metric"),
        F.create_map(
            F.lit("cluster"), F.col("factory_id"), F.lit("job"), F.lit("nodes"), F.lit("instance"), F.col("node_id")
        ).alias("labels"),
        "ts",
        F.col("ready").cast("double").alias("value"),
    )


@query(
    "a21_up_target_count",
    f"""WITH {INF}, l AS (SELECT factory_id, node_id, arg_max(ready, ts) AS up FROM node
      WHERE ts <= TIMESTAMP '2024-01-20' AND ts > TIMESTAMP '2024-01-20' - to_seconds({LOOKBACK}) GROUP BY ALL)
    SELECT factory_id AS cluster, count(*) AS targets, count(*) FILTER (up) AS up_targets FROM l GROUP BY 1""",
)
def a21(spark, d):
    return metrics.up_target_count(up_samples(spark, d), "2024-01-20 00:00:00", lookback_seconds=LOOKBACK)


def ending_samples(spark, d):
    """`up` samples of which one target stops without a word, and one with a marker."""
    ends = F.when((F.col("labels")["instance"] == "worker1") & (F.col("ts") > "2024-01-12"), "silent").when(
        (F.col("labels")["instance"] == "worker2") & (F.col("ts") > "2024-01-16"), "marked"
    )
    rows = up_samples(spark, d).withColumn("_end", ends)
    kept = rows.where("_end is null").drop("_end")
    marked = rows.where("_end = 'marked'").groupBy("metric", "labels.cluster", "labels.job", "labels.instance").agg(F.min("ts").alias("ts"))
    marks = marked.select(
        "metric",
        F.create_map(*[x for n in metrics.LABELS for x in (F.lit(n), F.col(n))]).alias("labels"),
        "ts",
        F.lit(float("nan")).alias("value"),
    )
    return kept.unionByName(marks)


_ENDING = f"""{INF}, sm AS (SELECT factory_id, node_id, ts, ready::INT::DOUBLE AS v FROM node
  WHERE NOT (node_id = 'worker1' AND ts > TIMESTAMP '2024-01-12') AND NOT (node_id = 'worker2' AND ts > TIMESTAMP '2024-01-16')
  UNION ALL SELECT factory_id, node_id, min(ts), NULL FROM node WHERE node_id = 'worker2' AND ts > TIMESTAMP '2024-01-16' GROUP BY ALL)"""


@query(
    "a21_ended_targets",
    f"""WITH {_ENDING}, m AS (SELECT unnest([TIMESTAMP '2024-01-12 02:00:00', TIMESTAMP '2024-01-16 06:00:00', TIMESTAMP '2024-01-20']) AS moment),
    l AS (SELECT moment, factory_id, node_id, v FROM m JOIN sm ON ts <= moment AND ts > moment - to_seconds({LOOKBACK})
      QUALIFY row_number() OVER (PARTITION BY moment, factory_id, node_id ORDER BY ts DESC) = 1)
    SELECT {iso_sql('l.moment')} AS moment, factory_id AS cluster, count(*) AS targets, count(*) FILTER (v = 1) AS up_targets FROM l
    WHERE v IS NOT NULL GROUP BY l.moment, factory_id""",
)
def a21_ended(spark, d):
    rows = ending_samples(spark, d)
    moments = ("2024-01-12 02:00:00", "2024-01-16 06:00:00", "2024-01-20 00:00:00")
    parts = [
        metrics.up_target_count(rows, at, lookback_seconds=LOOKBACK).select(
            iso(F.lit(at).cast("timestamp")).alias("moment"), "cluster", "targets", "up_targets"
        )
        for at in moments
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "a22_values_at_steps",
    f"""WITH {_ENDING}, b AS (SELECT factory_id, node_id, CAST(floor(epoch_us(min(ts)) / 7200e6) AS BIGINT) AS lo,
      CAST(ceil((epoch_us(max(ts)) + {LOOKBACK * 1000000}) / 7200e6) AS BIGINT) AS hi FROM sm GROUP BY ALL),
    g AS (SELECT factory_id, node_id, make_timestamp(unnest(generate_series(lo, hi)) * 7200000000) AS step FROM b),
    a AS (SELECT g.factory_id, g.node_id, step, sm.v, sm.ts FROM g ASOF JOIN sm ON g.factory_id = sm.factory_id AND g.node_id = sm.node_id AND g.step >= sm.ts)
    SELECT factory_id AS cluster, 'nodes' AS job, node_id AS instance, {iso_sql('step')} AS step, v AS value FROM a
    WHERE v IS NOT NULL AND ts > step - to_seconds({LOOKBACK})""",
)
def a22_steps(spark, d):
    out = metrics.values_at_steps(ending_samples(spark, d), 7200, lookback_seconds=LOOKBACK)
    return out.withColumn("step", iso("step"))


@query(
    "a22_up_series",
    f"""WITH {INF} SELECT factory_id AS cluster, 'nodes' AS job, node_id AS instance, {iso_sql(bucket_sql('ts', 3600))} AS step,
    arg_max(ready::INT::DOUBLE, ts) AS value FROM node GROUP BY ALL""",
)
def a22(spark, d):
    return metrics.up_series(up_samples(spark, d), 3600).withColumn("step", iso("step"))


@query(
    "a24_ai_event_rate",
    f"""WITH {FS} SELECT factory_id, {iso_sql(bucket_sql('source_timestamp', 3600))} AS window_start,
    count(*) FILTER (greatest(fire, fall, bend) >= 0.75) AS ai_events, count(*) AS messages FROM fs GROUP BY ALL""",
)
def a24(spark, d):
    return risk.ai_event_rate(factory(spark, d)).withColumn("window_start", iso("window_start"))


@query(
    "a25_collect_infra_state",
    f"""WITH {INF}, n AS (SELECT factory_id, {bucket_sql('ts', TIMING.infra_bucket)} AS w, node_id, arg_max(cpu, ts) AS cpu,
      arg_max(ready, ts) AS ready FROM node GROUP BY ALL),
    nn AS (SELECT factory_id, w, count(*) AS node_count, string_agg(node_id, ',' ORDER BY node_id) AS node_ids, sum(cpu) AS cpu_total,
      count(*) FILTER (ready) AS ready FROM n GROUP BY ALL),
    wl AS (SELECT factory_id, {bucket_sql('ts', TIMING.infra_bucket)} AS w, name, arg_max(status, ts) AS status FROM workload GROUP BY ALL),
    ww AS (SELECT factory_id, w, count(*) AS workload_count, count(*) FILTER (status = 'Running') AS running FROM wl GROUP BY ALL)
    SELECT factory_id, {iso_sql('w')} AS window_start, node_count, node_ids, round(cpu_total, 6) AS cpu_total, ready, workload_count, running
    FROM nn FULL JOIN ww USING (factory_id, w)""",
)
def a25(spark, d):
    rows = infra(spark, d)
    loads = rows.select("factory_id", F.col("source_timestamp").alias("ts"), "event_id", F.explode("workloads").alias("w"))
    loads = loads.select("factory_id", "ts", "event_id", "w.name", "w.status")
    out = state.collect_infra_state(metrics.node_rows(rows), loads, TIMING.infra_bucket)
    return out.select(
        "factory_id",
        iso("window_start").alias("window_start"),
        F.size("nodes").alias("node_count"),
        F.array_join(F.transform("nodes", lambda n: n.node_id), ",").alias("node_ids"),
        r6(F.aggregate("nodes", F.lit(0.0), lambda a, n: a + n.cpu_usage_percent)).alias("cpu_total"),
        F.size(F.filter("nodes", lambda n: n.ready)).alias("ready"),
        F.size("workloads").alias("workload_count"),
        F.size(F.filter("workloads", lambda w: w.status == "Running")).alias("running"),
    )


# --- joins -------------------------------------------------------------------------------------
_LATEST = """lf AS (SELECT * FROM fs QUALIFY row_number() OVER (PARTITION BY factory_id ORDER BY source_timestamp DESC) = 1),
li AS (SELECT * FROM inf QUALIFY row_number() OVER (PARTITION BY factory_id ORDER BY source_timestamp DESC) = 1)"""
FLEET = INF + FS[len(MSG):] + ", " + _LATEST


def fleet_state(spark, d):
    return state.assemble_latest(state.factory_section(factory(spark, d)), state.infra_section(infra(spark, d)))


@query(
    "j2_assemble_latest",
    f"""WITH {FLEET} SELECT factory_id, lf.message_id AS factory_message_id, li.message_id AS infra_message_id,
    {iso_sql('greatest(lf.source_timestamp, li.source_timestamp)')} AS updated_at, round(lf.temperature, 6) AS temperature,
    li.ready AS nodes_ready FROM lf FULL JOIN li USING (factory_id)""",
)
def j2(spark, d):
    return fleet_state(spark, d).select(
        "factory_id",
        "factory_message_id",
        "infra_message_id",
        iso("updated_at").alias("updated_at"),
        r6("sensor.temperature_celsius_avg").alias("temperature"),
        F.col("node_summary.ready").alias("nodes_ready"),
    )


ASOF = INF + FS[len(MSG):] + """, aso AS (SELECT fs.*, inf.event_id AS infra_event, inf.source_timestamp AS infra_at, inf.ready, inf.running,
  inf.published_at AS infra_published FROM fs ASOF LEFT JOIN inf ON fs.factory_id = inf.factory_id AND inf.source_timestamp <= fs.source_timestamp)"""


@query(
    "j3_asof_infra",
    f"""WITH {ASOF} SELECT event_id, {iso_sql('infra_at')} AS infra_at, ready FROM aso""",
)
def j3(spark, d):
    out = state.asof_infra(factory(spark, d), infra(spark, d), slice_seconds(spark, d), sections=("nodes",))
    return out.select(
        "event_id",
        iso("infra.at").alias("infra_at"),
        F.when(F.col("infra").isNotNull(), state.node_summary(F.col("infra.nodes"))["ready"]).alias("ready"),
    )


@query(
    "j3_asof_infra_tolerance",
    f"""WITH {ASOF} SELECT event_id, CASE WHEN {age_sql('source_timestamp', 'infra_at')} <= {TIMING.status_critical_after}
    THEN {iso_sql('infra_at')} END AS infra_at FROM aso""",
)
def j3_tolerance(spark, d):
    out = state.asof_infra(factory(spark, d), infra(spark, d), slice_seconds(spark, d), TIMING.status_critical_after, ())
    return out.select("event_id", iso("infra.at").alias("infra_at"))


@query(
    "j9_delivery_inputs",
    f"""WITH {MSG} SELECT factory_id, {iso_sql("max(received_at) FILTER (source_type = 'infra_state')")} AS latest_infra_at,
    {iso_sql('max(received_at)')} AS latest_raw_at, {iso_sql("max(published_at) FILTER (source_type = 'infra_state')")} AS last_publish_at
    FROM msg GROUP BY 1""",
)
def j9(spark, d):
    out = state.delivery_inputs(messages(spark, d))
    return out.select("factory_id", *[iso(c).alias(c) for c in out.columns[1:]])


_SPOTS = """spot AS (SELECT * FROM (VALUES ('factory-a', 'worker2', 'worker1'), ('factory-b', 'factory-b', NULL), ('factory-c', 'factory-c', NULL))
  AS t(factory_id, preferred, failover)),
placed AS (SELECT w.*, CASE WHEN status <> 'Running' THEN 'not_running' WHEN placed_on = preferred THEN 'preferred'
  WHEN placed_on = failover THEN 'failover' ELSE 'other' END AS placement_state FROM workload w LEFT JOIN spot USING (factory_id))"""


@query(
    "j11_placement_check",
    f"""WITH {INF}, {_SPOTS} SELECT event_id, name AS workload, placed_on, placement_state FROM placed""",
)
def j11(spark, d):
    out = directory.placement_check(infra(spark, d), config(spark).factories)
    return out.select("event_id", "workload", "placed_on", "placement_state")


@query(
    "r13_placement_state",
    f"""WITH {INF}, {_SPOTS} SELECT factory_id, name AS workload, placement_state, count(*) AS observations FROM placed GROUP BY ALL""",
)
def r13(spark, d):
    out = directory.placement_check(infra(spark, d), config(spark).factories)
    return out.groupBy("factory_id", "workload", "placement_state").agg(F.count(F.lit(1)).alias("observations"))


_TH = """th AS (SELECT * FROM (VALUES ('factory-b', 32.0::DOUBLE, 38.0::DOUBLE, 70.0::DOUBLE, 85.0::DOUBLE), ('factory-c', 33, 39, 72, 88))
  AS t(factory_id, tw, tc, hw, hc))"""


def _state_sql(value: str, warning: str, critical: str) -> str:
    return f"""CASE WHEN {value} IS NULL OR {warning} IS NULL THEN NULL WHEN {value} > {critical} THEN 'critical'
    WHEN {value} > {warning} THEN 'warning' ELSE 'normal' END"""


@query(
    "j12_with_thresholds",
    f"""WITH {FS}, {_TH} SELECT event_id, tw AS temperature_warning, hc AS humidity_critical FROM fs LEFT JOIN th USING (factory_id)""",
)
def j12(spark, d):
    out = directory.with_thresholds(factory(spark, d), config(spark).thresholds)
    return out.select("event_id", "temperature_warning", "humidity_critical")


@query(
    "r4_threshold_state",
    f"""WITH {FS}, {_TH} SELECT event_id, {_state_sql('temperature', 'tw', 'tc')} AS temperature_state,
    {_state_sql('humidity', 'hw', 'hc')} AS humidity_state,
    CASE WHEN humidity IS NULL THEN NULL WHEN humidity > 80 OR humidity < 20 THEN 'critical' WHEN humidity > 70 OR humidity < 30 THEN 'warning'
      ELSE 'normal' END AS draft_humidity_state FROM fs LEFT JOIN th USING (factory_id)""",
)
def r4(spark, d):
    out = directory.with_thresholds(factory(spark, d), config(spark).thresholds)
    c = F.col
    temperature, humidity = c("sensor.temperature_celsius_avg"), c("sensor.humidity_percent_avg")
    return out.select(
        "event_id",
        rules.threshold_state(temperature, c("temperature_warning"), c("temperature_critical")).alias("temperature_state"),
        rules.threshold_state(humidity, c("humidity_warning"), c("humidity_critical")).alias("humidity_state"),
        rules.draft_humidity_state(humidity).alias("draft_humidity_state"),
    )


@query(
    "r4_storage_state",
    f"""WITH {INF} SELECT event_id, node_id, {_state_sql('disk', '75', '90')} AS storage_state FROM node""",
)
def r4_storage(spark, d):
    nodes = metrics.node_rows(infra(spark, d))
    limits = (F.lit(C.STORAGE_WARNING), F.lit(C.STORAGE_CRITICAL))
    return nodes.select(
        "event_id", "node_id", rules.threshold_state(F.col("disk_usage_percent"), *limits).alias("storage_state")
    )


@query(
    "j13_factory_directory",
    f"""WITH {MSG} SELECT CASE factory_id WHEN 'factory-a' THEN 'Factory A' WHEN 'factory-b' THEN 'Factory B' ELSE 'Factory C' END AS display_name,
    CASE factory_id WHEN 'factory-a' THEN 'production-edge' ELSE 'testbed' END AS spoke_type, source_type, count(*) AS messages
    FROM msg GROUP BY ALL""",
)
def j13(spark, d):
    out = directory.factory_directory(messages(spark, d), config(spark).factories)
    return out.groupBy("display_name", "spoke_type", "source_type").agg(F.count(F.lit(1)).alias("messages"))


@query(
    "j7_roster_left_join",
    f"""WITH {FS} SELECT r.factory_id, count(fs.event_id) AS messages, count(fs.event_id) = 0 AS missing
    FROM (VALUES ('factory-a'), ('factory-b'), ('factory-c')) AS r(factory_id)
    LEFT JOIN fs ON fs.factory_id = r.factory_id AND fs.factory_id <> 'factory-b' GROUP BY 1""",
)
def j7(spark, d):
    rows = factory(spark, d).where(F.col("factory_id") != "factory-b")
    counts = rows.groupBy("factory_id").agg(F.count(F.lit(1)).alias("messages"))
    sites = config(spark).factories
    absent = directory.missing_factories(counts, sites).select("factory_id", F.lit(True).alias("missing"))
    full = directory.roster_left_join(counts, sites)
    return full.join(absent, "factory_id", "left").select(
        "factory_id",
        F.coalesce("messages", F.lit(0)).alias("messages"),
        F.coalesce("missing", F.lit(False)).alias("missing"),
    )


# --- status and bands -----------------------------------------------------------------------------
@query(
    "r9_delivery_status",
    f"""WITH {ASOF}, a AS (SELECT *, {age_sql('source_timestamp', 'infra_at')} AS age FROM aso)
    SELECT event_id, round(age, 6) AS age_seconds, age > {TIMING.infra_period} AS missed_interval,
    CASE WHEN age > {TIMING.status_critical_after} THEN 'critical' WHEN age > {TIMING.status_warning_after} THEN 'warning'
      WHEN age IS NOT NULL THEN 'normal' END AS status FROM a""",
)
def r9(spark, d):
    out = state.asof_infra(factory(spark, d), infra(spark, d), slice_seconds(spark, d), sections=())
    age = clock.age_seconds("source_timestamp", "infra.at")
    return out.select(
        "event_id",
        r6(age).alias("age_seconds"),
        rules.missed_interval(age, TIMING).alias("missed_interval"),
        rules.delivery_status(age, TIMING).alias("status"),
    )


def _band(c: str) -> str:
    return f"CASE WHEN {c} < 80 THEN 'normal' WHEN {c} < 90 THEN 'warning' ELSE 'danger' END"


@query(
    "r11_resource_band",
    f"""WITH {INF} SELECT event_id, node_id, {_band('cpu')} AS cpu_band, {_band('memory')} AS memory_band, {_band('disk')} AS disk_band FROM node""",
)
def r11(spark, d):
    out = metrics.with_resource_bands(metrics.node_rows(infra(spark, d)))
    return out.select("event_id", "node_id", "cpu_band", "memory_band", "disk_band")


def _ai_band(c: str) -> str:
    return f"CASE WHEN {c} < 0.25 THEN 'safe' WHEN {c} < 0.75 THEN 'warning' ELSE 'danger' END"


@query(
    "r10_ai_band",
    f"""WITH {FS} SELECT event_id, {_ai_band('fire')} AS fire_band, {_ai_band('fall')} AS fall_band,
    CASE WHEN bend < 0.25 THEN '안전' WHEN bend < 0.75 THEN '주의' ELSE '굽힘' END AS bend_label,
    CASE WHEN fire < 0.25 THEN '안전' WHEN fire < 0.75 THEN '주의' WHEN sound <> '' THEN sound ELSE '이상 소음' END AS sound_label FROM fs""",
)
def r10(spark, d):
    a = lambda n: F.col(f"ai_result.{n}")
    return factory(spark, d).select(
        "event_id",
        rules.ai_band(a("fire_score")).alias("fire_band"),
        rules.ai_band(a("fall_score")).alias("fall_band"),
        rules.ai_label(a("bend_score"), "bend").alias("bend_label"),
        rules.ai_label(a("fire_score"), "sound", a("abnormal_sound")).alias("sound_label"),
    )


@query(
    "r12_display_stale",
    f"""WITH {ASOF} SELECT event_id, coalesce({age_sql('source_timestamp', 'infra_at')} > {TIMING.infra_stale_after}, true) AS stale,
    CASE WHEN infra_at IS NULL THEN 'missing' WHEN {age_sql('source_timestamp', 'infra_at')} > {TIMING.infra_critical_after} THEN 'critical'
      WHEN {age_sql('source_timestamp', 'infra_at')} > {TIMING.infra_stale_after} THEN 'warning' ELSE 'fresh' END AS staleness FROM aso""",
)
def r12(spark, d):
    out = state.asof_infra(factory(spark, d), infra(spark, d), slice_seconds(spark, d), sections=())
    now, at = F.col("source_timestamp"), F.col("infra.at")
    return out.select(
        "event_id",
        views.display_stale(now, at, TIMING.infra_stale_after).alias("stale"),
        views.infra_staleness(now, at, TIMING).alias("staleness"),
    )


@query(
    "r16_failed_heartbeat",
    f"""WITH {INF}, g AS (SELECT factory_id, message_id, {age_sql('source_timestamp', 'lag(source_timestamp) OVER w')} AS gap
      FROM inf WINDOW w AS (PARTITION BY factory_id ORDER BY source_timestamp))
    SELECT factory_id, message_id, round(gap, 6) AS gap_seconds, CAST(floor(gap / {TIMING.infra_period}) AS BIGINT) AS missed FROM g
    WHERE gap > {3 * TIMING.infra_period}""",
)
def r16(spark, d):
    out = risk.failed_heartbeat(infra(spark, d), slice_seconds(spark, d), TIMING)
    return out.select("factory_id", "message_id", r6("gap_seconds").alias("gap_seconds"), "missed")


# --- reads over infrastructure ---------------------------------------------------------------------
INFRA_HISTORY = INF + f""", ih AS (SELECT *, {age_sql('source_timestamp', 'lag(source_timestamp) OVER w')} AS age,
  CASE WHEN coalesce({age_sql('source_timestamp', 'lag(source_timestamp) OVER w')}, 0) > {TIMING.status_critical_after} THEN 'critical'
    WHEN coalesce({age_sql('source_timestamp', 'lag(source_timestamp) OVER w')}, 0) > {TIMING.status_warning_after} THEN 'warning'
    ELSE 'normal' END AS status FROM inf WINDOW w AS (PARTITION BY factory_id ORDER BY source_timestamp))"""


def infra_history(spark, d):
    return state.infra_history(infra(spark, d), TIMING, slice_seconds=slice_seconds(spark, d))


@query(
    "p14_history_projection",
    f"""WITH {INFRA_HISTORY} SELECT factory_id, {iso_sql('source_timestamp')} AS ts, ready, 3 - running AS unhealthy, status,
    round(age, 6) AS age_seconds FROM ih""",
)
def p14(spark, d):
    out = views.history_projection(infra_history(spark, d), "INFRA")
    return out.select(
        "factory_id",
        iso("timestamp").alias("ts"),
        F.col("node_summary.ready").alias("ready"),
        F.col("workload_summary.unhealthy").alias("unhealthy"),
        F.col("pipeline_status.status").alias("status"),
        r6("pipeline_status.latest_infra_state_age_seconds").alias("age_seconds"),
    )


@query(
    "p13_latest_projection",
    f"""WITH {FLEET} SELECT factory_id, 3 AS total, ready, camera AS camera_available FROM li""",
)
def p13(spark, d):
    out = views.latest_projection(fleet_state(spark, d), ["node_summary", "device_summary"])
    return out.select("factory_id", "node_summary.total", "node_summary.ready", "device_summary.camera_available")


@query(
    "q5_infra_history",
    f"""WITH {INFRA_HISTORY} SELECT {iso_sql('source_timestamp')} AS ts, ready, camera AS camera_available, status FROM ih
    WHERE factory_id = 'factory-a' AND source_timestamp BETWEEN TIMESTAMP '2024-01-10' AND TIMESTAMP '2024-01-20'""",
)
def q5(spark, d):
    out = views.infra_history_read(infra_history(spark, d), "factory-a", datetime(2024, 1, 10), datetime(2024, 1, 20))
    return out.select(
        iso("timestamp").alias("ts"),
        F.col("node_summary.ready").alias("ready"),
        F.col("device_summary.camera_available").alias("camera_available"),
        F.col("pipeline_status.status").alias("status"),
    )


@query(
    "q6_node_series",
    f"""WITH {INF} SELECT factory_id, node_id, {iso_sql('ts')} AS ts, memory AS value FROM node""",
)
def q6(spark, d):
    out = views.node_series(infra_history(spark, d), "memory")
    return out.select("factory_id", "node_id", iso("timestamp").alias("ts"), "value")


@query(
    "q7_infra_current",
    f"""WITH {FLEET} SELECT n.factory_id, n.node_id, n.ready, n.cpu AS cpu_usage_percent, {_band('n.cpu')} AS cpu_band,
    {_band('n.disk')} AS disk_band FROM node n JOIN li USING (event_id)""",
)
def q7(spark, d):
    out = views.infra_current(fleet_state(spark, d))
    return out.select("factory_id", "node_id", "ready", "cpu_usage_percent", "cpu_band", "disk_band")


@query(
    "q12_delivery_overview",
    f"""WITH {MSG}, i AS (SELECT factory_id, max(received_at) FILTER (source_type = 'infra_state') AS ia, max(received_at) AS ra FROM msg GROUP BY 1),
    s AS (SELECT factory_id, {age_sql(_AS_OF, 'ia')} AS infra_age, {age_sql(_AS_OF, 'ra')} AS raw_age FROM i)
    SELECT factory_id, round(infra_age, 6) AS infra_age, round(raw_age, 6) AS raw_age,
    CASE WHEN infra_age > {TIMING.status_critical_after} THEN '위험' WHEN infra_age > {TIMING.status_warning_after} THEN '주의' ELSE '정상' END AS status_label FROM s""",
)
def q12(spark, d):
    out = views.delivery_overview(state.delivery_inputs(messages(spark, d)), AS_OF, TIMING)
    return out.select(
        "factory_id",
        r6("latest_infra_state_age_seconds").alias("infra_age"),
        r6("latest_s3_raw_age_seconds").alias("raw_age"),
        "status_label",
    )


