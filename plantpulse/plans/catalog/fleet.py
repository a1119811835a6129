"""Fleet reads, history reads and timeline events (A11, A12, A23, T, U1, W8, Q, E)."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from plantpulse.operators import gaps, risk, state, timeline
from plantpulse.plans import backward, views
from plantpulse.plans.catalog.infrastructure import (
    FLEET,
    INFRA_HISTORY,
    fleet_state,
    infra_history,
)
from plantpulse.plans.catalog.ingest import _RISK_HISTORY, risk_history, scored
from plantpulse.plans.catalog.registry import (
    AS_OF,
    ENV,
    FS,
    INF,
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
    messages,
    query,
    r6,
    slice_seconds,
)
from plantpulse.sources import feed

_NOW = f"TIMESTAMP '{AS_OF}'"


# --- fleet, from the additive score of the current state -----------------------------------------
# At AS_OF every site has been silent for a while, so staleness counts too.
def _late(ts_sql: str, limit: int) -> str:
    return f"{age_sql(_NOW, ts_sql)} > {limit}"


_CARDS = FLEET + f""",
th AS (SELECT * FROM (VALUES ('factory-a', 30.0::DOUBLE, 70.0::DOUBLE), ('factory-b', 32, 70), ('factory-c', 33, 72)) AS t(factory_id, tw, hw)),
fl AS (SELECT lf.factory_id, lf.source_timestamp AS fat, li.source_timestamp AS iat, li.ready, li.running, li.camera, li.microphone, lf.temperature,
   coalesce(lf.temperature > tw, false) AS temp_high, coalesce(lf.humidity > hw OR lf.humidity < 20, false) AS humidity_high,
   {_late('lf.source_timestamp', TIMING.risk_sensor_after)} AS sensor_no_data,
   li.agent_status <> 'alive' OR {_late('li.published_at', TIMING.risk_agent_after)} AS agent_down,
   li.ready < 3 OR {_late('li.source_timestamp', TIMING.risk_node_after)} AS node_down,
   NOT li.camera OR {_late('li.source_timestamp', TIMING.risk_device_after)} AS camera_down,
   NOT li.microphone OR {_late('li.source_timestamp', TIMING.risk_device_after)} AS mic_down,
   {_late('li.source_timestamp', TIMING.risk_delivery_after)} AS late
   FROM lf JOIN li USING (factory_id) JOIN th USING (factory_id)),
fsc AS (SELECT *, 15 * temp_high::INT + 10 * humidity_high::INT + 15 * sensor_no_data::INT + 15 * agent_down::INT + 20 * node_down::INT
   + 10 * camera_down::INT + 10 * mic_down::INT + 15 * late::INT AS raw_score,
   sensor_no_data::INT + agent_down::INT + node_down::INT + camera_down::INT + mic_down::INT + late::INT AS abnormal FROM fl),
rec AS (SELECT factory_id, max(received_at) FILTER (source_type = 'infra_state') AS ia FROM msg GROUP BY 1),
cards AS (SELECT fsc.*, least(raw_score, 100) AS risk_score, CASE WHEN raw_score < 40 THEN 'safe' WHEN raw_score < 70 THEN 'warning' ELSE 'danger' END AS risk_level,
   CASE WHEN {age_sql(_NOW, 'ia')} > {TIMING.status_critical_after} THEN 'critical' WHEN {age_sql(_NOW, 'ia')} > {TIMING.status_warning_after} THEN 'warning'
     ELSE 'normal' END AS status FROM fsc JOIN rec USING (factory_id))"""


def fleet_scored(spark, d):
    return risk.score_fleet(fleet_state(spark, d), config(spark).thresholds, AS_OF, TIMING)


def fleet_overview(spark, d):
    inputs = state.delivery_inputs(messages(spark, d))
    return views.fleet_overview(fleet_scored(spark, d), inputs, config(spark).factories, AS_OF, TIMING)


@query(
    "q1_fleet_overview",
    f"""WITH {_CARDS} SELECT factory_id, CASE risk_level WHEN 'safe' THEN '안전' WHEN 'warning' THEN '주의' ELSE '위험' END AS display_status,
    risk_score, risk_level, ready AS node_ready, 3 AS node_total, status AS pipeline_status, {iso_sql('greatest(fat, iat)')} AS updated_at,
    {_late('fat', TIMING.factory_stale_after)} AS factory_stale, {_late('iat', TIMING.infra_stale_after)} AS infra_stale FROM cards""",
)
def q1(spark, d):
    return fleet_overview(spark, d).select(
        "factory_id",
        "display_status",
        "risk_score",
        "risk_level",
        "node_ready",
        "node_total",
        "pipeline_status",
        iso("updated_at").alias("updated_at"),
        "factory_stale",
        "infra_stale",
    )


@query(
    "q2_factory_overview",
    f"""WITH {_CARDS} SELECT factory_id, CASE risk_level WHEN 'safe' THEN '안전' WHEN 'warning' THEN '주의' ELSE '위험' END AS display_status,
    risk_score, round(temperature, 6) AS temperature, running AS workloads_running,
    CASE WHEN camera THEN '정상' ELSE '확인 필요' END AS camera_label, CASE WHEN microphone THEN '정상' ELSE '확인 필요' END AS microphone_label FROM cards""",
)
def q2(spark, d):
    return views.factory_overview(fleet_scored(spark, d)).select(
        "factory_id",
        "display_status",
        "risk_score",
        r6("sensor.temperature_celsius_avg").alias("temperature"),
        F.col("workload_summary.running").alias("workloads_running"),
        "camera_label",
        "microphone_label",
    )


@query(
    "a11_fleet_summary",
    f"""WITH {_CARDS} SELECT count(*) AS total, count(*) FILTER (risk_level = 'danger') AS danger, count(*) FILTER (risk_level = 'warning') AS warning,
    count(*) FILTER (risk_level = 'safe') AS safe, count(*) FILTER (status <> 'normal') AS delayed FROM cards""",
)
def a11(spark, d):
    return views.fleet_summary(fleet_overview(spark, d))


@query("a12_abnormal_system_count", f"WITH {_CARDS} SELECT factory_id, abnormal AS abnormal_systems FROM cards")
def a12(spark, d):
    return views.abnormal_system_count(fleet_scored(spark, d), AS_OF, TIMING).select("factory_id", "abnormal_systems")


@query(
    "w8_fleet_rank",
    f"""WITH {_CARDS} SELECT factory_id, risk_level, row_number() OVER (ORDER BY CASE risk_level WHEN 'danger' THEN 0 WHEN 'warning' THEN 1 ELSE 2 END,
    risk_score DESC, factory_id) AS fleet_rank FROM cards""",
)
def w8(spark, d):
    return risk.fleet_rank(fleet_scored(spark, d)).select("factory_id", "risk_level", "fleet_rank")


@query(
    "t1_fleet_cards",
    f"""WITH {_CARDS} SELECT factory_id, risk_level, risk_score, status AS pipeline_status FROM cards
    ORDER BY CASE risk_level WHEN 'danger' THEN 0 WHEN 'warning' THEN 1 ELSE 2 END, risk_score DESC, factory_id""",
)
def t1(spark, d):
    return views.fleet_cards(fleet_overview(spark, d), "score").select(
        "factory_id", "risk_level", "risk_score", "pipeline_status"
    )


_ABNORMAL = f"""WITH {_CARDS} SELECT factory_id, component, {iso_sql('onset')} AS onset_at FROM (SELECT factory_id,
  unnest(['sensor', 'edge_agent', 'node', 'camera', 'microphone', 'delivery']) AS component,
  unnest([sensor_no_data, agent_down, node_down, camera_down, mic_down, late]) AS present, unnest([fat, iat, iat, iat, iat, iat]) AS onset FROM cards) WHERE present"""


@query("q10_abnormal_systems", _ABNORMAL)
def q10(spark, d):
    out = views.abnormal_systems(fleet_scored(spark, d), AS_OF, TIMING)
    return out.select("factory_id", "component", iso("onset_at").alias("onset_at"))


@query(
    "t3_abnormal_systems_over_time",
    f"""WITH {INF} SELECT factory_id, component, count(*) AS observations, {iso_sql('max(source_timestamp)')} AS newest FROM (SELECT factory_id, source_timestamp,
      unnest(['edge_agent', 'node', 'camera', 'microphone']) AS component, unnest([agent_status <> 'alive', ready < 3, NOT camera, NOT microphone]) AS present FROM inf)
    WHERE present GROUP BY ALL""",
)
def t3(spark, d):
    # Every infra message judged at its own time, by the same component flags.
    rows = infra(spark, d).select(
        "factory_id",
        F.col("source_timestamp").alias("last_factory_state_at"),
        F.col("source_timestamp").alias("last_infra_state_at"),
        F.lit(None).cast("struct<temperature_celsius_avg:double,humidity_percent_avg:double>").alias("sensor"),
        F.lit(None).cast("double").alias("temperature_warning"),
        F.lit(None).cast("double").alias("humidity_warning"),
        F.lit("safe").alias("risk_level"),
        "heartbeat",
        "nodes",
        "devices",
    )
    # The last publish is after the source time by a few seconds only.
    out = views.abnormal_systems(rows, F.col("last_infra_state_at"), TIMING)
    return out.groupBy("factory_id", "component").agg(
        F.count(F.lit(1)).alias("observations"), iso(F.max("onset_at")).alias("newest")
    )


@query(
    "q9_sensor_status",
    f"""WITH {ENV}, cur AS (SELECT factory_id, arg_max(temperature, ts) AS temperature, arg_max(humidity, ts) AS humidity, max(ts) AS seen FROM env GROUP BY 1),
    m AS (SELECT factory_id, {bucket_sql('ts', 3600)} AS w, avg(temperature) AS t, row_number() OVER (PARTITION BY factory_id ORDER BY {bucket_sql('ts', 3600)} DESC) AS rn FROM env GROUP BY 1, 2)
    SELECT factory_id, {iso_sql('seen')} AS sensor_at, round(temperature, 6) AS temperature, humidity, count(*) AS points,
    round(sum(t), 6) AS trend_sum, round(arg_min(t, w), 6) AS trend_first FROM cur JOIN m USING (factory_id) WHERE rn <= 12 GROUP BY ALL""",
)
def q9(spark, d):
    out = views.sensor_status(environment(spark, d), 12, 3600)
    return out.select(
        "factory_id",
        iso("sensor_at").alias("sensor_at"),
        r6("temperature").alias("temperature"),
        "humidity",
        F.size("trend").alias("points"),
        r6(F.aggregate("trend", F.lit(0.0), lambda a, x: a + x)).alias("trend_sum"),
        r6(F.col("trend")[0]).alias("trend_first"),
    )


# --- histories ------------------------------------------------------------------------------------
def factory_history(spark, d):
    return state.factory_history(state.last_per_bucket(factory(spark, d), TIMING), TIMING)


_FACTORY_HISTORY = f"""
fh AS (SELECT *, {bucket_sql('source_timestamp', TIMING.history_bucket)} + to_seconds({TIMING.history_bucket}) AS bucket FROM fs
  QUALIFY row_number() OVER (PARTITION BY factory_id, bucket ORDER BY source_timestamp DESC) = 1)"""
FROM, TO = datetime(2024, 1, 10), datetime(2024, 1, 20)
_RANGE = "bucket BETWEEN TIMESTAMP '2024-01-10' AND TIMESTAMP '2024-01-20'"


@query(
    "q3_risk_history",
    f"""WITH {SCORED}, {_RISK_HISTORY} SELECT {iso_sql('bucket')} AS ts, round(risk_score, 6) AS risk_score, risk_level,
    coalesce(top_causes, '') AS top_causes FROM rh LEFT JOIN top USING (message_id) WHERE factory_id = 'factory-c' AND {_RANGE}""",
)
def q3(spark, d):
    out = views.risk_history_read(risk_history(spark, d), "factory-c", FROM, TO)
    return out.select(
        iso("timestamp").alias("ts"),
        r6("risk_score").alias("risk_score"),
        "risk_level",
        F.array_join("top_cause_names", ",").alias("top_causes"),
    )


@query(
    "q4_factory_history",
    f"""WITH {FS}, {_FACTORY_HISTORY} SELECT {iso_sql('bucket')} AS ts, round(temperature, 6) AS temperature, humidity, fire AS fire_score,
    fall AS fall_score FROM fh WHERE factory_id = 'factory-b' AND {_RANGE}""",
)
def q4(spark, d):
    out = views.factory_history_read(factory_history(spark, d), "factory-b", FROM, TO)
    return out.select(
        iso("timestamp").alias("ts"),
        r6("temperature_celsius_avg").alias("temperature"),
        F.col("humidity_percent_avg").alias("humidity"),
        "fire_score",
        "fall_score",
    )


@query(
    "u1_merge_histories",
    f"""WITH {SCORED}, {_RISK_HISTORY}, {_FACTORY_HISTORY} SELECT 'RISK' AS kind, factory_id, {iso_sql('bucket')} AS ts FROM rh UNION ALL
    SELECT 'FACTORY', factory_id, {iso_sql('bucket')} FROM fh UNION ALL
    SELECT 'INFRA', factory_id, {iso_sql('source_timestamp')} FROM msg WHERE source_type = 'infra_state'""",
)
def u1(spark, d):
    out = timeline.merge_histories(risk_history(spark, d), factory_history(spark, d), infra_history(spark, d))
    return out.select("kind", "factory_id", iso("timestamp").alias("ts"))


# --- timeline events ---------------------------------------------------------------------------------
_LABEL = "CASE {0} WHEN 'safe' THEN '안전' WHEN 'warning' THEN '주의' ELSE '위험' END"
_RISK_LAG = f"""{SCORED}, {_RISK_HISTORY},
rl AS (SELECT rh.*, coalesce(top_causes, '') AS causes, lag(risk_level) OVER w AS was, lag(risk_score) OVER w AS was_score,
  lag(coalesce(top_causes, '')) OVER w AS was_causes FROM rh LEFT JOIN top USING (message_id) WINDOW w AS (PARTITION BY factory_id ORDER BY bucket))"""
_FACTORY_LAG = f"""{FS}, {_FACTORY_HISTORY},
th AS (SELECT * FROM (VALUES ('factory-a', 30.0::DOUBLE, 40.0::DOUBLE), ('factory-b', 32, 38), ('factory-c', 33, 39)) AS t(factory_id, tw, tc)),
fg AS (SELECT fh.*, tw, tc, lag(temperature) OVER w AS was_t, lag(fire) OVER w AS was_fire, lag(fall) OVER w AS was_fall, lag(bend) OVER w AS was_bend
  FROM fh JOIN th USING (factory_id) WINDOW w AS (PARTITION BY factory_id ORDER BY bucket))"""
_INFRA_LAG = f"""{INFRA_HISTORY},
il AS (SELECT *, lag(event_id) OVER w AS was_id, lag(status) OVER w AS was_status, lag(ready) OVER w AS was_ready, lag(running) OVER w AS was_running,
  lag(bme280) OVER w AS was_bme280, lag(camera) OVER w AS was_camera, lag(microphone) OVER w AS was_microphone
  FROM ih WINDOW w AS (PARTITION BY factory_id ORDER BY source_timestamp)),
nl AS (SELECT *, lag(cpu) OVER w AS was_cpu, lag(memory) OVER w AS was_memory, lag(disk) OVER w AS was_disk FROM node
  WINDOW w AS (PARTITION BY factory_id, node_id ORDER BY ts))"""


def events(spark, d, *types):
    # Histories that cannot hold the wanted types are not built at all.
    wanted = lambda make, kinds: make(spark, d) if not types or set(types) & set(kinds) else None
    out = timeline.timeline(
        wanted(risk_history, timeline.RISK_TYPES),
        wanted(factory_history, timeline.FACTORY_TYPES),
        wanted(infra_history, timeline.INFRA_TYPES),
        config(spark).thresholds,
        slice_seconds(spark, d),
        types or None,
    )
    return out.withColumn("timestamp", iso("timestamp")).drop("source")


def _event(name: str, type_: str, sql: str):
    def run(spark, d):
        return events(spark, d, type_).drop("type")

    query(name, sql)(run)


_event(
    "e1_risk_level_changed",
    "risk_level_changed",
    f"""WITH {_RISK_LAG} SELECT factory_id, {iso_sql('bucket')} AS timestamp, CASE risk_level WHEN 'safe' THEN 'info' ELSE risk_level END AS severity,
    'Risk ' || {_LABEL.format('was')} || ' -> ' || {_LABEL.format('risk_level')} AS title, replace(causes, ',', ', ') AS description
    FROM rl WHERE was IS NOT NULL AND was <> risk_level""",
)
_event(
    "e2_risk_jump",
    "risk_jump",
    f"""WITH {_RISK_LAG} SELECT factory_id, {iso_sql('bucket')} AS timestamp, 'warning' AS severity, 'Risk jump' AS title,
    replace(causes, ',', ', ') AS description FROM rl WHERE risk_score - was_score >= 10 - 1e-9""",
)
_event(
    "e3_top_causes_changed",
    "top_causes_changed",
    f"""WITH {_RISK_LAG} SELECT factory_id, {iso_sql('bucket')} AS timestamp, 'info' AS severity, 'Top causes changed' AS title,
    replace(was_causes, ',', ', ') || ' -> ' || replace(causes, ',', ', ') AS description FROM rl WHERE was IS NOT NULL AND was_causes <> causes""",
)
_event(
    "e4_temperature_rise",
    "temperature_rise",
    f"""WITH {_FACTORY_LAG} SELECT factory_id, {iso_sql('bucket')} AS timestamp, CASE WHEN temperature > tc THEN 'danger' ELSE 'warning' END AS severity,
    'Temperature rise' AS title, printf('%.1f', was_t) || ' -> ' || printf('%.1f', temperature) AS description FROM fg
    WHERE temperature - was_t >= 5 - 1e-9 OR (was_t <= tw AND temperature > tw)""",
)
_event(
    "e5_ai_score_rise",
    "ai_score_rise",
    f"""WITH {_FACTORY_LAG}, s AS (SELECT factory_id, bucket, unnest(['fire_score', 'fall_score', 'bend_score']) AS name, unnest([fire, fall, bend]) AS v,
      unnest([was_fire, was_fall, was_bend]) AS w FROM fg)
    SELECT factory_id, {iso_sql('bucket')} AS timestamp, CASE WHEN v >= 0.75 THEN 'danger' ELSE 'warning' END AS severity, name || ' rise' AS title,
    printf('%.2f', w) || ' -> ' || printf('%.2f', v) AS description FROM s WHERE v - w >= CAST(0.3 AS DOUBLE) - 1e-9""",
)
_event(
    "e6_delivery_changed",
    "pipeline_changed",
    f"""WITH {_INFRA_LAG} SELECT factory_id, {iso_sql('source_timestamp')} AS timestamp,
    CASE status WHEN 'critical' THEN 'danger' WHEN 'warning' THEN 'warning' ELSE 'info' END AS severity,
    'Pipeline ' || status AS title, was_status || ' -> ' || status AS description FROM il WHERE was_status <> status""",
)
_event(
    "e7_node_ready_changed",
    "node_ready_changed",
    f"""WITH {_INFRA_LAG} SELECT factory_id, {iso_sql('source_timestamp')} AS timestamp, CASE WHEN ready < was_ready THEN 'warning' ELSE 'info' END AS severity,
    'Nodes ready ' || ready || '/3' AS title, was_ready || ' -> ' || ready AS description FROM il WHERE was_ready <> ready""",
)
_event(
    "e8_workload_unhealthy",
    "workload_unhealthy",
    f"""WITH {_INFRA_LAG} SELECT factory_id, {iso_sql('source_timestamp')} AS timestamp, 'warning' AS severity, 'Workload unhealthy' AS title,
    'unhealthy=' || (3 - running) AS description FROM il WHERE was_running = 3 AND running < 3""",
)
_DEVICE = """dv AS (SELECT factory_id, source_timestamp, unnest(['bme280', 'camera', 'microphone']) AS device, unnest([bme280, camera, microphone]) AS flag,
  unnest([was_bme280, was_camera, was_microphone]) AS was FROM il)"""
_CAP = "upper(device[1]) || device[2:]"
_event(
    "e9_device_unavailable",
    "device_unavailable",
    f"""WITH {_INFRA_LAG}, {_DEVICE} SELECT factory_id, {iso_sql('source_timestamp')} AS timestamp, 'warning' AS severity, {_CAP} || ' unavailable' AS title,
    device || '_available=false' AS description FROM dv WHERE was AND NOT flag""",
)
_event(
    "e10_component_recovered",
    "component_recovered",
    f"""WITH {_INFRA_LAG}, {_DEVICE}, rc AS (SELECT factory_id, source_timestamp, device FROM dv WHERE NOT was AND flag UNION ALL
      SELECT factory_id, source_timestamp, 'pipeline' FROM il WHERE was_status <> 'normal' AND status = 'normal' UNION ALL
      SELECT factory_id, source_timestamp, 'node' FROM il WHERE was_ready < 3 AND ready = 3 UNION ALL
      SELECT factory_id, source_timestamp, 'workload' FROM il WHERE was_running < 3 AND running = 3)
    SELECT factory_id, {iso_sql('source_timestamp')} AS timestamp, 'info' AS severity, {_CAP} || ' recovered' AS title, device AS description FROM rc""",
)
_event(
    "e11_node_resource_high",
    "node_resource_high",
    f"""WITH {_INFRA_LAG}, x AS (SELECT factory_id, ts, node_id, unnest(['CPU', 'memory', 'disk']) AS name, unnest([cpu, memory, disk]) AS v,
      unnest([was_cpu, was_memory, was_disk]) AS w FROM nl)
    SELECT factory_id, {iso_sql('ts')} AS timestamp, CASE WHEN w < 90 AND v >= 90 THEN 'danger' ELSE 'warning' END AS severity,
    node_id || ' ' || name || ' ' || CASE WHEN w < 90 AND v >= 90 THEN '90' ELSE '80' END || '% 초과' AS title, printf('%.1f', v) AS description
    FROM x WHERE (w < 90 AND v >= 90) OR (w < 80 AND v >= 80)""",
)


_ALL_EVENTS = f"""WITH {SCORED}, {_RISK_HISTORY}, {_RISK_LAG[_RISK_LAG.index('rl AS'):]}, {_FACTORY_HISTORY},
{_FACTORY_LAG[_FACTORY_LAG.index('fg AS'):]}, {INFRA_HISTORY[len(MSG) + 2:]}, {_INFRA_LAG[_INFRA_LAG.index('il AS'):]}, {_DEVICE},
allev AS (
  SELECT factory_id, bucket AS ts, 'risk_level_changed' AS type, CASE risk_level WHEN 'safe' THEN 'info' ELSE risk_level END AS severity,
    'Risk ' || {_LABEL.format('was')} || ' -> ' || {_LABEL.format('risk_level')} AS title FROM rl WHERE was IS NOT NULL AND was <> risk_level
  UNION ALL SELECT factory_id, bucket, 'risk_jump', 'warning', 'Risk jump' FROM rl WHERE risk_score - was_score >= 10 - 1e-9
  UNION ALL SELECT factory_id, bucket, 'top_causes_changed', 'info', 'Top causes changed' FROM rl WHERE was IS NOT NULL AND was_causes <> causes
  UNION ALL SELECT factory_id, bucket, 'temperature_rise', CASE WHEN temperature > tc THEN 'danger' ELSE 'warning' END, 'Temperature rise' FROM fg
    WHERE temperature - was_t >= 5 - 1e-9 OR (was_t <= tw AND temperature > tw)
  UNION ALL SELECT factory_id, bucket, 'ai_score_rise', CASE WHEN v >= 0.75 THEN 'danger' ELSE 'warning' END, name || ' rise'
    FROM (SELECT factory_id, bucket, unnest(['fire_score', 'fall_score', 'bend_score']) AS name, unnest([fire, fall, bend]) AS v,
      unnest([was_fire, was_fall, was_bend]) AS w FROM fg) WHERE v - w >= CAST(0.3 AS DOUBLE) - 1e-9
  UNION ALL SELECT factory_id, source_timestamp, 'pipeline_changed', CASE status WHEN 'critical' THEN 'danger' WHEN 'warning' THEN 'warning' ELSE 'info' END,
    'Pipeline ' || status FROM il WHERE was_status <> status
  UNION ALL SELECT factory_id, source_timestamp, 'node_ready_changed', CASE WHEN ready < was_ready THEN 'warning' ELSE 'info' END,
    'Nodes ready ' || ready || '/3' FROM il WHERE was_ready <> ready
  UNION ALL SELECT factory_id, source_timestamp, 'workload_unhealthy', 'warning', 'Workload unhealthy' FROM il WHERE was_running = 3 AND running < 3
  UNION ALL SELECT factory_id, source_timestamp, 'device_unavailable', 'warning', {_CAP} || ' unavailable' FROM dv WHERE was AND NOT flag
  UNION ALL SELECT factory_id, source_timestamp, 'component_recovered', 'info', {_CAP} || ' recovered' FROM (
    SELECT factory_id, source_timestamp, device FROM dv WHERE NOT was AND flag UNION ALL
    SELECT factory_id, source_timestamp, 'pipeline' FROM il WHERE was_status <> 'normal' AND status = 'normal' UNION ALL
    SELECT factory_id, source_timestamp, 'node' FROM il WHERE was_ready < 3 AND ready = 3 UNION ALL
    SELECT factory_id, source_timestamp, 'workload' FROM il WHERE was_running < 3 AND running = 3)
  UNION ALL SELECT factory_id, ts, 'node_resource_high', CASE WHEN w < 90 AND v >= 90 THEN 'danger' ELSE 'warning' END,
    node_id || ' ' || name || ' ' || CASE WHEN w < 90 AND v >= 90 THEN '90' ELSE '80' END || '% 초과'
    FROM (SELECT factory_id, ts, node_id, unnest(['CPU', 'memory', 'disk']) AS name, unnest([cpu, memory, disk]) AS v,
      unnest([was_cpu, was_memory, was_disk]) AS w FROM nl) WHERE (w < 90 AND v >= 90) OR (w < 80 AND v >= 80))"""


@query("e12_severity", f"{_ALL_EVENTS} SELECT factory_id, type, severity, count(*) AS events FROM allev GROUP BY ALL")
def e12(spark, d):
    return _all_events(spark, d).groupBy("factory_id", "type", "severity").agg(F.count(F.lit(1)).alias("events"))


def _readers(spark, d):
    return (
        lambda start, end: feed.load_factory_states(spark, d, start, end),
        lambda start, end: feed.load_infra_states(spark, d, start, end),
    )


def _extent(spark, d):
    """Oldest and newest time of the table; the events of the last bucket carry its end."""
    oldest, newest = backward.reach(lambda start, end: feed.load_messages(spark, d))
    return oldest, newest + timedelta(seconds=TIMING.history_bucket)


def _between(spark, d, start, end, oldest, sites):
    return backward.timeline_between(
        *_readers(spark, d), config(spark).thresholds, start, end, oldest, sites, slice_seconds(spark, d), TIMING
    )


def _newest(spark, d, n):
    sites = {r.factory_id for r in config(spark).factories.collect()}
    oldest, newest = _extent(spark, d)
    return backward.newest_events(lambda start, end: _between(spark, d, start, end, oldest, sites), n, oldest, newest)


def _all_events(spark, d):
    oldest, newest = _extent(spark, d)
    return _between(spark, d, oldest, newest, oldest, set())


@query(
    "q8_timeline_events",
    f"""{_ALL_EVENTS} SELECT {iso_sql('ts')} AS timestamp, type, severity, title FROM allev
    WHERE factory_id = 'factory-a' AND ts BETWEEN TIMESTAMP '2024-01-10' AND TIMESTAMP '2024-01-20'""",
)
def q8(spark, d):
    only = [lambda start, end, read=read: read(start, end).where("factory_id = 'factory-a'") for read in _readers(spark, d)]
    oldest, _ = _extent(spark, d)
    found = backward.timeline_between(
        *only, config(spark).thresholds, FROM, TO, oldest, {"factory-a"}, slice_seconds(spark, d), TIMING
    )
    out = views.timeline_events(found, "factory-a", FROM, TO)
    return out.select(iso("timestamp").alias("timestamp"), "type", "severity", "title")


_NEWEST = "ORDER BY ts DESC, factory_id, type, title LIMIT 50"


@query("t4_timeline", f"{_ALL_EVENTS} SELECT factory_id, {iso_sql('ts')} AS timestamp, type, title FROM (SELECT * FROM allev {_NEWEST})")
def t4(spark, d):
    out = _newest(spark, d, 50)
    return out.select("factory_id", iso("timestamp").alias("timestamp"), "type", "title")


@query(
    "q11_recent_logs",
    f"{_ALL_EVENTS} SELECT factory_id, {iso_sql('ts')} AS timestamp, type, severity FROM (SELECT * FROM allev {_NEWEST.replace('50', '20')})",
)
def q11(spark, d):
    out = views.recent_logs(_newest(spark, d, 20), 20)
    return out.select("factory_id", iso("timestamp").alias("timestamp"), "type", "severity")


# --- daily summary --------------------------------------------------------------------------------------
@query(
    "a23_daily_ops_summary",
    f"""WITH {SCORED}, env AS (SELECT factory_id, source_timestamp AS ts, temperature FROM fs WHERE sensor_count > 0), {gap_sql('env', 'temperature', 600)},
    l AS (SELECT leveled.*, first_cause, lag(risk_level) OVER (PARTITION BY factory_id ORDER BY source_timestamp) AS was,
      strftime(source_timestamp, '%Y-%m-%d') AS day FROM leveled LEFT JOIN top USING (message_id)),
    cn AS (SELECT factory_id, day, first_cause, count(*) AS n FROM l WHERE first_cause IS NOT NULL GROUP BY ALL),
    mc AS (SELECT * FROM cn QUALIFY row_number() OVER (PARTITION BY factory_id, day ORDER BY n DESC, first_cause) = 1),
    g AS (SELECT factory_id, strftime(bucket, '%Y-%m-%d') AS day, count(*) FILTER (n = 0) * 600 AS gap_seconds FROM buckets GROUP BY ALL),
    s AS (SELECT factory_id, day, count(*) AS messages, round(min(risk_score), 6) AS min_score, round(avg(risk_score), 6) AS mean_score,
      round(max(risk_score), 6) AS max_score, round(count(*) FILTER (risk_level = 'safe') * 3, 6) AS safe_minutes,
      round(count(*) FILTER (risk_level = 'danger') * 3, 6) AS danger_minutes, count(*) FILTER (risk_level <> was) AS level_changes,
      count(*) FILTER (greatest(fire, fall, bend) >= 0.25 AND greatest(fire, fall, bend) < 0.75) AS uncertain_rows FROM l GROUP BY ALL)
    SELECT s.*, mc.first_cause AS main_cause, coalesce(gap_seconds, 0) AS gap_seconds FROM s LEFT JOIN mc USING (factory_id, day) LEFT JOIN g USING (factory_id, day)""",
)
def a23(spark, d):
    empty = gaps.empty_seconds_by_day(environment(spark, d), ["factory_id"], "temperature", 600)
    out = views.daily_ops_summary(scored(spark, d), empty, TIMING.factory_period, slice_seconds(spark, d))
    scores = ("min_score", "mean_score", "max_score", "safe_minutes", "danger_minutes")
    return out.select(
        "factory_id",
        "day",
        "messages",
        *[r6(c).alias(c) for c in scores],
        "level_changes",
        "uncertain_rows",
        "main_cause",
        "gap_seconds",
    )
