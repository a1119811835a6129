"""Failover drills (F, J10) and retention (L)."""

from __future__ import annotations

from datetime import datetime

import pyarrow as pa
from pyspark.sql import functions as F

from plantpulse.functions import clock
from plantpulse.operators import failover, retention
from plantpulse.plans.catalog.ingest import _RISK_HISTORY, risk_history
from plantpulse.plans.catalog.registry import (
    ENV,
    INF,
    MSG,
    SCORED,
    TIMING,
    age_sql,
    detections,
    environment,
    infra,
    iso,
    iso_sql,
    messages,
    query,
    r6,
    scratch,
    sounds,
)
from plantpulse.sources import feed, lake
from plantpulse.sources.settings import small_table

# (test_id, factory_id, test_type, target_node, start, end)
TESTS = (
    ("a-1", "factory-a", "lan_disconnect", "worker2", "2024-01-05 00:00:00", "2024-01-05 12:00:00"),
    ("a-2", "factory-a", "power_disconnect", "worker2", "2024-01-15 06:00:00", "2024-01-15 18:00:00"),
    ("b-1", "factory-b", "lan_disconnect", "worker2", "2024-01-08 00:00:00", "2024-01-08 12:00:00"),
    ("b-2", "factory-b", "power_disconnect", "worker2", "2024-01-20 12:00:00", "2024-01-21 00:00:00"),
    ("c-1", "factory-c", "lan_disconnect", "worker2", "2024-01-03 18:00:00", "2024-01-04 06:00:00"),
    ("c-2", "factory-c", "power_disconnect", "worker2", "2024-01-25 00:00:00", "2024-01-25 12:00:00"),
)
_VALUES = ", ".join(f"('{t}', '{f}', '{k}', TIMESTAMP '{a}', TIMESTAMP '{b}')" for t, f, k, _, a, b in TESTS)
_TESTS_SQL = f"tst AS (SELECT * FROM (VALUES {_VALUES}) AS t(test_id, factory_id, test_type, t_start, t_end))"


def tests(spark):
    schema = pa.schema(
        [(n, pa.string()) for n in ("test_id", "factory_id", "test_type", "target_node")]
        + [(n, pa.timestamp("us", tz="UTC")) for n in ("start", "end")]
    )
    rows = [(*r[:4], datetime.fromisoformat(r[4] + "+00:00"), datetime.fromisoformat(r[5] + "+00:00")) for r in TESTS]
    return small_table(spark, rows, schema)


def observations(spark, d):
    return feed.observations(infra(spark, d))


_MOMENTS = f"""{INF}, {_TESTS_SQL}, obs AS (SELECT w.factory_id, w.ts, w.event_id, (w.event_id + 2) % 17 <> 0 AS ready, name AS pod, status AS pod_status, placed_on AS pod_node FROM workload w),
ph AS (SELECT test_id, test_type, t_start, t_end, obs.* FROM obs JOIN tst ON obs.factory_id = tst.factory_id AND ts BETWEEN t_start AND t_end),
mom AS (SELECT test_id, t_start, ts, bool_and(ready) AS ready, count(*) AS targets, count(*) FILTER (pod_status = 'Running' AND pod_node = 'worker1') AS on_failover,
  count(*) FILTER (pod_status = 'Running' AND pod_node = 'worker2') AS on_preferred FROM ph GROUP BY ALL),
p1 AS (SELECT test_id, min(ts) AS fault_seen_at FROM mom WHERE NOT ready OR on_preferred < targets GROUP BY 1),
p2 AS (SELECT test_id, min(ts) AS not_ready_at FROM mom JOIN p1 USING (test_id) WHERE NOT ready AND ts >= fault_seen_at GROUP BY 1),
p3 AS (SELECT test_id, min(ts) AS on_failover_at FROM mom JOIN p2 USING (test_id) WHERE on_failover = targets AND ts >= not_ready_at GROUP BY 1),
p4 AS (SELECT test_id, min(ts) AS ready_again_at FROM mom JOIN p3 USING (test_id) WHERE ready AND ts >= on_failover_at GROUP BY 1),
p5 AS (SELECT test_id, min(ts) AS on_preferred_at FROM mom JOIN p4 USING (test_id) WHERE on_preferred = targets AND ts >= ready_again_at GROUP BY 1),
tl AS (SELECT * FROM tst LEFT JOIN p1 USING (test_id) LEFT JOIN p2 USING (test_id) LEFT JOIN p3 USING (test_id) LEFT JOIN p4 USING (test_id) LEFT JOIN p5 USING (test_id))"""


@query(
    "j10_phase_join",
    f"WITH {ENV}, {_TESTS_SQL} SELECT test_id, event_id FROM env JOIN tst ON env.factory_id = tst.factory_id AND ts BETWEEN t_start AND t_end",
)
def j10(spark, d):
    return failover.phase_join(environment(spark, d), tests(spark)).select("test_id", "event_id")


def probes(spark, d):
    """A test interval around every error of a site, from seconds to weeks long."""
    rows = infra(spark, d)
    length = F.element_at(F.array(*[F.lit(n) for n in _LENGTHS]), (F.col("event_id") % len(_LENGTHS) + 1).cast("int"))
    return rows.select(
        F.concat(F.lit("p-"), F.col("event_id").cast("string")).alias("test_id"),
        "factory_id",
        F.col("source_timestamp").alias("start"),
        clock.plus_seconds("source_timestamp", length).alias("end"),
    )


_LENGTHS = (0, 40, 600, 3600, 86400)


@query(
    "j10_many_intervals",
    f"""WITH {ENV}, pr AS (SELECT 'p-' || event_id AS test_id, factory_id AS site, source_timestamp AS t_start,
      source_timestamp + to_seconds({list(_LENGTHS)}[event_id % {len(_LENGTHS)} + 1]) AS t_end FROM msg WHERE source_type = 'infra_state')
    SELECT test_id, count(*) AS samples, {iso_sql('min(ts)')} AS first_at, round(avg(temperature), 6) AS mean_temperature
    FROM env JOIN pr ON factory_id = site AND ts BETWEEN t_start AND t_end GROUP BY 1""",
)
def j10_many(spark, d):
    inside = failover.phase_join(environment(spark, d), probes(spark, d), by=["test_id"], value="temperature")
    mean = F.when(F.col("values") > 0, F.col("total") / F.col("values"))
    return inside.select("test_id", "samples", iso("first_at").alias("first_at"), r6(mean).alias("mean_temperature"))


@query(
    "f1_failover_timeline",
    f"WITH {_MOMENTS} SELECT test_id, {', '.join(f'{iso_sql(p)} AS {p}' for p in failover.PHASES)} FROM tl",
)
def f1(spark, d):
    out = failover.failover_timeline(observations(spark, d), tests(spark))
    return out.select("test_id", *[iso(p).alias(p) for p in failover.PHASES])


# (site, preferred node, failover node); the third site has none of its own.
OWN_NODES = (("factory-a", "worker2", "worker1"), ("factory-b", "worker1", "worker2"))
_OWN = f"own AS (SELECT * FROM (VALUES {', '.join(map(str, OWN_NODES))}) AS t(site, pref, fail))"


@query(
    "f4_verdict_own_nodes",
    f"""WITH {_MOMENTS}, {_OWN}, v AS (SELECT test_id, ts, count(DISTINCT pod) FILTER (pod_status = 'Running' AND pod_node = coalesce(fail, 'worker1')) AS placed
      FROM ph LEFT JOIN own ON ph.factory_id = site WHERE {age_sql('ts', 't_start')} >= {TIMING.holdoff} GROUP BY ALL)
    SELECT test_id, factory_id, test_type, count(ts) AS moments, count(*) FILTER (placed = 3) AS good_moments,
    count(*) FILTER (placed = 3) > 0 AS success FROM tst LEFT JOIN v USING (test_id) GROUP BY ALL""",
)
def f4_own(spark, d):
    # Every observation arrives twice; targets are counted once.
    seen = observations(spark, d)
    nodes = spark.createDataFrame(list(OWN_NODES), "factory_id string, preferred_node string, failover_node string")
    return failover.failover_verdict(seen.unionByName(seen), tests(spark), "worker1", TIMING, nodes)


_DURATIONS = {
    "detect_seconds": ("not_ready_at", "fault_seen_at"),
    "failover_seconds": ("on_failover_at", "not_ready_at"),
    "outage_seconds": ("on_failover_at", "fault_seen_at"),
    "failback_seconds": ("on_preferred_at", "ready_again_at"),
    "total_seconds": ("on_preferred_at", "fault_seen_at"),
}


@query(
    "f2_phase_durations",
    f"WITH {_MOMENTS} SELECT test_id, factory_id, {', '.join(f'round({age_sql(a, b)}, 6) AS {n}' for n, (a, b) in _DURATIONS.items())} FROM tl",
)
def f2(spark, d):
    out = failover.phase_durations(failover.failover_timeline(observations(spark, d), tests(spark)))
    return out.select("test_id", "factory_id", *[r6(n).alias(n) for n in _DURATIONS])


@query(
    "f3_holdoff_filter",
    f"WITH {_MOMENTS} SELECT test_id, event_id, pod FROM ph WHERE {age_sql('ts', 't_start')} >= {TIMING.holdoff}",
)
def f3(spark, d):
    inside = failover.phase_join(observations(spark, d), tests(spark))
    return failover.holdoff_filter(inside, TIMING).select("test_id", "event_id", "pod")


@query(
    "f4_failover_verdict",
    f"""WITH {_MOMENTS}, v AS (SELECT test_id, ts, on_failover FROM mom WHERE {age_sql('ts', 't_start')} >= {TIMING.holdoff})
    SELECT test_id, factory_id, test_type, count(ts) AS moments, count(*) FILTER (on_failover = 3) AS good_moments,
    count(*) FILTER (on_failover = 3) > 0 AS success FROM tst LEFT JOIN v USING (test_id) GROUP BY ALL""",
)
def f4(spark, d):
    return failover.failover_verdict(observations(spark, d), tests(spark), "worker1", TIMING)


@query(
    "f5_first_data_after",
    f"""WITH {_MOMENTS}, {ENV[len(MSG) + 2:]} SELECT test_id, 'environment_data' AS measurement, {iso_sql('on_failover_at')} AS phase_at, {iso_sql('min(ts)')} AS first_data_at,
    round({age_sql('min(ts)', 'on_failover_at')}, 6) AS wait_seconds FROM tl JOIN env ON env.factory_id = tl.factory_id AND ts BETWEEN on_failover_at AND t_end
    GROUP BY test_id, on_failover_at""",
)
def f5(spark, d):
    phases = failover.failover_timeline(observations(spark, d), tests(spark))
    out = failover.first_data_after(environment(spark, d), phases, "on_failover_at", "environment_data")
    return out.select(
        "test_id",
        "measurement",
        iso("phase_at").alias("phase_at"),
        iso("first_data_at").alias("first_data_at"),
        r6("wait_seconds").alias("wait_seconds"),
    )


def _gap_part(table: str, measurement: str, seconds: int) -> str:
    us = seconds * 1000000
    return f"""SELECT * FROM (
      WITH sp AS (SELECT test_id, factory_id, unnest(generate_series(epoch_us(t_start) // {us}, epoch_us(t_end) // {us})) AS b FROM tst),
      c AS (SELECT test_id, epoch_us(ts) // {us} AS b, count(*) AS n FROM {table} JOIN tst ON {table}.factory_id = tst.factory_id AND ts BETWEEN t_start AND t_end GROUP BY ALL),
      f AS (SELECT test_id, b, coalesce(n, 0) AS n FROM sp LEFT JOIN c USING (test_id, b)),
      i AS (SELECT test_id, count(*) AS len FROM (SELECT test_id, b - row_number() OVER (PARTITION BY test_id ORDER BY b) AS g FROM f WHERE n = 0) GROUP BY test_id, g)
      SELECT test_id, '{measurement}' AS measurement, {seconds} AS bucket_seconds, (SELECT count(*) FROM f WHERE f.test_id = tst.test_id) AS buckets,
      coalesce((SELECT max(len) FROM i WHERE i.test_id = tst.test_id), 0) * {seconds} AS max_empty_seconds FROM tst)"""


@query(
    "f6_gap_report",
    f"WITH {ENV}, {_TESTS_SQL} "
    + " UNION ALL ".join(
        _gap_part(t, m, s)
        for t, m in (("env", "environment_data"), ("ai", "ai_detection"), ("snd", "acoustic_detection"))
        for s in (600, 60)
    ),
)
def f6(spark, d):
    return failover.gap_report(
        {
            "environment_data": (environment(spark, d), "temperature"),
            "ai_detection": (detections(spark, d), "fire_detected"),
            "acoustic_detection": (sounds(spark, d), "is_danger"),
        },
        tests(spark),
        (600, 60),
    )


@query(
    "f7_failover_sla",
    f"""WITH {_MOMENTS}, du AS (SELECT test_id, factory_id, {age_sql('on_failover_at', 'fault_seen_at')} AS outage, {age_sql('not_ready_at', 'fault_seen_at')} AS detect FROM tl)
    SELECT test_id, factory_id, round(outage, 6) AS outage_seconds, round(detect, 6) AS detect_seconds,
    coalesce(outage BETWEEN 0 AND {TIMING.failover_within}, false) AS resumed_in_time,
    coalesce(detect BETWEEN {TIMING.detect_from} AND {TIMING.detect_to}, false) AS detected_in_span,
    coalesce(detect BETWEEN 0 AND {TIMING.detect_to}, false) AS detected_in_time FROM du""",
)
def f7(spark, d):
    durations = failover.phase_durations(failover.failover_timeline(observations(spark, d), tests(spark)))
    out = failover.failover_sla(durations, TIMING)
    return out.withColumn("outage_seconds", r6("outage_seconds")).withColumn("detect_seconds", r6("detect_seconds"))


# --- retention ---------------------------------------------------------------------------------------
_TTL_AT = "2024-01-16 00:00:00"


@query(
    "l1_expire_history",
    f"""WITH {SCORED}, {_RISK_HISTORY} SELECT factory_id, {iso_sql('bucket')} AS ts, CAST(epoch(bucket) AS BIGINT) + 604800 AS ttl FROM rh
    WHERE CAST(epoch(bucket) AS BIGINT) + 604800 > epoch(TIMESTAMP '{_TTL_AT}')""",
)
def l1(spark, d):
    root = scratch(spark)
    history = risk_history(spark, d, 604800)
    lake.append_history(history, root, "RISK")
    lake.rewrite_alive(spark, f"{root}/RISK", f"{root}/RISK-alive", _TTL_AT)
    alive = retention.expire_history(lake.read_history(spark, root, "RISK-alive", history.schema), _TTL_AT)
    return alive.select("factory_id", iso("timestamp").alias("ts"), "ttl")


@query(
    "l2_retain",
    f"WITH {ENV} SELECT factory_id, {iso_sql('ts')} AS ts FROM env WHERE ts >= TIMESTAMP '2024-01-24 12:00:00'",
)
def l2(spark, d):
    out = retention.retain(environment(spark, d), "2024-01-25 12:00:00", 1)
    return out.select("factory_id", iso("ts").alias("ts"))


def inventory(spark, d):
    """Object listing of the three prefixes, with a second version per repeat."""
    m = feed.with_repeats(messages(spark, d))
    c = F.col
    where = F.when(c("event_id") % 3 == 0, "raw").when(c("event_id") % 3 == 1, "processed").otherwise("latest")
    return m.select(
        F.concat_ws("/", where, "message_id").alias("key"),
        c("delivery").cast("string").alias("version_id"),
        (F.octet_length("message_id") + c("event_id") % 100).cast("bigint").alias("size"),
        c("received_at").alias("last_modified"),
    )


_INVENTORY = f"""{MSG}, iv AS (SELECT CASE event_id % 3 WHEN 0 THEN 'raw' WHEN 1 THEN 'processed' ELSE 'latest' END AS prefix, message_id, delivery,
  octet_length(encode(message_id)) + event_id % 100 AS size, received_at + to_seconds(30 * delivery) AS last_modified
  FROM msg, (VALUES (0), (1)) AS v(delivery) WHERE delivery = 0 OR event_id % 10 = 0),
ag AS (SELECT *, floor({age_sql("TIMESTAMP '2024-04-15'", 'last_modified')} / 86400) AS age FROM iv)"""


@query(
    "l3_lifecycle_tier",
    f"""WITH {_INVENTORY} SELECT prefix, CASE WHEN prefix = 'raw' AND age >= 90 THEN 'archive' WHEN prefix = 'processed' AND age >= 95 THEN 'infrequent'
      ELSE 'standard' END AS tier, count(*) AS objects, CAST(sum(size) AS BIGINT) AS total_bytes FROM ag GROUP BY ALL""",
)
def l3(spark, d):
    return retention.tier_bytes(retention.lifecycle_tier(inventory(spark, d), "2024-04-15", processed_days=95))


@query(
    "l4_expire_noncurrent",
    f"""WITH {_INVENTORY}, nc AS (SELECT *, lead(last_modified) OVER (PARTITION BY message_id ORDER BY last_modified) AS since FROM iv)
    SELECT prefix || '/' || message_id AS key, {iso_sql('since')} AS noncurrent_since FROM nc
    WHERE floor({age_sql("TIMESTAMP '2024-04-15'", 'since')} / 86400) >= CASE prefix WHEN 'latest' THEN 80 ELSE 90 END""",
)
def l4(spark, d):
    out = retention.expire_noncurrent(inventory(spark, d), "2024-04-15", latest_days=80)
    return out.select("key", iso("noncurrent_since").alias("noncurrent_since"))


def snapshots(spark, d):
    ext = F.element_at(F.array(*[F.lit(e) for e in ("jpg", "PNG", "txt", "jpeg")]), (F.col("event_id") % 4 + 1).cast("int"))
    return messages(spark, d).select(
        F.concat(F.lit("/snapshots/"), F.col("node_id"), F.lit("/"), F.col("event_id").cast("string"), F.lit("."), ext).alias("path"),
        F.col("source_timestamp").alias("last_modified"),
    )


_FILES = f"{MSG}, fl AS (SELECT '/snapshots/' || node_id || '/' || event_id || '.' || ['jpg', 'PNG', 'txt', 'jpeg'][event_id % 4 + 1] AS path, source_timestamp AS lm, event_id FROM msg)"


@query(
    "l5_expire_snapshots",
    f"WITH {_FILES} SELECT path FROM fl WHERE event_id % 4 <> 2 AND {age_sql("TIMESTAMP '2024-01-20 12:00:00'", 'lm')} > 86400",
)
def l5(spark, d):
    return retention.expire_snapshots(snapshots(spark, d), "2024-01-20 12:00:00").select("path")


@query("l5_daily_purge", f"WITH {_FILES} SELECT path FROM fl WHERE lm < TIMESTAMP '2024-01-19 18:00:00'")
def l5_purge(spark, d):
    # 12:00 UTC is 21:00 in Seoul; the last 03:00 there was 18:00 UTC the day before.
    return retention.daily_purge(snapshots(spark, d), "2024-01-20 12:00:00").select("path")


