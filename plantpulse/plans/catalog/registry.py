"""Registry of queries and the SQL fragments their twins share.

The test data is sparse (one message in minutes, not seconds), so every
registered query runs with all periods and thresholds multiplied by 60.
Timestamps are returned as ISO text and doubles rounded to six decimals.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plantpulse.contract import Timing
from plantpulse.operators.sliced import Series, fitting_seconds
from plantpulse.sources import feed
from plantpulse.sources.settings import Settings, load_config
from plantpulse.sources.shared import shared_folder

TIMING = Timing().scaled(60)
AS_OF = "2024-01-31 00:00:00"
TOPIC_ROOT = "fleet"

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_ORACLES: dict[str, str] = {}
_SLICES: dict[tuple[str, str], int] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        if name in _QUERIES:
            raise ValueError(f"query registered twice: {name}")
        _QUERIES[name] = fn
        if sql is not None:
            _ORACLES[name] = sql
        return fn

    return register


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLES)


# --- Spark side ---------------------------------------------------------------------------
def iso(col) -> Column:
    return F.date_format(col, feed.ISO_MICROS)


def r6(col) -> Column:
    c = col if isinstance(col, Column) else F.col(col)
    return F.round(c.cast("double"), 6) + F.lit(0.0)


def messages(spark: SparkSession, d: str) -> DataFrame:
    return feed.load_messages(spark, d)


def factory(spark: SparkSession, d: str) -> DataFrame:
    return feed.load_factory_states(spark, d)


def infra(spark: SparkSession, d: str) -> DataFrame:
    return feed.load_infra_states(spark, d)


def environment(spark: SparkSession, d: str) -> DataFrame:
    return feed.measurements(factory(spark, d), "environment_data")


def detections(spark: SparkSession, d: str) -> DataFrame:
    return feed.measurements(factory(spark, d), "ai_detection")


def sounds(spark: SparkSession, d: str) -> DataFrame:
    return feed.measurements(factory(spark, d), "acoustic_detection")


def config(spark: SparkSession) -> Settings:
    return load_config(spark)


def slice_seconds(spark: SparkSession, d: str) -> int:
    """Slice width for the messages of this table, counted once per session."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _SLICES:
        rows = messages(spark, d).select("factory_id", "source_timestamp")
        _SLICES[key] = fitting_seconds(rows, ["factory_id"], "source_timestamp")
    return _SLICES[key]


def message_series(spark: SparkSession, d: str, keys=("factory_id",)) -> Series:
    return Series(tuple(keys), ("source_timestamp", "event_id"), slice_seconds(spark, d))


def sample_series(spark: SparkSession, d: str, keys=("factory_id",)) -> Series:
    return Series(tuple(keys), ("ts", "event_id"), slice_seconds(spark, d))


def scratch(spark: SparkSession) -> str:
    """A new folder under the session's shared folder."""
    return f"{shared_folder(spark)}/plantpulse-{uuid.uuid4().hex}"


# --- SQL side ------------------------------------------------------------------------------
def iso_sql(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%dT%H:%M:%S.%fZ')"


def age_sql(later: str, earlier: str) -> str:
    return f"((epoch_us({later}) - epoch_us({earlier})) / 1e6)"


def bucket_sql(ts: str, seconds: int) -> str:
    return f"make_timestamp(epoch_us({ts}) - epoch_us({ts}) % {seconds * 1000000})"


MSG = """
ev AS (SELECT event_id, user_id, ts, event_type,
              CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events),
msg0 AS (SELECT event_id, user_id, k, ts AS source_timestamp,
   'factory-' || chr(CAST(97 + user_id % 3 AS INTEGER)) AS factory_id,
   CASE WHEN event_type IN ('error', 'signup') THEN 'infra_state' ELSE 'factory_state' END AS source_type,
   CASE WHEN event_type IN ('error', 'signup') THEN 'cluster'
        ELSE 'worker' || CAST(user_id % 2 + 1 AS VARCHAR) END AS node_id,
   ts + to_seconds(k % 5) AS published_at,
   ts + to_seconds(k % 5) + to_seconds(event_id % 4) AS received_at FROM ev),
msg AS (SELECT *, factory_id || ':' || source_type || ':' || node_id || ':' ||
   strftime(source_timestamp, '%Y-%m-%dT%H:%M:%S.%fZ') AS message_id FROM msg0)"""

FS = MSG + """,
fs AS (SELECT *,
   CASE WHEN event_id % 29 = 0 THEN 0 ELSE 5 END AS sensor_count,
   CASE WHEN event_id % 29 <> 0 THEN 20 + k * CAST(0.2 AS DOUBLE) END AS temperature,
   CASE WHEN event_id % 29 <> 0 THEN CAST(40 + event_id % 50 AS DOUBLE) END AS humidity,
   CASE WHEN event_id % 29 <> 0 THEN CAST(1000 + user_id % 30 AS DOUBLE) END AS pressure,
   (event_id % 11) / 10 AS fire, (k % 11) / 10 AS fall, ((event_id + k) % 11) / 10 AS bend,
   CASE WHEN event_id % 7 = 0 THEN 'impact' ELSE '' END AS sound
   FROM msg WHERE source_type = 'factory_state')"""

# One row per node, workload and device of an infra message.
INF = MSG + """,
inf AS (SELECT *, CASE WHEN event_id % 31 = 0 THEN 'stopped' ELSE 'alive' END AS agent_status,
   (event_id % 17 <> 0)::INT + ((event_id + 1) % 17 <> 0)::INT + ((event_id + 2) % 17 <> 0)::INT AS ready,
   (event_id % 13 <> 0)::INT + ((event_id + 1) % 13 <> 0)::INT + ((event_id + 2) % 13 <> 0)::INT AS running,
   event_id % 19 <> 0 AS bme280, event_id % 23 <> 0 AS camera, event_id % 29 <> 0 AS microphone
   FROM msg WHERE source_type = 'infra_state'),
idx AS (SELECT * FROM (VALUES (0, 'master', 'vision'), (1, 'worker1', 'audio'), (2, 'worker2', 'climate')) AS t(i, node, workload)),
node AS (SELECT factory_id, source_timestamp AS ts, event_id, i, node AS node_id,
   (event_id + i) % 17 <> 0 AS ready, CAST((k + 31 * i) % 100 AS DOUBLE) AS cpu,
   CAST((k + 47 * i) % 100 AS DOUBLE) AS memory, CAST((event_id + 13 * i) % 100 AS DOUBLE) AS disk,
   CASE WHEN (event_id + i) % 37 = 0 THEN 'unreachable' ELSE 'ok' END AS reach
   FROM inf, idx),
workload AS (SELECT factory_id, source_timestamp AS ts, event_id, i, workload AS name,
   CASE WHEN (event_id + i) % 13 = 0 THEN 'Pending' ELSE 'Running' END AS status,
   event_id % 3 AS restarts, CASE WHEN event_id % 5 = 0 THEN 'worker1' ELSE 'worker2' END AS placed_on
   FROM inf, idx)"""

ENV = FS + """,
env AS (SELECT factory_id, node_id, source_timestamp AS ts, event_id, temperature, humidity, pressure
   FROM fs WHERE sensor_count > 0),
ai AS (SELECT factory_id, node_id, source_timestamp AS ts, event_id, (fire >= 0.5)::INT AS fire_detected,
   (fall >= 0.5)::INT AS fallen_detected, (bend >= 0.5)::INT AS bending_detected FROM fs),
snd AS (SELECT factory_id, node_id, source_timestamp AS ts, event_id, (sound <> '')::INT AS is_danger,
   sound AS label FROM fs)"""

# Weighted score of every factory_state message (same order of additions).
SCORED = FS + """,
th AS (SELECT * FROM (VALUES ('factory-a', 30.0::DOUBLE, 40.0::DOUBLE, 70.0::DOUBLE, 80.0::DOUBLE),
   ('factory-b', 32, 38, 70, 85), ('factory-c', 33, 39, 72, 88)) AS t(factory_id, tw, tc, hw, hc)),
val AS (SELECT fs.*, tw, tc, hw, hc,
   coalesce(least(greatest((temperature - tw) / (tc - tw), 0), 1), 0) * 20 AS c1,
   coalesce(least(greatest((humidity - hw) / (hc - hw), 0), 1), 0) * 10 AS c2,
   fire * 15 AS c4, fall * 35 AS c5, bend * 10 AS c6,
   CASE WHEN sound <> '' THEN 5 ELSE 0 END AS c7 FROM fs JOIN th USING (factory_id)),
scored AS (SELECT *, least(greatest(c1 + c2 + c4 + c5 + c6 + c7, 0), 100) AS risk_score FROM val),
leveled AS (SELECT *, CASE WHEN risk_score < 40 THEN 'safe' WHEN risk_score < 70 THEN 'warning'
   ELSE 'danger' END AS risk_level FROM scored),
cause AS (SELECT message_id, factory_id, event_id, source_timestamp, name, contribution,
   row_number() OVER (PARTITION BY message_id ORDER BY contribution DESC, pos) AS cause_rank
   FROM (SELECT *, unnest([1, 2, 4, 5, 6, 7]) AS pos,
     unnest(['temperature_celsius_avg', 'humidity_percent_avg', 'fire_score', 'fall_score', 'bend_score', 'abnormal_sound']) AS name,
     unnest([c1, c2, c4, c5, c6, c7]) AS contribution FROM leveled) WHERE contribution > 0),
top AS (SELECT message_id, string_agg(name, ',' ORDER BY cause_rank) AS top_causes, max(name) FILTER (cause_rank = 1) AS first_cause
   FROM cause WHERE cause_rank <= 3 GROUP BY message_id)"""


def gap_sql(source: str, value: str, seconds: int, key: str = "factory_id", ts: str = "ts") -> str:
    """CTE text: buckets(key, b, n) with empty buckets, per-series range."""
    return f"""
bounds AS (SELECT {key}, epoch_us(min({ts})) // {seconds * 1000000} AS lo, epoch_us(max({ts})) // {seconds * 1000000} AS hi
  FROM {source} GROUP BY 1),
spine AS (SELECT {key}, unnest(generate_series(lo, hi)) AS b FROM bounds),
filled AS (SELECT {key}, epoch_us({ts}) // {seconds * 1000000} AS b, count({value}) AS n, avg({value}) AS mean_value
  FROM {source} GROUP BY 1, 2),
buckets AS (SELECT s.{key}, s.b, make_timestamp(s.b * {seconds * 1000000}) AS bucket, coalesce(f.n, 0) AS n, f.mean_value
  FROM spine s LEFT JOIN filled f ON s.{key} = f.{key} AND s.b = f.b),
islands AS (SELECT {key}, min(b) AS first_b, count(*) AS len FROM
  (SELECT {key}, b, b - row_number() OVER (PARTITION BY {key} ORDER BY b) AS grp FROM buckets WHERE n = 0)
  GROUP BY {key}, grp)"""
