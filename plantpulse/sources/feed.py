"""Telemetry frames derived row by row from the shared `events` table.

The mapping is a narrow projection: no shuffle, and Catalyst prunes whatever a
query does not read (`struct(..).field` collapses to the plain expression).
"""

from __future__ import annotations

import math
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plantpulse.contract import PAYLOAD, SCHEMA_VERSION

ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"

NODE_ROLES = (
    ("master", "control-plane", 0),
    ("worker1", "failover-standby", 1),
    ("worker2", "sensor-ai-audio-preferred", 2),
)
WORKLOAD_NAMES = (("vision", 0), ("audio", 1), ("climate", 2))


def read_events(spark: SparkSession, sf_dir: str, start: datetime | None = None, end: datetime | None = None) -> DataFrame:
    """The table, or its rows from `start` to `end` (UTC), which the scan sees as a predicate on `ts`."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    kind = events.schema["ts"].dataType  # the table keeps times without a zone
    if start is not None:
        events = events.where(F.col("ts") >= F.lit(start).cast(kind))
    if end is not None:
        events = events.where(F.col("ts") <= F.lit(end).cast(kind))
    return events


def _seconds(expr):
    return F.make_dt_interval(secs=expr.cast("decimal(18,6)"))


INFRA_EVENT = "event_type IN ('error', 'signup')"


def _narrow(events: DataFrame) -> DataFrame:
    """The envelope facts of an event; everything else derives from these."""
    return events.selectExpr(
        "event_id",
        "user_id",
        "CAST(ts AS TIMESTAMP) AS source_timestamp",
        "CAST(get_json_object(props, '$.k') AS INT) AS k",
        "concat('factory-', char(97 + user_id % 3)) AS factory_id",
        f"CASE WHEN {INFRA_EVENT} THEN 'infra_state' ELSE 'factory_state' END AS source_type",
        f"CASE WHEN {INFRA_EVENT} THEN 'cluster' ELSE concat('worker', CAST(user_id % 2 + 1 AS STRING)) END AS node_id",
    ).selectExpr(
        "*",
        f"source_timestamp + {_seconds_sql('k % 5')} AS published_at",
        f"source_timestamp + {_seconds_sql('k % 5')} + {_seconds_sql('event_id % 4')} AS received_at",
    )


def _seconds_sql(expr: str) -> str:
    return f"make_dt_interval(0, 0, 0, CAST({expr} AS DECIMAL(18, 6)))"


def _node(name: str, role: str, i: int) -> str:
    return f"""named_struct('node_id', '{name}', 'role', '{role}', 'ready', (event_id + {i}) % 17 <> 0,
      'cpu_usage_percent', CAST((k + {31 * i}) % 100 AS DOUBLE), 'memory_usage_percent', CAST((k + {47 * i}) % 100 AS DOUBLE),
      'disk_usage_percent', CAST((event_id + {13 * i}) % 100 AS DOUBLE),
      'network_reachability', CASE WHEN (event_id + {i}) % 37 = 0 THEN 'unreachable' ELSE 'ok' END)"""


def _workload(name: str, i: int) -> str:
    return f"""named_struct('namespace', 'edge-apps', 'name', '{name}',
      'status', CASE WHEN (event_id + {i}) % 13 = 0 THEN 'Pending' ELSE 'Running' END, 'ready', (event_id + {i}) % 13 <> 0,
      'restart_count', CAST(event_id % 3 AS INT), 'node_id', CASE WHEN event_id % 5 = 0 THEN 'worker1' ELSE 'worker2' END)"""


def _device(name: str, every: int) -> str:
    return f"'{name}', named_struct('available', event_id % {every} <> 0, 'last_seen_at', source_timestamp)"


_READ = "event_id % 29 <> 0"
# Payload sections as plain structs, so that reading one field costs one field.
SECTIONS = {
    "factory_state": {
        "aggregation_window_seconds": "3",
        "sensor": f"""named_struct('sample_count', CASE WHEN {_READ} THEN 5 ELSE 0 END,
          'temperature_celsius_avg', CASE WHEN {_READ} THEN 20 + k * 0.2D END,
          'humidity_percent_avg', CASE WHEN {_READ} THEN CAST(40 + event_id % 50 AS DOUBLE) END,
          'pressure_hpa_avg', CASE WHEN {_READ} THEN CAST(1000 + user_id % 30 AS DOUBLE) END)""",
        "ai_result": """named_struct('sample_count', 3, 'fire_score', (event_id % 11) / 10, 'fall_score', (k % 11) / 10,
          'bend_score', ((event_id + k) % 11) / 10, 'abnormal_sound', CASE WHEN event_id % 7 = 0 THEN 'impact' ELSE '' END)""",
    },
    "infra_state": {
        "heartbeat": """named_struct('agent_status', CASE WHEN event_id % 31 = 0 THEN 'stopped' ELSE 'alive' END,
          'last_successful_publish_at', published_at, 'last_checkpoint_timestamp', source_timestamp,
          'publish_sequence', CAST(event_id AS BIGINT))""",
        "cluster": "named_struct('cluster_name', factory_id, 'kubernetes_version', 'v1')",
        "nodes": f"array({', '.join(_node(*n) for n in NODE_ROLES)})",
        "workloads": f"array({', '.join(_workload(*w) for w in WORKLOAD_NAMES)})",
        "devices": f"map({_device('bme280', 19)}, {_device('camera', 23)}, {_device('microphone', 29)})",
    },
}

ENVELOPE = (
    f"'{SCHEMA_VERSION}' AS schema_version",
    f"""concat_ws(':', factory_id, source_type, node_id, date_format(source_timestamp, "{ISO_MICROS}")) AS message_id""",
    "factory_id",
    "node_id",
    """CASE factory_id WHEN 'factory-a' THEN 'physical-rpi' WHEN 'factory-b' THEN 'vm-mac' ELSE 'vm-windows' END
      AS environment_type""",
    "CASE WHEN factory_id = 'factory-a' THEN 'sensor' ELSE 'dummy' END AS input_module_type",
    "source_type",
    "source_timestamp",
    "published_at",
    "concat('agent-', factory_id) AS agent_instance_id",
    "received_at",
    "event_id",
)


def _with_payload(events: DataFrame) -> DataFrame:
    fields = ", ".join(
        f"'{name}', CAST(CASE WHEN source_type = '{source}' THEN {expr} END AS {PAYLOAD[name].dataType.simpleString()})"
        for source, sections in SECTIONS.items()
        for name, expr in sections.items()
    )
    return _narrow(events).selectExpr(*ENVELOPE, f"named_struct({fields}) AS payload")


def _typed(events: DataFrame, source_type: str) -> DataFrame:
    sections = [f"{expr} AS {name}" for name, expr in SECTIONS[source_type].items()]
    wanted = INFRA_EVENT if source_type == "infra_state" else f"NOT {INFRA_EVENT}"
    return _narrow(events.where(wanted)).selectExpr(*ENVELOPE, *sections)


def load_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both source types, payload as one struct whose foreign sections are null."""
    return _with_payload(read_events(spark, sf_dir))


def load_factory_states(spark: SparkSession, sf_dir: str, start: datetime | None = None, end: datetime | None = None) -> DataFrame:
    return _typed(read_events(spark, sf_dir, start, end), "factory_state")


def load_infra_states(spark: SparkSession, sf_dir: str, start: datetime | None = None, end: datetime | None = None) -> DataFrame:
    return _typed(read_events(spark, sf_dir, start, end), "infra_state")


def with_repeats(messages: DataFrame) -> DataFrame:
    """At-least-once delivery: every tenth message arrives again 30 s later.

    One pass: each row is exploded into its one or two deliveries.
    """
    copies = F.when(F.col("event_id") % 10 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    delay = _seconds(F.col("delivery") * 30)
    return (
        messages.withColumn("delivery", F.explode(copies))
        .withColumn("published_at", F.col("published_at") + delay)
        .withColumn("received_at", F.col("received_at") + delay)
    )


def measurements(rows: DataFrame, name: str) -> DataFrame:
    """The three site-local measurements behind factory_state rows."""
    key = ["factory_id", "node_id", F.col("source_timestamp").alias("ts"), "event_id"]
    if name == "environment_data":
        return rows.where(F.col("sensor.sample_count") > 0).select(
            *key,
            F.col("sensor.temperature_celsius_avg").alias("temperature"),
            F.col("sensor.humidity_percent_avg").alias("humidity"),
            F.col("sensor.pressure_hpa_avg").alias("pressure"),
        )
    if name == "ai_detection":
        flag = lambda c: (F.col(f"ai_result.{c}") >= 0.5).cast("int")
        return rows.select(
            *key,
            flag("fire_score").alias("fire_detected"),
            flag("fall_score").alias("fallen_detected"),
            flag("bend_score").alias("bending_detected"),
        )
    if name == "acoustic_detection":
        sound = F.col("ai_result.abnormal_sound")
        return rows.select(*key, (sound != "").cast("int").alias("is_danger"), sound.alias("label"))
    raise ValueError(f"unknown measurement: {name}")


def observations(rows: DataFrame) -> DataFrame:
    """Node and workload observations of infra_state rows, one row per workload."""
    node = F.element_at(F.filter("nodes", lambda n: n.node_id == "worker2"), 1)
    return rows.select(
        "factory_id",
        F.col("source_timestamp").alias("ts"),
        F.lit("worker2").alias("node_id"),
        node.ready.alias("ready"),
        F.explode("workloads").alias("w"),
        "event_id",
    ).select(
        "factory_id",
        "ts",
        "node_id",
        "ready",
        F.col("w.name").alias("pod"),
        F.col("w.status").alias("pod_status"),
        F.col("w.node_id").alias("pod_node"),
        "event_id",
    )


# --- the same frames as streams -------------------------------------------------------------
#: Deliveries of an event table, and rows of a delivery that make one file more.
DELIVERIES, ROWS_PER_FILE = 3, 50_000


def deliver(spark: SparkSession, sf_dir: str, folder: str, parts: int = DELIVERIES, rows_per_file: int = ROWS_PER_FILE) -> str:
    """The event table written to `folder` in consecutive deliveries of about equal size, cut by time.

    All deliveries have the same number of files, whatever the files of the
    table: a stream that takes that many at once takes one delivery a batch.
    """
    events = read_events(spark, sf_dir)
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    rows, cuts = events.select(F.count(at), F.percentile_approx(at, [n / parts for n in range(1, parts)], 1000)).first()
    files = max(1, math.ceil(rows / parts / rows_per_file))
    ends = [None, *(cuts or []), None]
    for n, (low, high) in enumerate(zip(ends, ends[1:]), 1):
        part = events
        if low is not None:
            part = part.where(at > low)
        if high is not None:
            part = part.where(at <= high)
        part.repartition(files).write.mode("append").parquet(folder)
        # A task without rows writes no file; one without rows stands for it.
        for _ in range(n * files - _files(events, folder)):
            events.limit(0).write.mode("append").parquet(folder)
    return folder


def _files(events: DataFrame, folder: str) -> int:
    return len(events.sparkSession.read.schema(events.schema).parquet(folder).inputFiles())


def _event_stream(spark: SparkSession, sf_dir: str, folder: str | None, parts: int = DELIVERIES) -> DataFrame:
    events = read_events(spark, sf_dir)
    if folder is not None:
        each = max(1, _files(events, folder) // parts)
        return spark.readStream.schema(events.schema).option("maxFilesPerTrigger", each).parquet(folder)
    # A pattern, because a stream takes a plain path for a directory; it fits
    # the table as one file or as a directory of files.
    return spark.readStream.schema(events.schema).parquet(f"{sf_dir}/events.[p]arquet")


def stream_messages(spark: SparkSession, sf_dir: str, folder: str | None = None) -> DataFrame:
    """The table as one delivery, or what `deliver` wrote to `folder` file by file."""
    return _with_payload(_event_stream(spark, sf_dir, folder))


def stream_factory_states(spark: SparkSession, sf_dir: str, folder: str | None = None) -> DataFrame:
    return _typed(_event_stream(spark, sf_dir, folder), "factory_state")
