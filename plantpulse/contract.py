"""The data contract: schemas, fixed values and timing.

Everything that must equal the published contract for results to be right is
stated here once, as plain values.
"""

from __future__ import annotations

from dataclasses import dataclass, fields, replace

from pyspark.sql import types as T

# --- fixed values: identifiers and enumerations -----------------------------
SCHEMA_VERSION = "0.1.0"
CALCULATION_VERSION = "risk-v0.1.0"
SOURCE_TYPES = ("factory_state", "infra_state")
ENVIRONMENT_TYPES = ("physical-rpi", "vm-mac", "vm-windows")
INPUT_MODULE_TYPES = ("sensor", "dummy")
NODE_IDS = ("master", "worker1", "worker2", "cluster")
DEVICES = ("bme280", "camera", "microphone")
REQUIRED_FIELDS = (
    "schema_version",
    "message_id",
    "factory_id",
    "node_id",
    "environment_type",
    "input_module_type",
    "source_type",
    "source_timestamp",
    "published_at",
    "agent_instance_id",
)
HISTORY_KINDS = ("RISK", "FACTORY", "INFRA")

# --- fixed values: levels and bands ------------------------------------------
LEVEL_WARNING_FROM = 40.0
LEVEL_DANGER_FROM = 70.0
AI_WARNING_FROM = 0.25
AI_DANGER_FROM = 0.75
RESOURCE_WARNING_FROM = 80.0
RESOURCE_DANGER_FROM = 90.0
STORAGE_WARNING = 75.0
STORAGE_CRITICAL = 90.0
RISK_JUMP = 10.0
TEMPERATURE_RISE = 5.0
AI_RISE = 0.3
TOP_CAUSES = 3

# Draft anomaly bounds used by the additive rule set.
DRAFT_TEMPERATURE_WARNING = 30.0
DRAFT_TEMPERATURE_CRITICAL = 40.0
DRAFT_HUMIDITY_WARNING = 70.0
DRAFT_HUMIDITY_CRITICAL = 80.0
DRAFT_HUMIDITY_LOW_NORMAL = 30.0
DRAFT_HUMIDITY_LOW_CRITICAL = 20.0

# --- fixed values: display labels -----------------------------------------------
LEVEL_LABELS = {"safe": "안전", "warning": "주의", "danger": "위험"}
STATUS_LABELS = {"normal": "정상", "warning": "주의", "critical": "위험"}
FLAG_LABELS = {"true": "정상", "false": "확인 필요", "null": "미수신"}
NOT_SCORED_LABEL = "미계산"
UNKNOWN_STATUS_LABEL = "확인 필요"
DELAYED_LABEL = "데이터 지연"
AI_DANGER_LABELS = {
    "fire": "화재",
    "fall": "넘어짐",
    "bend": "굽힘",
    "sound": "이상 소음",
}

# --- fixed values: anomaly causes (code, label, weight, axis) ------------------
# The additive rule set.  `axis` separates what happens on site from what
# happens to the system that reports it.
CAUSES = (
    ("temp_high", "온도 이상", 15.0, "site"),
    ("humidity_high", "습도 이상", 10.0, "site"),
    ("sensor_no_data", "센서 무수신", 15.0, "site"),
    ("edge_agent_down", "엣지 에이전트 이상", 15.0, "system"),
    ("node_not_ready", "노드 이상", 20.0, "system"),
    ("camera_down", "카메라 이상", 10.0, "system"),
    ("mic_down", "마이크 이상", 10.0, "system"),
    ("pipeline_delay", "파이프라인 지연", 15.0, "system"),
    ("pipeline_no_data", "파이프라인 무수신", 15.0, "system"),
    ("data_plane_down", "데이터 플레인 이상", 15.0, "system"),
)

# --- fixed values: field rules of the runtime configuration --------------------
# (field, display, risk_enabled, weight, unit)
FIELD_RULES = (
    ("temperature", True, True, 15.0, "celsius"),
    ("humidity", True, True, 10.0, "percent"),
    ("node_status", True, True, 20.0, "status"),
    ("pod_health", True, True, 15.0, "status"),
    ("data_freshness", True, True, 15.0, "seconds"),
    ("ai_event_rate", True, True, 10.0, "events_per_hour"),
    ("storage_pressure", True, True, 10.0, "percent"),
    ("network_reachability", True, True, 5.0, "status"),
    ("camera_snapshot", True, False, 0.0, "image_reference"),
    ("audio_level", True, False, 0.0, "db"),
)
MAX_TOTAL_WEIGHT = 100.0

# (factory_id, field, display, risk_enabled, weight); null means "as global"
FIELD_OVERRIDES = (
    ("factory-c", "network_reachability", None, None, 10.0),
    ("factory-c", "storage_pressure", None, None, 5.0),
)

# (factory_id, display_name, status, spoke_type, environment_type,
#  input_module_type, preferred_node, failover_node, ai_event_baseline)
FACTORIES = (
    ("factory-a", "Factory A", "active", "production-edge", "physical-rpi", "sensor", "worker2", "worker1", None),
    ("factory-b", "Factory B", "planned", "testbed", "vm-mac", "dummy", "factory-b", None, 2.0),
    ("factory-c", "Factory C", "planned", "testbed", "vm-windows", "dummy", "factory-c", None, 4.0),
)

# (factory_id, metric, warning, critical)
THRESHOLDS = (
    ("factory-b", "temperature", 32.0, 38.0),
    ("factory-b", "humidity", 70.0, 85.0),
    ("factory-c", "temperature", 33.0, 39.0),
    ("factory-c", "humidity", 72.0, 88.0),
)

# Message-level weights for the seven readings of a factory_state message.
# Two of them (fall 35, temperature 20) are published examples, the rest are
# ours so that the enabled weights sum to 100.
MESSAGE_WEIGHTS = (
    ("temperature_celsius_avg", 20.0),
    ("humidity_percent_avg", 10.0),
    ("pressure_hpa_avg", 5.0),
    ("fire_score", 15.0),
    ("fall_score", 35.0),
    ("bend_score", 10.0),
    ("abnormal_sound", 5.0),
)

# --- schemas -----------------------------------------------------------------------
def _struct(**cols: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in cols.items()])


_S, _I, _L, _D, _B, _TS = (
    T.StringType(),
    T.IntegerType(),
    T.LongType(),
    T.DoubleType(),
    T.BooleanType(),
    T.TimestampType(),
)

SENSOR = _struct(
    sample_count=_I,
    temperature_celsius_avg=_D,
    humidity_percent_avg=_D,
    pressure_hpa_avg=_D,
)
AI_RESULT = _struct(
    sample_count=_I,
    fire_score=_D,
    fall_score=_D,
    bend_score=_D,
    abnormal_sound=_S,
)
HEARTBEAT = _struct(
    agent_status=_S,
    last_successful_publish_at=_TS,
    last_checkpoint_timestamp=_TS,
    publish_sequence=_L,
)
CLUSTER = _struct(cluster_name=_S, kubernetes_version=_S)
NODE = _struct(
    node_id=_S,
    role=_S,
    ready=_B,
    cpu_usage_percent=_D,
    memory_usage_percent=_D,
    disk_usage_percent=_D,
    network_reachability=_S,
)
WORKLOAD = _struct(
    namespace=_S,
    name=_S,
    status=_S,
    ready=_B,
    restart_count=_I,
    node_id=_S,
)
DEVICE = _struct(available=_B, last_seen_at=_TS)

# One payload type covers both source types; the sections of the other type
# are null.  That lets one parse serve the whole stream.
PAYLOAD = _struct(
    aggregation_window_seconds=_I,
    sensor=SENSOR,
    ai_result=AI_RESULT,
    heartbeat=HEARTBEAT,
    cluster=CLUSTER,
    nodes=T.ArrayType(NODE),
    workloads=T.ArrayType(WORKLOAD),
    devices=T.MapType(_S, DEVICE),
)
FACTORY_SECTIONS = ("aggregation_window_seconds", "sensor", "ai_result")
INFRA_SECTIONS = ("heartbeat", "cluster", "nodes", "workloads", "devices")

ENVELOPE = _struct(
    schema_version=_S,
    message_id=_S,
    factory_id=_S,
    node_id=_S,
    environment_type=_S,
    input_module_type=_S,
    source_type=_S,
    source_timestamp=_TS,
    published_at=_TS,
    agent_instance_id=_S,
)
MESSAGE = T.StructType(ENVELOPE.fields + [T.StructField("payload", PAYLOAD, True)])
RAW_MESSAGE = T.StructType(MESSAGE.fields + [T.StructField("received_at", _L, True)])

MEASUREMENTS = {
    "environment_data": _struct(
        factory_id=_S, node_id=_S, ts=_TS, temperature=_D, humidity=_D, pressure=_D
    ),
    "ai_detection": _struct(
        factory_id=_S,
        node_id=_S,
        ts=_TS,
        fire_detected=_I,
        fallen_detected=_I,
        bending_detected=_I,
    ),
    "acoustic_detection": _struct(
        factory_id=_S, node_id=_S, ts=_TS, is_danger=_I, label=_S
    ),
}


# --- timing ------------------------------------------------------------------------
@dataclass(frozen=True)
class Timing:
    """Periods and thresholds in seconds."""

    factory_period: int = 3
    infra_period: int = 20
    history_bucket: int = 30
    infra_bucket: int = 20
    status_warning_after: int = 40
    status_critical_after: int = 60
    factory_stale_after: int = 10
    infra_stale_after: int = 40
    infra_critical_after: int = 60
    risk_sensor_after: int = 180
    risk_agent_after: int = 120
    risk_node_after: int = 60
    risk_device_after: int = 180
    risk_delivery_after: int = 120
    delta_window: int = 600
    lateness: int = 60
    holdoff: int = 300
    failover_within: int = 120
    detect_from: int = 40
    detect_to: int = 60
    display_delay_from: int = 10
    display_delay_to: int = 35
    continuity_window: int = 600

    def scaled(self, factor: int) -> "Timing":
        """The same rules on data whose clock runs `factor` times slower."""
        return replace(self, **{f.name: getattr(self, f.name) * factor for f in fields(self)})


HISTORY_TTL_SECONDS = 86400
# A message may carry a time that is this much later than its receipt.
CLOCK_AHEAD_SECONDS = 3600
TTL_CHOICES = (7200, 86400, 604800)
