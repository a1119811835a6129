"""The published example documents, from two messages through the processor."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from plantpulse.contract import MESSAGE
from plantpulse.operators import checks
from plantpulse.sources.settings import load_config
from plantpulse.streaming import processor

# The published example of a site's readings and infrastructure.
SENSOR = {"sample_count": 5, "temperature_celsius_avg": 38.2, "humidity_percent_avg": 64.0, "pressure_hpa_avg": 1011.8}
AI = {"sample_count": 3, "fire_score": 0.0, "fall_score": 0.67, "bend_score": 0.2, "abnormal_sound": "impact"}
NODES = (("master", 31.2, 55.4, 42.1), ("worker1", 22.8, 48.0, 39.5), ("worker2", 44.8, 63.0, 45.5))


def envelope(source_type, node, at, published):
    return {
        "schema_version": "0.1.0",
        "message_id": f"factory-a:{source_type}:{node}:{at}",
        "factory_id": "factory-a",
        "node_id": node,
        "environment_type": "physical-rpi",
        "input_module_type": "sensor",
        "source_type": source_type,
        "source_timestamp": at,
        "published_at": published,
        "agent_instance_id": "agent-1",
    }


def bodies():
    site = {"aggregation_window_seconds": 3, "sensor": SENSOR, "ai_result": AI}
    infra = {
        "heartbeat": {"agent_status": "alive", "last_successful_publish_at": "2026-05-14T12:00:18Z", "publish_sequence": 7},
        "nodes": [
            {"node_id": n, "role": "node", "ready": True, "cpu_usage_percent": c, "memory_usage_percent": m, "disk_usage_percent": d, "network_reachability": "ok"}
            for n, c, m, d in NODES
        ],
        "workloads": [
            {"namespace": "edge-apps", "name": n, "status": "Running", "ready": True, "restart_count": 0, "node_id": "worker2"} for n in ("a", "b", "c")
        ],
        "devices": {n: {"available": True, "last_seen_at": "2026-05-14T12:00:19Z"} for n in ("bme280", "camera", "microphone")},
    }
    return [
        json.dumps(envelope("factory_state", "worker2", "2026-05-14T12:00:06Z", "2026-05-14T12:00:07Z") | {"payload": site}),
        json.dumps(envelope("infra_state", "cluster", "2026-05-14T12:00:20Z", "2026-05-14T12:00:21Z") | {"payload": infra}),
    ]


@pytest.fixture(scope="module")
def done(spark, tmp_path_factory):
    home = str(tmp_path_factory.mktemp("documents"))
    spark.createDataFrame([(b,) for b in bodies()], "value string").coalesce(1).write.text(f"{home}/in")
    source = checks.parse_messages(spark.readStream.text(f"{home}/in"), "value")
    source = source.select(*[f.name for f in MESSAGE.fields], checks.CORRUPT).withColumn("received_at", F.col("published_at"))
    for q in processor.run(source, home, load_config(spark), f"{home}/check"):
        q.awaitTermination()
    return home


def test_latest(spark, done):
    latest = processor.latest_state(spark, done, "2026-05-14 12:00:27")
    document = json.loads(processor.latest_documents(latest).first().document)
    assert document["pk"] == "FACTORY#factory-a" and document["sk"] == "LATEST"
    assert document["schema_version"] == "0.1.0" and document["updated_at"] == "2026-05-14T12:00:20Z"
    assert (document["last_factory_state_at"], document["last_infra_state_at"]) == ("2026-05-14T12:00:06Z", "2026-05-14T12:00:20Z")
    risk = document["risk"]
    assert risk["calculated_at"] == "2026-05-14T12:00:06Z" and risk["calculation_version"] == "risk-v0.1.0"
    fall = next(c for c in risk["top_causes"] if c["name"] == "fall_score")
    assert fall == {"name": "fall_score", "value": 0.67, "weight": 35.0, "contribution": pytest.approx(23.45)}
    warm = next(c for c in risk["top_causes"] if c["name"] == "temperature_celsius_avg")
    assert warm["value"] == 38.2 and warm["weight"] == 20.0
    assert risk["score"] >= sum(c["contribution"] for c in risk["top_causes"]) - 1e-9
    assert document["factory_state"] == {
        "source_message_id": "factory-a:factory_state:worker2:2026-05-14T12:00:06Z", "aggregation_window_seconds": 3, "sensor": SENSOR, "ai_result": AI,
    }
    infra = document["infra_state"]
    assert infra["source_message_id"] == "factory-a:infra_state:cluster:2026-05-14T12:00:20Z"
    assert infra["node_summary"] == {"total": 3, "ready": 3, "not_ready": 0}
    assert infra["nodes"] == [
        {"node_id": n, "ready": True, "cpu_usage_percent": c, "memory_usage_percent": m, "disk_usage_percent": d} for n, c, m, d in NODES
    ]
    assert infra["workload_summary"] == {"total": 3, "running": 3, "unhealthy": 0, "restart_count_total": 0}
    assert infra["device_summary"] == {"bme280_available": True, "camera_available": True, "microphone_available": True}
    assert document["pipeline_status"] == {"status": "normal", "latest_infra_state_age_seconds": 6.0, "latest_s3_raw_age_seconds": 6.0}
    assert document["dashboard"]["display_status"] in ("안전", "주의", "위험")
    assert document["dashboard"]["updated_at"] == "2026-05-14T12:00:20Z"


def test_histories(spark, done):
    day = (datetime(2026, 5, 14), datetime(2026, 5, 15))
    risk = processor.history(spark, done, "RISK", factory="factory-a", start=day[0], end=day[1]).first()
    assert (risk.pk, risk.sk) == ("FACTORY#factory-a", "HISTORY#RISK#2026-05-14T12:00:30Z")
    assert risk.bucket_seconds == 30 and risk.source == "last_value" and "fall_score" in risk.top_cause_names
    site = processor.history(spark, done, "FACTORY", start=day[0], end=day[1]).first()
    assert site.sk == "HISTORY#FACTORY#2026-05-14T12:00:30Z"
    assert {n: site[n] for n in ("temperature_celsius_avg", "humidity_percent_avg", "pressure_hpa_avg")} == {n: SENSOR[n] for n in SENSOR if n != "sample_count"}
    assert (site.fire_score, site.fall_score, site.bend_score) == (0.0, 0.67, 0.2)
    infra = processor.history(spark, done, "INFRA").first()
    assert infra.sk == "HISTORY#INFRA#2026-05-14T12:00:20Z" and infra.bucket_seconds == 20
    assert infra.node_summary.asDict() == {"total": 3, "ready": 3, "not_ready": 0}
    assert infra.ttl == int(datetime.fromisoformat("2026-05-14T12:00:20+00:00").timestamp()) + 86400
    assert processor.history(spark, done, "INFRA", start=datetime(2026, 5, 15), end=datetime(2026, 5, 16)).count() == 0
