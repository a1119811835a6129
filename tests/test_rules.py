"""Published examples and boundary values."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from plantpulse import contract as C
from plantpulse.contract import Timing
from plantpulse.functions import clock, rules, text
from plantpulse.operators import directory, risk, state
from plantpulse.operators import timeseries as ts
from plantpulse.plans import views
from plantpulse.sources.settings import load_config


def one(spark, *cols):
    return spark.range(1).select(*cols).first()


def each(spark, values, expr):
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(values)], "i int, v double")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("v"))).collect()]


def test_level_bounds(spark):
    got = each(spark, [0, 39.99, 40, 69.99, 70, 100, 72.4, 45.7, 18.2], rules.risk_level)
    assert got == ["safe", "safe", "warning", "warning", "danger", "danger", "danger", "warning", "safe"]


def test_delivery_status_bounds(spark):
    got = each(spark, [20, 40, 40.001, 41, 60, 60.001, 61], lambda v: rules.delivery_status(v, Timing()))
    assert got == ["normal", "normal", "warning", "warning", "warning", "critical", "critical"]


def test_ai_bands(spark):
    assert each(spark, [0.0, 0.2499, 0.25, 0.7499, 0.75, 1.0], rules.ai_band) == [
        "safe",
        "safe",
        "warning",
        "warning",
        "danger",
        "danger",
    ]


def test_resource_bands(spark):
    assert each(spark, [79.9, 80, 89.9, 90], rules.resource_band) == ["normal", "warning", "warning", "danger"]


def test_clamp_keeps_null(spark):
    assert one(spark, rules.clamp(F.lit(None).cast("double"), 0.0, 1.0))[0] is None


def test_labels(spark):
    row = one(
        spark,
        rules.level_label(F.lit("danger")),
        rules.level_label(F.lit(None).cast("string")),
        rules.flag_label(F.lit(None).cast("boolean")),
        rules.flag_label(F.lit(False)),
        rules.status_label(F.lit(None).cast("string")),
    )
    assert list(row) == ["위험", "미계산", "미수신", "확인 필요", "확인 필요"]


def test_ai_score_example(spark):
    at = datetime(2026, 5, 14, 1)
    rows = [("factory-a", "worker2", at + timedelta(seconds=i), 0, v, 0, i) for i, v in enumerate((0, 1, 1))]
    df = spark.createDataFrame(
        rows,
        "factory_id string, node_id string, ts timestamp, fire_detected int, fallen_detected int, bending_detected int, event_id int",
    )
    assert ts.ai_window_score(df, 3).first()["fall_score"] == 0.6667


def test_bucket_label(spark):
    at = F.lit("2026-05-14 12:00:06").cast("timestamp")
    edge = F.lit("2026-05-14 12:00:30").cast("timestamp")
    row = one(spark, text.iso(clock.bucket_label(at, 30)), text.iso(clock.bucket_label(edge, 30)))
    assert list(row) == ["2026-05-14T12:00:30Z", "2026-05-14T12:01:00Z"]


def test_identifiers(spark):
    mid = "factory-a:factory_state:worker2:2026-05-14T01:00:00Z"
    at = F.lit("2026-05-14 12:00:06").cast("timestamp")
    row = one(
        spark,
        text.message_id(F.lit("factory-a"), F.lit("factory_state"), F.lit("worker2"), F.lit("2026-05-14T01:00:00Z")),
        text.message_id_parts(F.lit(mid))[3],
        text.object_key("raw", [F.lit("factory-a"), F.lit("factory_state")], at, F.lit("m")),
        text.history_sort_key("RISK", at),
        text.partition_key(F.lit("factory-a")),
    )
    assert list(row) == [
        mid,
        "2026-05-14T01:00:00Z",
        "raw/factory-a/factory_state/yyyy=2026/mm=05/dd=14/m.json",
        "HISTORY#RISK#2026-05-14T12:00:06Z",
        "FACTORY#factory-a",
    ]


def test_display_time(spark):
    at = F.lit("2026-05-14 18:30:00").cast("timestamp")
    assert one(spark, clock.display_time(at))[0] == "2026-05-15 03:30:00"


def test_fall_contribution():
    assert 0.67 * dict(C.MESSAGE_WEIGHTS)["fall_score"] == pytest.approx(23.45)


def test_weights_sum(spark):
    cfg = load_config(spark)
    got = directory.weight_sum_check(directory.effective_rules(cfg)).collect()
    assert {(r.factory_id, r.total_weight, r.within_limit) for r in got} == {
        (f, 100.0, True) for f in ("factory-a", "factory-b", "factory-c")
    }
    assert sum(w for _, w in C.MESSAGE_WEIGHTS) == 100


def test_override(spark):
    got = {
        (r.factory_id, r.field): r.weight for r in directory.effective_rules(load_config(spark)).collect()
    }
    assert got["factory-c", "network_reachability"] == 10 and got["factory-a", "network_reachability"] == 5
    assert got["factory-c", "storage_pressure"] == 5 and got["factory-b", "storage_pressure"] == 10


def test_disabled_field_does_not_score(spark):
    cfg = load_config(spark, overrides=[("factory-a", "temperature", None, False, None)])
    weights = directory.rule_weights(directory.effective_rules(cfg)).where("factory_id = 'factory-a'").first()
    assert "temperature" not in weights.rule_weights


def test_resolve_window():
    now = datetime(2026, 5, 14, 12)
    assert views.resolve_window("2h", now=now) == (datetime(2026, 5, 14, 10), now)
    given = (datetime(2026, 5, 1), datetime(2026, 5, 2))
    assert views.resolve_window("1h", *given, now=now) == given


NODE = "struct<node_id:string,ready:boolean,network_reachability:string,disk_usage_percent:double>"
SITE = f"""factory_id string, sensor struct<temperature_celsius_avg:double,humidity_percent_avg:double>,
  last_factory_state_at timestamp, last_infra_state_at timestamp,
  heartbeat struct<agent_status:string,last_successful_publish_at:timestamp>, nodes array<{NODE}>,
  devices map<string,struct<available:boolean,last_seen_at:timestamp>>"""
NOW = datetime(2026, 5, 14, 12)


def site(temp=25.0, humidity=50.0, agent="alive", ready=True, camera=True, mic=True, factory_age=5, infra_age=5):
    seen = NOW - timedelta(seconds=infra_age)
    return (
        "factory-a",
        (temp, humidity),
        NOW - timedelta(seconds=factory_age),
        seen,
        (agent, seen),
        [("worker2", ready, "ok", 10.0)],
        {"camera": (camera, seen), "microphone": (mic, seen)},
    )


def additive(spark, **state_of):
    df = spark.createDataFrame([site(**state_of)], SITE)
    row = risk.score_fleet(df, load_config(spark).thresholds, "2026-05-14 12:00:00").first()
    return row.risk_score, row.risk_level, [c.name for c in row.top_causes]


def test_scenario_normal(spark):
    assert additive(spark) == (0.0, "safe", [])


def test_scenario_temperature(spark):
    assert additive(spark, temp=31.0) == (15.0, "safe", ["temp_high"])


def test_scenario_node(spark):
    assert additive(spark, ready=False) == (20.0, "safe", ["node_not_ready"])


def test_scenario_several(spark):
    score, level, causes = additive(spark, temp=31.0, ready=False, camera=False, mic=False, agent="down")
    assert (score, level) == (70.0, "danger")
    assert causes == ["node_not_ready", "temp_high", "edge_agent_down"]


def test_scenario_everything_is_clamped(spark):
    score, level, causes = additive(spark, temp=31.0, humidity=71.0, factory_age=181, infra_age=181)
    assert (score, level) == (100.0, "danger") and causes[0] == "node_not_ready"


def test_scenario_recovery(spark):
    assert additive(spark, temp=29.0) == (0.0, "safe", [])


def test_stale_limits(spark):
    assert additive(spark, infra_age=60)[0] == 0.0
    assert additive(spark, infra_age=61)[2] == ["node_not_ready"]
    assert additive(spark, factory_age=180)[0] == 0.0
    assert additive(spark, factory_age=181)[2] == ["sensor_no_data"]


def test_fleet_summary(spark):
    df = spark.createDataFrame(
        [("a", "danger", "normal"), ("b", "warning", "normal"), ("c", "safe", "normal")],
        "factory_id string, risk_level string, pipeline_status string",
    )
    assert tuple(views.fleet_summary(df).first()) == (3, 1, 1, 1, 0)


def test_fleet_card_orders(spark):
    at = NOW
    df = spark.createDataFrame(
        [
            ("a", "warning", 50.0, "normal", at, 1.0),
            ("b", "danger", 80.0, "normal", at, -1.0),
            ("c", "danger", 80.0, "critical", at, 2.0),
            ("d", None, None, None, None, None),
            ("e", "danger", 90.0, "normal", at, -2.0),
        ],
        "factory_id string, risk_level string, risk_score double, pipeline_status string, updated_at timestamp, score_delta double",
    )
    order = lambda by: "".join(r.factory_id for r in views.fleet_cards(df, by).collect())
    assert order("screen") == "ecbad"
    assert order("score") == "ebcad"
    assert order("rising") == "cebad"


def test_summaries(spark):
    df = spark.sql(
        """SELECT array(named_struct('ready', true), named_struct('ready', true), named_struct('ready', true)) AS n,
           array(named_struct('status', 'Running', 'ready', true, 'restart_count', 2),
                 named_struct('status', 'Pending', 'ready', false, 'restart_count', 1)) AS w"""
    )
    row = df.select(state.node_summary(F.col("n")), state.workload_summary(F.col("w"))).first()
    assert tuple(row[0]) == (3, 3, 0) and tuple(row[1]) == (2, 1, 1, 3)
