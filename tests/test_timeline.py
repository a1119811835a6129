"""Timeline events on small histories written by hand."""

from datetime import datetime, timedelta

from plantpulse.operators import timeline
from plantpulse.plans import views
from plantpulse.sources.settings import load_config

AT = datetime(2026, 5, 14, 12)
RISK = "factory_id string, timestamp timestamp, message_id string, risk_level string, risk_score double, top_cause_names array<string>"


def risk_points(spark, *points):
    rows = [
        ("factory-a", AT + timedelta(seconds=30 * i), f"m{i}", level, score, causes)
        for i, (level, score, causes) in enumerate(points)
    ]
    return spark.createDataFrame(rows, RISK)


def kinds(df):
    return [(r.type, r.severity, r.title) for r in df.orderBy("timestamp", "type").collect()]


def test_level_change_without_jump(spark):
    df = risk_points(
        spark, ("warning", 64.1, ["temperature_celsius_avg"]), ("danger", 72.4, ["fall_score", "temperature_celsius_avg"])
    )
    assert kinds(timeline.risk_events(df, 3600)) == [
        ("risk_level_changed", "danger", "Risk 주의 -> 위험"),
        ("top_causes_changed", "info", "Top causes changed"),
    ]


def test_jump_of_ten(spark):
    df = risk_points(spark, ("safe", 10.0, []), ("safe", 20.0, []), ("safe", 29.9, []))
    assert [k[0] for k in kinds(timeline.risk_events(df, 3600))] == ["risk_jump"]


def test_recovery_is_info(spark):
    df = risk_points(spark, ("danger", 80.0, ["x"]), ("safe", 10.0, ["x"]))
    assert kinds(timeline.risk_events(df, 3600)) == [("risk_level_changed", "info", "Risk 위험 -> 안전")]


def test_events_cross_slices(spark):
    """The point before may lie in an earlier slice."""
    df = risk_points(spark, ("safe", 10.0, []), ("danger", 75.0, []))
    assert kinds(timeline.risk_events(df, 1)) == kinds(timeline.risk_events(df, 86400))


def test_temperature_and_ai(spark):
    rows = [
        ("factory-b", AT, "m0", 31.9, 0.4, 0.0, 0.0),
        ("factory-b", AT + timedelta(seconds=30), "m1", 32.1, 0.7, 0.2, 0.0),
        ("factory-b", AT + timedelta(seconds=60), "m2", 38.5, 0.7, 0.2, 0.9),
        ("factory-b", AT + timedelta(seconds=90), "m3", 38.6, 0.7, 0.2, 0.9),
    ]
    df = spark.createDataFrame(
        rows,
        "factory_id string, timestamp timestamp, message_id string, temperature_celsius_avg double, fire_score double, fall_score double, bend_score double",
    )
    got = kinds(timeline.factory_events(df, load_config(spark).thresholds, 3600))
    assert got == [
        ("ai_score_rise", "warning", "fire_score rise"),
        ("temperature_rise", "warning", "Temperature rise"),
        ("ai_score_rise", "danger", "bend_score rise"),
        ("temperature_rise", "danger", "Temperature rise"),
    ]


def test_empty_range(spark):
    df = timeline.risk_events(risk_points(spark, ("safe", 1.0, [])), 3600)
    assert views.timeline_events(df, "factory-a", AT, AT + timedelta(hours=1)).count() == 0
