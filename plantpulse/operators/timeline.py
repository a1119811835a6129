"""Change events: each history is compared with its own previous point.

All events of a history are one array per row and one `inline`, so a history
is read, shuffled and ordered once whatever the number of event types.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantpulse import contract as C
from plantpulse.contract import Timing
from plantpulse.functions import clock, rules
from plantpulse.operators.directory import DRAFT_THRESHOLDS, with_thresholds
from plantpulse.operators.sliced import Series, over_rows, with_previous
from plantpulse.operators.state import device_summary, node_summary, workload_summary

POINT_ORDER = ("timestamp", "message_id")
# What the events of a history compare with the point before.
RISK_FACTS = ["risk_level", "risk_score", "top_cause_names"]
FACTORY_FACTS = ["temperature_celsius_avg", "fire_score", "fall_score", "bend_score"]
INFRA_FACTS = ["node_summary", "workload_summary", "device_summary", "nodes"]
# Absorbs binary noise in steps such as 0.7 - 0.4.
STEP_NOISE = 1e-9
RISK_TYPES = ("risk_level_changed", "risk_jump", "top_causes_changed")
FACTORY_TYPES = ("temperature_rise", "ai_score_rise")
INFRA_TYPES = (
    "pipeline_changed",
    "node_ready_changed",
    "workload_unhealthy",
    "device_unavailable",
    "component_recovered",
    "node_resource_high",
)
EVENT_COLUMNS = ("factory_id", "timestamp", "type", "severity", "title", "description", "source")


def _event(type_: str, when: Column, severity, title: Column, description: Column) -> Column:
    level = severity if isinstance(severity, Column) else F.lit(severity)
    return F.when(
        when,
        F.struct(
            F.lit(type_).alias("type"),
            level.alias("severity"),
            title.alias("title"),
            description.alias("description"),
        ),
    )


def _text(*parts) -> Column:
    return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])


def _arrow(before: Column, after: Column) -> Column:
    return _text(before, " -> ", after)


def _emit(df: DataFrame, events: Column, source: str) -> DataFrame:
    return (
        df.select("factory_id", "timestamp", F.inline(F.array_compact(events)))
        .withColumn("source", F.lit(f"HISTORY#{source}"))
        .select(*EVENT_COLUMNS)
    )


def _series(slice_seconds: int) -> Series:
    return Series(("factory_id",), POINT_ORDER, slice_seconds)


def level_severity(level: Column) -> Column:
    """Severity of arriving at a level or status."""
    return (
        F.when(level.isin("danger", "critical"), "danger").when(level == "warning", "warning").otherwise("info")
    )


def risk_events(history: DataFrame, slice_seconds: int) -> DataFrame:
    """Level changes, jumps and changes of the top causes."""
    points = with_previous(history.select("factory_id", *POINT_ORDER, *RISK_FACTS), _series(slice_seconds), RISK_FACTS)
    return _emit(points, _risk_changes(), "RISK")


def _risk_changes() -> Column:
    col, known = F.col, F.col("prev_risk_level").isNotNull()
    causes = F.array_join("top_cause_names", ", ")
    jump = col("risk_score") - col("prev_risk_score")
    return F.array(
        _event(
            "risk_level_changed",
            known & (col("risk_level") != col("prev_risk_level")),
            level_severity(col("risk_level")),
            _text("Risk ", _arrow(rules.level_label(col("prev_risk_level")), rules.level_label(col("risk_level")))),
            causes,
        ),
        _event("risk_jump", jump >= C.RISK_JUMP - STEP_NOISE, "warning", F.lit("Risk jump"), causes),
        _event(
            "top_causes_changed",
            known & ~col("top_cause_names").eqNullSafe(col("prev_top_cause_names")),
            "info",
            F.lit("Top causes changed"),
            _arrow(F.array_join("prev_top_cause_names", ", "), causes),
        ),
    )


def factory_events(history: DataFrame, thresholds: DataFrame, slice_seconds: int) -> DataFrame:
    """Temperature rises (step or threshold crossing) and AI score rises."""
    points = with_previous(history.select("factory_id", *POINT_ORDER, *FACTORY_FACTS), _series(slice_seconds), FACTORY_FACTS)
    return _emit(with_thresholds(points, thresholds, DRAFT_THRESHOLDS), _factory_changes(), "FACTORY")


def _factory_changes() -> Column:
    temperature, *scores = FACTORY_FACTS
    now, before, limit = F.col(temperature), F.col(f"prev_{temperature}"), F.col("temperature_warning")
    crossed = (before <= limit) & (now > limit)
    events = [
        _event(
            "temperature_rise",
            (now - before >= C.TEMPERATURE_RISE - STEP_NOISE) | crossed,
            F.when(now > F.col("temperature_critical"), "danger").otherwise("warning"),
            F.lit("Temperature rise"),
            F.format_string("%.1f -> %.1f", before, now),
        )
    ]
    for s in scores:
        value, prev = F.col(s), F.col(f"prev_{s}")
        events.append(
            _event(
                "ai_score_rise",
                value - prev >= C.AI_RISE - STEP_NOISE,
                F.when(rules.ai_band(value) == "danger", "danger").otherwise("warning"),
                F.lit(f"{s} rise"),
                F.format_string("%.2f -> %.2f", prev, value),
            )
        )
    return F.array(*events)


def site_events(history: DataFrame, thresholds: DataFrame, slice_seconds: int) -> DataFrame:
    """RISK and FACTORY events of points that hold the facts of both, ordered once."""
    facts = [*RISK_FACTS, *FACTORY_FACTS]
    points = with_previous(history.select("factory_id", *POINT_ORDER, *facts), _series(slice_seconds), facts)
    points = with_thresholds(points, thresholds, DRAFT_THRESHOLDS)
    kinds = {"RISK": _risk_changes(), "FACTORY": _factory_changes()}
    tagged = [
        F.transform(F.array_compact(events), lambda e, k=kind: F.struct(*[e[c] for c in ("type", "severity", "title", "description")], F.lit(f"HISTORY#{k}").alias("source")))
        for kind, events in kinds.items()
    ]
    return points.select("factory_id", "timestamp", F.inline(F.concat(*tagged))).select(*EVENT_COLUMNS)


def infra_events(history: DataFrame, slice_seconds: int) -> DataFrame:
    """Delivery, node, workload, device and resource changes, and recoveries."""
    cols = ["pipeline_status", *INFRA_FACTS]
    points = with_previous(history.select("factory_id", *POINT_ORDER, *cols), _series(slice_seconds), cols)
    return _emit(points.where(F.col("prev_pipeline_status").isNotNull()), _infra_changes(), "INFRA")


def infra_message_events(infra: DataFrame, slice_seconds: int, timing: Timing = Timing()) -> DataFrame:
    """INFRA events straight from messages: one ordering, two rows of look-back.

    The status of a point tells how long after the one before it came, so the
    status before needs the row before that.
    """
    cols = infra.select(
        "factory_id",
        F.col("source_timestamp").alias("timestamp"),
        "message_id",
        node_summary(F.col("nodes")).alias("node_summary"),
        workload_summary(F.col("workloads")).alias("workload_summary"),
        device_summary(F.col("devices")).alias("device_summary"),
        "nodes",
    )
    points = over_rows(
        cols,
        _series(slice_seconds),
        ["timestamp", *INFRA_FACTS],
        lambda w: {f"prev_{c}": F.lag(c).over(w) for c in ("timestamp", *INFRA_FACTS)} | {"_before": F.lag("timestamp", 2).over(w)},
        rows=2,
    ).where(F.col("prev_timestamp").isNotNull())

    def status(now: str, before: str) -> Column:
        age = F.coalesce(clock.age_seconds(now, before), F.lit(0.0))
        return F.struct(rules.delivery_status(age, timing).alias("status"))

    points = points.withColumns(
        {"pipeline_status": status("timestamp", "prev_timestamp"), "prev_pipeline_status": status("prev_timestamp", "_before")}
    )
    return _emit(points, _infra_changes(), "INFRA")


def _infra_changes() -> Column:
    col = F.col
    status, was = col("pipeline_status.status"), col("prev_pipeline_status.status")
    ready, was_ready = col("node_summary.ready"), col("prev_node_summary.ready")
    down, was_down = col("node_summary.not_ready"), col("prev_node_summary.not_ready")
    sick, was_sick = col("workload_summary.unhealthy"), col("prev_workload_summary.unhealthy")
    events = [
        _event("pipeline_changed", status != was, level_severity(status), _text("Pipeline ", status), _arrow(was, status)),
        _event(
            "node_ready_changed",
            (ready != was_ready) | (down != was_down),
            F.when(down > was_down, "warning").otherwise("info"),
            _text("Nodes ready ", ready.cast("string"), "/", col("node_summary.total").cast("string")),
            _arrow(was_ready.cast("string"), ready.cast("string")),
        ),
        _event(
            "workload_unhealthy",
            (was_sick == 0) & (sick >= 1),
            "warning",
            F.lit("Workload unhealthy"),
            _text("unhealthy=", sick.cast("string")),
        ),
        _recovered((was != "normal") & (status == "normal"), "pipeline"),
        _recovered((was_down > 0) & (down == 0), "node"),
        _recovered((was_sick > 0) & (sick == 0), "workload"),
    ]
    for device in C.DEVICES:
        flag, before = col(f"device_summary.{device}_available"), col(f"prev_device_summary.{device}_available")
        events.append(
            _event(
                "device_unavailable",
                before & ~flag,
                "warning",
                F.lit(f"{device.capitalize()} unavailable"),
                F.lit(f"{device}_available=false"),
            )
        )
        events.append(_recovered(~before & flag, device))
    return F.concat(F.array(*events), F.flatten(F.transform("nodes", _resource_events)))


def _recovered(when: Column, component: str) -> Column:
    return _event(
        "component_recovered", when, "info", F.lit(f"{component.capitalize()} recovered"), F.lit(component)
    )


def _resource_events(node: Column) -> Column:
    """Upward crossings of 80 and 90 per cent against the same node before."""
    before = F.get(F.filter("prev_nodes", lambda p: p.node_id == node.node_id), F.lit(0))

    def crossing(metric: str, name: str) -> Column:
        now, was = node[metric], before[metric]
        to_danger = (was < C.RESOURCE_DANGER_FROM) & (now >= C.RESOURCE_DANGER_FROM)
        to_warning = (was < C.RESOURCE_WARNING_FROM) & (now >= C.RESOURCE_WARNING_FROM)
        return _event(
            "node_resource_high",
            to_danger | to_warning,
            F.when(to_danger, "danger").otherwise("warning"),
            _text(node.node_id, f" {name} ", F.when(to_danger, "90").otherwise("80"), "% 초과"),
            F.format_string("%.1f", now),
        )

    return F.array(
        crossing("cpu_usage_percent", "CPU"),
        crossing("memory_usage_percent", "memory"),
        crossing("disk_usage_percent", "disk"),
    )


def merge_histories(risk: DataFrame, factory: DataFrame, infra: DataFrame) -> DataFrame:
    """The three histories as one relation, `kind` telling them apart."""
    parts = [df.withColumn("kind", F.lit(k)) for df, k in ((risk, "RISK"), (factory, "FACTORY"), (infra, "INFRA"))]
    return parts[0].unionByName(parts[1], allowMissingColumns=True).unionByName(parts[2], allowMissingColumns=True)


def timeline(
    risk: DataFrame | None,
    factory: DataFrame | None,
    infra: DataFrame | None,
    thresholds: DataFrame,
    slice_seconds: int,
    types: Sequence[str] | None = None,
) -> DataFrame:
    """All events of the given histories, unordered; `types` narrows them.

    A history may be left out (None) if none of its event types is wanted.
    """
    parts = []
    if risk is not None:
        parts.append(risk_events(risk, slice_seconds))
    if factory is not None:
        parts.append(factory_events(factory, thresholds, slice_seconds))
    if infra is not None:
        parts.append(infra_events(infra, slice_seconds))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out if types is None else out.where(F.col("type").isin(*types))


def newest_events(events: DataFrame, n: int) -> DataFrame:
    """The newest `n` events of the whole fleet (top-k, no full sort)."""
    return events.orderBy(F.col("timestamp").desc(), "factory_id", "type", "title").limit(n)
