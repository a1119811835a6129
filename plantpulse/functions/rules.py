"""Rule expressions: levels, bands, states, clamps and labels."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from plantpulse import contract as C
from plantpulse.contract import Timing


def _lookup(values: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(v) for v in chain(*values.items())])


def clamp(value: Column, low: float, high: float) -> Column:
    """Null stays null (least and greatest alone would skip it)."""
    return F.when(value.isNotNull(), F.least(F.greatest(value, F.lit(low)), F.lit(high)))


def normalised(value: Column, warning: Column, critical: Column) -> Column:
    """Linear from 0 at the warning threshold to 1 at the critical one.

    Zero where the value or the thresholds are missing.
    """
    span = F.when(critical != warning, critical - warning)
    return F.coalesce(
        F.when(value.isNotNull() & span.isNotNull(), clamp((value - warning) / span, 0.0, 1.0)),
        F.lit(0.0),
    )


def risk_level(score: Column) -> Column:
    return (
        F.when(score < C.LEVEL_WARNING_FROM, "safe")
        .when(score < C.LEVEL_DANGER_FROM, "warning")
        .when(score.isNotNull(), "danger")
    )


def level_rank(level: Column) -> Column:
    """Danger first; a site without a score comes last."""
    return (
        F.when(level == "danger", 0).when(level == "warning", 1).when(level == "safe", 2).otherwise(3)
    )


def ai_band(mean: Column) -> Column:
    return (
        F.when(mean < C.AI_WARNING_FROM, "safe")
        .when(mean < C.AI_DANGER_FROM, "warning")
        .when(mean.isNotNull(), "danger")
    )


def ai_label(mean: Column, field: str, sound_text: Column | None = None) -> Column:
    """안전 / 주의 / the danger word of the field (or the heard sound)."""
    danger = F.lit(C.AI_DANGER_LABELS[field])
    if sound_text is not None:
        danger = F.coalesce(F.nullif(sound_text, F.lit("")), danger)
    band = ai_band(mean)
    return (
        F.when(band == "safe", C.LEVEL_LABELS["safe"])
        .when(band == "warning", C.LEVEL_LABELS["warning"])
        .when(band == "danger", danger)
    )


def resource_band(percent: Column) -> Column:
    return (
        F.when(percent < C.RESOURCE_WARNING_FROM, "normal")
        .when(percent < C.RESOURCE_DANGER_FROM, "warning")
        .when(percent.isNotNull(), "danger")
    )


def threshold_state(value: Column, warning: Column, critical: Column) -> Column:
    """Strictly above a threshold counts as that state."""
    return (
        F.when(value.isNull() | warning.isNull() | critical.isNull(), F.lit(None).cast("string"))
        .when(value > critical, "critical")
        .when(value > warning, "warning")
        .otherwise("normal")
    )


def draft_humidity_state(value: Column) -> Column:
    """Two-sided draft band for humidity."""
    return (
        F.when(
            (value > C.DRAFT_HUMIDITY_CRITICAL) | (value < C.DRAFT_HUMIDITY_LOW_CRITICAL),
            "critical",
        )
        .when(
            (value > C.DRAFT_HUMIDITY_WARNING) | (value < C.DRAFT_HUMIDITY_LOW_NORMAL),
            "warning",
        )
        .when(value.isNotNull(), "normal")
    )


def delivery_status(age: Column, timing: Timing) -> Column:
    """normal / warning / critical from the age of the latest infra message."""
    return (
        F.when(age > timing.status_critical_after, "critical")
        .when(age > timing.status_warning_after, "warning")
        .when(age.isNotNull(), "normal")
    )


def missed_interval(age: Column, timing: Timing) -> Column:
    return age > timing.infra_period


def status_value(status: Column) -> Column:
    """0, 0.5 or 1 for normal, warning, critical."""
    return F.when(status == "critical", 1.0).when(status == "warning", 0.5).otherwise(0.0)


def level_label(level: Column) -> Column:
    return F.coalesce(_lookup(C.LEVEL_LABELS)[level], F.lit(C.NOT_SCORED_LABEL))


def status_label(status: Column) -> Column:
    return F.coalesce(_lookup(C.STATUS_LABELS)[status], F.lit(C.UNKNOWN_STATUS_LABEL))


def flag_label(flag: Column) -> Column:
    return _lookup(C.FLAG_LABELS)[F.coalesce(flag.cast("string"), F.lit("null"))]
