"""Joins with the configuration: rules, thresholds, directory, placement.

None of these carries a broadcast hint.  The configuration side has a known
size, so Catalyst broadcasts it below the threshold and shuffles beyond it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantpulse import contract as C
from plantpulse.sources.settings import Settings


def effective_rules(settings: Settings, field_rules: Sequence[tuple] = C.FIELD_RULES) -> DataFrame:
    """One row per site and field: the global rule unless the site overrides it.

    The short rule list is unfolded on each site row, so no cross join.
    """
    rules = F.array(
        *[
            F.struct(
                F.lit(field).alias("field"),
                F.lit(display).alias("display"),
                F.lit(enabled).alias("risk_enabled"),
                F.lit(float(weight)).alias("weight"),
                F.lit(unit).alias("unit"),
            )
            for field, display, enabled, weight, unit in field_rules
        ]
    )
    given = settings.factories.select("factory_id", F.inline(rules))
    own = settings.overrides.select(
        "factory_id",
        "field",
        *[F.col(c).alias(f"own_{c}") for c in ("display", "risk_enabled", "weight")],
    )
    return given.join(own, ["factory_id", "field"], "left").select(
        "factory_id",
        "field",
        *[F.coalesce(f"own_{c}", c).alias(c) for c in ("display", "risk_enabled", "weight")],
        "unit",
    )


def risk_enabled_filter(rules: DataFrame) -> DataFrame:
    return rules.where("risk_enabled")


def rule_weights(rules: DataFrame) -> DataFrame:
    """factory_id -> map of enabled field to weight (as many entries as fields)."""
    return risk_enabled_filter(rules).groupBy("factory_id").agg(
        F.map_from_entries(F.collect_list(F.struct("field", "weight"))).alias("rule_weights")
    )


def weight_sum_check(rules: DataFrame, limit: float = C.MAX_TOTAL_WEIGHT) -> DataFrame:
    """Enabled weight per site and whether it is within the limit."""
    return (
        risk_enabled_filter(rules)
        .groupBy("factory_id")
        .agg(F.sum("weight").alias("total_weight"))
        .withColumn("within_limit", F.col("total_weight") <= limit)
    )


def with_rule_weights(df: DataFrame, rules: DataFrame, field_rules: Sequence[tuple] = C.FIELD_RULES) -> DataFrame:
    """Attach `rule_weights`; a site without rules gets the global ones."""
    fallback = F.create_map(
        *[x for field, _, enabled, weight, _ in field_rules if enabled for x in (F.lit(field), F.lit(float(weight)))]
    )
    return df.join(rule_weights(rules), "factory_id", "left").withColumn(
        "rule_weights", F.coalesce("rule_weights", fallback)
    )


def with_thresholds(df: DataFrame, thresholds: DataFrame, defaults: dict[str, tuple[float, float]] | None = None) -> DataFrame:
    """Attach `<metric>_warning` and `<metric>_critical` of the row's site."""
    out = df.join(thresholds, "factory_id", "left")
    filled = {
        f"{m}_{level}": F.coalesce(f"{m}_{level}", F.lit(bound))
        for m, bounds in (defaults or {}).items()
        for level, bound in zip(("warning", "critical"), bounds)
    }
    return out.withColumns(filled) if filled else out


# Bounds for sites whose configuration has none.
DRAFT_THRESHOLDS = {
    "temperature": (C.DRAFT_TEMPERATURE_WARNING, C.DRAFT_TEMPERATURE_CRITICAL),
    "humidity": (C.DRAFT_HUMIDITY_WARNING, C.DRAFT_HUMIDITY_CRITICAL),
}


def factory_directory(df: DataFrame, factories: DataFrame) -> DataFrame:
    """Attach display name, spoke type and state of the site."""
    facts = factories.select(
        "factory_id",
        "display_name",
        F.col("status").alias("site_status"),
        "spoke_type",
        F.col("environment_type").alias("site_environment"),
    )
    return df.join(facts, "factory_id", "left")


def roster_left_join(df: DataFrame, factories: DataFrame) -> DataFrame:
    """Every configured site, with its row if there is one."""
    return factories.select("factory_id", "display_name").join(df, "factory_id", "left")


def missing_factories(df: DataFrame, factories: DataFrame) -> DataFrame:
    """Configured sites without data."""
    return factories.select("factory_id", "display_name").join(df, "factory_id", "left_anti")


def visible_fields(long_rows: DataFrame, rules: DataFrame) -> DataFrame:
    """Null out the values of fields a site does not display.

    `long_rows` has factory_id, field and value; unknown fields stay visible.
    """
    flags = rules.select("factory_id", "field", "display")
    return (
        long_rows.join(flags, ["factory_id", "field"], "left")
        .withColumn("value", F.when(F.coalesce("display", F.lit(True)), F.col("value")))
        .drop("display")
    )


def displayed_columns(columns: Sequence[str], field_of: dict[str, str], field_rules: Sequence[tuple] = C.FIELD_RULES) -> list[str]:
    """Columns to select when the global rules hide some fields."""
    hidden = {field for field, display, *_ in field_rules if not display}
    return [c for c in columns if field_of.get(c) not in hidden]


def placement_check(infra: DataFrame, factories: DataFrame) -> DataFrame:
    """Each workload with its placement: preferred, failover, other, not_running."""
    spots = factories.select("factory_id", "preferred_node", "failover_node")
    rows = infra.select("factory_id", "source_timestamp", "event_id", F.explode("workloads").alias("w")).select(
        "factory_id",
        "source_timestamp",
        "event_id",
        F.col("w.name").alias("workload"),
        F.col("w.status").alias("workload_status"),
        F.col("w.node_id").alias("placed_on"),
    )
    return rows.join(spots, "factory_id", "left").withColumn("placement_state", placement_state())


def placement_state():
    return (
        F.when(F.col("workload_status") != "Running", "not_running")
        .when(F.col("placed_on") == F.col("preferred_node"), "preferred")
        .when(F.col("placed_on") == F.col("failover_node"), "failover")
        .otherwise("other")
    )


def label_causes(scored: DataFrame, causes: DataFrame) -> DataFrame:
    """One row per top cause with its label and axis."""
    rows = scored.select("factory_id", "message_id", F.posexplode("top_causes").alias("pos", "c")).select(
        "factory_id",
        "message_id",
        (F.col("pos") + 1).alias("cause_rank"),
        F.col("c.name").alias("code"),
        F.col("c.contribution").alias("contribution"),
    )
    return rows.join(causes.select("code", "label", "axis"), "code", "left")
