"""Runtime configuration as small tables (S11).

Parsing the configuration file is left to its owner; this module takes the
rows.  They enter as Arrow tables, so Spark knows their size and broadcasts a
join side only while it is below `spark.sql.autoBroadcastJoinThreshold`;
beyond that it shuffles, and adaptive execution splits hot sites.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from plantpulse import contract as C

_RULES = pa.schema(
    [
        ("field", pa.string()),
        ("display", pa.bool_()),
        ("risk_enabled", pa.bool_()),
        ("weight", pa.float64()),
        ("unit", pa.string()),
    ]
)
_OVERRIDES = pa.schema(
    [
        ("factory_id", pa.string()),
        ("field", pa.string()),
        ("display", pa.bool_()),
        ("risk_enabled", pa.bool_()),
        ("weight", pa.float64()),
    ]
)
_FACTORIES = pa.schema(
    [(n, pa.string()) for n in (
        "factory_id",
        "display_name",
        "status",
        "spoke_type",
        "environment_type",
        "input_module_type",
        "preferred_node",
        "failover_node",
    )]
    + [("ai_event_baseline", pa.float64())]
)
METRICS = ("temperature", "humidity")
_THRESHOLDS = pa.schema(
    [("factory_id", pa.string())]
    + [(f"{m}_{level}", pa.float64()) for m in METRICS for level in ("warning", "critical")]
)
_CAUSES = pa.schema(
    [("code", pa.string()), ("label", pa.string()), ("weight", pa.float64()), ("axis", pa.string())]
)


def small_table(spark: SparkSession, rows: Iterable[tuple], schema: pa.Schema) -> DataFrame:
    """Driver rows as a relation of known size."""
    columns = list(zip(*rows)) or [[] for _ in schema]
    arrays = [pa.array(list(c), type=f.type) for c, f in zip(columns, schema)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, schema=schema))


def wide_thresholds(rows: Iterable[tuple]) -> list[tuple]:
    """(site, metric, warning, critical) rows -> one row per site."""
    sites: dict[str, dict[str, tuple]] = {}
    for site, metric, warning, critical in rows:
        if metric not in METRICS:
            raise ValueError(f"no thresholds are known for {metric!r} (site {site}); known: {', '.join(METRICS)}")
        sites.setdefault(site, {})[metric] = (warning, critical)
    return [(site, *[b for m in METRICS for b in found.get(m, (None, None))]) for site, found in sites.items()]


@dataclass(frozen=True)
class Settings:
    """field_rules, overrides, factories, thresholds and causes as DataFrames.

    `thresholds` has one row per site.
    """

    field_rules: DataFrame
    overrides: DataFrame
    factories: DataFrame
    thresholds: DataFrame
    causes: DataFrame


def load_config(
    spark: SparkSession,
    field_rules=C.FIELD_RULES,
    overrides=C.FIELD_OVERRIDES,
    factories=C.FACTORIES,
    thresholds=C.THRESHOLDS,
    causes=C.CAUSES,
) -> Settings:
    return Settings(
        small_table(spark, field_rules, _RULES),
        small_table(spark, overrides, _OVERRIDES),
        small_table(spark, factories, _FACTORIES),
        small_table(spark, wide_thresholds(thresholds), _THRESHOLDS),
        small_table(spark, causes, _CAUSES),
    )
