"""Risk rules that are valid from a moment on, and scores by the rule then in force.

A rule change names a field, the moment it takes effect, and what it sets: for
one site or, without a site, for all. What a change leaves null stays as it was
for all sites, so a site can take back its own value by setting null. `rule_states`
folds the changes into one row per site and moment: the weight of every enabled
field, the displayed fields, and the name of the newest change. A message meets
the state in force at its own time, looked up in the list of its site, so a message
that comes late is scored by the old rule and one received early by the new.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plantpulse import contract as C
from plantpulse.operators.directory import DRAFT_THRESHOLDS, with_thresholds
from plantpulse.operators.risk import Cause, message_causes, with_score
from plantpulse.operators.sliced import Series, fill_forward
from plantpulse.sources.settings import small_table

CHANGES = pa.schema(
    [
        ("version", pa.string()),
        ("valid_from", pa.timestamp("us", tz="UTC")),
        ("factory_id", pa.string()),
        ("field", pa.string()),
        ("display", pa.bool_()),
        ("risk_enabled", pa.bool_()),
        ("weight", pa.float64()),
    ]
)
#: Changes are few and far apart: a slice of changes spans a year.
CHANGE_SLICE = 365 * 86400
_SET = ("display", "risk_enabled", "weight")


def changes(spark: SparkSession, rows: Sequence[tuple]) -> DataFrame:
    """(version, valid_from, factory_id or None, field, display, risk_enabled, weight) as a table."""
    return small_table(spark, rows, CHANGES)


def rule_states(change_table: DataFrame, factories: DataFrame) -> DataFrame:
    """factory_id, valid_from, rule_version, rule_weights and displayed fields.

    Fields that no change has named yet are not in force. Of changes to the same
    field at the same moment the one with the larger version name counts.
    """
    sites = factories.select("factory_id").distinct()
    known = change_table.where(F.col("valid_from").isNotNull() & F.col("field").isNotNull())
    newest = known.groupBy("factory_id", "field", "valid_from").agg(
        F.max_by(F.struct(*_SET), "version").alias("set"), F.max("version").alias("version")
    )
    common = newest.where("factory_id is null").select("field", "valid_from", "version", F.col("set").alias("common"))
    own = newest.where("factory_id is not null").withColumnRenamed("set", "own")
    # A common change concerns every site: the few field names are unfolded on each site, so no cross join.
    names = sorted(r.field for r in known.select("field").distinct().collect())
    listed = F.explode(F.array(*[F.lit(n) for n in names]) if names else F.array().cast("array<string>"))
    spread = sites.select("factory_id", listed.alias("field")).join(common, "field")
    touched = spread.unionByName(own.join(sites, "factory_id", "left_semi"), allowMissingColumns=True)
    folded = touched.groupBy("factory_id", "field", "valid_from").agg(
        F.max("common").alias("common"), F.max("own").alias("own"), F.max("version").alias("version")
    )
    # At every moment of a site all its fields are stated, also those that do not change.
    moments = folded.groupBy("factory_id", "valid_from").agg(F.max("version").alias("rule_version"))
    fields = folded.groupBy("factory_id").agg(F.collect_set("field").alias("_fields"))
    grid = moments.join(fields, "factory_id").select("factory_id", "valid_from", "rule_version", F.explode("_fields").alias("field"))
    stated = grid.join(folded.drop("version"), ["factory_id", "field", "valid_from"], "left")
    series = Series(("factory_id", "field"), ("valid_from",), CHANGE_SLICE)
    filled = fill_forward(stated, series, ["common", "own"]).where("common is not null or own is not null")
    value = {c: F.coalesce(F.col(f"own.{c}"), F.col(f"common.{c}")) for c in _SET}
    enabled = F.coalesce(value["risk_enabled"], F.lit(False)) & value["weight"].isNotNull()
    return filled.groupBy("factory_id", "valid_from", "rule_version").agg(
        F.map_from_entries(
            F.collect_list(F.when(enabled, F.struct("field", value["weight"])))
        ).alias("rule_weights"),
        F.array_sort(F.collect_set(F.when(F.coalesce(value["display"], F.lit(False)), F.col("field")))).alias("displayed"),
    )


def with_rules(rows: DataFrame, states: DataFrame, slice_seconds: int | None = None) -> DataFrame:
    """Rows with `rules`: the state in force at their source_timestamp, null before the first.

    The states of a site, few and small, become one list in order of time; every
    row looks its own up there, so messages are neither shuffled nor sorted as
    long as the lists can be broadcast. `slice_seconds` is not needed any more.
    """
    first = F.lit(-(2**63))
    listed = states.select(
        "factory_id",
        F.struct(
            F.coalesce(F.unix_micros("valid_from"), first).alias("at"),
            F.struct("rule_version", "rule_weights", "displayed").alias("rules"),
        ).alias("_state"),
    )
    # The states hold maps, which have no order of their own.
    earlier = lambda a, b: F.when(a["at"] < b["at"], -1).when(a["at"] > b["at"], 1).otherwise(0)
    sites = (
        listed.groupBy("factory_id")
        .agg(F.array_sort(F.collect_list("_state"), earlier).alias("_states"))
        .select("factory_id", F.col("_states.at").alias("_moments"), F.col("_states.rules").alias("_rules"))
    )
    now = F.coalesce(F.unix_micros("source_timestamp"), first)
    begun = F.coalesce(F.size(F.filter("_moments", lambda m: m <= now)), F.lit(0))
    return rows.join(sites, "factory_id", "left").select(*rows.columns, F.get("_rules", begun - 1).alias("rules"))


def ruled_causes(names: Sequence[str] = tuple(n for n, _ in C.MESSAGE_WEIGHTS)) -> list[Cause]:
    """The readings of a message under the weights of its `rules`; a field without weight drops out."""
    return [
        Cause(c.name, c.value, F.col("rules.rule_weights")[c.name], reading=c.reading)
        for c in message_causes({n: 0.0 for n in names})
    ]


def score_by_rules(
    factory: DataFrame,
    thresholds: DataFrame,
    states: DataFrame,
    slice_seconds: int,
    processed_at=None,
    defaults: Mapping[str, tuple[float, float]] | None = None,
) -> DataFrame:
    """Score factory_state messages by the rules in force at their time.

    `calculation_version` names the rules. `processed_at` is when the result is
    made, by default the receipt of the message, which a second run repeats.
    """
    ready = with_thresholds(
        with_rules(factory, states, slice_seconds), thresholds, DRAFT_THRESHOLDS if defaults is None else defaults
    )
    return with_score(ready, ruled_causes()).withColumns(
        {
            "calculation_version": F.coalesce("rules.rule_version", F.lit("none")),
            "displayed": F.col("rules.displayed"),
            "calculated_at": F.col("source_timestamp"),
            "event_timestamp": F.col("source_timestamp"),
            "processed_at": F.col("received_at") if processed_at is None else processed_at,
        }
    ).drop("rules")


def hidden(value, field: str):
    """A shown value, or null where the rules in force do not display its field."""
    return F.when(F.array_contains("displayed", field), value)
