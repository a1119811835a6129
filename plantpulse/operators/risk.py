"""Risk scoring: contributions, causes, score, level, trend."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plantpulse import contract as C
from plantpulse.contract import Timing
from plantpulse.functions import clock, rules
from plantpulse.operators.directory import DRAFT_THRESHOLDS, with_rule_weights, with_thresholds
from plantpulse.operators.sliced import Series, as_of
from plantpulse.operators.state import share
from plantpulse.operators.timeseries import inter_arrival

CAUSE_WEIGHTS = {code: weight for code, _, weight, _ in C.CAUSES}
CAUSE_AXES = {code: axis for code, _, _, axis in C.CAUSES}
SITE_READINGS = tuple(name for name, _ in C.MESSAGE_WEIGHTS)


@dataclass(frozen=True)
class Cause:
    """One term of a score: value x weight, if present.

    `value` lies between 0 and 1; `reading` is what was measured and is shown.
    """

    name: str
    value: Column
    weight: Column
    since: Column | None = None
    present: Column | None = None
    part: Column | None = None
    reading: Column | None = None

    @property
    def contribution(self) -> Column:
        if self.part is not None:
            return self.part
        amount = self.value * self.weight
        return amount if self.present is None else F.when(self.present, amount)

    def fields(self) -> list[Column]:
        since = F.lit(None).cast("timestamp") if self.since is None else self.since
        return [
            F.lit(self.name).alias("name"),
            (self.value if self.reading is None else self.reading).alias("value"),
            self.weight.alias("weight"),
            self.contribution.alias("contribution"),
            since.alias("since"),
        ]


# --- three rule sets, one shape: a list of causes --------------------------------------
def message_causes(weights: Mapping[str, float] | Sequence[tuple] = C.MESSAGE_WEIGHTS) -> list[Cause]:
    """Seven readings of a factory_state message, each normalised x weight.

    Needs the threshold columns; a site without thresholds gets 0 for
    temperature and humidity, and pressure has none.
    """
    weights = dict(weights)
    col = F.col
    values = {
        "temperature_celsius_avg": rules.normalised(
            col("sensor.temperature_celsius_avg"), col("temperature_warning"), col("temperature_critical")
        ),
        "humidity_percent_avg": rules.normalised(
            col("sensor.humidity_percent_avg"), col("humidity_warning"), col("humidity_critical")
        ),
        "pressure_hpa_avg": F.lit(0.0),
        "fire_score": F.coalesce(col("ai_result.fire_score"), F.lit(0.0)),
        "fall_score": F.coalesce(col("ai_result.fall_score"), F.lit(0.0)),
        "bend_score": F.coalesce(col("ai_result.bend_score"), F.lit(0.0)),
        "abnormal_sound": F.when(col("ai_result.abnormal_sound") != "", 1.0).otherwise(0.0),
    }
    readings = {n: col(f"sensor.{n}") for n in ("temperature_celsius_avg", "humidity_percent_avg", "pressure_hpa_avg")}
    return [Cause(n, v, F.lit(float(weights[n])), reading=readings.get(n)) for n, v in values.items() if n in weights]


def weighted_contributions(df: DataFrame, weights: Mapping[str, float] | Sequence[tuple] = C.MESSAGE_WEIGHTS) -> DataFrame:
    return with_causes(df, message_causes(weights))


def anomaly_flags(as_of_time: Column, timing: Timing = Timing(), publisher: str | None = None) -> dict[str, Column]:
    """The anomalies as booleans over a combined state row.

    Expects sensor, thresholds, last_factory_state_at, last_infra_state_at,
    heartbeat, nodes and devices; a missing section counts as no data. With
    `publisher`, the workload that sends a site's data, also workloads: the data
    plane is down while that workload is not running and ready.
    """
    col = F.col
    stale = stale_flags(as_of_time, timing)
    known = lambda c: F.coalesce(c, F.lit(False))
    humidity = col("sensor.humidity_percent_avg")
    camera = col("devices")["camera"]["available"]
    mic = col("devices")["microphone"]["available"]
    never = col("last_infra_state_at").isNull()
    down = lambda w: (w["name"] == publisher) & ((w["status"] != "Running") | ~w["ready"])
    data_plane = {} if publisher is None else {"data_plane_down": known(F.exists("workloads", down))}
    return {
        "temp_high": known(col("sensor.temperature_celsius_avg") > col("temperature_warning")),
        "humidity_high": known(
            (humidity > col("humidity_warning")) | (humidity < C.DRAFT_HUMIDITY_LOW_CRITICAL)
        ),
        "sensor_no_data": stale["sensor_no_data"],
        "edge_agent_down": known(col("heartbeat.agent_status") != "alive") | stale["edge_agent_down"],
        "node_not_ready": known(F.exists("nodes", lambda n: ~n.ready)) | stale["node_not_ready"],
        "camera_down": known(~camera) | stale["camera_down"],
        "mic_down": known(~mic) | stale["mic_down"],
        "pipeline_delay": ~never & stale["pipeline_delay"],
        "pipeline_no_data": never,
        **data_plane,
    }


def stale_flags(as_of_time: Column, timing: Timing = Timing()) -> dict[str, Column]:
    """No message for longer than the limit of that component."""
    def late(ts: Column, limit: int) -> Column:
        return F.coalesce(clock.age_seconds(as_of_time, ts) > limit, F.lit(True))

    infra = F.col("last_infra_state_at")
    return {
        "sensor_no_data": late(F.col("last_factory_state_at"), timing.risk_sensor_after),
        "edge_agent_down": late(F.col("heartbeat.last_successful_publish_at"), timing.risk_agent_after),
        "node_not_ready": late(infra, timing.risk_node_after),
        "camera_down": late(F.col("devices")["camera"]["last_seen_at"], timing.risk_device_after),
        "mic_down": late(F.col("devices")["microphone"]["last_seen_at"], timing.risk_device_after),
        "pipeline_delay": late(infra, timing.risk_delivery_after),
    }


def stale_causes(state: DataFrame, as_of_time, timing: Timing = Timing()) -> DataFrame:
    """Codes of the components that have been silent too long."""
    flags = stale_flags(clock.as_timestamp(as_of_time), timing)
    return state.withColumn(
        "stale_codes", F.array_compact(F.array(*[F.when(f, F.lit(c)) for c, f in flags.items()]))
    )


def anomaly_causes(
    as_of_time, timing: Timing = Timing(), weights: Mapping[str, float] = CAUSE_WEIGHTS, publisher: str | None = None
) -> list[Cause]:
    """The fixed-weight rule set: every present anomaly adds its weight."""
    now = clock.as_timestamp(as_of_time)
    on_site = ("temp_high", "humidity_high", "sensor_no_data")
    return [
        Cause(
            code,
            F.lit(1.0),
            F.lit(float(weights[code])),
            since=F.col("last_factory_state_at" if code in on_site else "last_infra_state_at"),
            present=flag,
        )
        for code, flag in anomaly_flags(now, timing, publisher).items()
    ]


def additive_causes(state: DataFrame, as_of_time, timing: Timing = Timing()) -> DataFrame:
    return with_causes(state, anomaly_causes(as_of_time, timing))


def field_causes(as_of_time, timing: Timing = Timing()) -> list[Cause]:
    """The ten configured fields; needs rule_weights and the threshold columns.

    `ai_events_per_hour` and `ai_event_baseline` feed the event-rate field.  A
    field that is not enabled has no weight and drops out.
    """
    col = F.col
    now = clock.as_timestamp(as_of_time)
    disk = F.array_max(F.transform("nodes", lambda n: n.disk_usage_percent))
    age = clock.age_seconds(now, col("last_infra_state_at"))
    status = F.coalesce(rules.delivery_status(age, timing), F.lit("critical"))
    rate = F.when(
        col("ai_event_baseline") > 0,
        rules.clamp(col("ai_events_per_hour") / (2 * col("ai_event_baseline")), 0.0, 1.0),
    )
    zero = F.lit(0.0)
    values = {
        "temperature": rules.normalised(
            col("sensor.temperature_celsius_avg"), col("temperature_warning"), col("temperature_critical")
        ),
        "humidity": rules.normalised(
            col("sensor.humidity_percent_avg"), col("humidity_warning"), col("humidity_critical")
        ),
        "node_status": F.coalesce(share(col("nodes"), lambda n: ~n.ready), zero),
        "pod_health": F.coalesce(share(col("workloads"), lambda w: (w.status != "Running") | ~w.ready), zero),
        "data_freshness": rules.status_value(status),
        "ai_event_rate": F.coalesce(rate, zero),
        "storage_pressure": rules.normalised(disk, F.lit(C.STORAGE_WARNING), F.lit(C.STORAGE_CRITICAL)),
        "network_reachability": F.coalesce(share(col("nodes"), lambda n: n.network_reachability != "ok"), zero),
        "camera_snapshot": zero,
        "audio_level": zero,
    }
    return [Cause(n, v, col("rule_weights")[n]) for n, v in values.items()]


# --- from causes to a score -------------------------------------------------------------
def with_causes(df: DataFrame, causes: Sequence[Cause]) -> DataFrame:
    """`causes`: every term that applies, in rule order."""
    terms = F.array(*[F.when(c.contribution.isNotNull(), F.struct(*c.fields())) for c in causes])
    return df.withColumn("causes", F.array_compact(terms))


def risk_score_sum(causes: Sequence[Cause]) -> Column:
    """Sum of the contributions, within 0..100: plain arithmetic, no arrays."""
    total = F.lit(0.0)
    for c in causes:
        total = total + F.coalesce(c.contribution, F.lit(0.0))
    return rules.clamp(total, 0.0, 100.0)


def rank_causes(causes: Sequence[Cause], n: int = C.TOP_CAUSES) -> Column:
    """Highest contribution first, then the newest, then the rule order.

    The sort key leads the struct, so the sort itself needs no comparator.
    """
    keyed = F.array(
        *[
            F.struct(
                (-F.coalesce(c.contribution, F.lit(0.0))).alias("a"),
                (F.lit(0) if c.since is None else -F.coalesce(F.unix_micros(c.since), F.lit(0))).alias("b"),
                F.lit(i).alias("i"),
                F.struct(*c.fields()).alias("cause"),
            )
            for i, c in enumerate(causes)
        ]
    )
    first = F.slice(F.sort_array(keyed), 1, n)
    return F.transform(F.filter(first, lambda k: k.a < 0), lambda k: k.cause)


def with_score(df: DataFrame, causes: Sequence[Cause]) -> DataFrame:
    """risk_score, risk_level and top_causes; what is not used is pruned.

    Values and contributions become columns first, so that the score and the
    ranking refer to them instead of repeating their expressions.
    """
    names = [(f"_value_{i}", f"_part_{i}") for i in range(len(causes))]
    parts = df.withColumns({v: c.value for (v, _), c in zip(names, causes)}).withColumns(
        {
            p: F.col(v) * c.weight if c.present is None else F.when(c.present, F.col(v) * c.weight)
            for (v, p), c in zip(names, causes)
        }
    )
    ready = [Cause(c.name, F.col(v), c.weight, c.since, part=F.col(p), reading=c.reading) for (v, p), c in zip(names, causes)]
    return (
        parts.withColumn("risk_score", risk_score_sum(ready))
        .withColumns({"risk_level": rules.risk_level(F.col("risk_score")), "top_causes": rank_causes(ready)})
        .drop(*[n for pair in names for n in pair])
    )


def score_messages(
    factory: DataFrame,
    thresholds: DataFrame,
    weights: Mapping[str, float] | Sequence[tuple] = C.MESSAGE_WEIGHTS,
    calculation_version: str = C.CALCULATION_VERSION,
    defaults: dict | None = None,
) -> DataFrame:
    """Score every factory_state message; a projection plus one small join.

    `event_timestamp` is when it happened, `processed_at` when it reached us,
    so that a second run over the archive gives the same rows.
    """
    ready = with_thresholds(factory, thresholds, DRAFT_THRESHOLDS if defaults is None else defaults)
    return with_score(ready, message_causes(weights)).withColumns(
        {
            "calculation_version": F.lit(calculation_version),
            "calculated_at": F.col("source_timestamp"),
            "event_timestamp": F.col("source_timestamp"),
            "processed_at": F.col("received_at"),
        }
    )


def score_fleet(latest: DataFrame, thresholds: DataFrame, as_of_time, timing: Timing = Timing()) -> DataFrame:
    """Additive score of every site's current state."""
    ready = with_thresholds(latest, thresholds, DRAFT_THRESHOLDS)
    return with_score(ready, anomaly_causes(as_of_time, timing))


def score_configured(
    state: DataFrame,
    rule_table: DataFrame,
    thresholds: DataFrame,
    as_of_time: Column,
    timing: Timing = Timing(),
) -> DataFrame:
    """Score by the configured fields and the site's own weights."""
    ready = with_rule_weights(with_thresholds(state, thresholds, DRAFT_THRESHOLDS), rule_table)
    return with_score(ready, field_causes(as_of_time, timing))


# --- trend, axis, text ----------------------------------------------------------------
def score_delta(scored: DataFrame, slice_seconds: int, delta_seconds: int = 600) -> DataFrame:
    """Score minus the score as of `delta_seconds` earlier (null before that)."""
    series = Series(("factory_id",), ("source_timestamp", "message_id"), slice_seconds)
    past = scored.select(
        "factory_id", "source_timestamp", "message_id", F.struct(F.col("risk_score").alias("score")).alias("past")
    )
    earlier = F.col("source_timestamp") - F.make_dt_interval(secs=F.lit(delta_seconds))
    return (
        as_of(scored, past, series, "past", left_time=earlier)
        .withColumn("score_delta", F.col("risk_score") - F.col("past.score"))
        .drop("past")
    )


def trend_direction(delta: Column) -> Column:
    return F.when(delta > 0, "up").when(delta < 0, "down").otherwise("flat")


def origin_axis(causes: Column) -> Column:
    """site, system, both or none: where the causes come from."""
    axes = {**CAUSE_AXES, **{r: "site" for r in SITE_READINGS}}
    names = lambda axis: [n for n, a in axes.items() if a == axis]
    site = F.exists(causes, lambda c: c["name"].isin(*names("site")))
    system = F.exists(causes, lambda c: c["name"].isin(*names("system")))
    return (
        F.when(site & system, "both").when(site, "site").when(system, "system").otherwise("none")
    )


def status_summary_text(causes: Column, level: Column) -> Column:
    """`<cause, cause> → <level label>`, or only the label without causes."""
    listed = F.array_join(F.transform(causes, lambda c: c["name"]), ", ")
    label = rules.level_label(level)
    return F.when(F.size(causes) > 0, F.concat(listed, F.lit(" → "), label)).otherwise(label)


def fleet_rank(cards: DataFrame) -> DataFrame:
    """Position of every site in the fleet.

    Works on one row per site, which is what makes an unpartitioned order
    acceptable; never call it on messages.
    """
    order = Window.orderBy(
        rules.level_rank(F.col("risk_level")), F.col("risk_score").desc_nulls_last(), F.col("factory_id")
    )
    return cards.withColumn("fleet_rank", F.row_number().over(order))


def failed_heartbeat(infra: DataFrame, slice_seconds: int, timing: Timing = Timing(), misses: int = 3) -> DataFrame:
    """Infra messages that came after at least `misses` missed periods."""
    series = Series(("factory_id",), ("source_timestamp", "message_id"), slice_seconds)
    steps = inter_arrival(infra.select("factory_id", "source_timestamp", "message_id"), series)
    limit = misses * timing.infra_period
    return steps.where(F.col("gap_seconds") > limit).withColumn(
        "missed", F.floor(F.col("gap_seconds") / timing.infra_period)
    )


def ai_event_rate(factory: DataFrame, window_seconds: int = 3600) -> DataFrame:
    """AI events (any score in the danger band) per site and hour."""
    hit = F.greatest("ai_result.fire_score", "ai_result.fall_score", "ai_result.bend_score") >= C.AI_DANGER_FROM
    return factory.groupBy(
        "factory_id", clock.bucket_start("source_timestamp", window_seconds).alias("window_start")
    ).agg(F.count_if(hit).alias("ai_events"), F.count(F.lit(1)).alias("messages"))
