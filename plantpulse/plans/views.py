"""The dashboard's reads as DataFrame functions (no HTTP)."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plantpulse import contract as C
from plantpulse.contract import Timing
from plantpulse.functions import clock, rules
from plantpulse.operators import metrics, timeline as tl
from plantpulse.operators.directory import roster_left_join
from plantpulse.operators.risk import anomaly_flags
from plantpulse.operators.sliced import Series, with_previous
from plantpulse.operators.state import latest_per_factory, with_delivery_status
from plantpulse.operators.timeseries import run_durations

WINDOWS = {"1h": 3600, "2h": 7200, "24h": 86400}
COMPONENTS = {
    "sensor": ("sensor_no_data",),
    "edge_agent": ("edge_agent_down",),
    "node": ("node_not_ready",),
    "camera": ("camera_down",),
    "microphone": ("mic_down",),
    "delivery": ("pipeline_delay", "pipeline_no_data"),
}


# --- time ranges ------------------------------------------------------------------------
def resolve_window(
    window: str | None = None,
    start: datetime | None = None,
    end: datetime | None = None,
    now: datetime | None = None,
) -> tuple[datetime, datetime]:
    """from and to win, each for itself; an end that is open is `now`, a start the window before the end."""
    end = end or now or datetime.now(timezone.utc).replace(tzinfo=None)
    return start or end - timedelta(seconds=WINDOWS[window or "1h"]), end


def time_range(df: DataFrame, start: datetime, end: datetime, ts: str = "timestamp") -> DataFrame:
    """Closed interval on the time column, and on `date` where there is one."""
    if "date" in df.columns:
        df = df.where(F.col("date").between(start.strftime("%Y-%m-%d"), end.strftime("%Y-%m-%d")))
    return df.where(F.col(ts).between(F.lit(start), F.lit(end)))


def _range(df: DataFrame, factory: str | None, start, end) -> DataFrame:
    out = time_range(df, start, end)
    return out if factory is None else out.where(F.col("factory_id") == factory)


# --- projections ------------------------------------------------------------------------
RISK_POINT = ("factory_id", "timestamp", "risk_score", "risk_level", "top_cause_names", "bucket_seconds")
FACTORY_POINT = (
    "factory_id",
    "timestamp",
    "temperature_celsius_avg",
    "humidity_percent_avg",
    "pressure_hpa_avg",
    "fire_score",
    "fall_score",
    "bend_score",
    "bucket_seconds",
)
INFRA_POINT = ("factory_id", "timestamp", "node_summary", "nodes", "workload_summary", "device_summary", "pipeline_status")


def latest_projection(latest: DataFrame, sections: Sequence[str]) -> DataFrame:
    """Only the wanted sections of the current state (nested pruning)."""
    return latest.select("factory_id", *sections)


def history_projection(history: DataFrame, kind: str) -> DataFrame:
    return history.select(*{"RISK": RISK_POINT, "FACTORY": FACTORY_POINT, "INFRA": INFRA_POINT}[kind])


# --- fleet ---------------------------------------------------------------------------------
def fleet_cards(cards: DataFrame, order_by: str = "screen") -> DataFrame:
    """Order cards: `screen`, `score` or `rising` (see README)."""
    rank, score = rules.level_rank(F.col("risk_level")), F.col("risk_score").desc_nulls_last()
    abnormal = F.when(F.coalesce(F.col("pipeline_status"), F.lit("unknown")) != "normal", 0).otherwise(1)
    rising = F.when(F.col("score_delta") > 0, 0).otherwise(1) if "score_delta" in cards.columns else F.lit(0)
    orders: dict[str, list[Column]] = {
        "screen": [rank, score, abnormal, F.col("updated_at").desc_nulls_last()],
        "score": [rank, score],
        "rising": [rank, rising, score],
    }
    return cards.orderBy(*orders[order_by], "factory_id")


def fleet_summary(cards: DataFrame) -> DataFrame:
    """total, danger, warning, safe, delayed."""
    level = lambda name: F.count_if(F.col("risk_level") == name)
    return cards.agg(
        F.count(F.lit(1)).alias("total"),
        level("danger").alias("danger"),
        level("warning").alias("warning"),
        level("safe").alias("safe"),
        F.count_if(F.coalesce(F.col("pipeline_status"), F.lit("unknown")) != "normal").alias("delayed"),
    )


def fleet_cards_of(
    scored_latest: DataFrame, inputs: DataFrame, factories: DataFrame, as_of_time, timing: Timing = Timing()
) -> DataFrame:
    """One card per configured site: level, score, causes, nodes, delivery, freshness."""
    status = with_delivery_status(inputs, as_of_time, timing).select(
        "factory_id", F.col("status").alias("pipeline_status")
    )
    cards = scored_latest.join(status, "factory_id", "left")
    now = clock.as_timestamp(as_of_time)
    return roster_left_join(cards, factories).select(
        "factory_id",
        "display_name",
        rules.level_label(F.col("risk_level")).alias("display_status"),
        "risk_score",
        "risk_level",
        F.transform("top_causes", lambda c: c["name"]).alias("top_causes"),
        F.col("node_summary.ready").alias("node_ready"),
        F.col("node_summary.total").alias("node_total"),
        "pipeline_status",
        "updated_at",
        "last_factory_state_at",
        "last_infra_state_at",
        display_stale(now, F.col("last_factory_state_at"), timing.factory_stale_after).alias("factory_stale"),
        display_stale(now, F.col("last_infra_state_at"), timing.infra_stale_after).alias("infra_stale"),
    )


def display_stale(now: Column, ts: Column, limit: int) -> Column:
    return F.coalesce(clock.age_seconds(now, ts) > limit, F.lit(True))


def infra_staleness(now: Column, ts: Column, timing: Timing = Timing()) -> Column:
    age = clock.age_seconds(now, ts)
    return (
        F.when(age > timing.infra_critical_after, "critical")
        .when(age > timing.infra_stale_after, "warning")
        .when(age.isNotNull(), "fresh")
        .otherwise("missing")
    )


def fleet_overview(scored_latest: DataFrame, inputs: DataFrame, factories: DataFrame, as_of_time, timing: Timing = Timing(), order_by: str = "screen") -> DataFrame:
    return fleet_cards(fleet_cards_of(scored_latest, inputs, factories, as_of_time, timing), order_by)


def factory_overview(scored_latest: DataFrame, factory: str | None = None) -> DataFrame:
    """Current state of one site (or all), labelled for display."""
    rows = scored_latest if factory is None else scored_latest.where(F.col("factory_id") == factory)
    return rows.select(
        "factory_id",
        rules.level_label(F.col("risk_level")).alias("display_status"),
        "risk_score",
        F.transform("top_causes", lambda c: c["name"]).alias("top_causes"),
        "sensor",
        "ai_result",
        "node_summary",
        "workload_summary",
        *[
            rules.flag_label(F.col(f"device_summary.{d}_available")).alias(f"{d}_label")
            for d in C.DEVICES
        ],
        "updated_at",
    )


# --- history reads --------------------------------------------------------------------------
def risk_history_read(history: DataFrame, factory: str | None, start, end) -> DataFrame:
    return history_projection(_range(history, factory, start, end), "RISK")


def factory_history_read(history: DataFrame, factory: str | None, start, end) -> DataFrame:
    return history_projection(_range(history, factory, start, end), "FACTORY")


def infra_history_read(history: DataFrame, factory: str | None, start, end) -> DataFrame:
    return history_projection(_range(history, factory, start, end), "INFRA")


def node_series(history: DataFrame, metric: str, factory: str | None = None) -> DataFrame:
    """One series per node for a metric of the INFRA history."""
    rows = history if factory is None else history.where(F.col("factory_id") == factory)
    points = F.transform(
        "nodes", lambda n: F.struct(n.node_id.alias("node_id"), n[f"{metric}_usage_percent"].alias("value"))
    )
    return rows.select("factory_id", "timestamp", F.inline(points))


def infra_current(latest: DataFrame, factory: str | None = None) -> DataFrame:
    """Current nodes with their resource bands."""
    rows = latest if factory is None else latest.where(F.col("factory_id") == factory)
    return metrics.with_resource_bands(rows.select("factory_id", "last_infra_state_at", F.inline("nodes")))


def timeline_events(events: DataFrame, factory: str | None, start, end) -> DataFrame:
    """Events of a time range, newest first."""
    return _range(events, factory, start, end).orderBy(F.col("timestamp").desc(), "factory_id", "type", "title")


def recent_logs(events: DataFrame, n: int) -> DataFrame:
    return tl.newest_events(events, n)


def latest_n(df: DataFrame, n: int, ts: str = "ts", ties: Sequence[str] = ()) -> DataFrame:
    """Newest `n` rows over everything (top-k in each task, then merged)."""
    return df.orderBy(F.col(ts).desc(), *[F.col(t).desc() for t in ties]).limit(n)


def latest_n_per_factory(df: DataFrame, n: int, ts: str = "ts", ties: Sequence[str] = ()) -> DataFrame:
    newest = Window.partitionBy("factory_id").orderBy(*[F.col(c).desc() for c in (ts, *ties)])
    return df.withColumn("recency", F.row_number().over(newest)).where(F.col("recency") <= n)


def sensor_status(environment: DataFrame, points: int, interval_seconds: int) -> DataFrame:
    """Current temperature and humidity per site and the last bucket means."""
    current = latest_per_factory(
        environment.select("factory_id", "ts", "event_id", "temperature", "humidity"), ("factory_id",), ("ts", "event_id")
    ).select("factory_id", F.col("ts").alias("sensor_at"), "temperature", "humidity")
    means = environment.groupBy("factory_id", clock.bucket_start("ts", interval_seconds).alias("ts")).agg(
        F.avg("temperature").alias("mean_temperature")
    )
    trend = (
        latest_n_per_factory(means, points)
        .groupBy("factory_id")
        .agg(F.array_sort(F.collect_list(F.struct("ts", "mean_temperature"))).alias("_t"))
        .select("factory_id", F.transform("_t", lambda p: p.mean_temperature).alias("trend"))
    )
    return current.join(trend, "factory_id", "left")


def component_flags(as_of_time, timing: Timing = Timing()) -> dict[str, Column]:
    flags = anomaly_flags(clock.as_timestamp(as_of_time), timing)
    out = {}
    for component, codes in COMPONENTS.items():
        any_of = flags[codes[0]]
        for code in codes[1:]:
            any_of = any_of | flags[code]
        out[component] = any_of
    return out


def abnormal_system_count(state: DataFrame, as_of_time, timing: Timing = Timing()) -> DataFrame:
    """Abnormal components per site: adding six flags, no shuffle."""
    flags = component_flags(as_of_time, timing)
    return state.withColumn("abnormal_systems", sum((f.cast("int") for f in flags.values()), F.lit(0)))


def abnormal_systems(state: DataFrame, as_of_time, timing: Timing = Timing()) -> DataFrame:
    """One row per abnormal component; worst sites first, then newest onset."""
    onset = {"sensor": "last_factory_state_at"}
    items = F.array_compact(
        F.array(
            *[
                F.when(
                    flag,
                    F.struct(
                        F.lit(name).alias("component"),
                        F.col(onset.get(name, "last_infra_state_at")).alias("onset_at"),
                    ),
                )
                for name, flag in component_flags(as_of_time, timing).items()
            ]
        )
    )
    return state.select("factory_id", "risk_level", F.inline(items)).orderBy(
        rules.level_rank(F.col("risk_level")), F.col("onset_at").desc_nulls_last(), "factory_id", "component"
    )


def delivery_overview(inputs: DataFrame, as_of_time, timing: Timing = Timing()) -> DataFrame:
    """Delivery state of every site with its display label."""
    return with_delivery_status(inputs, as_of_time, timing).withColumn(
        "status_label", rules.status_label(F.col("status"))
    )


def level_minutes(scored: DataFrame, slice_seconds: int) -> DataFrame:
    """Runs of one risk level per site with start, end and duration."""
    series = Series(("factory_id",), ("source_timestamp", "message_id"), slice_seconds)
    return run_durations(scored, series, "risk_level")


def daily_ops_summary(scored: DataFrame, empty: DataFrame, sample_seconds: int, slice_seconds: int) -> DataFrame:
    """Per site and day: score range, time per level, level changes, uncertain
    AI rows, empty time and the most frequent first cause.

    `empty` has empty_seconds per factory_id and day (`gaps.empty_seconds_by_day`),
    `sample_seconds` is the time one message stands for.
    """
    series = Series(("factory_id",), ("source_timestamp", "message_id"), slice_seconds)
    ai = F.greatest("ai_result.fire_score", "ai_result.fall_score", "ai_result.bend_score")
    rows = with_previous(
        scored.select(
            "factory_id",
            *series.order,
            "risk_score",
            "risk_level",
            rules.ai_band(ai).alias("ai_band"),
            F.get("top_causes", F.lit(0))["name"].alias("first_cause"),
        ),
        series,
        ["risk_level"],
    ).withColumn("day", F.date_format("source_timestamp", "yyyy-MM-dd"))
    # One row per site, day and first cause, then folded: the second step sees
    # a handful of rows per day.
    per_cause = rows.groupBy("factory_id", "day", "first_cause").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("risk_score").alias("lo"),
        F.max("risk_score").alias("hi"),
        F.sum("risk_score").alias("total"),
        *[F.count_if(F.col("risk_level") == lv).alias(lv) for lv in C.LEVEL_LABELS],
        F.count_if(F.col("risk_level") != F.col("prev_risk_level")).alias("changes"),
        F.count_if(F.col("ai_band") == "warning").alias("uncertain"),
    )
    minutes = lambda c: (F.sum(c) * sample_seconds / 60).alias(f"{c}_minutes")
    days = per_cause.groupBy("factory_id", "day").agg(
        F.sum("n").alias("messages"),
        F.min("lo").alias("min_score"),
        (F.sum("total") / F.sum("n")).alias("mean_score"),
        F.max("hi").alias("max_score"),
        *[minutes(lv) for lv in C.LEVEL_LABELS],
        F.sum("changes").alias("level_changes"),
        F.sum("uncertain").alias("uncertain_rows"),
        F.min_by(
            "first_cause", F.when(F.col("first_cause").isNotNull(), F.struct(-F.col("n"), "first_cause"))
        ).alias("main_cause"),
    )
    gaps = empty.select("factory_id", "day", F.col("empty_seconds").alias("gap_seconds"))
    return days.join(gaps, ["factory_id", "day"], "left").fillna({"gap_seconds": 0})



def risk_input_summary(
    latest: DataFrame, inputs: DataFrame, gaps: DataFrame, factories: DataFrame, as_of_time, timing: Timing = Timing()
) -> DataFrame:
    """The seven inputs of a risk judgement, one row per site.

    `latest` is the current state, `gaps` the longest empty run per site.
    """
    now = clock.as_timestamp(as_of_time)
    status = with_delivery_status(inputs, as_of_time, timing).select("factory_id", F.col("status").alias("pipeline_status"))
    spots = factories.select("factory_id", "preferred_node", "failover_node")

    def all_on(node: str) -> Column:
        return F.forall("workloads", lambda w: (w.status == "Running") & (w.node_id == F.col(node)))

    rows = (
        latest.join(status, "factory_id", "left")
        .join(gaps.select("factory_id", F.col("max_empty_seconds").alias("data_gap_seconds")), "factory_id", "left")
        .join(spots, "factory_id", "left")
    )
    return rows.select(
        "factory_id",
        clock.age_seconds(now, F.col("last_factory_state_at")).alias("sensor_freshness"),
        F.col("workload_summary.unhealthy").alias("workload_health"),
        F.when(all_on("preferred_node"), "preferred")
        .when(all_on("failover_node"), "failover")
        .otherwise("mixed")
        .alias("failover_state"),
        "pipeline_status",
        "data_gap_seconds",
        clock.age_seconds(now, F.col("last_infra_state_at")).alias("infra_state"),
        F.concat_ws("/", F.col("node_summary.ready"), F.col("node_summary.total")).alias("edge_node_status"),
    )
