"""The data processor: messages in, processed results, current state, histories out.

    messages -> checked -> rejects (rows without an event time among them)
                        -> valid -> per micro-batch, first copy of each message:
                             score by the rules in force -> processed/risk-score, processed/factory-state
                             infra -> processed/infra-state
                             current state of both sections, newest receipt and publish times
                             winners per bucket -> history; every infra message -> history
                             what the batch adds to the summaries of its days -> days
                             messages behind their site's time -> late, besides all that

No message is lost for coming late. Copies are recognised by the ids stored in
the hours that a batch touches: an id holds its message's time, so copies of a
message lie in the same hour of the same site.

All results of a micro-batch lie in folders of its own, so running a batch
again replaces them. Histories lie under date and site, then batch: a read of a
range opens its dates only, and a date whose rows have all expired is dropped
as a folder. Rules are asked for at every batch, so a change needs no restart.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import ExitStack
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from plantpulse import contract as C
from plantpulse.contract import Timing
from plantpulse.functions import clock, rules
from plantpulse.operators import checks, daily, risk, rulebook, state
from plantpulse.operators.sliced import Series, as_of
from plantpulse.operators.timeseries import downsample_last
from plantpulse.plans import backward
from plantpulse.sources import lake, latest
from plantpulse.sources.settings import Settings
from plantpulse.streaming import flows

SCORED = (
    "risk_score",
    "risk_level",
    "top_causes",
    "score_delta_10m",
    "displayed",
    "calculation_version",
    "calculated_at",
    "event_timestamp",
    "processed_at",
)
#: Rule states, or a function that reads them anew for every batch.
Rules = DataFrame | Callable[[SparkSession], DataFrame]
DELIVERY = ("latest_infra_at", "latest_raw_at", "last_publish_at")


def scored_messages(
    messages: DataFrame,
    thresholds: DataFrame,
    states: DataFrame | None = None,
    earlier: DataFrame | None = None,
    slice_seconds: int = 3600,
    timing: Timing = Timing(),
    processed_at: Column | None = None,
) -> DataFrame:
    """Factory messages with score, causes and the change of the score in ten minutes.

    Without rule states the fixed weights count. `earlier` has factory_id,
    source_timestamp, message_id and risk_score of what is stored already.
    """
    factory = checks.apply_null_policy(checks.factory_rows(messages))
    if states is None:
        scored = risk.score_messages(factory, thresholds).withColumn("displayed", F.lit(None).cast("array<string>"))
        if processed_at is not None:
            scored = scored.withColumn("processed_at", processed_at)
    else:
        scored = rulebook.score_by_rules(factory, thresholds, states, slice_seconds, processed_at)
    return with_delta(scored, earlier, slice_seconds, timing)


def with_delta(scored: DataFrame, earlier: DataFrame | None, slice_seconds: int, timing: Timing = Timing()) -> DataFrame:
    """score_delta_10m: score minus the newest score at least `delta_window` old.

    Null if that one is older than twice the window. What a late message would
    change about results already stored is left as it was.
    """
    series = Series(("factory_id",), ("source_timestamp", "message_id"), slice_seconds)
    point = ("factory_id", "source_timestamp", "message_id")
    past = scored.select(*point, "risk_score")
    if earlier is not None:
        past = past.unionByName(earlier.select(*point, "risk_score"))
    past = past.select(*point, F.struct(F.col("source_timestamp").alias("at"), F.col("risk_score").alias("score")).alias("_past"))
    then = F.col("source_timestamp") - F.make_dt_interval(secs=F.lit(timing.delta_window))
    found = as_of(scored, past, series, "_past", left_time=then)
    fresh = clock.age_seconds(F.col("source_timestamp"), F.col("_past.at")) <= 2 * timing.delta_window
    return found.withColumn("score_delta_10m", F.when(fresh, F.col("risk_score") - F.col("_past.score"))).drop("_past")


def results(messages: DataFrame, thresholds: DataFrame, scored: DataFrame | None = None) -> dict[str, DataFrame]:
    """The three processed datasets of a set of valid messages.

    The same function serves a micro-batch and a batch run over the archive.
    """
    scored = scored_messages(messages, thresholds) if scored is None else scored
    infra = checks.device_policy(checks.infra_rows(messages)).withColumn("event_timestamp", F.col("source_timestamp"))
    key = ("factory_id", *state.NEWEST, "event_timestamp")
    return {
        "risk-score": scored.select("factory_id", *state.NEWEST, *SCORED),
        "factory-state": scored.select(*key, "received_at", "sensor", "ai_result"),
        "infra-state": infra.select(
            *key,
            "heartbeat",
            "nodes",
            "workloads",
            "devices",
            state.node_summary(F.col("nodes")).alias("node_summary"),
            state.workload_summary(F.col("workloads")).alias("workload_summary"),
            state.device_summary(F.col("devices")).alias("device_summary"),
        ),
    }


def stored_scores(batch: DataFrame, root: str, batch_id: int, timing: Timing = Timing()) -> DataFrame | None:
    """Scores of earlier batches that the deltas of this one can need: only the hours concerned are read."""
    path = f"{root}/processed/risk-score"
    if lake.stored_batches(batch.sparkSession, path) is None:
        return None
    hours = F.sequence(
        F.date_trunc("hour", clock.plus_seconds("source_timestamp", -2 * timing.delta_window)),
        F.date_trunc("hour", "source_timestamp"),
        F.expr("interval 1 hour"),
    )
    touched = batch.where("source_type = 'factory_state'").select("factory_id", F.date_trunc("hour", "source_timestamp").alias("source_timestamp")).distinct()
    asked = touched.select("factory_id", F.explode(hours).alias("_hour")).distinct()
    asked = lake.with_date_parts(asked, "_hour", hours=True).select(*lake.PROCESSED_PARTITIONS)
    known = lake.stored_batches(batch.sparkSession, path, "source_timestamp timestamp, risk_score double")
    return known.where(F.col("batch") != batch_id).join(asked, list(lake.PROCESSED_PARTITIONS), "left_semi")


def delivery_times(messages: DataFrame, stored: DataFrame | None) -> DataFrame:
    """Newest receipt of infra, of anything, and newest publish per site, so far."""
    found = state.delivery_inputs(messages)
    if stored is None:
        return found
    both = stored.select("factory_id", *DELIVERY).unionByName(found)
    return both.groupBy("factory_id").agg(*[F.max(c).alias(c) for c in DELIVERY])


def first_copies(batch: DataFrame, root: str, batch_id: int) -> DataFrame:
    """Messages of the batch that no earlier batch has stored, one copy each.

    Of copies inside the batch the one received first stays. Only the hours
    that the batch touches are read of what is stored, and only their ids.
    """
    order = F.struct("received_at", "published_at")
    number = Window.partitionBy("message_id").orderBy(order)
    found = batch.withColumn("_copy", F.row_number().over(number)).where("_copy = 1").drop("_copy")
    parts = lake.with_date_parts(found, "source_timestamp", hours=True)
    touched = parts.select(*lake.PROCESSED_PARTITIONS).distinct()
    for name in ("factory-state", "infra-state"):
        known = lake.stored_batches(batch.sparkSession, f"{root}/processed/{name}")
        if known is not None:
            stored = known.where(F.col("batch") != batch_id).join(touched, list(lake.PROCESSED_PARTITIONS), "left_semi")
            found = found.join(stored.select("message_id"), "message_id", "left_anti")
    return found.select(*batch.columns)


def batch_writer(
    root: str,
    settings: Settings,
    timing: Timing = Timing(),
    tasks: int | None = None,
    states: Rules | None = None,
    slice_seconds: int = 3600,
) -> Callable[[DataFrame, int], None]:
    """Handler of one micro-batch of valid messages.

    Give `tasks` for a replay whose batches span very many hours, and `states`
    (see `rulebook.rule_states`) to score by configured rules.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        seen = latest.read_before(batch, f"{root}/latest/seen", batch_id)
        in_force = states(batch.sparkSession) if callable(states) else states
        now = F.lit(datetime.now().astimezone()).cast("timestamp")
        work = lambda name: f"{root}/work/{name}/batch={batch_id}"
        with ExitStack() as keeps:
            keep = lambda rows, name, dealt: keeps.enter_context(flows.kept_in_files(rows, work(name), dealt))
            if in_force is not None:
                # Of known size, so that the join with the messages can broadcast them.
                in_force = keep(in_force, "rules", False)
            messages = keep(first_copies(batch, root, batch_id), "messages", True)
            earlier = stored_scores(messages, root, batch_id, timing)
            made = scored_messages(messages, settings.thresholds, in_force, earlier, slice_seconds, timing, now)
            made = made.select("factory_id", *state.NEWEST, *SCORED, "received_at", *C.FACTORY_SECTIONS)
            # Rows of an hour lie together from here on: both datasets made of them need no shuffle.
            by_hour = lake.spread_over_folders(
                lake.with_date_parts(made, "event_timestamp", hours=True), lake.PROCESSED_PARTITIONS, tasks
            )
            scored = keep(by_hour.select(*made.columns), "scored", True)
            found = results(messages, settings.thresholds, scored)
            for name, rows in found.items():
                parts = lake.with_date_parts(rows, "event_timestamp", hours=True)
                if name == "infra-state":
                    parts = lake.spread_over_folders(parts, lake.PROCESSED_PARTITIONS, tasks)
                (
                    parts.write.mode("overwrite")
                    .partitionBy(*lake.PROCESSED_PARTITIONS)
                    .parquet(f"{root}/processed/{name}/batch={batch_id}")
                )
            for kind, name in (("RISK", "risk-score"), ("FACTORY", "factory-state")):
                winners = downsample_last(
                    found[name], ["factory_id"], "source_timestamp", state.NEWEST, timing.history_bucket
                )
                lake.write_history_batch(winners, f"{root}/history", kind, batch_id)
            lake.write_parts(daily.day_parts(scored), f"{root}/days", batch_id)
            infra = found["infra-state"].select("factory_id", *state.NEWEST, "nodes", "workloads", "devices")
            lake.write_history_batch(infra, f"{root}/history", "INFRA", batch_id)
            times = messages.select("factory_id", *state.NEWEST)
            _, late = flows.split_late(messages, times.limit(0) if seen is None else seen, timing)
            flows.write_batch(late, f"{root}/late", batch_id)
            latest.upsert_latest(scored.drop("received_at"), f"{root}/latest/factory", batch_id)
            latest.upsert_latest(found["infra-state"], f"{root}/latest/infra", batch_id)
            delivered = latest.read_before(batch, f"{root}/latest/delivery", batch_id)
            latest.write_version(delivery_times(messages, delivered), f"{root}/latest/delivery", batch_id)
            latest.upsert_latest(times, f"{root}/latest/seen", batch_id)

    return handle


def run(
    messages: DataFrame,
    root: str,
    settings: Settings,
    checkpoint: str,
    timing: Timing = Timing(),
    tasks: int | None = None,
    states: Rules | None = None,
    slice_seconds: int = 3600,
) -> list[StreamingQuery]:
    """Start the processor on a stream of parsed messages.

    Rejected rows have a query of their own: they may lack all that the
    processor goes by.
    """
    checked = checks.with_errors(messages, settings.factories)
    good = checks.valid(checked).drop("errors", checks.CORRUPT)
    rejects = flows.run_to_files(checks.rejected(checked), f"{root}/rejects", f"{checkpoint}/rejects")
    return [
        rejects,
        flows.run_batches(
            good, batch_writer(root, settings, timing, tasks, states, slice_seconds), f"{checkpoint}/processor"
        ),
    ]


def current_state(spark: SparkSession, root: str) -> DataFrame:
    """LATEST: both sections of every site, assembled on read."""
    factory = latest.read_latest(spark, f"{root}/latest/factory")
    infra = latest.read_latest(spark, f"{root}/latest/infra")
    return state.assemble_latest(
        factory.select(
            "factory_id",
            F.col("source_timestamp").alias("last_factory_state_at"),
            F.col("message_id").alias("factory_message_id"),
            "sensor",
            "ai_result",
            "risk_score",
            "risk_level",
            "top_causes",
            "score_delta_10m",
            "displayed",
            "calculated_at",
            "calculation_version",
            "aggregation_window_seconds",
        ),
        infra.select(
            "factory_id",
            F.col("source_timestamp").alias("last_infra_state_at"),
            F.col("message_id").alias("infra_message_id"),
            "heartbeat",
            "nodes",
            "workloads",
            "devices",
            "node_summary",
            "workload_summary",
            "device_summary",
        ),
    )


def latest_state(spark: SparkSession, root: str, as_of_time, timing: Timing = Timing()) -> DataFrame:
    """LATEST with `pipeline_status` and `dashboard`, as they are at `as_of_time`.

    A reading whose field the rules do not display is null in `shown`.
    """
    now = clock.as_timestamp(as_of_time)
    inputs = state.with_delivery_status(latest.read_latest(spark, f"{root}/latest/delivery"), now, timing)
    delivery = inputs.select(
        "factory_id",
        F.struct("status", "latest_infra_state_age_seconds", "latest_s3_raw_age_seconds").alias("pipeline_status"),
    )
    fields = [n for n, _ in C.MESSAGE_WEIGHTS]
    displayed = lambda f: F.col("displayed").isNull() | F.array_contains("displayed", f)
    reading = lambda f: F.col(f"{'sensor' if f in C.SENSOR.names else 'ai_result'}.{f}")
    return (
        current_state(spark, root)
        .join(delivery, "factory_id", "left")
        .withColumns(
            {
                "shown": F.struct(*[F.when(displayed(f), reading(f)).alias(f) for f in fields]),
                "dashboard": F.struct(
                    rules.level_label(F.col("risk_level")).alias("display_status"),
                    risk.status_summary_text(F.col("top_causes"), F.col("risk_level")).alias("summary"),
                    F.col("updated_at").alias("updated_at"),
                ),
            }
        )
    )


def latest_documents(latest_rows: DataFrame) -> DataFrame:
    """factory_id and the LATEST item of every site as one JSON text (see `latest_state`).

    A section that has never arrived is left out.
    """
    utc = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    causes = F.transform("top_causes", lambda c: F.struct(*[c[n].alias(n) for n in ("name", "value", "weight", "contribution")]))
    cut = lambda rows, names: F.transform(rows, lambda r: F.struct(*[r[n].alias(n) for n in names]))
    node = ("node_id", "ready", "cpu_usage_percent", "memory_usage_percent", "disk_usage_percent")
    risk_part = F.struct(
        F.col("risk_score").alias("score"),
        F.col("risk_level").alias("level"),
        "score_delta_10m",
        causes.alias("top_causes"),
        utc("calculated_at").alias("calculated_at"),
        "calculation_version",
    )
    site_part = F.struct(F.col("factory_message_id").alias("source_message_id"), "aggregation_window_seconds", "sensor", "ai_result")
    infra_part = F.struct(
        F.col("infra_message_id").alias("source_message_id"),
        "node_summary",
        cut("nodes", node).alias("nodes"),
        "workload_summary",
        "device_summary",
    )
    item = F.struct(
        F.concat(F.lit("FACTORY#"), "factory_id").alias("pk"),
        F.lit("LATEST").alias("sk"),
        "factory_id",
        F.lit(C.SCHEMA_VERSION).alias("schema_version"),
        utc("updated_at").alias("updated_at"),
        utc("last_factory_state_at").alias("last_factory_state_at"),
        utc("last_infra_state_at").alias("last_infra_state_at"),
        F.when(F.col("factory_message_id").isNotNull(), risk_part).alias("risk"),
        F.when(F.col("factory_message_id").isNotNull(), site_part).alias("factory_state"),
        F.when(F.col("infra_message_id").isNotNull(), infra_part).alias("infra_state"),
        "pipeline_status",
        F.struct("dashboard.display_status", "dashboard.summary", utc("dashboard.updated_at").alias("updated_at")).alias("dashboard"),
    )
    return latest_rows.select("factory_id", F.to_json(item).alias("document"))


def history(
    spark: SparkSession,
    root: str,
    kind: str,
    timing: Timing = Timing(),
    factory: str | None = None,
    start: datetime | None = None,
    end: datetime | None = None,
) -> DataFrame:
    """RISK, FACTORY or INFRA history, of one site or range if asked for.

    A bucket cut by a batch border has one winner; INFRA holds every message,
    and its status needs the message before, so a range is read from there.
    """
    def stored(low: datetime | None, high: datetime | None) -> DataFrame:
        rows = lake.read_history_batches(spark, f"{root}/history", kind, factory, low, high)
        return rows.drop("batch", "date", "bucket")

    if kind == "INFRA":
        low = None
        if start is not None:
            oldest, _ = backward.reach(lambda a, b: stored(a, b))
            low = backward.earlier_start(stored, start, 1, oldest) if oldest and oldest < start else start
        made = state.infra_history(stored(low, end), timing, slice_seconds=timing.history_bucket * 120)
    else:
        low = None if start is None else start - timedelta(seconds=timing.history_bucket)
        last = downsample_last(stored(low, end), ["factory_id"], "source_timestamp", state.NEWEST, timing.history_bucket)
        made = (state.risk_history if kind == "RISK" else state.factory_history)(last, timing)
    return lake.between(made, "timestamp", start, end)


def day_summaries(
    spark: SparkSession, root: str, timing: Timing = Timing(), start: datetime | None = None, end: datetime | None = None
) -> DataFrame:
    """Summaries per site and day of all batches so far; only the days asked for are read."""
    return daily.day_summaries(lake.read_parts(spark, f"{root}/days", start, end), timing.factory_period)


def expire_history(spark: SparkSession, root: str, as_of_time: datetime, ttl_seconds: int = C.HISTORY_TTL_SECONDS) -> list[str]:
    """Drop the dates whose rows have all outlived `ttl_seconds`; returns their folders.

    Rows of the border date that have expired are left to readers, which go by `ttl`.
    """
    cut = as_of_time - timedelta(seconds=ttl_seconds)
    return [f for kind in C.HISTORY_KINDS for f in lake.drop_dates(spark, f"{root}/history/{kind}", cut)]
