"""Current state, summaries of infrastructure sections, and histories."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plantpulse import contract as C
from plantpulse.contract import Timing
from plantpulse.functions import clock, rules
from plantpulse.operators.checks import with_store_keys
from plantpulse.operators.sliced import Series, as_of, fill_forward, with_previous
from plantpulse.operators.timeseries import downsample_last

# The winner of two messages never depends on arrival order.
NEWEST = ("source_timestamp", "published_at", "message_id")
INFRA_FACTS = ("heartbeat", "nodes", "workloads", "devices")


# --- summaries (column expressions, no shuffle) -------------------------------------
def node_summary(nodes: Column) -> Column:
    ready = F.size(F.filter(nodes, lambda n: n.ready))
    return F.struct(
        F.size(nodes).alias("total"), ready.alias("ready"), (F.size(nodes) - ready).alias("not_ready")
    )


def workload_summary(workloads: Column) -> Column:
    running = F.size(F.filter(workloads, lambda w: (w.status == "Running") & w.ready))
    return F.struct(
        F.size(workloads).alias("total"),
        running.alias("running"),
        (F.size(workloads) - running).alias("unhealthy"),
        F.aggregate(
            workloads, F.lit(0).cast("bigint"), lambda acc, w: acc + F.coalesce(w.restart_count, F.lit(0))
        ).alias("restart_count_total"),
    )


def device_summary(devices: Column) -> Column:
    """Null where a device never reported."""
    return F.struct(*[devices[d]["available"].alias(f"{d}_available") for d in C.DEVICES])


def share(rows: Column, bad) -> Column:
    """Fraction of array elements that satisfy `bad`; 0 for an empty array."""
    n = F.size(rows)
    return F.when(n > 0, F.size(F.filter(rows, bad)) / n).otherwise(0.0)


# --- latest ---------------------------------------------------------------------------
def latest_per_factory(
    df: DataFrame, keys: Sequence[str] = ("factory_id", "source_type"), order: Sequence[str] = NEWEST
) -> DataFrame:
    """Newest row per key, in two steps.

    The newest time of every key is a hash aggregate over narrow columns; the join
    with it, broadcast while there are few keys, leaves the rows of that time, and
    only those are put in full order. Wide rows are neither sorted nor shuffled.
    `order` starts with a timestamp.
    """
    names = {k: f"_key_{n}" for n, k in enumerate(keys)}
    newest = df.groupBy(*[F.col(k).alias(name) for k, name in names.items()]).agg(
        F.max(F.unix_micros(order[0])).alias("_newest")
    )
    same = F.unix_micros(df[order[0]]).eqNullSafe(newest["_newest"])
    for k, name in names.items():
        same &= df[k].eqNullSafe(newest[name])
    last = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in order])
    return (
        df.join(newest, same)
        .select(*df.columns)
        .withColumn("_place", F.row_number().over(last))
        .where("_place = 1")
        .select(*keys, *[c for c in df.columns if c not in keys])
    )


def factory_section(factory: DataFrame) -> DataFrame:
    """Latest factory_state per site."""
    # Selected first: what a struct winner holds cannot be pruned later.
    last = latest_per_factory(factory.select("factory_id", *NEWEST, "sensor", "ai_result"), ("factory_id",))
    return last.select(
        "factory_id",
        F.col("source_timestamp").alias("last_factory_state_at"),
        F.col("message_id").alias("factory_message_id"),
        "sensor",
        "ai_result",
    )


def infra_section(infra: DataFrame) -> DataFrame:
    """Latest infra_state per site with its summaries."""
    last = latest_per_factory(infra.select("factory_id", *NEWEST, *INFRA_FACTS), ("factory_id",))
    return last.select(
        "factory_id",
        F.col("source_timestamp").alias("last_infra_state_at"),
        F.col("message_id").alias("infra_message_id"),
        "heartbeat",
        "nodes",
        "workloads",
        "devices",
        node_summary(F.col("nodes")).alias("node_summary"),
        workload_summary(F.col("workloads")).alias("workload_summary"),
        device_summary(F.col("devices")).alias("device_summary"),
    )


def assemble_latest(factory_latest: DataFrame, infra_latest: DataFrame) -> DataFrame:
    """Full outer join of the two sections: one row per site."""
    return factory_latest.join(infra_latest, "factory_id", "full_outer").withColumn(
        "updated_at", F.greatest("last_factory_state_at", "last_infra_state_at")
    )


def delivery_inputs(messages: DataFrame) -> DataFrame:
    """Latest infra receipt, latest stored object and last publish per site.

    Reads envelope columns only; one conditional aggregate replaces two joins.
    """
    infra = F.col("source_type") == "infra_state"
    return messages.groupBy("factory_id").agg(
        F.max(F.when(infra, F.col("received_at"))).alias("latest_infra_at"),
        F.max("received_at").alias("latest_raw_at"),
        F.max(F.when(infra, F.col("published_at"))).alias("last_publish_at"),
    )


def with_delivery_status(inputs: DataFrame, as_of_time, timing: Timing = Timing()) -> DataFrame:
    """Ages at `as_of_time` and the status they mean."""
    now = clock.as_timestamp(as_of_time)
    infra_age = clock.age_seconds(now, F.col("latest_infra_at"))
    return inputs.select(
        "*",
        infra_age.alias("latest_infra_state_age_seconds"),
        clock.age_seconds(now, F.col("latest_raw_at")).alias("latest_s3_raw_age_seconds"),
        rules.delivery_status(infra_age, timing).alias("status"),
        rules.missed_interval(infra_age, timing).alias("missed_interval"),
    )


def last_known(df: DataFrame, series: Series, sections: Sequence[str]) -> DataFrame:
    """Carry each section forward until the next message that brings it."""
    return fill_forward(df, series, sections)


def asof_infra(
    factory: DataFrame,
    infra: DataFrame,
    slice_seconds: int,
    tolerance_seconds: float | None = None,
    sections: Sequence[str] = INFRA_FACTS,
) -> DataFrame:
    """Every factory_state row with the newest infra state at or before it.

    `infra` is a struct of the time (`at`) and the wanted sections; name only
    those that are used, because a struct travels whole.
    """
    series = Series(("factory_id",), ("source_timestamp", "message_id"), slice_seconds)
    facts = infra.select(
        "factory_id",
        "source_timestamp",
        "message_id",
        F.struct(F.col("source_timestamp").alias("at"), *sections).alias("infra"),
    )
    out = as_of(factory, facts, series, "infra")
    if tolerance_seconds is not None:
        fresh = clock.age_seconds(F.col("source_timestamp"), F.col("infra.at")) <= tolerance_seconds
        out = out.withColumn("infra", F.when(fresh, F.col("infra")))
    return out


def collect_infra_state(nodes: DataFrame, workloads: DataFrame, window_seconds: int = 20) -> DataFrame:
    """Status rows -> one infra payload per site and window.

    Newest row per node and per workload first; what is collected is then as
    long as the cluster is wide.
    """
    def newest(df: DataFrame, entity: str, out: str) -> DataFrame:
        fields = [c for c in df.columns if c not in ("factory_id", "ts", "event_id")]
        return (
            df.groupBy("factory_id", clock.bucket_start("ts", window_seconds).alias("window_start"), entity)
            .agg(F.max_by(F.struct(*fields), F.struct("ts", "event_id")).alias("_item"))
            .groupBy("factory_id", "window_start")
            .agg(F.array_sort(F.collect_list("_item")).alias(out))
        )

    return newest(nodes, "node_id", "nodes").join(
        newest(workloads, "name", "workloads"), ["factory_id", "window_start"], "full_outer"
    )


# --- histories ------------------------------------------------------------------------
def last_per_bucket(factory: DataFrame, timing: Timing = Timing()) -> DataFrame:
    """The factory_state rows that history keeps: the last one per bucket.

    Scoring is a function of one row, so it comes after this reduction: a
    tenth of the messages at the published periods.
    """
    rows = factory.select("factory_id", *NEWEST, "received_at", "sensor", "ai_result")
    return downsample_last(rows, ["factory_id"], "source_timestamp", NEWEST, timing.history_bucket)


def risk_history(scored_last: DataFrame, timing: Timing = Timing(), ttl_seconds: int = C.HISTORY_TTL_SECONDS) -> DataFrame:
    """HISTORY#RISK from scored rows of `last_per_bucket`."""
    cols = scored_last.select(
        "factory_id",
        "bucket",
        "message_id",
        "risk_score",
        "risk_level",
        F.transform("top_causes", lambda c: c["name"]).alias("top_cause_names"),
    )
    return _history(cols, "RISK", timing.history_bucket, ttl_seconds)


def factory_history(last: DataFrame, timing: Timing = Timing(), ttl_seconds: int = C.HISTORY_TTL_SECONDS) -> DataFrame:
    """HISTORY#FACTORY from rows of `last_per_bucket`."""
    cols = last.select(
        "factory_id",
        "bucket",
        "message_id",
        *[F.col(f"sensor.{c}").alias(c) for c in C.SENSOR.names[1:]],
        *[F.col(f"ai_result.{c}").alias(c) for c in ("fire_score", "fall_score", "bend_score")],
    )
    return _history(cols, "FACTORY", timing.history_bucket, ttl_seconds)


def infra_history(
    infra: DataFrame,
    timing: Timing = Timing(),
    ttl_seconds: int = C.HISTORY_TTL_SECONDS,
    slice_seconds: int = 3600,
) -> DataFrame:
    """HISTORY#INFRA: every message; its status tells how late it came."""
    cols = infra.select(
        "factory_id",
        "source_timestamp",
        "published_at",
        "message_id",
        node_summary(F.col("nodes")).alias("node_summary"),
        "nodes",
        workload_summary(F.col("workloads")).alias("workload_summary"),
        device_summary(F.col("devices")).alias("device_summary"),
    )
    series = Series(("factory_id",), NEWEST, slice_seconds)
    age = clock.age_seconds("source_timestamp", "prev_source_timestamp")
    out = (
        with_previous(cols, series, ["source_timestamp"])
        .withColumn(
            "pipeline_status",
            F.struct(
                rules.delivery_status(F.coalesce(age, F.lit(0.0)), timing).alias("status"),
                age.alias("latest_infra_state_age_seconds"),
            ),
        )
        .drop("prev_source_timestamp")
        .withColumn("bucket", F.col("source_timestamp"))
    )
    return _history(out, "INFRA", timing.infra_bucket, ttl_seconds)


def _history(df: DataFrame, kind: str, bucket_seconds: int, ttl_seconds: int) -> DataFrame:
    keyed = with_store_keys(df.withColumnRenamed("bucket", "timestamp"), kind)
    return keyed.withColumns(
        {
            "schema_version": F.lit(C.SCHEMA_VERSION),
            "bucket_seconds": F.lit(bucket_seconds),
            "source": F.lit("as_received" if kind == "INFRA" else "last_value"),
            "ttl": clock.ttl("timestamp", ttl_seconds),
        }
    )
