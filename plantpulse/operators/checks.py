"""Ingest projections, contract checks, normalisation and deduplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plantpulse import contract as C
from plantpulse.functions import clock, text
from plantpulse.operators import distributions
from plantpulse.operators.sliced import Series, state_runs
from plantpulse.operators.gaps import missing_buckets

CORRUPT = "corrupt_record"
PARSED = T.StructType(C.RAW_MESSAGE.fields + [T.StructField(CORRUPT, T.StringType(), True)])


# --- topic rule ----------------------------------------------------------------------
def filter_topic(df: DataFrame, root: str, factory: str | None = None, topic: str = "topic") -> DataFrame:
    """Keep `root/<factory>/<one level>`; `factory=None` accepts any site."""
    parts = F.split(topic, "/")
    keep = (F.size(parts) == 3) & (F.get(parts, F.lit(0)) == root)
    if factory is not None:
        keep &= F.get(parts, F.lit(1)) == factory
    return df.where(keep)


def ingest_projection(df: DataFrame, received_at: Column | None = None, topic: str = "topic") -> DataFrame:
    """All fields, source_type from the third topic level, receipt in epoch ms.

    Pass `received_at` where the arrival time is known; only a live stream
    should fall back to the clock.
    """
    arrival = F.current_timestamp() if received_at is None else received_at
    return df.withColumn("source_type", text.topic_part(topic, 3)).withColumn(
        "received_at", F.unix_millis(arrival)
    )


def assign_message_id(df: DataFrame) -> DataFrame:
    """Keep a given id, else hash the content so that retries get the same id."""
    content = [c for c in df.columns if c not in ("message_id", "received_at")]
    fallback = F.sha2(F.to_json(F.struct(*content)), 256)
    return df.withColumn("message_id", F.coalesce("message_id", fallback))


# --- parse ------------------------------------------------------------------------------
def parse_messages(df: DataFrame, body: str = "body") -> DataFrame:
    """JSON text -> typed columns; text that does not parse is kept aside.

    Columns beside `body` pass through.  The corrupt text is in CORRUPT.
    """
    parsed = F.from_json(body, PARSED, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    others = [c for c in df.columns if c != body]
    return df.withColumn("_m", parsed).select(*others, "_m.*")


def to_body(messages: DataFrame) -> Column:
    """Compact JSON text of a typed message."""
    return F.to_json(
        F.struct(*[f.name for f in C.MESSAGE.fields]),
        {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"},
    )


# --- normalise --------------------------------------------------------------------------
# Accepted other names of a reading, and the name they become.
READING_ALIASES = {
    "temperature_celsius_avg": ("temperature_c", "temperature_celsius", "temperature"),
    "humidity_percent_avg": ("humidity_percent", "humidity"),
    "pressure_hpa_avg": ("pressure_hpa", "pressure"),
}


def normalize_readings(df: DataFrame) -> DataFrame:
    """Unify reading names and cast text to numbers; unreadable becomes null."""
    out = df
    for name, aliases in READING_ALIASES.items():
        present = [c for c in (name, *aliases) if c in df.columns]
        if present:
            value = F.coalesce(*[F.col(c).try_cast("double") for c in present])
            out = out.withColumn(name, value).drop(*[c for c in present if c != name])
    return out


def apply_null_policy(factory_rows: DataFrame) -> DataFrame:
    """An unread sensor or model has count 0 and null values; silence is ''."""
    def cleared(section: str, names: Sequence[str]) -> Column:
        count = F.coalesce(F.col(f"{section}.sample_count"), F.lit(0))
        return F.struct(
            count.alias("sample_count"),
            *[F.when(count > 0, F.col(f"{section}.{n}")).alias(n) for n in names],
            *(
                [F.coalesce(F.col("ai_result.abnormal_sound"), F.lit("")).alias("abnormal_sound")]
                if section == "ai_result"
                else []
            ),
        )

    return factory_rows.withColumn("sensor", cleared("sensor", C.SENSOR.names[1:])).withColumn(
        "ai_result", cleared("ai_result", ("fire_score", "fall_score", "bend_score"))
    )


def device_policy(infra_rows: DataFrame) -> DataFrame:
    """Every known device has an entry; a missing one is unavailable."""
    entries = [
        part
        for d in C.DEVICES
        for part in (
            F.lit(d),
            F.struct(
                F.coalesce(F.col("devices")[d]["available"], F.lit(False)).alias("available"),
                F.col("devices")[d]["last_seen_at"].alias("last_seen_at"),
            ),
        )
    ]
    return infra_rows.withColumn("devices", F.create_map(*entries))


# --- validate ---------------------------------------------------------------------------
def required_errors(columns: Sequence[str] = C.REQUIRED_FIELDS) -> Column:
    """Names of missing required fields, as `missing:<field>`."""
    return F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(f"missing:{c}")) for c in columns]))


def domain_errors(nodes: Column | None = None) -> Column:
    """Enumerated fields with a value outside their domain, as `domain:<field>`.

    `nodes`: names that the configuration gives the site's nodes; they are as
    good as the fixed ones.
    """
    domains = {
        "environment_type": C.ENVIRONMENT_TYPES,
        "input_module_type": C.INPUT_MODULE_TYPES,
        "source_type": C.SOURCE_TYPES,
        "node_id": C.NODE_IDS,
    }
    known = {c: F.col(c).isin(*values) for c, values in domains.items()}
    if nodes is not None:
        known["node_id"] |= F.coalesce(F.array_contains(nodes, F.col("node_id")), F.lit(False))
    return F.array_compact(F.array(*[F.when(~good, F.lit(f"domain:{c}")) for c, good in known.items()]))


def with_site_nodes(df: DataFrame, factories: DataFrame) -> DataFrame:
    """`site_nodes`: the nodes that the configuration declares for the site."""
    declared = factories.select(
        "factory_id", F.array_compact(F.array("preferred_node", "failover_node")).alias("site_nodes")
    )
    return df.join(declared, "factory_id", "left")


def with_errors(df: DataFrame, factories: DataFrame | None = None) -> DataFrame:
    """`errors` lists everything wrong with a message; empty means valid.

    With `factories`, nodes declared for a site are valid there.
    """
    if factories is not None:
        checked = with_site_nodes(df, factories)
        return _with_errors(checked, F.col("site_nodes")).drop("site_nodes")
    return _with_errors(df, None)


def _with_errors(df: DataFrame, nodes: Column | None) -> DataFrame:
    errors = F.concat(required_errors(), domain_errors(nodes))
    if CORRUPT in df.columns:
        broken = F.when(F.col(CORRUPT).isNotNull(), F.array(F.lit("corrupt"))).otherwise(
            F.array().cast("array<string>")
        )
        errors = F.concat(broken, errors)
    if "received_at" in df.columns and df.schema["received_at"].dataType == T.TimestampType():
        ahead = clock.age_seconds("source_timestamp", "received_at") > C.CLOCK_AHEAD_SECONDS
        errors = F.concat(errors, F.when(ahead, F.array(F.lit("clock_ahead"))).otherwise(F.array().cast("array<string>")))
    return df.withColumn("errors", errors)


def valid(df: DataFrame) -> DataFrame:
    return df.where(F.size("errors") == 0)


def rejected(df: DataFrame) -> DataFrame:
    """Invalid rows with one text naming the reasons."""
    return df.where(F.size("errors") > 0).withColumn("reason", F.concat_ws(",", "errors"))


def quarantine_split(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows); both are filters over the same scan."""
    checked = with_errors(df)
    return valid(checked).drop("errors"), rejected(checked)


def route_by_source_type(df: DataFrame) -> dict[str, DataFrame]:
    return {s: df.where(F.col("source_type") == s) for s in C.SOURCE_TYPES}


def _sections(messages: DataFrame, source_type: str, names: Sequence[str]) -> DataFrame:
    return (
        messages.where(F.col("source_type") == source_type)
        .select("*", *[F.col(f"payload.{n}").alias(n) for n in names])
        .drop("payload")
    )


def factory_rows(messages: DataFrame) -> DataFrame:
    """factory_state messages with their payload sections as columns."""
    return _sections(messages, "factory_state", C.FACTORY_SECTIONS)


def infra_rows(messages: DataFrame) -> DataFrame:
    """infra_state messages with their payload sections as columns."""
    return _sections(messages, "infra_state", C.INFRA_SECTIONS)


# --- identifiers -------------------------------------------------------------------------
def with_id_parts(df: DataFrame) -> DataFrame:
    parts = text.message_id_parts("message_id")
    names = ("id_factory", "id_source_type", "id_node", "id_timestamp")
    return df.select("*", *[F.get(parts, F.lit(i)).alias(n) for i, n in enumerate(names)])


def with_store_keys(df: DataFrame, kind: str, ts: str = "timestamp") -> DataFrame:
    """pk and sk of a current-state or history item."""
    sk = F.lit(text.LATEST_SORT_KEY) if kind == "LATEST" else text.history_sort_key(kind, ts)
    return df.withColumn("pk", text.partition_key(F.col("factory_id"))).withColumn("sk", sk)


# --- deduplicate ---------------------------------------------------------------------------
def dedup_messages(df: DataFrame, order: Sequence[str] = ("received_at", "published_at")) -> DataFrame:
    """First arrival per message_id.

    The rank filter keeps one row per id and map task before the shuffle, so
    a much repeated id does not gather its copies in one task.
    """
    first = Window.partitionBy("message_id").orderBy(*order)
    return df.withColumn("_copy", F.row_number().over(first)).where(F.col("_copy") == 1).drop("_copy")


def exact_duplicates(df: DataFrame, keys: Sequence[str] = ("message_id",)) -> DataFrame:
    """Keys written more than once, how often and by how many nodes."""
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("copies"), F.size(F.collect_set("node_id")).alias("writers"))
        .where(F.col("copies") > 1)
    )


def series_median(buckets: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Median of the non-zero bucket counts of each series, by way of a histogram."""
    counts = distributions.histogram(buckets.where(F.col("sample_count") > 0), keys, {"count": F.col("sample_count")}, 0)
    return distributions.statistics(counts, keys, {"median_count": 0.5}, resolution=0).select(*keys, "median_count")


def duplicate_write_candidates(buckets: DataFrame, keys: Sequence[str], factor: float = 2.0) -> DataFrame:
    """Buckets holding more than `factor` times the usual count of the series."""
    return buckets.join(series_median(buckets, keys), list(keys)).where(
        F.col("sample_count") > F.col("median_count") * factor
    )


# --- completeness ------------------------------------------------------------------------
def missing_samples(df: DataFrame, keys: Sequence[str], value: str, interval_seconds: int, ts: str = "ts") -> DataFrame:
    """Expected and missing buckets per series."""
    return missing_buckets(df, keys, value, interval_seconds, ts=ts)


def field_null_report(df: DataFrame, keys: Sequence[str], fields: dict[str, Column]) -> DataFrame:
    """Share of nulls per field: one aggregation, then one row per field."""
    shares = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("row_count"),
        *[F.avg(c.isNull().cast("int")).alias(n) for n, c in fields.items()],
    )
    pairs = F.array(*[F.struct(F.lit(n).alias("field"), F.col(n).alias("null_share")) for n in fields])
    return shares.select(*keys, "row_count", F.inline(pairs))


def continuity_check(df: DataFrame, series: Series, tolerance_seconds: int, at_least_seconds: int) -> DataFrame:
    """Longest stretch whose arrivals are never further apart than the tolerance."""
    stretches = state_runs(df, series, max_gap_seconds=tolerance_seconds)
    return (
        stretches.groupBy(*series.keys)
        .agg(F.max(clock.age_seconds("run_end", "run_start")).alias("longest_seconds"))
        .withColumn("continuous", F.col("longest_seconds") >= at_least_seconds)
    )
