"""The data processor in three micro-batches against one batch computation."""

import pytest
from pyspark.sql import functions as F

from plantpulse.contract import MESSAGE, Timing
from plantpulse.operators import checks, risk, state
from plantpulse.sources import feed, lake
from plantpulse.sources.settings import load_config
from plantpulse.streaming import flows, processor

TIMING = Timing().scaled(60)


@pytest.fixture(scope="module")
def done(spark, sf_dir, tmp_path_factory):
    """Three days of messages, delivered in three files, some of them broken."""
    home = str(tmp_path_factory.mktemp("processor"))
    days = F.col("source_timestamp").between("2024-01-02", "2024-01-05")
    messages = feed.load_messages(spark, sf_dir).where(days).cache()
    config = load_config(spark)
    names = [f.name for f in MESSAGE.fields]
    for start, end in (("2024-01-02", "2024-01-03"), ("2024-01-03", "2024-01-04"), ("2024-01-04", "2024-01-05")):
        part = messages.where((F.col("source_timestamp") >= start) & (F.col("source_timestamp") < end))
        body = part.select(checks.to_body(part).alias("value"))
        broken = part.where("event_id % 20 = 0").select(F.expr("substring(message_id, 1, 5)").alias("value"))
        body.unionByName(broken).coalesce(1).write.mode("append").text(f"{home}/in")
        source = checks.parse_messages(spark.readStream.text(f"{home}/in"), "value").select(
            *names, F.unix_micros("published_at").alias("_p"), checks.CORRUPT
        )
        source = source.withColumn("received_at", F.timestamp_micros("_p")).drop("_p")
        for q in processor.run(source, home, config, f"{home}/check", TIMING):
            q.awaitTermination()
    return home, messages, config


def test_current_state(spark, done):
    home, messages, config = done
    got = {r.factory_id: (r.factory_message_id, r.infra_message_id) for r in processor.current_state(spark, home).collect()}
    last = messages.groupBy("factory_id").agg(
        F.max_by("message_id", F.when(F.col("source_type") == "factory_state", F.col("source_timestamp"))).alias("f"),
        F.max_by("message_id", F.when(F.col("source_type") == "infra_state", F.col("source_timestamp"))).alias("i"),
    )
    assert got == {r.factory_id: (r.f, r.i) for r in last.collect()}


@pytest.mark.parametrize("kind", ["RISK", "FACTORY"])
def test_history(spark, done, kind):
    home, messages, config = done
    last = state.last_per_bucket(checks.factory_rows(messages), TIMING)
    if kind == "RISK":
        want = state.risk_history(risk.score_messages(last, config.thresholds), TIMING)
        cols = ["sk", "risk_score", "risk_level", "top_cause_names"]
    else:
        want = state.factory_history(last, TIMING)
        cols = ["sk", "temperature_celsius_avg", "fall_score"]
    cols = ["pk", *cols, "ttl"]
    rows = lambda df: sorted(map(repr, df.select(*cols).collect()))
    assert rows(processor.history(spark, home, kind, TIMING)) == rows(want)


def test_processed_and_rejects(spark, done):
    home, messages, _ = done
    counts = {n: spark.read.parquet(f"{home}/processed/{n}").count() for n in lake.PROCESSED_DATASETS}
    factory = messages.where("source_type = 'factory_state'").count()
    infra = messages.where("source_type = 'infra_state'").count()
    assert counts == {"risk-score": factory, "factory-state": factory, "infra-state": infra}
    rejects = spark.read.parquet(f"{home}/rejects")
    assert rejects.count() == messages.where("event_id % 20 = 0").count()
    assert all(r.reason.startswith("corrupt") for r in rejects.collect())


def test_batch_again_replaces_itself(spark, done):
    home, messages, config = done
    write = processor.batch_writer(f"{home}/again", config, TIMING)
    batch = messages.where("source_timestamp < '2024-01-03'")
    for _ in range(2):
        write(batch, 0)
    got = spark.read.parquet(f"{home}/again/processed/infra-state").count()
    assert got == batch.where("source_type = 'infra_state'").count()
    assert flows.latest.versions(spark, f"{home}/again/latest/infra") == [0]
