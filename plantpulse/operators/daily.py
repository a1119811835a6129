"""Day summaries that add up: parts per site, day and first cause, merged on read.

A part counts and sums what one set of messages contributes to a day. Parts of
different sets are merged by adding, so a micro-batch stores only the parts of
its own messages, a late message adds to its own day alone, and a batch that is
run again replaces its parts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantpulse import contract as C
from plantpulse.functions import rules

KEYS = ("factory_id", "date", "first_cause")
LEVELS = tuple(C.LEVEL_LABELS)


def day_parts(scored: DataFrame) -> DataFrame:
    """factory_id, date, first_cause and what the scored messages add to them."""
    ai = F.greatest("ai_result.fire_score", "ai_result.fall_score", "ai_result.bend_score")
    rows = scored.select(
        "factory_id",
        F.date_format("source_timestamp", "yyyy-MM-dd").alias("date"),
        F.get("top_causes", F.lit(0))["name"].alias("first_cause"),
        "risk_score",
        "risk_level",
        rules.ai_band(ai).alias("_band"),
    )
    return rows.groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("messages"),
        F.min("risk_score").alias("low"),
        F.max("risk_score").alias("high"),
        F.sum("risk_score").alias("total"),
        *[F.count_if(F.col("risk_level") == level).alias(level) for level in LEVELS],
        F.count_if(F.col("_band") == "warning").alias("uncertain"),
    )


def day_summaries(parts: DataFrame, sample_seconds: float) -> DataFrame:
    """Per site and day, from any number of parts: score range and mean, minutes per level, main cause.

    `sample_seconds` is the time that one message stands for. The main cause is
    the most frequent first cause, the first by name among equals.
    """
    sums = ("messages", "total", *LEVELS, "uncertain")
    per_cause = parts.groupBy(*KEYS).agg(F.min("low").alias("low"), F.max("high").alias("high"), *[F.sum(c).alias(c) for c in sums])
    named = F.when(F.col("first_cause").isNotNull(), F.struct(-F.col("messages"), "first_cause"))
    return per_cause.groupBy("factory_id", "date").agg(
        F.sum("messages").alias("messages"),
        F.min("low").alias("min_score"),
        (F.sum("total") / F.sum("messages")).alias("mean_score"),
        F.max("high").alias("max_score"),
        *[(F.sum(level) * sample_seconds / 60).alias(f"{level}_minutes") for level in LEVELS],
        F.sum("uncertain").alias("uncertain_rows"),
        F.min_by("first_cause", named).alias("main_cause"),
    )
