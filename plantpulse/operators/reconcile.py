"""Two archives compared from the top: days, then hours, then messages.

A branch (site and day, site and hour) is summed up by its number of messages and
an order-free checksum of ids and compared fields. Only branches that differ are
opened: the rows of equal ones meet neither a shuffle by hour nor one by id. Equal
archives cost two aggregates with one row per site and day. Where the tables are
partitioned by the branch columns, the join with the differing branches prunes
what is read.

An id that occurs with different values on one side is reported as such and not
compared by a value that happens to be smallest. Copies with equal values count
once; without `copies` the caller says that there are none.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantpulse.functions import clock

DAY, HOUR = ("factory_id", "day"), ("factory_id", "day", "hour")


def prepared(df: DataFrame, compare: Sequence[str], ts: str = "source_timestamp", copies: bool = True) -> DataFrame:
    """factory_id, day, hour, message_id and a 128-bit mark of the compared values."""
    marks = F.struct(F.xxhash64("message_id", *compare).alias("a"), F.xxhash64(F.lit(1), *compare, "message_id").alias("b"))
    rows = df.select(
        "factory_id",
        F.date_format(ts, "yyyy-MM-dd").alias("day"),
        F.hour(clock.bucket_start(ts, 3600)).alias("hour"),
        "message_id",
        marks.alias("mark"),
    )
    return rows.distinct() if copies else rows


def branch_sums(rows: DataFrame, branch: Sequence[str]) -> DataFrame:
    """Messages and checksum of every branch."""
    wide = lambda c: F.sum(F.col(c).cast("decimal(38,0)"))
    return rows.groupBy(*branch).agg(F.count(F.lit(1)).alias("n"), wide("mark.a").alias("a"), wide("mark.b").alias("b"))


def differing(left: DataFrame, right: DataFrame, branch: Sequence[str]) -> DataFrame:
    """Branches that the two sides do not have alike."""
    sides = [
        branch_sums(rows, branch).select(*branch, F.struct("n", "a", "b").alias(name)) for rows, name in ((left, "l"), (right, "r"))
    ]
    joined = sides[0].join(sides[1], list(branch), "full_outer")
    return joined.where(~F.col("l").eqNullSafe(F.col("r"))).select(*branch)


def reconcile_branches(left: DataFrame, right: DataFrame) -> DataFrame:
    """message_id and outcome of every message that is not equal on both sides (see `prepared`).

    missing: only on the left; extra: only on the right; differing: other values;
    contradicting: one side holds several values of the id.
    """
    days = differing(left, right, DAY)
    sides = [rows.join(days, list(DAY), "left_semi") for rows in (left, right)]
    hours = differing(*sides, HOUR)
    opened = [rows.join(hours, list(HOUR), "left_semi") for rows in sides]
    per_id = [
        rows.groupBy("message_id").agg(F.min("mark").alias(name), (F.min("mark") != F.max("mark")).alias(f"{name}_many"))
        for rows, name in zip(opened, "lr", strict=True)
    ]
    joined = per_id[0].join(per_id[1], "message_id", "full_outer")
    many = F.coalesce("l_many", F.lit(False)) | F.coalesce("r_many", F.lit(False))
    outcome = (
        F.when(many, "contradicting")
        .when(F.col("r").isNull(), "missing")
        .when(F.col("l").isNull(), "extra")
        .when(F.col("l") != F.col("r"), "differing")
    )
    return joined.select("message_id", outcome.alias("outcome")).where("outcome is not null")
