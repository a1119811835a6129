"""Time helpers: epoch seconds, ages, buckets, display time."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_column(value) -> Column:
    return value if isinstance(value, Column) else F.col(value)


def seconds(ts) -> Column:
    """Epoch seconds with the fraction kept."""
    return F.unix_micros(ts) / F.lit(1000000)


def age_seconds(as_of, ts) -> Column:
    return (F.unix_micros(as_of) - F.unix_micros(ts)) / F.lit(1000000)


def bucket_start(ts, interval_seconds: int) -> Column:
    """Start of the epoch-aligned bucket `[start, start + interval)`."""
    step = interval_seconds * 1000000
    micros = F.unix_micros(ts)
    return F.timestamp_micros(micros - F.pmod(micros, F.lit(step)))


def bucket_label(ts, interval_seconds: int) -> Column:
    """A bucket is labelled with its end."""
    return bucket_start(ts, interval_seconds) + F.make_dt_interval(secs=F.lit(interval_seconds))


def plus_seconds(ts, secs) -> Column:
    s = secs if isinstance(secs, Column) else F.lit(secs)
    return as_column(ts) + F.make_dt_interval(secs=s.cast("decimal(18,6)"))


def ttl(ts, ttl_seconds: int) -> Column:
    return F.unix_seconds(ts) + F.lit(ttl_seconds)


def display_time(ts, zone: str = "Asia/Seoul") -> Column:
    return F.date_format(F.from_utc_timestamp(ts, zone), "yyyy-MM-dd HH:mm:ss")


def relative_age(as_of, ts) -> Column:
    """`N초 전`, the "N seconds ago" text of a card."""
    return F.concat(F.floor(age_seconds(as_of, ts)).cast("string"), F.lit("초 전"))


def as_timestamp(value) -> Column:
    """Column from an ISO text, a datetime, or a Column."""
    return value if isinstance(value, Column) else F.lit(value).cast("timestamp")
