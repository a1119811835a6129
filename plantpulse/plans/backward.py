"""Reading a history backwards, no further than an answer needs.

A change event compares a point with the one before it, so a range needs a few
points below its start. How far below is found by counting in windows that grow
by STEP, each a scan with a time predicate. The newest events of a fleet are
looked for in the same way: windows from the newest point backwards, until one
holds as many events as asked for; all that is left unread is older.

Readers are functions (start, end) -> rows, so that the predicate of the range
reaches the scan, and partitions and row groups outside it are not opened.
"""

from __future__ import annotations

from collections.abc import Callable, Collection
from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantpulse.contract import Timing
from plantpulse.operators import risk, state, timeline

Reader = Callable[[datetime | None, datetime | None], DataFrame]
FIRST = timedelta(days=1)
STEP = 4
_TICK = timedelta(microseconds=1)


def reach(read: Reader, ts: str = "source_timestamp") -> tuple[datetime | None, datetime | None]:
    """Oldest and newest time of a table: an aggregate of one column."""
    row = read(None, None).agg(*[F.date_format(f(ts), "yyyy-MM-dd HH:mm:ss.SSSSSS") for f in (F.min, F.max)]).first()
    return tuple(None if text is None else datetime.fromisoformat(text) for text in row)


def earlier_start(
    read: Reader, start: datetime, points: int, oldest: datetime, sites: Collection[str] | None = None, first: timedelta = FIRST
) -> datetime:
    """A time before which nothing is needed: from it on every site has `points` rows before `start`.

    `sites` are those that matter, by default those that occur in the window;
    a site whose rows are all later makes the search end at `oldest`.
    """
    width = first
    while True:
        low = start - width
        if low <= oldest:
            return oldest
        counts = {r.factory_id: r["count"] for r in read(low, start - _TICK).groupBy("factory_id").count().collect()}
        wanted = counts if sites is None else sites
        if wanted and all(counts.get(s, 0) >= points for s in wanted):
            return low
        width *= STEP


def timeline_between(
    read_factory: Reader,
    read_infra: Reader,
    thresholds: DataFrame,
    start: datetime,
    end: datetime,
    oldest: datetime,
    sites: Collection[str],
    slice_seconds: int,
    timing: Timing = Timing(),
) -> DataFrame:
    """All events from `start` to `end`, read from just below `start`."""
    # A bucket is labelled with its end, so its rows begin one bucket earlier.
    rows_from = start - timedelta(seconds=timing.history_bucket)
    last = state.last_per_bucket(read_factory(earlier_start(read_factory, rows_from, 1, oldest, sites), end), timing)
    scored = risk.score_messages(last, thresholds).select(
        "factory_id",
        F.col("bucket").alias("timestamp"),
        "message_id",
        "risk_level",
        "risk_score",
        F.transform("top_causes", lambda c: c["name"]).alias("top_cause_names"),
        *[F.col(f"sensor.{c}" if c.startswith("temperature") else f"ai_result.{c}").alias(c) for c in timeline.FACTORY_FACTS],
    )
    infra = read_infra(earlier_start(read_infra, start, 2, oldest, sites), end)
    events = timeline.site_events(scored, thresholds, slice_seconds).unionByName(
        timeline.infra_message_events(infra, slice_seconds, timing)
    )
    return events.where(F.col("timestamp").between(F.lit(start), F.lit(end)))


def newest_events(
    between: Callable[[datetime, datetime], DataFrame], n: int, oldest: datetime, newest: datetime, first: timedelta = FIRST
) -> DataFrame:
    """The newest `n` events; `between` gives the events of a range."""
    width = first
    while True:
        low = max(newest - width, oldest)
        found = between(low, newest)
        if low <= oldest or len(found.select("timestamp").limit(n).collect()) >= n:
            return timeline.newest_events(found, n)
        width *= STEP
