"""Identifiers, topics, object keys and store keys as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def iso(ts) -> Column:
    """UTC ISO-8601 text with second precision; text order is time order."""
    return F.date_format(ts, ISO_SECONDS)


def parse_iso(text) -> Column:
    return F.try_to_timestamp(text)


def message_id(factory, source_type, node, timestamp_text) -> Column:
    return F.concat_ws(":", factory, source_type, node, timestamp_text)


def message_id_parts(col) -> Column:
    """[factory, source type, node, timestamp]; the timestamp keeps its colons."""
    return F.split(col, ":", 4)


def topic(root: str, factory, source_type) -> Column:
    return F.concat_ws("/", F.lit(root), factory, source_type)


def topic_part(col, position: int) -> Column:
    return F.try_element_at(F.split(col, "/"), F.lit(position))


def object_key(prefix: str, parts, ts, name, hours: bool = False) -> Column:
    """`prefix/part/.../yyyy=/mm=/dd=[/hh=]/name.json` in UTC."""
    day = "'yyyy='yyyy'/mm='MM'/dd='dd"
    return F.concat_ws(
        "/",
        F.lit(prefix),
        *parts,
        F.date_format(ts, day + ("'/hh='HH" if hours else "")),
        F.concat(name, F.lit(".json")),
    )


def partition_key(factory) -> Column:
    return F.concat(F.lit("FACTORY#"), factory)


def history_sort_key(kind: str, ts) -> Column:
    return F.concat(F.lit(f"HISTORY#{kind}#"), iso(ts))


LATEST_SORT_KEY = "LATEST"
