"""Registered queries, each next to the SQL that must give the same rows."""

from plantpulse.plans.catalog import (  # noqa: F401
    contract_checks,
    drills,
    fleet,
    infrastructure,
    ingest,
    risk,
    series,
    streams,
)
from plantpulse.plans.catalog.registry import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
