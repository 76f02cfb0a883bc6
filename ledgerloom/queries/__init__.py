"""Queries over the given tables, each with an equivalent SQL statement where there is one."""

from ledgerloom.queries import (  # noqa: F401  (importing registers the queries)
    aggregates,
    expressions,
    joins,
    periods,
    reports,
    retail,
    scans,
    sinks,
    units,
)
from ledgerloom.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
