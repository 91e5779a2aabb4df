"""Queries over the driver's tables, one for each operator, with SQL that says the same."""

from __future__ import annotations

from .base import QUERIES, SQL
from . import aggregates, domain, joins, lookups, relational, scalars  # noqa: F401  (they register themselves)

__all__ = ["QUERIES", "SQL"]
