"""All registered queries."""

from __future__ import annotations

from tidemark.plans import query_checks, query_events, query_flows, query_generic, query_growth, query_pnl, query_tables, query_tokens  # noqa: F401
from tidemark.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
