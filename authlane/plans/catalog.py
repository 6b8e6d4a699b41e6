"""All registered queries and their reference SQL."""

from __future__ import annotations

from authlane.plans import lane_queries, report_queries, rule_queries  # noqa: F401
from authlane.plans.registry import ORACLES, QUERIES, Query

__all__ = ["ORACLES", "QUERIES", "Query"]
