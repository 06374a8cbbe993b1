"""All registered queries; importing a module registers its queries."""

from __future__ import annotations

from pricelake.plans import (  # noqa: F401
    analytics_queries, bronze_queries, gold_queries, modelling_queries, operations_queries, silver_queries, timeline_queries,
)
from pricelake.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
