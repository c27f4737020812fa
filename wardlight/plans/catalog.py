"""All named queries."""

from __future__ import annotations

from wardlight.plans import events_queries, increment_queries, metrics_queries, questions, scores_queries, tables_queries, tiles_queries
from wardlight.plans.registry import QUERIES, run

MODULES = (tables_queries, increment_queries, scores_queries, events_queries, metrics_queries, tiles_queries, questions)
__all__ = ["MODULES", "QUERIES", "run"]
