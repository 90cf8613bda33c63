"""All registered queries; importing the modules registers them."""

from __future__ import annotations

from tallyloom.plans import (  # noqa: F401
    chart_queries,
    cleaning_queries,
    governance_queries,
    jobs,
    model_queries,
    relational_queries,
    sequence_queries,
    source_queries,
    stream_queries,
)
from tallyloom.plans.registry import QUERIES, STATEMENTS

__all__ = ["QUERIES", "STATEMENTS"]
