"""Registered queries: every operator applied to the given tables, with its SQL check."""

from __future__ import annotations

from rillstone.plans import (  # noqa: F401
    delivery_queries,
    join_queries,
    placement_queries,
    rolling_queries,
    row_queries,
    source_queries,
    split_queries,
    sql_queries,
    state_queries,
    stream_queries,
    window_queries,
)
from rillstone.plans.registry import CHECKS, QUERIES

__all__ = ["CHECKS", "QUERIES"]
