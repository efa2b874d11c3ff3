"""Registered queries: bindings onto the given tables and their SQL oracles."""

from tissueloom.plans import cell_queries, spot_queries  # noqa: F401
from tissueloom.plans.registry import QUERIES

__all__ = ["QUERIES"]
