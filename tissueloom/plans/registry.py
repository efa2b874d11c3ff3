"""The query registry."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    oracle: str | None


QUERIES: dict[str, Query] = {}


def query(name: str, oracle: str | None = None):
    """Register ``(spark, sf_dir) -> DataFrame`` under ``name`` with its SQL oracle."""

    def add(run):
        QUERIES[name] = Query(run, oracle)
        return run

    return add


def rd(expr: str, digits: int = 6) -> str:
    """Rounded double in the oracle, without negative zero."""
    return f"(CASE WHEN round({expr}, {digits}) = 0 THEN 0.0::DOUBLE ELSE round({expr}, {digits}) END)"
