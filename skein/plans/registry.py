"""Registry of the engine's own queries: name, plan and, where SQL can express it, DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def load() -> None:
    """Fill the registry; the modules that hold the queries register them as they are imported."""
    from . import capture_queries, queries, wide_queries  # noqa: F401
