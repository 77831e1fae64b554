"""Query catalogue: every registered query with its DuckDB oracle statement.

``QUERIES[key](spark, sf_dir) -> DataFrame`` builds the query on the driver's
tables under ``sf_dir``; ``ORACLE[key]`` is the equivalent SQL over the same
tables (pre-registered views in DuckDB).  Keys without an oracle entry are
checked on rows only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fleetscope.plans.oracle import with_fixture

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(key: str, sql: str | None = None, extra_ctes: str = ""):
    """Decorator: register ``fn(spark, sf_dir)`` under ``key`` with its oracle SELECT."""
    def deco(fn: QueryFn) -> QueryFn:
        if key in QUERIES:
            raise KeyError(f"duplicate query key {key}")
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = with_fixture(sql, extra_ctes)
        return fn
    return deco


def _load_all() -> None:
    # Importing the modules runs their @register decorators.
    from fleetscope.plans import q_reports, q_mart, q_cleanse, q_io  # noqa: F401


_load_all()
