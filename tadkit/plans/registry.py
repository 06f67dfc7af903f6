"""Named, checkable queries over the fixture tables.

Each entry is ``name -> (fn(spark, sf_dir) -> DataFrame, duckdb_sql | None)``.
Names follow ``<inventory id>_<short name>``.  The SQL text is the
independent formulation used as the correctness oracle; both sides alias
every computed column identically.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

REGISTRY: dict[str, tuple[QueryFn, str | None]] = {}


def query(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


def load_all() -> dict[str, tuple[QueryFn, str | None]]:
    # Importing the modules fills REGISTRY.
    from tadkit.plans import (  # noqa: F401
        q_sources, q_frame, q_joins, q_agg, q_windows, q_quality, q_stats,
        q_models, q_segment, q_text, q_jobs,
    )
    return REGISTRY
