"""Registry binding operators to harness tables.

Each registered query is ``fn(spark, sf_dir) -> DataFrame`` and may carry an
oracle: an ANSI SQL string DuckDB runs over the same parquet tables.  Queries
without an oracle (random, iterative or streaming operators) are checked on
rows and invariants in ``tests/``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    fn: QueryFn
    sql: str | None
    section: str


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None = None, section: str = "") -> Callable[[QueryFn], QueryFn]:
    def deco(fn: QueryFn) -> QueryFn:
        if name in REGISTRY:
            raise ValueError(f"query {name!r} registered twice")
        REGISTRY[name] = Query(name, fn, sql.strip() if sql else None, section)
        return fn
    return deco


def load_all() -> dict[str, Query]:
    # Import for side effects: each module registers its queries.
    from quarry.plans import (  # noqa: F401
        q_sources, q_relational, q_joins, q_aggregates, q_windows, q_reshape,
        q_text, q_datetime, q_math_geo, q_stats, q_timeseries, q_graph, q_ml,
        q_streaming,
    )
    return REGISTRY
