"""Query catalogue: name -> Spark plan builder, plus its DuckDB oracle SQL.

Every query reads whole driver tables (or data Spark derives from them).
Floats are rounded to 6 places on both sides so the comparison is about the
computation, not the summation order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


MODULES = ["lodestar.plans.q_graph", "lodestar.plans.q_text", "lodestar.plans.q_vectors", "lodestar.plans.q_kernel", "lodestar.plans.q_recsys", "lodestar.plans.q_ads", "lodestar.plans.q_community", "lodestar.plans.q_walks", "lodestar.plans.q_files", "lodestar.streaming.opinion"]


def load_all() -> None:
    """Import the query modules (importing registers their queries)."""
    import importlib
    for m in MODULES:
        importlib.import_module(m)
