"""Registry of the queries exposed to the driver: Spark callable + oracle SQL.

Each callable takes ``(spark, sf_dir)`` and returns a DataFrame computed
from the whole given tables (or data Spark derives from them).  The oracle
is DuckDB SQL over the same tables, with the same column names.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from dockhand.session import read_table

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[QueryFn, str | None]] = {}


def query(name: str, oracle: str | None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in REGISTRY:
            raise ValueError(f"query {name} registered twice")
        REGISTRY[name] = (fn, oracle)
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, sf_dir, name)


def view(spark: SparkSession, sf_dir: str, name: str) -> str:
    """Register ``dh_<name>`` for the SQL-text operators; returns the view name."""
    v = f"dh_{name}"
    read_table(spark, sf_dir, name).createOrReplaceTempView(v)
    return v


def load_all() -> dict[str, tuple[QueryFn, str | None]]:
    # importing the modules registers their queries
    from dockhand.plans import q_files, q_flows, q_loads, q_scalars, q_sources, q_tables  # noqa: F401
    return REGISTRY
